"""Streaming jobs: silver, gold and alert queries from one message stream, and the notifier.

The three layer queries share one logical plan up to the enriched stream and
each keeps its own checkpoint (each re-reads the source, as independent
queries do). Static dimensions are joined stream-static, broadcast when
measured small.

Output modes:
  * silver: append to a parquet table;
  * gold keeps mergeable panes in its state (:mod:`meterlake.operators.gold`), never a set of meters in one row;
  * gold, ``mode="update"`` (the service default): every trigger merges only the panes it changed into a pane
    table partitioned by day, and readers roll the panes up into windows; state and storage stay bounded;
  * gold, ``mode="append"``: a window is written once, when the watermark
    passes its end; state stays bounded;
  * gold, ``mode="complete"``: every trigger rewrites the whole aggregate
    (the watermark then frees no state); it is written as a snapshot folder
    per batch id (idempotent on replay) and readers take the newest;
  * alerts: append, from the keyed stateful detector.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.errors import AnalysisException

from meterlake import params as P
from meterlake import schemas
from meterlake.functions import columns as C
from meterlake.operators import cleaning, enrich, gold, insights
from meterlake.operators.joins import DEFAULT_MAX_BROADCAST_BYTES
from meterlake.session import ROCKSDB, STATE_STORE, conf_scope, ship_package
from meterlake.sources.files import exists, folders, newest_committed, remove, utc_day
from meterlake.streaming.detector_state import Detector, make_detector


@dataclass
class Trigger:
    """``processing_time`` (e.g. ``"10 seconds"``) for a service, or ``available_now`` for a bounded run."""

    processing_time: str | None = None
    available_now: bool = False

    def apply(self, w):
        if self.available_now:
            return w.trigger(availableNow=True)
        if self.processing_time:
            return w.trigger(processingTime=self.processing_time)
        return w


SERVICE_SILVER = Trigger(processing_time="10 seconds")
SERVICE_GOLD = Trigger(processing_time="10 seconds")
SERVICE_ALERTS = Trigger()                       # as soon as possible
SERVICE_NOTIFY = Trigger(processing_time="5 seconds")
BOUNDED = Trigger(available_now=True)


def enriched_stream(messages: DataFrame, households: DataFrame, weather: DataFrame,
                    max_broadcast_bytes: int | None = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Messages -> silver rows (parse, clean, enrich with the static dimensions)."""
    payload = cleaning.parse_messages(messages)
    return enrich.enrich_silver(cleaning.clean_readings(payload), households, weather, max_broadcast_bytes)


def start_silver(silver: DataFrame, path: str, checkpoint: str, trigger: Trigger = SERVICE_SILVER,
                 fmt: str = "parquet", name: str | None = None, by_day: bool = False) -> StreamingQuery:
    """Append to the silver table; ``by_day`` partitions it by the UTC day of the reading, so that reports over a
    range of dates read only those days."""
    if by_day:
        silver = silver.withColumn("day", utc_day("timestamp"))
    w = (silver.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", path))
    if by_day:
        w = w.partitionBy("day")
    if name:
        w = w.queryName(name)
    return trigger.apply(w).start()


def _snapshot_writer(path: str, fmt: str, rolled):
    def write(batch: DataFrame, batch_id: int) -> None:
        # The complete result of this batch; overwriting the batch's own
        # folder makes a replayed batch idempotent.
        rolled(batch).write.mode("overwrite").format(fmt).save(f"{path}/snapshot={batch_id:020d}")
    return write


PANE_KEYS = ("pane", *gold.KEYS, "LCLid")


def merge_panes(spark: SparkSession, changes: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Put the panes a batch changed (whole rows) in place of their older rows in the pane table at ``path``.

    The days that hold changes are staged whole, old rows and new, and then
    replace those days' partitions; other days are not read. A batch that is replayed
    after its staging was committed only publishes it again, so a run that died
    while replacing days loses nothing. Older staged batches are dropped once this one
    is published, so storage is the table, one batch's days and its changes. While days are being
    replaced a reader may see some new and some old ones.
    """
    staged, table = f"{path}/staged/batch={batch_id:020d}", f"{path}/panes"
    if not exists(spark, f"{staged}/_SUCCESS"):
        given = f"{path}/changes/batch={batch_id:020d}"
        changes.withColumn("day", utc_day("pane.start")).write.mode("overwrite").format(fmt).save(given)
        new = spark.read.format(fmt).load(given)
        days = [r["day"] for r in new.select("day").distinct().collect()]  # one row a day
        if not days:
            return
        rows = new
        if exists(spark, table):
            old = spark.read.format(fmt).load(table).filter(F.col("day").isin(days)).select(*new.columns)
            keys = [k for k in PANE_KEYS if k in new.columns]
            known = new.select(*(F.col(k).alias(f"_{k}") for k in keys))
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
            rows = new.unionByName(old.join(known, same, "left_anti"))
        rows.write.mode("overwrite").format(fmt).save(staged)
    (spark.read.format(fmt).load(staged).repartition("day", *gold.KEYS).write.mode("overwrite").format(fmt)
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").save(table))
    for kind in ("staged", "changes"):
        for name in folders(spark, f"{path}/{kind}/batch=*"):
            if name != f"batch={batch_id:020d}" or kind == "changes":
                remove(spark, f"{path}/{kind}/{name}")


def _merge_writer(path: str, fmt: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        merge_panes(batch.sparkSession, batch, path, batch_id, fmt)
    return write


def start_gold(silver: DataFrame, path: str, checkpoint: str, mode: str = "update",
               trigger: Trigger = SERVICE_GOLD, watermark: str = P.WATERMARK, fmt: str = "parquet",
               exact_scale: int | str | None = None, meters: str = "approx",
               window: str = P.WINDOW, slide: str = P.SLIDE) -> StreamingQuery:
    """``exact_scale`` as in :func:`gold.gold_kpis`; ``meters="exact"`` keeps pane rows per meter and counts them."""
    by_meter, sums = meters == "exact", gold.sums_of(exact_scale)
    panes = gold.gold_panes(silver.withWatermark("timestamp", watermark), f"{gold.pane_seconds(window, slide)} seconds",
                            by_meter, sums)
    if mode == "complete":
        w = (panes.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(
            _snapshot_writer(path, fmt, lambda batch: gold.roll_windows(batch, window, slide, by_meter, sums))))
    elif mode == "append":
        w = (gold.window_stream(panes, window, slide, by_meter, sums).writeStream.outputMode("append").format(fmt)
             .option("checkpointLocation", checkpoint).option("path", path))
    elif mode == "update":
        w = (panes.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
             .foreachBatch(_merge_writer(path, fmt)))
    else:
        raise ValueError(f"gold mode must be complete, append or update, not {mode!r}")
    return trigger.apply(w).start()


def _read_or_empty(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:  # nothing written yet
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_gold(spark: SparkSession, path: str, mode: str = "update", fmt: str = "parquet",
              window: str = P.WINDOW, slide: str = P.SLIDE) -> DataFrame:
    """The live gold table: the windows rolled up from the pane table (update mode), the appended windows, or
    the newest snapshot (complete mode).

    Snapshots are folders ``snapshot=<batch id>``; the newest one with a
    commit mark is read, so a half-written snapshot is never live and older
    ones are not opened.
    """
    newest = newest_committed(spark, path) if mode == "complete" else None
    if mode == "complete" and newest is None:
        return spark.createDataFrame([], schemas.GOLD)
    df = _read_or_empty(spark, f"{path}/{newest}" if newest else f"{path}/panes" if mode == "update" else path, fmt)
    if df is None:
        return spark.createDataFrame([], schemas.GOLD)
    if mode != "update":
        return df
    return gold.roll_windows(df.drop("day"), window, slide, "LCLid" in df.columns,
                             "exact" if "load0" in df.columns else "plain")


def alert_stream(silver: DataFrame, p: P.DetectorParams = P.DEFAULT_DETECTOR,
                 watermark: str = P.WATERMARK, key: str = "LCLid", host: str = "group_state") -> DataFrame:
    """Stateful detector over the enriched stream (readings with known temperature).

    ``host``: ``group_state`` (``applyInPandasWithState``, the state travels with the rows) or
    ``value_state`` (``transformWithStateInPandas``, needs the RocksDB state store).
    """
    readings = (silver.filter(F.col("temperature").isNotNull() & C.usable_reading("consumption")
                              & F.col("timestamp").isNotNull())
                .withWatermark("timestamp", watermark)
                .select(F.col(key).cast("string").alias("LCLid"), "timestamp", "consumption",
                        F.col("temperature").cast("double").alias("temperature")))
    ship_package(silver.sparkSession)
    if host == "value_state":
        return readings.groupBy("LCLid").transformWithStateInPandas(
            Detector(p), schemas.ALERT, "append", "ProcessingTime" if p.timeout else "None")
    if host != "group_state":
        raise ValueError(f"host must be group_state or value_state, not {host!r}")
    return readings.groupBy("LCLid").applyInPandasWithState(
        make_detector(p), schemas.ALERT, schemas.DETECTOR_STATE, "append",
        "ProcessingTimeTimeout" if p.timeout else "NoTimeout")


def start_alerts(silver: DataFrame, path: str, checkpoint: str, p: P.DetectorParams = P.DEFAULT_DETECTOR,
                 trigger: Trigger = SERVICE_ALERTS, fmt: str = "parquet", key: str = "LCLid",
                 host: str = "group_state") -> StreamingQuery:
    a = alert_stream(silver, p, key=key, host=host)
    w = (a.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", path))
    store = {STATE_STORE: ROCKSDB} if host == "value_state" else {}
    with conf_scope(silver.sparkSession, store):
        return trigger.apply(w).start()


def notifications(alerts: DataFrame, min_value: float | None = None) -> DataFrame:
    """Projection of new alerts with the processing time."""
    return (insights.critical_alerts(alerts, min_value)
            .select("LCLid", "timestamp", "message", "temperature",
                    F.current_timestamp().alias("processed_at")))


def _notify_writer(path: str, fmt: str):
    def deliver(batch: DataFrame, batch_id: int) -> None:
        # Empty batches deliver nothing; a replayed batch id overwrites its own folder.
        if batch.isEmpty():
            return
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").format(fmt).save(f"{path}/batch={batch_id:020d}"))
    return deliver


def start_notify(spark: SparkSession, alerts_path: str, out_path: str, checkpoint: str,
                 min_value: float | None = None, trigger: Trigger = SERVICE_NOTIFY,
                 fmt: str = "parquet") -> StreamingQuery:
    """Stream the alert history and deliver each non-empty batch to the notification table."""
    from meterlake.streaming.sources import table_stream
    n = notifications(table_stream(spark, alerts_path, schemas.ALERT, fmt), min_value)
    w = n.writeStream.option("checkpointLocation", checkpoint).foreachBatch(_notify_writer(out_path, fmt))
    return trigger.apply(w).start()


def read_notifications(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    df = _read_or_empty(spark, path, fmt)
    if df is None:
        return spark.createDataFrame([], schemas.NOTIFICATION)
    return df.select(*[f.name for f in schemas.NOTIFICATION])


def start_layer_queries(spark: SparkSession, messages: DataFrame, households: DataFrame, weather: DataFrame,
                        root: str, p: P.DetectorParams = P.DEFAULT_DETECTOR, gold_mode: str = "update",
                        triggers: dict[str, Trigger] | None = None) -> dict[str, StreamingQuery]:
    """Start the silver, gold and alert queries over one message source.

    Each query re-reads the source and keeps its own checkpoint under
    ``root/checkpoints/<layer>``; outputs go to ``root/<layer>``. Wait with
    ``spark.streams.awaitAnyTermination()``: one query ending ends the service.
    """
    t = {"silver": SERVICE_SILVER, "gold": SERVICE_GOLD, "alerts": SERVICE_ALERTS, **(triggers or {})}
    silver = enriched_stream(messages, households, weather)
    return {
        "silver": start_silver(silver, f"{root}/silver", f"{root}/checkpoints/silver", t["silver"], by_day=True),
        "gold": start_gold(silver, f"{root}/gold", f"{root}/checkpoints/gold", gold_mode, t["gold"]),
        "alerts": start_alerts(silver, f"{root}/alerts", f"{root}/checkpoints/alerts", p, t["alerts"]),
    }
