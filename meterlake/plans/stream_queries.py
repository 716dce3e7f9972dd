"""Streaming queries, run as bounded replays.

The raw readings of the test tables are rendered as CSV lines, turned into
keyed JSON messages by the replay job and landed as message files under the
shared scratch folder (``spark.checkpoint.dir``). Each query then runs its
streaming plan over those files with ``availableNow`` (every file available
at start, then stop), writes to its sink with its own checkpoint, and
returns the sink read back as a batch DataFrame -- which has the same DuckDB
twin as the batch form.

Bounded replays run the detector without the processing-time timeout: with
that timeout Spark keeps scheduling empty batches to look for expired
state, so an ``availableNow`` run would never end. ``stream_alerts_expired`` has the
timeout: it runs by trigger and is stopped once its input is committed.
"""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake import schemas
from meterlake.functions import columns as C
from meterlake.operators import maintenance, replay
from meterlake.operators.joins import settle_all
from meterlake.plans import layers
from meterlake.plans import oracle as O
from meterlake.plans.queries import GOLD_KEYS, METER_PARAMS, join_gold, meters_close, register
from meterlake.session import app_key, conf_scope, scratch_path, state_partitions
from meterlake.sources import tables
from meterlake.streaming import enrich_join, jobs
from meterlake.streaming.sources import file_messages

_landed: dict[tuple, str] = {}


def land_messages(spark: SparkSession, sf: str) -> str:
    """Replay the raw readings into message files (the topic); returns their folder.

    Landed once per session and data folder: like the source's three
    queries on one topic, every streaming query of a session reads the same
    messages, each from its own checkpoint.
    """
    key = (app_key(spark), sf.rstrip("/"))
    path = _landed.get(key)
    if path is None:
        msgs = replay.replay_messages(tables.csv_lines(tables.readings_raw(spark, sf)))
        path = scratch_path(spark, "messages")
        replay.write_messages(msgs, path)
        _landed[key] = path
    return path


def _sized(spark: SparkSession, *paths: str) -> conf_scope:
    """Start a replay with state partitions sized from its input (see ``state_partitions``)."""
    size = sum(maintenance.layer_bytes(spark, p) for p in paths)
    return conf_scope(spark, {"spark.sql.shuffle.partitions": str(state_partitions(spark, size))})


def run_bounded(q) -> None:
    """Wait for the end of the input, however long it takes; a failed stream raises."""
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def enriched(spark: SparkSession, sf: str, msg_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    return jobs.enriched_stream(file_messages(spark, msg_dir, max_files_per_trigger=max_files_per_trigger),
                                layers.households(spark, sf), layers.weather(spark, sf))


def stream_silver_table(spark: SparkSession, sf: str) -> DataFrame:
    msg_dir = land_messages(spark, sf)
    out, ck = scratch_path(spark, "silver"), scratch_path(spark, "ck-silver")
    with _sized(spark, msg_dir):
        q = jobs.start_silver(enriched(spark, sf, msg_dir), out, ck, jobs.BOUNDED)
    run_bounded(q)
    return spark.read.schema(schemas.SILVER).parquet(out)


def stream_gold_table(spark: SparkSession, sf: str, mode: str, meters: str = "approx") -> DataFrame:
    msg_dir = land_messages(spark, sf)
    out, ck = scratch_path(spark, f"gold-{mode}"), scratch_path(spark, f"ck-gold-{mode}")
    with _sized(spark, msg_dir):
        q = jobs.start_gold(enriched(spark, sf, msg_dir), out, ck, mode=mode, trigger=jobs.BOUNDED,
                            exact_scale=layers.VALUE_SCALE, meters=meters)
    run_bounded(q)
    return jobs.read_gold(spark, out, mode)


def stream_alerts_table(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    msg_dir = land_messages(spark, sf)
    out, ck = scratch_path(spark, "alerts"), scratch_path(spark, "ck-alerts")
    p = METER_PARAMS.with_(timeout=None)
    with _sized(spark, msg_dir):
        q = jobs.start_alerts(enriched(spark, sf, msg_dir), out, ck, p, jobs.BOUNDED)
    run_bounded(q)
    return spark.read.schema(schemas.ALERT).parquet(out), out


def stream_alerts_resumed_table(spark: SparkSession, sf: str, slices: int = 4) -> DataFrame:
    """The detector over messages that arrive in time order, started twice from one checkpoint.

    Half of the time slices are published before each start, and the cap on
    files per micro-batch is the smallest slice, so the state crosses at
    least ``slices`` micro-batches and a restart.
    """
    msgs = replay.replay_messages(tables.csv_lines(tables.readings_raw(spark, sf)))
    parts = replay.time_slices(msgs, scratch_path(spark, "slices"), slices)
    msg_dir, out, ck = (scratch_path(spark, n) for n in ("messages-ordered", "alerts-resumed", "ck-alerts-resumed"))
    p = METER_PARAMS.with_(timeout=None)
    # both starts read dimensions written once: each is an aggregate over a whole base table
    homes, hours = (s.frame for s in settle_all([layers.households(spark, sf), layers.weather(spark, sf)]))
    published = 0
    for half in (parts[:slices // 2], parts[slices // 2:]):
        sizes = []
        for part in half:
            replay.write_messages(part, msg_dir)
            total = len(spark.read.schema(schemas.MESSAGE).parquet(msg_dir).inputFiles())
            sizes.append(total - published)
            published = total
        with _sized(spark, msg_dir):
            messages = file_messages(spark, msg_dir, max_files_per_trigger=max(1, min(sizes)))
            q = jobs.start_alerts(jobs.enriched_stream(messages, homes, hours), out, ck, p, jobs.BOUNDED)
        run_bounded(q)
    return spark.read.schema(schemas.ALERT).parquet(out)


IDLE_PARAMS = METER_PARAMS.with_(calibration=12, timeout="3 seconds")


def run_to_offset(q, offset: int) -> None:
    """Wait until a micro-batch has committed the file source's log ``offset``, then stop the query.

    A query with state that expires by the clock schedules batches for ever, so it never ends by itself.
    """
    while q.isActive:
        done = q.lastProgress
        end = re.search(r"logOffset\W+(\d+)", str(done["sources"][0]["endOffset"])) if done else None
        if end and int(end[1]) >= offset:
            break
        time.sleep(0.2)
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    q.stop()


def stream_alerts_expired_table(spark: SparkSession, sf: str, host: str = "value_state") -> DataFrame:
    """The detector over two halves of history, with a pause beyond the idle timeout and a restart between them."""
    msgs = replay.replay_messages(tables.csv_lines(tables.readings_raw(spark, sf)))
    whole = scratch_path(spark, "messages-whole")
    replay.write_messages(msgs, whole)
    msgs = spark.read.schema(schemas.MESSAGE).parquet(whole)
    times = C.parse_reading_ts(F.from_json("value", schemas.PAYLOAD)["tstp"])
    span = layers.readings(spark, sf).agg(F.unix_micros(F.min("timestamp")).alias("a"), F.unix_micros(F.max("timestamp")).alias("b"))
    cut = span.select(F.date_trunc("day", F.timestamp_micros(F.floor((F.col("a") + F.col("b")) / 2)))).scalar()
    early = F.coalesce(times < cut, F.lit(True))
    msg_dir, out, ck = (scratch_path(spark, n) for n in ("messages-halves", "alerts-expired", "ck-alerts-expired"))
    for number, half in enumerate((msgs.filter(early), msgs.filter(~early))):
        replay.write_messages(half, msg_dir)
        with _sized(spark, msg_dir):
            q = jobs.start_alerts(enriched(spark, sf, msg_dir), out, ck, IDLE_PARAMS, jobs.Trigger("200 milliseconds"), host=host)
        run_to_offset(q, number)
        time.sleep(5.0)  # longer than the idle timeout
    return spark.read.schema(schemas.ALERT).parquet(out)


@register("replay_to_json", O.sql("""
SELECT trim(f[1]) AS key,
       json_object('LCLid', trim(f[1]), 'tstp', trim(f[2]), 'energy', trim(f[3]))::VARCHAR AS value
FROM (SELECT string_split(regexp_replace(LCLid || ',' || tstp || ',' || coalesce("energy(kWh/hh)", ''), ',+$', ''), ',')
             AS f FROM readings_raw) t
WHERE len(f) = 3""", "readings_raw"))
def q_replay_to_json(spark: SparkSession, sf: str) -> DataFrame:
    return replay.replay_messages(tables.csv_lines(tables.readings_raw(spark, sf)))


@register("parse_readings", O.sql("""
SELECT LCLid, tstp, "energy(kWh/hh)" AS energy FROM readings_raw
WHERE coalesce("energy(kWh/hh)", '') <> ''""", "readings_raw"))
def q_parse_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Replayed messages with a binary value (as a broker delivers them) decoded back to payload columns."""
    from meterlake.operators import cleaning
    msgs = replay.replay_messages(tables.csv_lines(tables.readings_raw(spark, sf)))
    return cleaning.parse_messages(msgs.select("key", F.col("value").cast("binary").alias("value")))


@register("stream_silver", O.sql("SELECT * FROM silver", "silver"))
def q_stream_silver(spark: SparkSession, sf: str) -> DataFrame:
    return layers.to_ntz(stream_silver_table(spark, sf))


@register("stream_gold", O.sql("""
SELECT window_start, window_end, acorn_group, precipType, avg_consumption, total_load, avg_temp, TRUE AS meters_close
FROM gold""", "gold"))
def q_stream_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Complete-mode gold; its HyperLogLog meter counts, as on any stream, held against the exact ones."""
    live = layers.to_ntz(stream_gold_table(spark, sf, "complete"))
    both = join_gold(live, layers.to_ntz(layers.gold_layer(spark, sf)))
    return both.select(*GOLD_KEYS, "avg_consumption", "total_load", "avg_temp",
                       meters_close("active_meters", "exact_meters").alias("meters_close"))


@register("stream_gold_exact", O.sql("SELECT * FROM gold", "gold"))
def q_stream_gold_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Complete-mode gold with exact meter counts (pane rows per meter)."""
    return layers.to_ntz(stream_gold_table(spark, sf, "complete", meters="exact"))


@register("stream_gold_append", O.sql("""
SELECT * FROM gold
WHERE window_end <= (SELECT max(timestamp) FROM silver) - INTERVAL 10 MINUTE""", "gold", "silver"))
def q_stream_gold_append(spark: SparkSession, sf: str) -> DataFrame:
    """Append-mode gold: exactly the windows the final watermark (latest reading - 10 min) has closed."""
    return layers.to_ntz(stream_gold_table(spark, sf, "append", meters="exact"))


@register("stream_gold_update", O.sql("SELECT * FROM gold", "gold"))
def q_stream_gold_update(spark: SparkSession, sf: str) -> DataFrame:
    """Update-mode gold: changed panes merged by day, windows rolled up on reading."""
    return layers.to_ntz(stream_gold_table(spark, sf, "update", meters="exact"))


@register("stream_alerts_resumed", O.sql("SELECT * FROM alerts", "alerts"))
def q_stream_alerts_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """The detector's state carried over micro-batches and a restart."""
    return layers.to_ntz(stream_alerts_resumed_table(spark, sf))


@register("stream_alerts_expired", O.sql("SELECT * FROM alerts_half", "alerts_half"))
def q_stream_alerts_expired(spark: SparkSession, sf: str) -> DataFrame:
    """Meters idle past the timeout calibrate again: each half of the history is scored on its own."""
    return layers.to_ntz(stream_alerts_expired_table(spark, sf))


@register("stream_alerts", O.sql("SELECT * FROM alerts", "alerts"))
def q_stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return layers.to_ntz(stream_alerts_table(spark, sf)[0])


@register("stream_notify", O.sql("SELECT LCLid, timestamp, message, temperature FROM alerts", "alerts"))
def q_stream_notify(spark: SparkSession, sf: str) -> DataFrame:
    """Every alert delivered once by the notifier (delivery columns left out)."""
    _, alerts_dir = stream_alerts_table(spark, sf)
    out, ck = scratch_path(spark, "notify"), scratch_path(spark, "ck-notify")
    with _sized(spark, alerts_dir):
        q = jobs.start_notify(spark, alerts_dir, out, ck, trigger=jobs.BOUNDED)
    run_bounded(q)
    return layers.to_ntz(jobs.read_notifications(spark, out).select("LCLid", "timestamp", "message", "temperature"))


def land_weather(spark: SparkSession, sf: str) -> str:
    """Hourly weather rows as they would arrive on a weather topic (text fields)."""
    key = (app_key(spark), sf.rstrip("/"), "weather")
    path = _landed.get(key)
    if path is None:
        path = scratch_path(spark, "weather-topic")
        tables.weather_raw(spark, sf).write.mode("overwrite").parquet(path)
        _landed[key] = path
    return path


@register("stream_stream_enrich", O.sql("SELECT * FROM silver", "silver"))
def q_stream_stream_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """Readings joined with the weather *stream* (left outer, watermarked both sides), bounded replay."""
    msg_dir, w_dir = land_messages(spark, sf), land_weather(spark, sf)
    end_msg, end_w = enrich_join.end_markers(spark)
    m_end, w_end = scratch_path(spark, "end-messages"), scratch_path(spark, "end-weather")
    end_msg.write.parquet(m_end)
    end_w.write.parquet(w_end)
    messages = file_messages(spark, msg_dir).unionByName(file_messages(spark, m_end))
    weather = (spark.readStream.schema(schemas.RAW_WEATHER).parquet(w_dir)
               .unionByName(spark.readStream.schema(schemas.RAW_WEATHER).parquet(w_end)))
    out, ck = scratch_path(spark, "silver-ss"), scratch_path(spark, "ck-silver-ss")
    silver = enrich_join.stream_stream_enrich(messages, weather, layers.households(spark, sf))
    with _sized(spark, msg_dir, w_dir):
        q = jobs.start_silver(silver, out, ck, jobs.BOUNDED)
    run_bounded(q)
    return layers.to_ntz(spark.read.schema(schemas.SILVER).parquet(out))
