"""Command line jobs: ``python -m meterlake.cli <job> [options]`` (or through spark-submit).

  replay    CSV blocks -> keyed JSON messages (files, or a Kafka topic)
  consume   messages -> silver, gold and alert streams (runs until stopped)
  notify    alert history -> notification table (runs until stopped)
  insights  silver/gold/alerts tables -> the nine report tables
  eda       CSV blocks + household file -> profile tables
  maintain  compact a layer (a snapshot table into its next snapshot); list (and optionally delete) expired files

Paths may be local or on any filesystem Spark reads. Stream checkpoints go
under ``--root/checkpoints``.
"""

from __future__ import annotations

import argparse

from meterlake import params as P
from meterlake.operators import cleaning, eda, insights, maintenance, replay
from meterlake.session import build_session, scratch_path, ship_package, sizing_conf
from meterlake.sources import files
from meterlake.streaming import jobs
from meterlake.streaming.sources import file_messages, kafka_messages


def _dims(spark, a):
    house = cleaning.household_dim(files.read_households_csv(spark, a.households))
    weather = cleaning.weather_dim(files.read_weather_csv(spark, a.weather))
    return house, weather


def _messages(spark, a):
    if a.kafka:
        return kafka_messages(spark, a.kafka, a.topic, a.max_per_trigger)
    return file_messages(spark, a.messages, max_files_per_trigger=a.max_files_per_trigger)


def _input_bytes(spark, a) -> int:
    """Bytes of the files a job reads: they size its partitions (a stream, its state partitions)."""
    inputs = {"replay": [a.readings], "consume": [a.messages], "notify": [f"{a.root}/alerts"], "eda": [a.readings],
              "insights": [f"{a.root}/silver", f"{a.root}/gold"], "maintain": [a.layer, a.table]}[a.job]
    return sum(files.size_of(spark, path) for path in inputs if path)


def _write(df, path, fmt):
    df.write.mode("overwrite").format(fmt).save(path)


def run(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="meterlake")
    ap.add_argument("job", choices=["replay", "consume", "notify", "insights", "eda", "maintain"])
    ap.add_argument("--master", default=None)
    ap.add_argument("--root", help="output / checkpoint root")
    ap.add_argument("--readings", help="glob of reading CSV blocks")
    ap.add_argument("--households")
    ap.add_argument("--weather")
    ap.add_argument("--messages", help="folder of message files")
    ap.add_argument("--kafka", help="bootstrap servers")
    ap.add_argument("--topic", default="energy-readings")
    ap.add_argument("--max-per-trigger", type=int, default=P.MAX_RECORDS_PER_TRIGGER)
    ap.add_argument("--max-files-per-trigger", type=int, default=P.MAX_FILES_PER_TRIGGER)
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--gold-mode", default="update", choices=["complete", "append", "update"])
    ap.add_argument("--since", help="insights: first day of readings (yyyy-mm-dd)")
    ap.add_argument("--until", help="insights: last day of readings")
    ap.add_argument("--exact", action="store_true", help="insights: fixed-point moments of readings at 3 decimals")
    ap.add_argument("--min-value", type=float, default=None, help="notifier: only alerts above this reading")
    ap.add_argument("--layer", help="maintain: layer folder to compact")
    ap.add_argument("--table", help="maintain: snapshot table to clean")
    ap.add_argument("--retention-hours", type=float, default=P.RETENTION_HOURS)
    ap.add_argument("--delete", action="store_true", help="maintain: delete the expired files")
    ap.add_argument("--once", action="store_true",
                    help="consume/notify: process what is available, then stop (no state timeout)")
    a = ap.parse_args(argv)

    # Stream checkpoints go under --root; other scratch data under the
    # session's spark.checkpoint.dir (a temporary folder only if it is unset).
    spark = build_session(a.master, app_name=f"meterlake-{a.job}")
    ship_package(spark)
    for setting, value in sizing_conf(_input_bytes(spark, a)).items():
        spark.conf.set(setting, value)
    fmt = a.format
    if a.job == "replay":
        lines = files.read_text_lines(spark, a.readings)
        for part in replay.time_slices(replay.replay_messages(lines), scratch_path(spark, "replay")):
            replay.write_messages(part, a.messages, kafka_bootstrap=a.kafka, topic=a.topic)
    elif a.job == "consume":
        house, weather = _dims(spark, a)
        if a.once:
            qs = jobs.start_layer_queries(spark, _messages(spark, a), house, weather, a.root,
                                          P.DEFAULT_DETECTOR.with_(timeout=None), a.gold_mode,
                                          {k: jobs.BOUNDED for k in ("silver", "gold", "alerts")})
            for q in qs.values():
                q.awaitTermination()
        else:
            jobs.start_layer_queries(spark, _messages(spark, a), house, weather, a.root, gold_mode=a.gold_mode)
            spark.streams.awaitAnyTermination()
    elif a.job == "notify":
        jobs.start_notify(spark, f"{a.root}/alerts", f"{a.root}/notifications", f"{a.root}/checkpoints/notify",
                          a.min_value, jobs.BOUNDED if a.once else jobs.SERVICE_NOTIFY).awaitTermination()
    elif a.job == "insights":
        silver = files.read_layer(spark, f"{a.root}/silver", fmt, a.since, a.until)
        gold = jobs.read_gold(spark, f"{a.root}/gold", a.gold_mode, fmt)
        alerts = files.read_layer(spark, f"{a.root}/alerts", fmt)
        for name, df in insights.business_reports(silver, gold, alerts, exact=a.exact).items():
            _write(df, f"{a.root}/reports/{name}", fmt)
    elif a.job == "eda":
        raw = files.read_readings_csv(spark, a.readings)
        house = files.read_households_csv(spark, a.households)
        _write(eda.raw_profile(raw), f"{a.root}/eda/raw_profile", fmt)
        _write(eda.top_values(raw, None), f"{a.root}/eda/top_values", fmt)
        _write(eda.ts_format_profile(raw), f"{a.root}/eda/ts_format_profile", fmt)
        _write(eda.group_distribution(house), f"{a.root}/eda/group_distribution", fmt)
        _write(eda.orphan_meters(raw, house), f"{a.root}/eda/orphan_meters", fmt)
    elif a.job == "maintain":
        if a.layer and maintenance.compact_live(spark, a.layer, fmt=fmt) is None:  # a layer without snapshots
            maintenance.compact(spark, a.layer, f"{a.layer.rstrip('/')}-compacted", fmt=fmt)
        if a.table:
            expired = maintenance.expired_files(spark, a.table, a.retention_hours, fmt=fmt)
            out = maintenance.delete_files(expired) if a.delete else expired
            _write(out, f"{a.root}/maintenance/expired", fmt)
    spark.stop()


if __name__ == "__main__":
    run()
