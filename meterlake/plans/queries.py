"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and their SQL twins.

Every query reads the shared test tables through the adapter, so its work
grows with them. Timestamps leave as ``timestamp_ntz`` and window structs
as ``window_start``/``window_end`` columns (see :func:`layers.to_ntz`).
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterlake.operators import bucketed, detector, eda, gold, insights
from meterlake.params import DetectorParams
from meterlake.plans import layers
from meterlake.plans import oracle as O
from meterlake.session import ship_package
from meterlake.sources import files, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query; hour, day and window boundaries are taken in UTC."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- layers -----------------------------------------------------------------

@register("enrich_silver", O.sql("SELECT * FROM silver", "silver"))
def q_enrich_silver(spark: SparkSession, sf: str) -> DataFrame:
    """The silver job: enrich the readings and persist the layer the reports read."""
    return layers.to_ntz(layers.silver_layer(spark, sf))


@register("gold_kpis", O.sql("SELECT * FROM gold", "gold"))
def q_gold_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return layers.to_ntz(layers.gold_exact(spark, sf))


@register("gold_any_decimals", O.sql(f"""
SELECT window_start, window_end, acorn_group, precipType, {O.exact_total("p")} / n AS avg_consumption,
       {O.exact_total("p")} AS total_load, active_meters, avg_temp
FROM (SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, acorn_group, precipType, COUNT(p0) AS n,
             {", ".join(f"CAST(SUM(p{i}) AS BIGINT) AS p{i}" for i in range(5))},
             COUNT(DISTINCT LCLid) AS active_meters, AVG(temperature) AS avg_temp
      FROM pieces GROUP BY ws, acorn_group, precipType) g""", "pieces"))
def q_gold_any_decimals(spark: SparkSession, sf: str) -> DataFrame:
    """Gold of readings that no number of decimals holds (sevenths of a kWh), with exact sums of doubles."""
    from pyspark.sql import functions as F
    silver = layers.silver_layer(spark, sf).withColumn("consumption", F.col("consumption") / F.lit(7.0))
    return layers.to_ntz(gold.gold_kpis(silver, approx_meters=False, exact_scale="exact"))


HLL_RSD = 0.05


def meters_close(approx: str, exact: str):
    """True where a HyperLogLog count lies within four standard errors (and one meter) of the exact count."""
    from pyspark.sql import functions as F
    return F.abs(F.col(approx) - F.col(exact)) <= F.lit(4 * HLL_RSD) * F.col(exact) + F.lit(1)


@register("gold_active_meters_approx", O.sql("""
SELECT window_start, window_end, acorn_group, precipType, TRUE AS meters_close, TRUE AS load_close, TRUE AS avg_close, avg_temp FROM gold""", "gold"))
def q_gold_approx(spark: SparkSession, sf: str) -> DataFrame:
    """Gold as the source computes it (HyperLogLog meter counts, plain double sums), held against the exact gold."""
    from pyspark.sql import functions as F
    approx = layers.to_ntz(gold.gold_kpis(layers.silver_layer(spark, sf), rsd=HLL_RSD))
    both = join_gold(approx, layers.to_ntz(layers.gold_layer(spark, sf)))
    def close(c: str):
        return F.abs(F.col(c) - F.col(f"exact_{c}")) <= F.lit(1e-9) * (F.abs(f"exact_{c}") + F.lit(1.0))
    load, avg = close("total_load"), close("avg_consumption")
    return both.select(*GOLD_KEYS, meters_close("active_meters", "exact_meters").alias("meters_close"),
                       load.alias("load_close"), avg.alias("avg_close"), "avg_temp")


GOLD_KEYS = ("window_start", "window_end", "acorn_group", "precipType")


def join_gold(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """``approx`` with the exact meter count, load and mean of each row; rows on one side only keep NULLs on the other."""
    from pyspark.sql import functions as F
    known = exact.select(*(F.col(k).alias(f"x_{k}") for k in GOLD_KEYS), F.col("active_meters").alias("exact_meters"),
                         F.col("total_load").alias("exact_total_load"),
                         F.col("avg_consumption").alias("exact_avg_consumption"))
    same = [F.col(k).eqNullSafe(F.col(f"x_{k}")) for k in GOLD_KEYS]
    return approx.join(known, same, "full")


@register("household_dim", O.sql("SELECT * FROM households", "households"))
def q_household_dim(spark: SparkSession, sf: str) -> DataFrame:
    return layers.households(spark, sf)


@register("weather_dim", O.sql("SELECT * FROM weather", "weather"))
def q_weather_dim(spark: SparkSession, sf: str) -> DataFrame:
    return layers.to_ntz(layers.weather(spark, sf))


@register("clean_readings", O.sql("SELECT LCLid, timestamp, consumption FROM readings", "readings"))
def q_clean_readings(spark: SparkSession, sf: str) -> DataFrame:
    return layers.to_ntz(layers.readings(spark, sf))


# --- exploratory profile of the raw readings ----------------------------------

def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return tables.readings_raw(spark, sf).select("LCLid", "tstp", "`energy(kWh/hh)`")


_MISSING = """count(CASE WHEN "energy(kWh/hh)" IS NULL OR "energy(kWh/hh)" = '' OR contains("energy(kWh/hh)", 'Null')
                     THEN 1 END) AS missing_energy,
       count(CASE WHEN tstp IS NULL THEN 1 END) AS missing_timestamp,
       count(CASE WHEN LCLid IS NULL THEN 1 END) AS missing_lclid"""


@register("raw_profile", O.sql(f"""SELECT count(*) AS total_rows, {_MISSING},
       min(tstp) AS first_tstp, max(tstp) AS last_tstp FROM readings_raw""", "readings_raw"))
def q_raw_profile(spark: SparkSession, sf: str) -> DataFrame:
    return eda.raw_profile(_raw(spark, sf))


@register("row_count", O.sql("SELECT count(*) AS total_rows FROM readings_raw", "readings_raw"))
def q_row_count(spark: SparkSession, sf: str) -> DataFrame:
    return eda.row_count(_raw(spark, sf))


@register("quality_profile", O.sql(f"SELECT {_MISSING} FROM readings_raw", "readings_raw"))
def q_quality_profile(spark: SparkSession, sf: str) -> DataFrame:
    return eda.quality_profile(_raw(spark, sf))


@register("top_values", O.sql("""SELECT "energy(kWh/hh)" AS energy, count(*) AS count FROM readings_raw
GROUP BY 1 ORDER BY count DESC, energy ASC NULLS FIRST LIMIT 10""", "readings_raw"))
def q_top_values(spark: SparkSession, sf: str) -> DataFrame:
    return eda.top_values(_raw(spark, sf))


@register("time_extent", O.sql("SELECT min(tstp) AS first_tstp, max(tstp) AS last_tstp FROM readings_raw",
                               "readings_raw"))
def q_time_extent(spark: SparkSession, sf: str) -> DataFrame:
    return eda.time_extent(_raw(spark, sf))


@register("ts_format_profile", O.sql("""SELECT CAST(length(tstp) AS INTEGER) AS len_tstp, count(*) AS count
FROM readings_raw GROUP BY 1""", "readings_raw"))
def q_ts_format_profile(spark: SparkSession, sf: str) -> DataFrame:
    return eda.ts_format_profile(_raw(spark, sf))


@register("group_distribution", O.sql("""SELECT Acorn_grouped, count(*) AS count FROM households_raw
GROUP BY 1""", "households_raw"))
def q_group_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return eda.group_distribution(tables.households_raw(spark, sf))


@register("orphan_meters", O.sql("""SELECT count(*) AS orphan_meters FROM (SELECT DISTINCT LCLid FROM readings_raw) r
WHERE NOT EXISTS (SELECT 1 FROM households_raw h WHERE h.LCLid = r.LCLid)""", "readings_raw", "households_raw"))
def q_orphan_meters(spark: SparkSession, sf: str) -> DataFrame:
    return eda.orphan_meters(_raw(spark, sf), tables.households_raw(spark, sf))


@register("orphan_meter_ids", O.sql("""SELECT DISTINCT LCLid FROM readings_raw r
WHERE NOT EXISTS (SELECT 1 FROM households_raw h WHERE h.LCLid = r.LCLid)""", "readings_raw", "households_raw"))
def q_orphan_meter_ids(spark: SparkSession, sf: str) -> DataFrame:
    return eda.orphan_meter_ids(_raw(spark, sf), tables.households_raw(spark, sf))


# --- detector (batch form) ----------------------------------------------------

# Users of the test tables have 45-99 readings, so the production
# calibration of 600 never scores one; the per-meter alert layer uses a
# calibration of 30 and thresholds 3 / 5. The production defaults run keyed
# by event type (about 2 000 readings per key at sf0.01).
METER_PARAMS = DetectorParams(calibration=30, z_mild=3.0, z_extreme=5.0, value_scale=layers.VALUE_SCALE)
DEFAULT_PARAMS = DetectorParams(value_scale=layers.VALUE_SCALE)


def alerts_layer(spark: SparkSession, sf: str) -> DataFrame:
    """The persisted alert history the reports read."""
    return layers.alerts_layer(spark, sf, METER_PARAMS)


@register("running_baseline", O.sql("""SELECT k AS LCLid, timestamp, consumption, temperature,
       n AS prior_n, mean AS prior_mean, sd AS prior_sd FROM stats_meter""", "stats_meter"))
def q_running_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return layers.to_ntz(detector.running_baseline(layers.silver_layer(spark, sf), METER_PARAMS))


@register("anomaly_alerts", O.sql("SELECT * FROM alerts", "alerts"))
def q_anomaly_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return layers.to_ntz(layers.alerts(spark, sf, METER_PARAMS))


@register("anomaly_alerts_defaults", O.sql("SELECT * FROM alerts_type", "alerts_type"))
def q_anomaly_alerts_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return layers.to_ntz(layers.alerts(spark, sf, DEFAULT_PARAMS, key="event_type"))


def _by_meter(spark: SparkSession, sf: str, job) -> DataFrame:
    """A detector job over silver laid out by meter: its buckets need no exchange, its hot meters are scanned in ranges."""
    def run(part: DataFrame, chunk_rows: int | None = None) -> DataFrame:
        return job(part, METER_PARAMS, chunk_rows=chunk_rows)
    return bucketed.over_parts(layers.silver_by_meter(spark, sf), run, chunk_rows=detector.DEFAULT_CHUNK_ROWS)


@register("running_baseline_by_meter", ORACLE["running_baseline"])
def q_running_baseline_by_meter(spark: SparkSession, sf: str) -> DataFrame:
    return layers.to_ntz(_by_meter(spark, sf, detector.running_baseline))


@register("anomaly_alerts_by_meter", ORACLE["anomaly_alerts"])
def q_anomaly_alerts_by_meter(spark: SparkSession, sf: str) -> DataFrame:
    return layers.to_ntz(_by_meter(spark, sf, detector.anomaly_alerts))


TYPE_PARAMS = DEFAULT_PARAMS.with_(z_mild=2.0, z_extreme=3.5)


@register("anomaly_alerts_by_type", O.sql("SELECT * FROM alerts_type_low", "alerts_type_low"))
def q_anomaly_alerts_by_type(spark: SparkSession, sf: str) -> DataFrame:
    """Production calibration of 600 readings with thresholds that the test tables reach, in both kinds of weather."""
    return layers.to_ntz(layers.alerts(spark, sf, TYPE_PARAMS, key="event_type"))


# --- reports: silver ------------------------------------------------------------

def _fx(col: str, scale: int) -> str:
    return f"CAST(round({col} * CAST({10 ** scale}.0 AS DOUBLE)) AS BIGINT)"


def _mean(n: str, s: str, scale: int) -> str:
    return f"(CASE WHEN {n} > 0 THEN CAST({s} AS DOUBLE) / (CAST({n} AS DOUBLE) * CAST({10 ** scale}.0 AS DOUBLE)) END)"


def _cent(n: str, s: str, q: str) -> str:
    return f"CAST(CAST({n} AS HUGEINT) * {q} - CAST({s} AS HUGEINT) * {s} AS DOUBLE)"


def _sd(n: str, s: str, q: str, scale: int) -> str:
    return (f"(CASE WHEN {n} > 1 THEN sqrt({_cent(n, s, q)} / (CAST({n} * ({n} - 1) AS DOUBLE)"
            f" * CAST({10 ** (2 * scale)}.0 AS DOUBLE))) END)")


_PAIR = "consumption IS NOT NULL AND temperature IS NOT NULL"
_PX = f"CASE WHEN {_PAIR} THEN {_fx('consumption', 3)} END"
_PY = f"CASE WHEN {_PAIR} THEN {_fx('temperature', 2)} END"


@register("thermal_sensitivity", O.sql(f"""
SELECT acorn_group,
       CASE WHEN pn > 1 AND {_cent('pn', 'psx', 'pqx')} > 0 AND {_cent('pn', 'psy', 'pqy')} > 0
            THEN CAST(CAST(pn AS HUGEINT) * pqxy - CAST(psx AS HUGEINT) * psy AS DOUBLE)
                 / sqrt({_cent('pn', 'psx', 'pqx')} * {_cent('pn', 'psy', 'pqy')}) END AS pearson_corr,
       {_sd('nx', 'sx', 'qx', 3)} / {_sd('ny', 'sy', 'qy', 2)} AS thermal_slope
FROM (SELECT acorn_group,
             count(CASE WHEN {_PAIR} THEN 1 END) AS pn,
             sum({_PX}) AS psx, sum({_PY}) AS psy,
             sum(CAST({_PX} AS HUGEINT) * {_PX}) AS pqx, sum(CAST({_PY} AS HUGEINT) * {_PY}) AS pqy,
             sum(CAST({_PX} AS HUGEINT) * {_PY}) AS pqxy,
             count(consumption) AS nx, sum({_fx('consumption', 3)}) AS sx,
             sum(CAST({_fx('consumption', 3)} AS HUGEINT) * {_fx('consumption', 3)}) AS qx,
             count(temperature) AS ny, sum({_fx('temperature', 2)}) AS sy,
             sum(CAST({_fx('temperature', 2)} AS HUGEINT) * {_fx('temperature', 2)}) AS qy
      FROM silver GROUP BY acorn_group) g""", "silver"))
def q_thermal_sensitivity(spark: SparkSession, sf: str) -> DataFrame:
    return insights.thermal_sensitivity(layers.silver_layer(spark, sf), exact=True)


@register("volatility_index", O.sql(f"""
SELECT acorn_group, {_sd('n', 's', 'q', 3)} / {_mean('n', 's', 3)} AS volatility_index
FROM (SELECT acorn_group, count(consumption) AS n, sum({_fx('consumption', 3)}) AS s,
             sum(CAST({_fx('consumption', 3)} AS HUGEINT) * {_fx('consumption', 3)}) AS q
      FROM silver GROUP BY acorn_group) g""", "silver"))
def q_volatility_index(spark: SparkSession, sf: str) -> DataFrame:
    return insights.volatility_index(layers.silver_layer(spark, sf), exact=True)


@register("weekend_shift", O.sql(f"""
SELECT acorn_group, {_mean('n0', 's0', 3)} AS avg_weekday, {_mean('n1', 's1', 3)} AS avg_weekend,
       ({_mean('n1', 's1', 3)} - {_mean('n0', 's0', 3)}) / {_mean('n0', 's0', 3)} * CAST(100.0 AS DOUBLE)
         AS weekend_shift_pct
FROM (SELECT acorn_group,
             count(CASE WHEN dayofweek(timestamp) NOT IN (0, 6) THEN consumption END) AS n0,
             sum(CASE WHEN dayofweek(timestamp) NOT IN (0, 6) THEN {_fx('consumption', 3)} END) AS s0,
             count(CASE WHEN dayofweek(timestamp) IN (0, 6) THEN consumption END) AS n1,
             sum(CASE WHEN dayofweek(timestamp) IN (0, 6) THEN {_fx('consumption', 3)} END) AS s1
      FROM silver GROUP BY acorn_group) g""", "silver"))
def q_weekend_shift(spark: SparkSession, sf: str) -> DataFrame:
    return insights.weekend_shift(layers.silver_layer(spark, sf), exact=True)


RANGE = ("2024-01-08", "2024-01-21")  # two whole weeks inside the month of the test tables


@register("volatility_index_in_range", O.sql(f"""
SELECT acorn_group, {_sd('n', 's', 'q', 3)} / {_mean('n', 's', 3)} AS volatility_index
FROM (SELECT acorn_group, count(consumption) AS n, sum({_fx('consumption', 3)}) AS s,
             sum(CAST({_fx('consumption', 3)} AS HUGEINT) * {_fx('consumption', 3)}) AS q
      FROM silver WHERE CAST(timestamp AS DATE) BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'
      GROUP BY acorn_group) g""", "silver"))
def q_volatility_index_in_range(spark: SparkSession, sf: str) -> DataFrame:
    """A report over a range of dates: only those days' partitions of silver are read."""
    silver = files.read_layer(spark, layers.silver_days(spark, sf), since=RANGE[0], until=RANGE[1])
    return insights.volatility_index(silver, exact=True)


# --- reports: gold ----------------------------------------------------------------

@register("par_index", O.sql(f"""
SELECT hour, peak / {_mean('n', 's', 3)} AS PAR_index
FROM (SELECT CAST(hour(window_start) AS INTEGER) AS hour, max(total_load) AS peak, count(total_load) AS n,
             sum({_fx('total_load', 3)}) AS s FROM gold GROUP BY 1) g
ORDER BY PAR_index DESC NULLS LAST, hour LIMIT 5""", "gold"))
def q_par_index(spark: SparkSession, sf: str) -> DataFrame:
    return insights.par_index(layers.gold_layer(spark, sf), exact=True)


@register("load_per_meter", O.sql(f"""
SELECT acorn_group, CAST(hour(window_start) AS INTEGER) AS hour,
       (CAST(sum({_fx('total_load', 3)}) AS DOUBLE) / CAST(1000.0 AS DOUBLE)) / CAST(sum(active_meters) AS DOUBLE)
         AS kwh_per_meter
FROM gold GROUP BY 1, 2
ORDER BY kwh_per_meter DESC NULLS LAST, acorn_group ASC NULLS FIRST, hour LIMIT 5""", "gold"))
def q_load_per_meter(spark: SparkSession, sf: str) -> DataFrame:
    return insights.load_per_meter(layers.gold_layer(spark, sf), exact=True)


@register("gold_outliers", O.sql(f"""
SELECT window_start, window_end, total_load, avg_temp FROM gold
WHERE total_load > (SELECT {_mean('n', 's', 3)} + CAST(2.0 AS DOUBLE) * {_sd('n', 's', 'q', 3)}
                    FROM (SELECT count(total_load) AS n, sum({_fx('total_load', 3)}) AS s,
                                 sum(CAST({_fx('total_load', 3)} AS HUGEINT) * {_fx('total_load', 3)}) AS q
                          FROM gold) st)""", "gold"))
def q_gold_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return layers.to_ntz(insights.gold_outliers(layers.gold_layer(spark, sf), exact=True))


# --- reports: alerts ----------------------------------------------------------------

@register("alert_severity", O.sql("""
SELECT LCLid, round(avg(currentValue / expectedAvg), 9) AS avg_severity, count(*) AS alert_count
FROM alerts GROUP BY LCLid ORDER BY avg_severity DESC NULLS LAST, LCLid ASC NULLS FIRST LIMIT 5""", "alerts"))
def q_alert_severity(spark: SparkSession, sf: str) -> DataFrame:
    """Severity means are of arbitrary doubles; they are shown to 9 places."""
    from pyspark.sql import functions as F
    out = insights.alert_severity(alerts_layer(spark, sf))
    return out.select("LCLid", F.round("avg_severity", 9).alias("avg_severity"), "alert_count")


@register("alert_temp_bins", O.sql("""
SELECT round(temperature / CAST(5.0 AS DOUBLE)) * CAST(5.0 AS DOUBLE) AS temp_bin, count(*) AS count
FROM alerts GROUP BY 1""", "alerts"))
def q_alert_temp_bins(spark: SparkSession, sf: str) -> DataFrame:
    return insights.alert_temp_bins(alerts_layer(spark, sf))


@register("alert_group_rank", O.sql("""
SELECT s.acorn_group, count(*) AS count, count(DISTINCT a_id) AS alert_count
FROM (SELECT *, row_number() OVER () AS a_id FROM alerts) a JOIN silver s ON a.LCLid = s.LCLid
GROUP BY s.acorn_group""", "alerts", "silver"))
def q_alert_group_rank(spark: SparkSession, sf: str) -> DataFrame:
    return insights.alert_group_rank(alerts_layer(spark, sf), layers.silver_layer(spark, sf))


@register("alert_group_rank_by_meter", ORACLE["alert_group_rank"])
def q_alert_group_rank_by_meter(spark: SparkSession, sf: str) -> DataFrame:
    """The ranking over silver laid out by meter: only the alerts are shuffled."""
    return insights.alert_group_rank(alerts_layer(spark, sf), layers.silver_by_meter(spark, sf))


CRITICAL_LEVEL = 222.0  # about the median alert of the test tables, so that the filter splits them


@register("critical_alerts", O.sql(f"SELECT * FROM alerts WHERE currentValue > {CRITICAL_LEVEL}", "alerts"))
def q_critical_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return layers.to_ntz(insights.critical_alerts(alerts_layer(spark, sf), CRITICAL_LEVEL))


# Streaming and replay queries register themselves on import.
from meterlake.plans import stream_queries  # noqa: E402,F401
from meterlake.plans import table_queries  # noqa: E402,F401
