"""Business reports over the silver, gold and alert layers.

Statistics are the built-in ``avg``/``stddev``/``corr`` of doubles by default. With ``exact=True``
they come from fixed-point moments (:mod:`meterlake.functions.moments`, which take readings at
``CONS_SCALE`` decimals) and are identical for every partitioning; with ``exact="any"`` the
reports of sums and means use exact sums of doubles (:mod:`meterlake.functions.exact`), which round
nothing and are as independent of the order. All forms aggregate partially, map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions import columns as C
from meterlake.functions import exact as X
from meterlake.functions import moments as M
from meterlake.operators.bucketed import ByKey, over_parts
from meterlake.operators.joins import dimension_join

CONS_SCALE = 3   # kWh per half hour, Wh steps
TEMP_SCALE = 2   # degrees


# --- silver: behaviour --------------------------------------------------------

def silver_group_moments(silver: DataFrame) -> DataFrame:
    """One aggregate pass over silver with every moment the three silver
    reports need, per group: consumption and temperature (each on its own
    known values and on the rows where both are known), their co-moment, and
    weekday / weekend consumption count and sum. One partial aggregate, one
    small shuffle; the reports are projections of its one row per group.
    Values without a fixed-point form count as unknown."""
    x, y = (F.when(C.usable_reading(c), F.col(c)) for c in ("consumption", "temperature"))
    pair = x.isNotNull() & y.isNotNull()
    px, py = F.when(pair, x), F.when(pair, y)
    wk = C.is_weekend("timestamp")
    xd, xe = F.when(wk == 0, x), F.when(wk == 1, x)
    return silver.groupBy("acorn_group").agg(
        M.count_both(x, y).alias("pn"),
        M.sum_fixed(px, CONS_SCALE).alias("psx"), M.sum_fixed(py, TEMP_SCALE).alias("psy"),
        M.sum_sq_fixed(px, CONS_SCALE).alias("pqx"), M.sum_sq_fixed(py, TEMP_SCALE).alias("pqy"),
        M.sum_prod_fixed(px, CONS_SCALE, py, TEMP_SCALE).alias("pqxy"),
        F.count(x).alias("nx"), M.sum_fixed(x, CONS_SCALE).alias("sx"), M.sum_sq_fixed(x, CONS_SCALE).alias("qx"),
        F.count(y).alias("ny"), M.sum_fixed(y, TEMP_SCALE).alias("sy"), M.sum_sq_fixed(y, TEMP_SCALE).alias("qy"),
        F.count(xd).alias("n0"), M.sum_fixed(xd, CONS_SCALE).alias("s0"),
        F.count(xe).alias("n1"), M.sum_fixed(xe, CONS_SCALE).alias("s1"),
    )


def _c(n: str):
    return F.col(n)


def thermal_from(m: DataFrame) -> DataFrame:
    corr = M.corr_from(_c("pn"), _c("psx"), _c("psy"), _c("pqx"), _c("pqy"), _c("pqxy"))
    sdx = M.sd_from(_c("nx"), _c("sx"), _c("qx"), CONS_SCALE)
    sdy = M.sd_from(_c("ny"), _c("sy"), _c("qy"), TEMP_SCALE)
    out = m.select("acorn_group", corr.alias("pearson_corr"), F.try_divide(sdx, sdy).alias("thermal_slope"))
    return out.orderBy(F.asc_nulls_first("pearson_corr"), F.asc_nulls_first("acorn_group"))


def volatility_from(m: DataFrame) -> DataFrame:
    cov = F.try_divide(M.sd_from(_c("nx"), _c("sx"), _c("qx"), CONS_SCALE), M.mean_from(_c("nx"), _c("sx"), CONS_SCALE))
    out = m.select("acorn_group", cov.alias("volatility_index"))
    return out.orderBy(F.desc_nulls_last("volatility_index"), F.asc_nulls_first("acorn_group"))


def weekend_from(m: DataFrame) -> DataFrame:
    wd = M.mean_from(_c("n0"), _c("s0"), CONS_SCALE)
    we = M.mean_from(_c("n1"), _c("s1"), CONS_SCALE)
    return m.select("acorn_group", wd.alias("avg_weekday"), we.alias("avg_weekend"),
                    (F.try_divide(we - wd, wd) * F.lit(100.0)).alias("weekend_shift_pct"))


def thermal_sensitivity(silver: DataFrame, exact: bool = False) -> DataFrame:
    """Per group: Pearson correlation of consumption with temperature, and the
    ratio of their standard deviations (kWh per degree of spread; not a
    regression slope). Ascending by correlation."""
    if exact:
        return thermal_from(silver_group_moments(silver))
    out = silver.groupBy("acorn_group").agg(
        F.corr("consumption", "temperature").alias("pearson_corr"),
        F.try_divide(F.stddev("consumption"), F.stddev("temperature")).alias("thermal_slope"))
    return out.orderBy(F.asc_nulls_first("pearson_corr"), F.asc_nulls_first("acorn_group"))


def volatility_index(silver: DataFrame, exact: bool = False) -> DataFrame:
    """Coefficient of variation of consumption per group, descending."""
    if exact:
        return volatility_from(silver_group_moments(silver))
    out = silver.groupBy("acorn_group").agg(
        F.try_divide(F.stddev("consumption"), F.avg("consumption")).alias("volatility_index"))
    return out.orderBy(F.desc_nulls_last("volatility_index"), F.asc_nulls_first("acorn_group"))


def weekend_shift(silver: DataFrame, exact: bool | str = False) -> DataFrame:
    """Mean consumption on weekdays and weekends per group, and the weekend
    change in percent ``(weekend - weekday) / weekday * 100``.

    The weekend flag has fixed values (0 = weekday, 1 = weekend; the pivot
    lists them explicitly), so a group or a dataset without weekend rows
    yields NULL instead of a missing column.
    """
    if exact == "any":
        known, wk = F.when(C.usable_reading("consumption"), F.col("consumption")), C.is_weekend("timestamp")
        day, end = F.when(wk == 0, known), F.when(wk == 1, known)
        m = silver.groupBy("acorn_group").agg(F.count(day).alias("n0"), *X.limb_sums(day, "d"),
                                              F.count(end).alias("n1"), *X.limb_sums(end, "e"))
        m = m.select("acorn_group", F.try_divide(X.limb_total("d"), "n0").alias("avg_weekday"),
                     F.try_divide(X.limb_total("e"), "n1").alias("avg_weekend"))
        wd, we = F.col("avg_weekday"), F.col("avg_weekend")
        return m.withColumn("weekend_shift_pct", F.try_divide(we - wd, wd) * F.lit(100.0))
    if exact:
        return weekend_from(silver_group_moments(silver))
    df = silver.withColumn("is_weekend", C.is_weekend("timestamp"))
    p = df.groupBy("acorn_group").pivot("is_weekend", [0, 1]).agg(F.avg("consumption"))
    wd, we = F.col("0"), F.col("1")
    return p.select("acorn_group", wd.alias("avg_weekday"), we.alias("avg_weekend"),
                    (F.try_divide(we - wd, wd) * F.lit(100.0)).alias("weekend_shift_pct"))


# --- gold: grid ---------------------------------------------------------------

def _with_hour(gold: DataFrame) -> DataFrame:
    return gold.withColumn("hour", F.hour(F.col("window.start")))


def first_rows(ranked: DataFrame, k: int | None) -> DataFrame:
    """The first k rows of a ranked report, or all of it."""
    return ranked if k is None else ranked.limit(k)


def par_index(gold: DataFrame, k: int | None = 5, exact: bool | str = False) -> DataFrame:
    """Peak-to-average ratio of window load by hour of day; top ``k``.

    Windows overlap (each reading counts in two), as in the gold layer.
    """
    g = _with_hour(gold).groupBy("hour")
    if exact == "any":
        g = g.agg(F.max("total_load").alias("peak"), F.count(F.when(C.usable_reading("total_load"), 1)).alias("n"),
                  *X.limb_sums("total_load", "s"))
        out = g.select("hour", F.try_divide("peak", F.try_divide(X.limb_total("s"), "n")).alias("PAR_index"))
    elif exact:
        g = g.agg(F.max("total_load").alias("peak"), F.count(M.fixed("total_load", CONS_SCALE)).alias("n"),
                  M.sum_fixed("total_load", CONS_SCALE).alias("s"))
        out = g.select("hour", F.try_divide(F.col("peak"), M.mean_from(F.col("n"), F.col("s"), CONS_SCALE))
                       .alias("PAR_index"))
    else:
        out = g.agg(F.try_divide(F.max("total_load"), F.avg("total_load")).alias("PAR_index"))
    return first_rows(out.orderBy(F.desc_nulls_last("PAR_index"), F.asc("hour")), k)


def load_per_meter(gold: DataFrame, k: int | None = 5, exact: bool | str = False) -> DataFrame:
    """Load per active meter by (group, hour of day): ``sum(load) / sum(active meters)``; top ``k``."""
    groups = _with_hour(gold).groupBy("acorn_group", "hour")
    if exact == "any":
        out = (groups.agg(*X.limb_sums("total_load", "s"), F.sum("active_meters").alias("m"))
               .select("acorn_group", "hour", F.try_divide(X.limb_total("s"), "m").alias("kwh_per_meter")))
    else:
        tot = (M.sum_fixed("total_load", CONS_SCALE).cast("double") / F.lit(float(10 ** CONS_SCALE))
               if exact else F.sum("total_load"))
        out = groups.agg(F.try_divide(tot, F.sum("active_meters")).alias("kwh_per_meter"))
    return first_rows(out.orderBy(F.desc_nulls_last("kwh_per_meter"), F.asc_nulls_first("acorn_group"), F.asc("hour")), k)


def gold_hour_moments(gold: DataFrame) -> DataFrame:
    """One aggregate pass over gold per (group, hour of day): peak, count and
    fixed-point sum of the window load, and active meters; the hourly reports
    are projections of it (exact sums add up across groups)."""
    return (_with_hour(gold).groupBy("acorn_group", "hour")
            .agg(F.max("total_load").alias("peak"), F.count(M.fixed("total_load", CONS_SCALE)).alias("n"),
                 M.sum_fixed("total_load", CONS_SCALE).alias("s"), F.sum("active_meters").alias("meters")))


def par_from(m: DataFrame, k: int | None = 5) -> DataFrame:
    h = m.groupBy("hour").agg(F.max("peak").alias("peak"), F.sum("n").alias("n"), F.sum("s").alias("s"))
    out = h.select("hour", F.try_divide(F.col("peak"), M.mean_from(F.col("n"), F.col("s"), CONS_SCALE))
                   .alias("PAR_index"))
    return first_rows(out.orderBy(F.desc_nulls_last("PAR_index"), F.asc("hour")), k)


def load_from(m: DataFrame, k: int | None = 5) -> DataFrame:
    tot = F.col("s").cast("double") / F.lit(float(10 ** CONS_SCALE))
    out = m.select("acorn_group", "hour", F.try_divide(tot, F.col("meters")).alias("kwh_per_meter"))
    return first_rows(out.orderBy(F.desc_nulls_last("kwh_per_meter"), F.asc_nulls_first("acorn_group"), F.asc("hour")), k)


def gold_outliers(gold: DataFrame, sigmas: float = 2.0, exact: bool = False) -> DataFrame:
    """Windows whose load exceeds the mean by more than ``sigmas`` standard deviations.

    The bound is a scalar subquery planned with the main query (no round
    trip through the driver); an empty or single-row gold table has no bound
    and returns no rows.
    """
    if exact:
        st = gold.agg(F.count(M.fixed("total_load", CONS_SCALE)).alias("n"), M.sum_fixed("total_load", CONS_SCALE).alias("s"),
                      M.sum_sq_fixed("total_load", CONS_SCALE).alias("q"))
        n, s, q = F.col("n"), F.col("s"), F.col("q")
        bound = st.select(M.mean_from(n, s, CONS_SCALE) + F.lit(sigmas) * M.sd_from(n, s, q, CONS_SCALE))
    else:
        bound = gold.select(F.avg("total_load") + F.lit(sigmas) * F.stddev("total_load"))
    return (gold.filter(F.col("total_load") > bound.scalar())
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "total_load", "avg_temp"))


# --- alerts: operations -------------------------------------------------------

def alert_severity(alerts: DataFrame, k: int | None = 5) -> DataFrame:
    """Mean ratio of the reading to its expected value, and alert count, per meter; top ``k``."""
    sev = F.try_divide(F.col("currentValue"), F.col("expectedAvg"))
    out = alerts.groupBy("LCLid").agg(F.avg(sev).alias("avg_severity"), F.count(F.lit(1)).alias("alert_count"))
    return first_rows(out.orderBy(F.desc_nulls_last("avg_severity"), F.asc_nulls_first("LCLid")), k)


def alert_temp_bins(alerts: DataFrame, width: float = 5.0) -> DataFrame:
    """Alerts per temperature bin of ``width`` degrees, ascending."""
    return (alerts.groupBy(C.temperature_bin("temperature", width).alias("temp_bin"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy(F.asc_nulls_first("temp_bin")))


def alert_group_rank(alerts: DataFrame, silver: DataFrame | ByKey,
                     max_broadcast_bytes: int | None = None) -> DataFrame:
    """Per social group: the number of (alert, silver reading) pairs of the
    same meter -- what joining alerts with silver on the meter and counting
    gives -- and the plain number of alerts.

    Both sides are reduced to one row per meter (and group) before the join,
    so the result is ``sum over meters of alerts(m) * readings(m, group)``
    without materialising the pairs; no hot meter can blow up a task. Both
    reduced sides are keyed by meter; by default the planner (and AQE, from
    runtime sizes) picks the join, since measuring the alert side would run
    the detector twice. Silver laid out by meter is counted and joined in its
    buckets, without an exchange.
    """
    a = alerts.groupBy("LCLid").agg(F.count(F.lit(1)).alias("a"))

    def alerted(part: DataFrame) -> DataFrame:
        s = part.groupBy("LCLid", "acorn_group").agg(F.count(F.lit(1)).alias("r"))
        return dimension_join(s, a, "LCLid", "inner", max_broadcast_bytes)

    j = over_parts(silver, alerted) if isinstance(silver, ByKey) else alerted(silver)
    return (j.groupBy("acorn_group")
            .agg(F.sum(F.col("a") * F.col("r")).alias("count"),
                 F.sum("a").alias("alert_count"))
            .orderBy(F.desc("count"), F.asc_nulls_first("acorn_group")))


def critical_alerts(alerts: DataFrame, min_value: float | None = 10.0) -> DataFrame:
    """Alerts above a reading level (the notifier's optional filter)."""
    return alerts if min_value is None else alerts.filter(F.col("currentValue") > F.lit(min_value))


# --- all reports --------------------------------------------------------------

def silver_group_stats(silver: DataFrame) -> DataFrame:
    """What the three silver reports need per group, as built-in statistics of doubles, in one aggregate pass."""
    x, wk = F.col("consumption"), C.is_weekend("timestamp")
    return silver.groupBy("acorn_group").agg(
        F.corr("consumption", "temperature").alias("pearson_corr"), F.stddev(x).alias("sd"), F.avg(x).alias("mean"),
        F.stddev("temperature").alias("sd_temp"), F.avg(F.when(wk == 0, x)).alias("avg_weekday"),
        F.avg(F.when(wk == 1, x)).alias("avg_weekend"))


def silver_reports(silver: DataFrame, exact: bool = False) -> dict[str, DataFrame]:
    """The three silver reports from one aggregate pass (one row per group, persisted)."""
    if exact:
        m = silver_group_moments(silver).persist()
        return {"thermal_sensitivity": thermal_from(m), "volatility_index": volatility_from(m),
                "weekend_shift": weekend_from(m)}
    m = silver_group_stats(silver).persist()
    wd, we = F.col("avg_weekday"), F.col("avg_weekend")
    return {
        "thermal_sensitivity": m.select("acorn_group", "pearson_corr", F.try_divide("sd", "sd_temp").alias("thermal_slope"))
        .orderBy(F.asc_nulls_first("pearson_corr"), F.asc_nulls_first("acorn_group")),
        "volatility_index": m.select("acorn_group", F.try_divide("sd", "mean").alias("volatility_index"))
        .orderBy(F.desc_nulls_last("volatility_index"), F.asc_nulls_first("acorn_group")),
        "weekend_shift": m.select("acorn_group", wd, we, (F.try_divide(we - wd, wd) * F.lit(100.0)).alias("weekend_shift_pct")),
    }


def gold_reports(gold: DataFrame, k: int | None = None, exact: bool = False) -> dict[str, DataFrame]:
    """The two hourly gold reports from one aggregate pass (one row per group and hour, persisted), and the outliers."""
    if exact:
        m = gold_hour_moments(gold).persist()
        hourly = {"par_index": par_from(m, k), "load_per_meter": load_from(m, k)}
    else:
        m = (_with_hour(gold).groupBy("acorn_group", "hour")
             .agg(F.max("total_load").alias("peak"), F.count("total_load").alias("n"), F.sum("total_load").alias("s"),
                  F.sum("active_meters").alias("meters")).persist())
        h = m.groupBy("hour").agg(F.max("peak").alias("peak"), F.sum("n").alias("n"), F.sum("s").alias("s"))
        par = h.select("hour", F.try_divide("peak", F.try_divide("s", "n")).alias("PAR_index"))
        load = m.select("acorn_group", "hour", F.try_divide("s", "meters").alias("kwh_per_meter"))
        hourly = {"par_index": first_rows(par.orderBy(F.desc_nulls_last("PAR_index"), F.asc("hour")), k),
                  "load_per_meter": first_rows(load.orderBy(F.desc_nulls_last("kwh_per_meter"),
                                                            F.asc_nulls_first("acorn_group"), F.asc("hour")), k)}
    return hourly | {"gold_outliers": gold_outliers(gold, exact=exact)}


def business_reports(silver: DataFrame, gold: DataFrame, alerts: DataFrame, k: int | None = None,
                     exact: bool = False) -> dict[str, DataFrame]:
    """The nine reports over the three layers, whole; ``k`` cuts the ranked ones to their first rows.

    The silver reports share one aggregate pass (one row per group), the
    hourly gold reports another (one row per group and hour); both small
    aggregates are persisted (``spark.catalog.clearCache()`` releases them).
    The outlier and alert reports are one aggregate each.
    """
    return {
        **silver_reports(silver, exact),
        **gold_reports(gold, k, exact),
        "alert_severity": alert_severity(alerts, k),
        "alert_temp_bins": alert_temp_bins(alerts),
        "alert_group_rank": alert_group_rank(alerts, silver),
    }
