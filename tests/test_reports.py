
import datetime as dt

from meterlake import schemas
from meterlake.operators import insights

T0 = dt.datetime(2024, 1, 1)  # a Monday


def _gold(spark, rows):
    return spark.createDataFrame(rows, schemas.GOLD)


def test_outliers_of_empty_or_single_row_gold_are_empty(spark):
    assert insights.gold_outliers(_gold(spark, [])).count() == 0
    one = [((T0, T0 + dt.timedelta(hours=1)), "A", None, 1.0, 2.0, 3, 5.0)]
    assert insights.gold_outliers(_gold(spark, one)).count() == 0
    assert insights.gold_outliers(_gold(spark, one), exact=False).count() == 0


def test_outliers_use_mean_plus_two_sd(spark):
    rows = [((T0 + dt.timedelta(minutes=30 * i), T0 + dt.timedelta(minutes=30 * i + 60)), "A", None, 1.0,
             v, 1, 5.0) for i, v in enumerate([1.0] * 20 + [10.0])]
    got = insights.gold_outliers(_gold(spark, rows)).collect()
    assert [r["total_load"] for r in got] == [10.0]


def test_weekend_shift_without_weekend_rows_is_null(spark):
    silver = spark.createDataFrame(
        [("M1", T0 + dt.timedelta(hours=h), 1.0 + h, "A", 10.0, 8.0, 0.5, None) for h in range(48)],
        schemas.SILVER)
    for exact in (True, False):
        r = insights.weekend_shift(silver, exact=exact).first()
        assert r["avg_weekend"] is None and r["weekend_shift_pct"] is None
        assert r["avg_weekday"] is not None


def test_alert_group_rank_counts_pairs_and_alerts(spark):
    silver = spark.createDataFrame(
        [("M1", T0, 1.0, "A", 1.0, 1.0, 0.5, None)] * 3 + [("M2", T0, 1.0, "B", 1.0, 1.0, 0.5, None)] * 2,
        schemas.SILVER)
    alerts = spark.createDataFrame(
        [("M1", T0, 9.0, 1.0, "Z-Score: 9.00", 1.0, "x")] * 2 + [("M2", T0, 9.0, 1.0, "Z-Score: 9.00", 1.0, "x")],
        schemas.ALERT)
    got = [tuple(r) for r in insights.alert_group_rank(alerts, silver).collect()]
    assert got == [("A", 6, 2), ("B", 2, 1)]
