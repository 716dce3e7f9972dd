"""The resumed detector run computes its dimensions once, not at each start."""

from meterlake.plans import layers, stream_queries
from tests.conftest import SF_SMALL


def test_resumed_run_reads_the_base_tables_of_the_dimensions_once(spark, monkeypatch):
    calls = []
    for name in ("households", "weather"):
        real = getattr(layers, name)
        monkeypatch.setattr(layers, name, lambda *a, real=real, name=name: calls.append(name) or real(*a))
    resumed = stream_queries.stream_alerts_resumed_table(spark, SF_SMALL)
    assert sorted(calls) == ["households", "weather"]
    live, _ = stream_queries.stream_alerts_table(spark, SF_SMALL)
    assert sorted(map(str, resumed.collect())) == sorted(map(str, live.collect()))
