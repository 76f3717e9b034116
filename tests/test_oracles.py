"""Every registered batch query, and some streams, beside its reference SQL on the small tables."""

import pytest
from check import compare

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
STREAMS = {n for n in entry.queries() if n.startswith("st_")} | {"pipe_log_watch"}
QUICK = {"st_level_counts", "st_histogram", "st_late_policy", "st_upsert", "st_sliding_stats", "st_gauge",
         "st_firing_now", "st_health_report", "st_request_metrics"}
NAMES = sorted(n for n in entry.registry.QUERIES if n not in STREAMS or n in QUICK)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    text, ok = compare(spark, SF, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok, text


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["method", "count"] and df.count() > 0


def test_every_query_outside_llm_has_an_oracle():
    from skyops import registry

    assert set(registry.QUERIES) == set(registry.ORACLES)
