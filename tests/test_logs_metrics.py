import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from skyops.functions import logs as fn
from skyops.functions.labels import format_labels
from skyops.functions.text import float_text, strip
from skyops.functions.thresholds import compare
from skyops.operators import health, logs, metrics

AS_OF = dt.datetime(2024, 6, 1)


def parse(spark, *lines):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, value string")
    rows = logs.parse(df, as_of=F.lit(AS_OF).cast("timestamp"), keep=("i",)).collect()
    return {r.i: r for r in rows}


def test_mixed_lines(spark):
    got = parse(
        spark, json.dumps({"ts": 1704067200.5, "severity": "warn", "name": "n", "msg": "m"}),
        '{"timestamp": "2024-01-01T00:00:00.250Z", "level": "odd", "context": {"a": 1}}',
        "<13>Jan  5 01:02:03 web1 nginx[77]: upstream error", "\t \n", "[1, 2]",
        '{"ts": "123", "message": null}', '{"a": 1')
    assert got[0].ts == dt.datetime(2024, 1, 1, 0, 0, 0, 500000) and got[0].level == "WARNING"
    assert got[1].ts.microsecond == 250000 and got[1].level == "ODD" and got[1].context == {"a": "1"}
    assert got[2].ts == dt.datetime(2024, 1, 5, 1, 2, 3) and got[2].level == "ERROR"
    assert got[2].context == {"hostname": "web1", "pid": "77"} and got[2].logger == "nginx"
    assert 3 not in got
    assert got[4].message == "[1, 2]" and got[4].ts == AS_OF
    assert got[5].ts == AS_OF and got[5].message == "None"
    assert got[6].message == '{"a": 1'


def test_level_order(spark):
    df = spark.createDataFrame([("info: error",), ("fatal",), ("stderr",), ("x",)], "s string")
    assert [r[0] for r in df.select(fn.infer_level(F.col("s"))).collect()] == [
        "INFO", "CRITICAL", "ERROR", "INFO"]


@pytest.mark.parametrize("value", [0.0, 1.0, 0.1, 123456.75, 1e7, 123456789.5, 1e15, 1e16, 2.5e-4,
                                   1e-5, 3.25e-7, -1e7, 1e100, float("inf"), float("nan")])
def test_float_text(spark, value):
    got = spark.range(1).select(float_text(F.lit(value))).first()[0]
    assert got == repr(value)


def test_strip(spark):
    got = spark.range(1).select(strip(F.lit("  \t\n a b  \r"))).first()[0]
    assert got == "a b"


def test_operator_table(spark):
    cases = [(">", 2.0, 1.0, True), (">", 1.0, 1.0, False), ("<", 0.5, 1.0, True),
             (">=", 1.0, 1.0, True), ("<=", 1.0, 1.0, True), ("==", 1.0, 1.0 + 1e-10, True),
             ("==", 1.0, 1.1, False), (">", float("nan"), 1.0, False)]
    df = spark.createDataFrame(cases, "op string, v double, t double, want boolean")
    rows = df.select(compare(F.col("op"), F.col("v"), F.col("t")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in rows)


def samples(spark, rows):
    df = spark.createDataFrame(rows, "name string, labels map<string,string>, value double, "
                                     "op string, ts long")
    return metrics.keyed(df)


def test_histogram_is_cumulative(spark):
    rows = [("h", {}, v, "observe", 0) for v in (0.5, 1.5, 2.5, 99.0)]
    h = metrics.histogram(samples(spark, rows), bounds=(1.0, 2.0, 5.0)).first()
    assert list(h.buckets) == [1, 2, 3, 4] and h["count"] == 4 and h["sum"] == 103.5


def test_counter_and_gauge(spark):
    rows = [("c", {"b": "2", "a": "1"}, 2.0, "inc", 1), ("c", {"a": "1", "b": "2"}, 3.0, "inc", 2),
            ("c", {"a": "1", "b": "2"}, -1.0, "inc", 3)]
    s = samples(spark, rows)
    got = metrics.counter(s).select(format_labels(F.col("key")), "value").collect()
    assert [tuple(r) for r in got] == [('{a="1",b="2"}', 5.0)]
    assert metrics.rejected(s).count() == 1
    g = samples(spark, [("g", {}, 5.0, "inc", 1), ("g", {}, 10.0, "set", 2), ("g", {}, 1.0, "dec", 3),
                        ("k", {}, 4.0, "inc", 1), ("k", {}, 1.0, "dec", 2)])
    assert {r.name: r.value for r in metrics.gauge(g).collect()} == {"g": 9.0, "k": 3.0}


def test_exposition_order(spark, tmp_path):
    s = samples(spark, [("c", {"x": "b"}, 1.0, "inc", 1), ("c", {"x": "a"}, 2.0, "inc", 1)])
    h = samples(spark, [("h", {}, 0.3, "observe", 1)])
    lines = metrics.exposition([
        ("c_total", "help", "counter", metrics.counter(s, ("key",))),
        ("lat", "help", "histogram", metrics.histogram(h, ("key",)))])
    metrics.write_exposition(lines, str(tmp_path / "m"))
    text = "".join(f.read_text() for f in sorted((tmp_path / "m").glob("part-*"))).split("\n")
    assert text[:6] == ["# HELP c_total help", "# TYPE c_total counter", 'c_total{x="a"} 2.0',
                        'c_total{x="b"} 1.0', "", "# HELP lat help"]
    assert 'lat_bucket{le="0.25"} 0' in text and 'lat_bucket{le="+Inf"} 1' in text
    assert text[-3:-1] == ["lat_sum 0.3", "lat_count 1"]


def test_config_threshold_beats_own(spark):
    results = spark.createDataFrame(
        [("cpu", "WARNING", 78.0, 60.0, "m"), ("odd", "CRITICAL", 1.0, 7.0, "m"),
         ("cpu", "OK", 1.0, 1.0, "m")],
        "check string, status string, value double, threshold double, message string")
    user = spark.createDataFrame([("cpu", 75.0, None)],
                                 "check string, warning double, critical double")
    got = {r.check: r.threshold for r in health.result_alerts(
        results, health.thresholds(spark, user)).collect()}
    assert got == {"cpu": 75.0, "odd": 7.0}


def test_empty_report_is_ok(spark):
    df = spark.createDataFrame([("OK",), ("ERROR",), ("CRITICAL",)], "s string")
    assert df.agg(health.worst(F.col("s"))).first()[0] == "ERROR"
    assert df.limit(0).agg(health.worst(F.col("s"))).first()[0] == "OK"
    assert (health.cpu_critical(80), health.cpu_critical(90), health.steep_critical(80)) == (95, 95, 95)


def test_log_check_ignores_what_comes_later(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from skyops.plans.log_check import log_check

    lines = spark.createDataFrame([('{"timestamp": "2030-01-01T00:00:00Z", "level": "ERROR", "message": "late"}',)], "value string")
    rules = [{"name": "any", "metric": "error_count", "operator": ">=", "threshold": 1}]
    assert log_check(lines, rules, F.lit(dt.datetime(2025, 1, 1)).cast("timestamp")).collect() == []
    assert len(log_check(lines, rules, F.lit(dt.datetime(2030, 1, 1, 0, 1)).cast("timestamp")).collect()) == 1


def test_rules_of_a_stream_have_their_own_windows(spark, tmp_path):
    import datetime as dt

    from skyops.streaming import alerts, run

    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(seconds=20 * k), "INFO", "a", "m") for k in range(60)]
    spark.createDataFrame(rows, "ts timestamp, level string, logger string, message string").write.parquet(str(tmp_path / "in"))
    entries = spark.readStream.schema("ts timestamp, level string, logger string, message string").parquet(str(tmp_path / "in"))
    rules = [{"name": "short", "metric": "total_entries", "operator": ">=", "threshold": 10, "window_seconds": 60},
             {"name": "long", "metric": "total_entries", "operator": ">=", "threshold": 10, "window_seconds": 300}]
    events = alerts.watch(entries, rules, None, 120, 60, "0 seconds")
    run.to_files(events, str(tmp_path / "out"), str(tmp_path / "check"), "parquet").awaitTermination()
    fired = {r.name for r in spark.read.schema(alerts.EVENTS).parquet(str(tmp_path / "out")).collect()}
    assert fired == {"long"}  # a minute holds three entries, five minutes hold fifteen
