"""Stream tables: bounded by keys, unchanged by repeated batches; firing alerts from the state."""

import datetime as dt
import pathlib
import random

from pyspark.sql import functions as F

from skyops.operators.metrics import keyed
from skyops.sinks import upsert
from skyops.streaming import alerts as st_alerts
from skyops.streaming import metrics as st_metrics
from skyops.streaming import ratelimit as st_ratelimit
from skyops.streaming import run, upsert as st_upsert

T0 = dt.datetime(2024, 1, 1)


def test_latest_rows_are_bounded_by_keys(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, n bigint"
    write = st_metrics.latest_table(path, schema, ["k"], buckets=4)
    sizes = []
    for batch in range(8):
        write(spark.createDataFrame([(f"k{i}", batch * 10 + i) for i in range(5)], schema), batch)
        sizes.append(len(list(pathlib.Path(path).rglob("part-*"))))
    write(spark.createDataFrame([("k1", -1)], schema), 3)  # an older batch again
    assert {r.k: r.n for r in upsert.read_table(spark, path, schema).collect()} == {f"k{i}": 70 + i for i in range(5)}
    assert max(sizes) <= 5


def test_gauges_over_batches(spark, tmp_path):
    rng = random.Random(6)
    path = str(tmp_path / "g")
    write = st_metrics.gauge_table(path, buckets=4)
    rows, want = [], {}
    for i in range(300):
        rows.append((i, T0 + dt.timedelta(seconds=i // 3), "g", {"a": rng.choice("xyz")}, float(rng.randrange(9)), rng.choice(["set", "inc", "dec", "inc"])))
    for start in range(0, 300, 60):
        part = rows[start : start + 60]
        rng.shuffle(part)
        df = keyed(spark.createDataFrame(part, "event_id long, ts timestamp, name string, labels map<string,string>, value double, op string"))
        write(df, start // 60)
        write(df, start // 60)  # a repeated batch changes nothing
    for _, _, _, labels, value, op in sorted(rows, key=lambda r: r[0]):
        k = labels["a"]
        want[k] = value if op == "set" else want.get(k, 0.0) + (value if op == "inc" else -value)
    got = {r.label: r.value for r in st_metrics.read_gauges(spark, path).collect()}
    assert sorted(got.values()) == sorted(want.values()) and len(got) == 3


def test_limits_over_batches(spark, tmp_path):
    rng = random.Random(4)
    hits = sorted((rng.random() * 300, i, rng.choice(["a", "b", None])) for i in range(240))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    write = st_ratelimit.limit_batches(out, state, max_requests=3, window_seconds=20, buckets=2)
    kept, want = {}, {}
    for s, i, c in hits:
        us = round(s * 1e6)
        alive = [t for t in kept.get(c, []) if t > us - 20_000_000]
        want[i] = len(alive) < 3
        kept[c] = [*alive, us] if want[i] else alive
    for batch in range(4):
        part = [(i, c, T0 + dt.timedelta(microseconds=round(s * 1e6))) for s, i, c in hits[60 * batch : 60 * batch + 60]]
        rng.shuffle(part)
        df = spark.createDataFrame(part, "event_id long, client string, ts timestamp")
        write(df, batch)
        if batch == 2:
            write(df, batch)  # decided again as before
    got = {r.seq: r.accepted for r in st_ratelimit.read_decisions(spark, out).collect()}
    assert got == want and not all(want.values())
    assert max(len(r.times) for r in upsert.read_table(spark, state, st_ratelimit.STATE).collect()) <= 3


def log_files(spark, folder, levels, start):
    rows = [(T0 + dt.timedelta(seconds=start + i), level, "app", "m") for i, level in enumerate(levels)]
    spark.createDataFrame(rows, "ts timestamp, level string, logger string, message string").coalesce(1).write.mode("append").parquet(folder)


def test_firing_now_follows_the_stream(spark, tmp_path):
    folder, check = str(tmp_path / "in"), str(tmp_path / "check")
    rules = [{"name": "errors", "metric": "error_count", "operator": ">", "threshold": 2},
             {"name": "many", "metric": "total_entries", "operator": ">=", "threshold": 1}]
    firing = []
    for k, levels in enumerate((["INFO"] * 60, ["ERROR"] * 60, ["INFO"] * 120)):
        log_files(spark, folder, levels, 60 * k)
        entries = spark.readStream.schema("ts timestamp, level string, logger string, message string").parquet(folder)
        events = st_alerts.watch(entries, rules, None, 30, 10, "0 seconds")
        run.to_files(events, str(tmp_path / "out"), check).awaitTermination()
        firing.append({r.name for r in st_alerts.firing_now(spark, check).collect()})
    assert firing == [{"many"}, {"many", "errors"}, {"many"}]


def test_redelivered_rows_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "in")
    for _ in range(2):
        spark.range(50).withColumn("ts", F.lit(T0).cast("timestamp")).write.mode("append").parquet(folder)
    rows = spark.readStream.schema("id long, ts timestamp").parquet(folder)
    run.to_files(st_upsert.without_redelivered(rows, ["id"], "ts", "1 hour"), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50
