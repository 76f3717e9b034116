import datetime as dt
import random

import pytest
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from skyops.operators import alerts, logs, ratelimit, timeline
from skyops.operators.timeline import bucketed_lag, sums_of, ticks_of, time_bucket

T0 = dt.datetime(2024, 1, 1)


def entries(spark, rows):
    return spark.createDataFrame(
        [(k, T0 + dt.timedelta(seconds=s), level) for k, s, level in rows],
        "k string, ts timestamp, level string")


@pytest.mark.parametrize("window", [1, 7, 60])
def test_trailing_stats_against_brute_force(spark, window):
    rng = random.Random(window)
    rows = [(rng.choice("ab"), rng.choice([rng.randrange(300), rng.random() * 300]),
             rng.choice(["ERROR", "INFO", "CRITICAL", "DEBUG"])) for _ in range(400)]
    got = {(r.k, r.ts): r for r in logs.trailing_stats(entries(spark, rows), ["k"], window).collect()}
    micros = [(k, round(s * 1e6), level) for k, s, level in
              ((k, dt.timedelta(seconds=s).total_seconds(), level) for k, s, level in rows)]
    for k, us, _ in micros:
        inside = [(u, level) for kk, u, level in micros
                  if kk == k and us - window * 1_000_000 <= u <= us]
        r = got[(k, T0 + dt.timedelta(microseconds=us))]
        assert r.total_entries == len(inside)
        assert r.error_count == sum(level == "ERROR" for _, level in inside)
        assert r.window_start == T0 + dt.timedelta(microseconds=min(inside)[0])


def test_bucketed_lag_equals_lag(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "b"]), i, rng.choice([None, 1, 2]))
            for i in rng.sample(range(5000), 500)]
    df = spark.createDataFrame(rows, "k string, i long, v int")
    got = bucketed_lag(df, ["k"], F.col("i"), F.floor(F.col("i") / 40), F.col("v"), "p")
    want = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("i")))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_error_rate(spark):
    rows = [("a", i, "INFO") for i in range(8)] + [("a", 8, "ERROR"), ("a", 9, "CRITICAL")]
    s = logs.rolling_stats(entries(spark, rows)).first()
    assert s.error_rate == pytest.approx(0.2) and s.throughput == pytest.approx(10 / 9)
    empty = logs.rolling_stats(entries(spark, [])).first()
    assert (empty.total_entries, empty.error_rate, empty.throughput) == (0, 0.0, 0.0)


def test_fire_once_then_resolve(spark):
    stats = spark.createDataFrame(
        [(T0 + dt.timedelta(seconds=86_399 + i), float(v)) for i, v in enumerate([1, 9, 9, 2, 1, 9])],
        "ts timestamp, error_count double")
    for m in alerts.METRICS:
        if m != "error_count":
            stats = stats.withColumn(m, F.lit(0.0))
    rules = alerts.rules_frame(spark, [
        {"name": "e", "metric": "error_count", "operator": ">", "threshold": 5},
        {"name": "x", "metric": "nothing", "operator": ">", "threshold": 5}])
    out = alerts.transitions(alerts.evaluate(stats, rules, ["ts"]), (), "ts")
    rows = sorted(out.collect(), key=lambda r: r.ts)
    assert [r.state for r in rows] == ["firing", "resolved", "firing"]
    text = out.select(alerts.message()).first()[0]
    assert "e — error_count is" in text and text.endswith("(threshold: > 5.0)")
    assert alerts.firing_now(out, (), "ts").count() == 1


def test_bad_rules_are_refused(spark):
    for bad in ({"operator": "~"}, {"severity": "odd"}):
        with pytest.raises(ValueError):
            alerts.rules_frame(spark, [{"name": "a", "metric": "m", "operator": ">",
                                        "threshold": 1, **bad}])


@pytest.mark.parametrize("limit,window", [(1, 5), (3, 10), (5, 60)])
def test_rate_limit_against_brute_force(spark, limit, window):
    rng = random.Random(limit)
    hits = [(i, rng.choice("abc"), rng.choice([1, 1, 1, 40]) * rng.random() * 100)
            for i in range(600)]
    df = spark.createDataFrame([(i, c, T0 + dt.timedelta(seconds=s)) for i, c, s in hits],
                               "event_id long, client string, ts timestamp")
    got = {r.event_id: r.accepted for r in ratelimit.decide(
        df, max_requests=limit, window_seconds=window).collect()}
    kept = {}
    for i, c, us in sorted(((i, c, round(s * 1e6)) for i, c, s in hits),
                           key=lambda h: (h[2], h[0])):
        alive = [t for t in kept.get(c, []) if t > us - window * 1_000_000]
        ok = len(alive) < limit
        kept[c] = alive + [us] if ok else alive
        assert got[i] == ok
    assert len(got) == 600


def test_time_bucket(spark):
    b = spark.range(1).select(time_bucket(F.lit(T0).cast("timestamp"), 60)).first()[0]
    assert b == int((T0 - dt.datetime(1970, 1, 1)).total_seconds()) // 60


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("width", [3, 40, 10_000])
def test_sums_over_buckets_of_any_width(spark, keys, width):
    """Windows that span many buckets, and buckets that hold many windows, null keys too."""
    rng = random.Random(width)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([rng.randrange(900), 5000 + rng.randrange(60)]), rng.randrange(5)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, us long, v long")
    for span in (0, 17, 400):
        ticks = ticks_of(df, keys, F.col("us"), {"s": F.sum("v")})
        got = sorted(map(str, sums_of(ticks, keys, ["s"], span, width).collect()))
        want = []
        for k, us in {(k if keys else None, us) for k, us, _ in rows}:
            inside = [(u, v) for kk, u, v in rows if (not keys or kk == k) and us - span <= u <= us]
            want.append(str(Row(**({"k": k} if keys else {}), _us=us, s=sum(v for _, v in inside), _oldest=min(inside)[0])))
        assert got == sorted(want)


def test_a_dense_stream_gets_narrow_buckets(spark, monkeypatch):
    monkeypatch.setattr(timeline, "TICKS", 1000)
    dense = spark.range(50_000).select(F.col("id").alias("us"))
    assert timeline.bucket_width(dense, [], F.col("us"), 10**12) == 1000 * timeline.MICROS // 50_000
    ticks = ticks_of(dense, [], F.col("us"), {"n": F.count(F.lit(1))})
    sums = sums_of(ticks, [], ["n"], 9999, 20_000)
    assert sums.agg(F.max("n"), F.sum("n")).first()[:] == (10_000, sum(min(i + 1, 10_000) for i in range(50_000)))
    sparse = spark.range(10).select((F.col("id") * 3_600_000_000).alias("us"))
    assert timeline.bucket_width(sparse, [], F.col("us"), 123_456_789) == 123_456_789
    assert timeline.bucket_width(sparse.limit(0), [], F.col("us"), 123_456_789) == 123_456_789


def test_rules_keep_the_rows_of_a_metric_apart(spark):
    """Statistics are not dealt by metric, and the tasks of a timeline grow with its rows."""
    stats = spark.range(2000).select(F.timestamp_micros("id").alias("ts"), *[F.col("id").cast("double").alias(m) for m in alerts.METRICS])
    rules = alerts.rules_frame(spark, [{"name": "e", "metric": "error_count", "operator": ">", "threshold": 5}])
    plan = alerts.evaluate(stats.repartition(6), rules, ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(metric" not in plan


def test_tasks_of_a_timeline_grow_with_its_rows(spark, monkeypatch):
    monkeypatch.setattr(timeline, "ROWS", 100)
    df = spark.range(2000).select("id", (F.col("id") % 7).alias("v"))
    got = bucketed_lag(df, [], F.col("id"), F.floor(F.col("id") / 20), F.col("v"), "p", 2000)
    rows = [(r.id, r.p, r.at) for r in got.withColumn("at", F.spark_partition_id()).collect()]
    assert sorted(r[:2] for r in rows if r[1] is not None) == [(i, (i - 1) % 7) for i in range(1, 2000)]
    assert max(sum(r[2] == t for r in rows) for t in {r[2] for r in rows}) < 500
    ticks = spark.range(2000).select(F.col("id").alias("_us"), F.lit(1).alias("n"))
    want = sorted(map(str, sums_of(ticks, [], ["n"], 30, 50).collect()))
    dealt = sums_of(ticks, [], ["n"], 30, 50, 2000)
    assert sorted(map(str, dealt.collect())) == want and dealt.select(F.spark_partition_id()).distinct().count() > 10
