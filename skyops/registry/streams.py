"""Streaming queries, run over the event file until it is exhausted, then read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from skyops.functions.labels import format_labels
from skyops.operators import alerts, health, logs, metrics
from skyops.registry import bindings as b
from skyops.registry import logs as log_queries
from skyops.registry import query
from skyops.registry.catalog import _CLEAN_OUT, _ROUTED, _clean_out
from skyops.registry.health import (_CHECKS_SQL, _KEYS, _OUT_TEXT, _REPORT_SQL, _names,
                                    check_rows)
from skyops.registry.metrics import _ACCESS, _ACCESS_SQL, _KEY_SQL, _LABELS_SPARK, _OP, _buckets_sql
from skyops.session import scratch_dir
from skyops.sinks import events as event_sink
from skyops.sinks import upsert
from skyops.sources import checks as check_source
from skyops.sources import logs as log_source
from skyops.streaming import alerts as st_alerts
from skyops.streaming import health as st_health
from skyops.streaming import logs as st_logs
from skyops.streaming import metrics as st_metrics
from skyops.streaming import ratelimit as st_ratelimit
from skyops.streaming import run
from skyops.streaming import upsert as st_upsert

_AS_OF = dt.datetime(2024, 2, 1)


def stream(spark, sf, name):
    """One of the given tables as a file stream."""
    schema = b.table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def event_stream(spark, sf):
    df = stream(spark, sf, "events")
    return df.withColumn("ts", df["ts"].cast("timestamp"))


def log_stream(spark, sf):
    return event_stream(spark, sf).selectExpr(
        "event_id", "ts", f"{b.LEVEL_CASE} AS level", "CAST(user_id AS STRING) AS logger",
        f"{b.MESSAGE} AS message", "from_json(props, 'map<string,string>') AS context")


def drain(spark, df, name, fmt="parquet", schema=None):
    """Run a stream to its end into files and read them."""
    path = scratch_dir(spark, name)
    run.to_files(df, f"{path}/out", f"{path}/checkpoint", fmt).awaitTermination()
    reader = spark.read.schema(schema or df.schema)
    return reader.format(fmt).load(f"{path}/out")


def drain_updates(spark, df, name, keys):
    """Run a stream in update mode into a table that keeps the newest row of every key."""
    path = scratch_dir(spark, name)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    run.each_batch(df, st_metrics.latest_table(f"{path}/out", schema, keys), f"{path}/checkpoint", "update").awaitTermination()
    return upsert.read_table(spark, f"{path}/out", schema)


# -- logs --------------------------------------------------------------------------------------

_N, _SLIDE, _DELAY = 3600, 1200, 600
_W = _N // _SLIDE
_WINDOWS = f"""l AS ({b.LOGS_SQL}), mx AS (SELECT max(us) AS top FROM l),
wr AS (SELECT *, (us // {_SLIDE * 1000000} - i) * {_SLIDE * 1000000} AS start_us
  FROM l, (SELECT unnest(range({_W})) AS i)),
w AS (SELECT {{keys}}start_us, count(*) AS total_entries,
  count(*) FILTER (level = 'ERROR') AS error_count,
  count(*) FILTER (level = 'CRITICAL') AS critical_count,
  count(*) FILTER (level = 'WARNING') AS warning_count,
  count(*) FILTER (level = 'DEBUG') AS debug_count,
  count(*) FILTER (level NOT IN ('ERROR', 'CRITICAL', 'WARNING', 'DEBUG')) AS info_count,
  min(us) AS first_us, max(us) AS last_us FROM wr
  GROUP BY ALL),
closed AS (SELECT * FROM w, mx WHERE start_us + {_N * 1000000} <= top - {_DELAY * 1000000})"""
_COLS = ("total_entries", "error_count", "critical_count", "warning_count", "debug_count",
         "info_count")


@query("st_sliding_stats", f"""WITH {_WINDOWS.format(keys='logger, ')} SELECT logger, start_us,
  {', '.join(_COLS)}, round((error_count + critical_count) / total_entries, 9) AS error_rate,
  round(CASE WHEN last_us > first_us THEN total_entries / ((last_us - first_us) / 1e6) ELSE 0 END,
  9) AS throughput FROM closed""")
def _(spark, sf):
    stats = st_logs.sliding_stats(log_stream(spark, sf), ["logger"], _N, _SLIDE,
                                  f"{_DELAY} seconds")
    rows = stats.select("logger", F.unix_micros("window.start").alias("start_us"), *_COLS,
                        F.round("error_rate", 9).alias("error_rate"),
                        F.round("throughput", 9).alias("throughput"))
    return drain(spark, rows, "sliding")


@query("win_sliding_batch", f"""WITH {_WINDOWS.format(keys='logger, ')} SELECT logger, start_us,
  {', '.join(_COLS)} FROM w""")
def _(spark, sf):
    stats = st_logs.sliding_stats_batch(b.logs(spark, sf), ["logger"], _N, _SLIDE)
    return stats.select("logger", F.unix_micros("window.start").alias("start_us"), *_COLS)


_RULES = [
    {"name": "high_error_rate", "metric": "error_rate", "operator": ">", "threshold": 0.5,
     "severity": "critical"},
    {"name": "busy", "metric": "total_entries", "operator": ">=", "threshold": 18},
]


@query("st_alerts", f"""WITH {_WINDOWS.format(keys='')},
ev AS (SELECT 'high_error_rate' AS name, start_us + {_N * 1000000} AS us,
    (error_count + critical_count) / total_entries AS value,
    (error_count + critical_count) / total_entries > 0.5 AS breached FROM closed
  UNION ALL SELECT 'busy', start_us + {_N * 1000000}, CAST(total_entries AS DOUBLE),
    total_entries >= 18 FROM closed)
SELECT name, us, round(value, 9) AS value, CASE WHEN breached THEN 'firing' ELSE 'resolved' END
  AS state FROM (SELECT *, lag(breached, 1, false) OVER (PARTITION BY name ORDER BY us) AS was
  FROM ev) WHERE breached <> was""")
def _(spark, sf):
    events = st_alerts.watch(log_stream(spark, sf), _RULES, None, _N, _SLIDE, f"{_DELAY} seconds")
    return drain(spark, events, "alerts", schema=st_alerts.EVENTS).select(
        "name", F.unix_micros("ts").alias("us"), F.round("value", 9).alias("value"), "state")


@query("st_firing_now", f"""WITH {_WINDOWS.format(keys='')},
ev AS (SELECT 'high_error_rate' AS name, start_us + {_N * 1000000} AS us,
    (error_count + critical_count) / total_entries AS value,
    (error_count + critical_count) / total_entries > 0.5 AS breached FROM closed
  UNION ALL SELECT 'busy', start_us + {_N * 1000000}, CAST(total_entries AS DOUBLE),
    total_entries >= 18 FROM closed),
ch AS (SELECT * FROM (SELECT *, lag(breached, 1, false) OVER (PARTITION BY name ORDER BY us) AS was FROM ev) WHERE breached <> was)
SELECT name, '' AS stream, max(us) AS us, round(arg_max(value, us), 9) AS value FROM ch GROUP BY 1 HAVING arg_max(breached, us)""")
def _(spark, sf):
    """The alerts that fire once the log is read to its end, from the state of the alert query."""
    path = scratch_dir(spark, "firing")
    events = st_alerts.watch(log_stream(spark, sf), _RULES, None, _N, _SLIDE, f"{_DELAY} seconds")
    run.to_files(events, f"{path}/alerts", f"{path}/checkpoint").awaitTermination()
    return st_alerts.firing_now(spark, f"{path}/checkpoint").select(
        "name", "stream", F.unix_micros("ts").alias("us"), F.round("value", 9).alias("value"))


@query("pipe_log_watch", f"""WITH {_WINDOWS.format(keys='')},
ev AS (SELECT 'busy' AS alert, 'WARNING: busy — total_entries is' AS what, '>= 18.0' AS bound,
    start_us + {_N * 1000000} AS us, CAST(total_entries AS DOUBLE) AS value, total_entries >= 18 AS breached
  FROM closed
  UNION ALL SELECT 'high_error_rate', 'CRITICAL: high_error_rate — error_rate is', '> 0.5',
    start_us + {_N * 1000000}, (error_count + critical_count) / total_entries,
    (error_count + critical_count) / total_entries > 0.5 FROM closed)
SELECT alert, CASE WHEN breached THEN 'firing' ELSE 'resolved' END AS state,
  printf('[%s] %s %.4f (threshold: %s)', CASE WHEN breached THEN 'FIRING' ELSE 'RESOLVED' END, what, value, bound) AS message,
  us FROM (SELECT *, lag(breached, 1, false) OVER (PARTITION BY alert ORDER BY us) AS was FROM ev)
WHERE breached <> was""")
def _(spark, sf):
    """Log lines on files -> entries -> statistics -> rules -> alert lines, continuously."""
    path = scratch_dir(spark, "watch")
    lines = b.logs(spark, sf).select(F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"), "level",
        F.col("logger").alias("logger_name"), "message")).alias("value"))
    lines.write.text(f"{path}/log")
    entries = logs.parse(log_source.stream_lines(spark, f"{path}/log"),
                         as_of=F.lit(_AS_OF).cast("timestamp"))
    events = st_alerts.watch(entries, _RULES, None, _N, _SLIDE, f"{_DELAY} seconds")
    text = events.select(alerts.event_json("ts").alias("value"))
    run.to_files(text, f"{path}/alerts", f"{path}/checkpoint", "text").awaitTermination()
    back = spark.read.schema("alert string, state string, message string, triggered_at double")
    return back.json(f"{path}/alerts").select(
        "alert", "state", "message", F.round(F.col("triggered_at") * 1e6).cast("bigint").alias("us"))


@query("src_log_stream", f"WITH {log_queries._AUTO} SELECT level, logger, message FROM auto")
def _(spark, sf):
    path = scratch_dir(spark, "follow")
    b.log_lines(spark, sf).select("value").write.text(f"{path}/log")
    entries = logs.parse(log_source.stream_lines(spark, f"{path}/log", max_files=4),
                         as_of=F.lit(_AS_OF).cast("timestamp"))
    return drain(spark, entries.select("level", "logger", "message"), "entries")


@query("st_level_counts", f"""WITH l AS ({b.LOGS_SQL}) SELECT logger, {log_queries._COUNTS}
  FROM l GROUP BY 1""")
def _(spark, sf):
    counts = log_stream(spark, sf).groupBy("logger").agg(
        *[c.alias(n) for n, c in logs.level_counts().items()])
    return drain_updates(spark, counts, "levels", ["logger"])


@query("st_on_entry", f"""WITH l AS ({b.LOGS_SQL}) SELECT level, count(*) AS n FROM l
  WHERE level IN ('ERROR', 'CRITICAL') GROUP BY 1""")
def _(spark, sf):
    path = scratch_dir(spark, "callback")

    def keep_errors(batch, batch_id):
        (batch.filter(F.col("level").isin("ERROR", "CRITICAL")).select("event_id", "level")
         .write.mode("overwrite").parquet(f"{path}/b={batch_id}"))

    st_logs.on_entry(log_stream(spark, sf), keep_errors, f"{path}/checkpoint").awaitTermination()
    rows = spark.read.schema("event_id bigint, level string").option(
        "pathGlobFilter", "*.parquet").parquet(f"{path}/b=*")
    return rows.groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@query("udf_callback", f"""WITH l AS ({b.LOGS_SQL}) SELECT logger, count(*) AS warnings FROM l
  WHERE level = 'WARNING' GROUP BY 1""")
def _(spark, sf):
    path = scratch_dir(spark, "callback")

    def count_warnings(batch, batch_id):
        (batch.filter(F.col("level") == "WARNING").groupBy("logger")
         .agg(F.count(F.lit(1)).alias("warnings")).write.mode("overwrite")
         .parquet(f"{path}/b={batch_id}"))

    st_logs.on_entry(log_stream(spark, sf), count_warnings, f"{path}/checkpoint").awaitTermination()
    rows = spark.read.schema("logger string, warnings bigint").parquet(f"{path}/b=*")
    return rows.groupBy("logger").agg(F.sum("warnings").alias("warnings"))


@query("st_json_logs", f"""WITH l AS ({b.LOGS_SQL}) SELECT level, logger AS logger_name, message,
  props ->> '$.k' AS k FROM l""")
def _(spark, sf):
    lines = log_stream(spark, sf).select(event_sink.json_log_line().alias("value"))
    out = drain(spark, lines, "json-logs", "text")
    parsed = out.select(F.from_json("value", "level string, logger_name string, message string, "
                                             "context map<string,string>").alias("r"))
    return parsed.select("r.level", "r.logger_name", "r.message",
                         F.col("r.context")["k"].alias("k"))


# The older events come second: what lies behind the watermark by then is dropped.
@query("st_late_policy", """WITH t AS (SELECT ts, event_id,
  epoch_us(ts) >= (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 FROM events) AS young
  FROM events)
SELECT 'kept' AS what, count(*) AS n FROM t WHERE young
UNION ALL SELECT 'late', count(*) FROM t WHERE NOT young""")
def _(spark, sf):
    """Rows that a stateful stream kept, and the number that Spark says it dropped."""
    path = scratch_dir(spark, "late")
    events = b.events(spark, sf).select("event_id", "ts")
    us = F.unix_micros("ts")
    low, high = events.agg(F.min(us), F.max(us)).first()
    young = us >= (low + high) // 2
    late = 0
    for part in (events.filter(young), events.filter(~young)):
        part.write.mode("append").parquet(f"{path}/in")
        rows = spark.readStream.schema(events.schema).option("pathGlobFilter", "*.parquet").parquet(f"{path}/in")
        once = rows.withWatermark("ts", "10 minutes").dropDuplicates(["event_id", "ts"])
        query = run.to_files(once, f"{path}/out", f"{path}/checkpoint")
        query.awaitTermination()
        late += run.late_rows(query)
    kept = spark.read.schema(events.schema).parquet(f"{path}/out").agg(F.count(F.lit(1)).alias("n"))
    return kept.select(F.lit("kept").alias("what"), "n").unionByName(
        spark.createDataFrame([("late", late)], "what string, n bigint"))


# -- metrics ----------------------------------------------------------------------------------------

def sample_stream(spark, sf):
    rows = event_stream(spark, sf).selectExpr(
        "event_id", "ts", "event_type AS name", f"{_LABELS_SPARK} AS labels", "value",
        f"{_OP} AS op")
    return metrics.keyed(rows)


_S = (f"s AS (SELECT event_id, event_type AS name, {_KEY_SQL} AS label, value, {_OP} AS op "
      "FROM events)")


@query("st_counters", f"""WITH {_S} SELECT name, label, round(sum(value), 6) AS value FROM s
  GROUP BY 1, 2""")
def _(spark, sf):
    rows = metrics.counter(sample_stream(spark, sf)).select(
        "name", format_labels(F.col("key")).alias("label"), "value")
    return drain_updates(spark, rows, "counters", ["name", "label"]).withColumn(
        "value", F.round("value", 6))


@query("st_histogram", f"""WITH {_S} SELECT name, label, count(*) FILTER (value <= 0.5) AS le_05,
  count(*) FILTER (value <= 10) AS le_10, count(*) AS n, round(sum(value), 6) AS total
  FROM s GROUP BY 1, 2""")
def _(spark, sf):
    hist = metrics.histogram(sample_stream(spark, sf)).select(
        "name", format_labels(F.col("key")).alias("label"), "buckets", "sum", "count")
    rows = drain_updates(spark, hist, "histogram", ["name", "label"])
    at = metrics.bounds_of()
    return rows.select("name", "label", F.col("buckets")[at.index(0.5)].alias("le_05"),
                       F.col("buckets")[at.index(10.0)].alias("le_10"), F.col("count").alias("n"),
                       F.round("sum", 6).alias("total"))


@query("st_gauge", f"""WITH {_S}, l AS (SELECT name, label, max(event_id) FILTER (op = 'set')
  AS last_set FROM s GROUP BY 1, 2)
SELECT s.name, s.label, round(sum(CASE op WHEN 'dec' THEN -value ELSE value END), 6) AS value
FROM s JOIN l ON s.name = l.name AND s.label = l.label
WHERE last_set IS NULL OR event_id >= last_set GROUP BY 1, 2""")
def _(spark, sf):
    path = scratch_dir(spark, "gauges")
    run.each_batch(sample_stream(spark, sf), st_metrics.gauge_table(f"{path}/out"), f"{path}/checkpoint").awaitTermination()
    return st_metrics.read_gauges(spark, f"{path}/out").withColumn("value", F.round("value", 6))


@query("st_request_metrics", f"""WITH {_ACCESS_SQL} SELECT method, endpoint,
  'requests' AS kind, CAST(status AS VARCHAR) AS item, count(*) AS n FROM a GROUP BY 1, 2, 4
UNION ALL SELECT method, endpoint, 'latency', le, cumulative FROM
  ({_buckets_sql('method, endpoint', 'a', 'latency')})""")
def _(spark, sf):
    """Request counts and the latency histogram of a stream of hits."""
    access = event_stream(spark, sf).selectExpr(*[f"{e} AS `{c}`" for c, e in _ACCESS])
    counts = drain_updates(spark, metrics.request_counts(access), "requests", ["method", "endpoint", "status"])
    latency = drain_updates(spark, metrics.request_latency(access), "latency", ["method", "endpoint"])
    return counts.select("method", "endpoint", F.lit("requests").alias("kind"), F.col("status").cast("string").alias("item"),
                         F.col("requests").alias("n")).unionByName(metrics.histogram_buckets(latency, ("method", "endpoint")).select(
        "method", "endpoint", F.lit("latency").alias("kind"), F.col("le").alias("item"), F.col("cumulative").alias("n")))


@query("st_rate_limit", """WITH RECURSIVE h AS (SELECT event_id, user_id AS client,
  epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
f AS (SELECT event_id, client, us, rn, true AS accepted, [us] AS kept FROM h WHERE rn = 1
  UNION ALL
  SELECT h.event_id, h.client, h.us, h.rn,
    len(list_filter(f.kept, lambda t: t > h.us - 86400000000)) < 3,
    CASE WHEN len(list_filter(f.kept, lambda t: t > h.us - 86400000000)) < 3
      THEN list_append(list_filter(f.kept, lambda t: t > h.us - 86400000000), h.us)
      ELSE list_filter(f.kept, lambda t: t > h.us - 86400000000) END
  FROM f JOIN h ON h.client = f.client AND h.rn = f.rn + 1)
SELECT event_id, CAST(client AS VARCHAR) AS client, accepted FROM f""")
def _(spark, sf):
    access = event_stream(spark, sf).selectExpr("event_id", "user_id AS client", "ts")
    path = scratch_dir(spark, "limit")
    decide = st_ratelimit.limit_batches(f"{path}/out", f"{path}/state", max_requests=3, window_seconds=86_400)
    run.each_batch(access, decide, f"{path}/checkpoint").awaitTermination()
    return st_ratelimit.read_decisions(spark, f"{path}/out").withColumnRenamed("seq", "event_id")


# -- health and catalog ---------------------------------------------------------------------------

@query("st_check_results", "SELECT status, count(*) AS n FROM (SELECT CASE WHEN event_id % 8 "
       "IN (0, 1, 2, 5) THEN 'ERROR' WHEN event_id % 8 = 3 THEN 'OK' WHEN event_id % 8 = 4 "
       "THEN 'WARNING' WHEN value < 60 THEN 'OK' WHEN value < 100 THEN 'WARNING' "
       "WHEN value < 200 THEN 'CRITICAL' ELSE 'ERROR' END AS status FROM events) GROUP BY 1")
def _(spark, sf):
    path = scratch_dir(spark, "check-stream")
    b.events(spark, sf).selectExpr(f"{_OUT_TEXT} AS value").write.text(path)
    rows = check_source.stream_check_results(spark, path, F.lit(_AS_OF).cast("timestamp"))
    out = drain(spark, rows.select("check", "status"), "checks")
    return out.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("st_health_report", f"""WITH {_CHECKS_SQL}, {_REPORT_SQL} SELECT *,
  CASE overall_status WHEN 'CRITICAL' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END AS exit_code FROM rep""")
def _(spark, sf):
    """Latest result per check in a table that a stream keeps; the report folds those rows per run.

    A batch is reduced to its latest results before they meet the stored ones, so the stream holds no state.
    """
    from skyops.registry.health import _CHECK_COLS

    path = scratch_dir(spark, "report")
    rows = event_stream(spark, sf).selectExpr(
        "date_format(ts, 'yyyy-MM-dd') AS run", *[f"{e} AS `{c}`" for c, e in _CHECK_COLS])
    rows = rows.select(*check_rows(spark, sf).columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    run.each_batch(rows, st_health.latest_results_table(path + "/out", schema, _KEYS, "event_id"), path + "/checkpoint").awaitTermination()
    report = health.report(upsert.read_table(spark, path + "/out", schema), _KEYS)
    return report.withColumn("checks", _names(F.col("checks")))


@query("st_upsert", f"WITH {_ROUTED} SELECT {_CLEAN_OUT}, 'run-s' AS run_id FROM routed "
       "WHERE outcome = 'valid'")
def _(spark, sf):
    """Every row is delivered twice; what comes again is dropped before the table sees it."""
    path = scratch_dir(spark, "stream-upsert")
    part = stream(spark, sf, "part")
    twice = part.unionByName(stream(spark, sf, "part")).withColumn("_at", F.timestamp_seconds(F.col("p_partkey")))
    once = st_upsert.without_redelivered(twice, ["p_partkey"], "_at", "1 day").select(*part.columns)
    raw = b.project(once, b.RAW).withColumn("disc_year", F.col("disc_year").cast("int"))
    st_upsert.upsert_stream(raw, f"{path}/catalog", f"{path}/checkpoint",
                            "run-s").awaitTermination()
    return _clean_out(upsert.read_table(spark, f"{path}/catalog").drop("ingested_at", "updated_at"))
