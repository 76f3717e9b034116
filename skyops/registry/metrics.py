"""Counter, gauge, histogram, exposition, label and rate-limit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyops.functions.labels import format_labels, label_key
from skyops.operators import metrics, ratelimit
from skyops.registry import bindings as b
from skyops.registry import query
from skyops.session import scratch_dir

# -- inputs: events as samples and as an access log ------------------------------------------

_LABELS_SPARK = ("map('user', CAST(user_id AS STRING), 'kind', "
                 "CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END)")
_KEY_SQL = ("'{kind=\"' || CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END "
            "|| '\",user=\"' || user_id || '\"}'")
_OP = "CASE WHEN event_id % 5 = 0 THEN 'set' WHEN event_id % 2 = 1 THEN 'inc' ELSE 'dec' END"
_ACCESS = [
    ("event_id", "event_id"), ("client", "user_id"),
    ("method", "CASE WHEN event_type IN ('click', 'view') THEN 'GET' ELSE 'POST' END"),
    ("endpoint", "concat('/', event_type)"),
    ("status", "CASE WHEN event_id % 11 = 0 THEN 500 WHEN event_id % 7 = 0 THEN 404 ELSE 200 END"),
    ("latency", "value / 100"),
]


def samples(spark, sf):
    df = b.events(spark, sf).selectExpr(
        "event_id", "ts", "event_type AS name", f"{_LABELS_SPARK} AS labels", "value",
        f"{_OP} AS op")
    return metrics.keyed(df)


def access_log(spark, sf):
    cols = [f"{e} AS `{c}`" for c, e in _ACCESS]
    return b.events(spark, sf).selectExpr("ts", *cols)


_SAMPLES_SQL = (f"s AS (SELECT event_id, epoch_us(ts) AS us, event_type AS name, {_KEY_SQL} "
                f"AS label, value, {_OP} AS op FROM events)")
_ACCESS_SQL = "a AS (SELECT epoch_us(ts) AS us, " + ", ".join(
    f"{e} AS {c}" for c, e in _ACCESS) + " FROM events)"


@query("label_key", f"WITH {_SAMPLES_SQL} SELECT label, count(*) AS n FROM s GROUP BY 1")
def _(spark, sf):
    return samples(spark, sf).groupBy(format_labels(F.col("key")).alias("label")).agg(
        F.count(F.lit(1)).alias("n"))


@query("agg_counter", f"WITH {_SAMPLES_SQL} SELECT name, label, round(sum(value - 5), 6) AS value "
       "FROM s WHERE value >= 5 GROUP BY 1, 2")
def _(spark, sf):
    rows = samples(spark, sf).withColumn("value", F.col("value") - 5)
    return metrics.counter(rows).select("name", format_labels(F.col("key")).alias("label"),
                                        F.round("value", 6).alias("value"))


@query("agg_counter_rejected", "SELECT event_type AS name, count(*) AS rejected FROM events "
       "WHERE value < 5 GROUP BY 1")
def _(spark, sf):
    rows = samples(spark, sf).withColumn("value", F.col("value") - 5)
    return metrics.rejected(rows).groupBy("name").agg(F.count(F.lit(1)).alias("rejected"))


@query("agg_gauge", f"""WITH {_SAMPLES_SQL}, l AS (SELECT name, label,
  max(event_id) FILTER (op = 'set') AS last_set FROM s GROUP BY 1, 2)
SELECT s.name, s.label, round(sum(CASE op WHEN 'dec' THEN -value ELSE value END), 6) AS value
FROM s JOIN l ON s.name = l.name AND s.label = l.label
WHERE last_set IS NULL OR event_id >= last_set GROUP BY 1, 2""")
def _(spark, sf):
    return metrics.gauge(samples(spark, sf), ("ts", "event_id")).select(
        "name", format_labels(F.col("key")).alias("label"), F.round("value", 6).alias("value"))


_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]


def _buckets_sql(by, source, value):
    rows = [f"SELECT {by}, '{x}' AS le, count(*) FILTER ({value} <= {x}) AS cumulative "
            f"FROM {source} GROUP BY {by}" for x in _BOUNDS]
    rows.append(f"SELECT {by}, '+Inf' AS le, count(*) AS cumulative FROM {source} GROUP BY {by}")
    return " UNION ALL ".join(rows)


@query("agg_histogram", f"WITH {_SAMPLES_SQL} "
       + _buckets_sql("name, label", "s", "value / 100"))
def _(spark, sf):
    rows = samples(spark, sf).withColumn("value", F.col("value") / 100)
    out = metrics.histogram_buckets(metrics.histogram(rows))
    return out.select("name", format_labels(F.col("key")).alias("label"), "le", "cumulative")


@query("agg_request_metrics", f"""WITH {_ACCESS_SQL} SELECT method, endpoint,
  'requests' AS kind, CAST(status AS VARCHAR) AS item, count(*) AS n FROM a GROUP BY 1, 2, 4
UNION ALL SELECT method, endpoint, 'latency', le, cumulative FROM
  ({_buckets_sql('method, endpoint', 'a', 'latency')})""")
def _(spark, sf):
    access = access_log(spark, sf)
    counts = metrics.request_counts(access).select(
        "method", "endpoint", F.lit("requests").alias("kind"),
        F.col("status").cast("string").alias("item"), F.col("requests").alias("n"))
    by = ("method", "endpoint")
    latency = metrics.histogram_buckets(metrics.request_latency(access), by).select(
        *by, F.lit("latency").alias("kind"), F.col("le").alias("item"),
        F.col("cumulative").alias("n"))
    return counts.unionByName(latency)


def _blocks(spark, sf):
    rows = samples(spark, sf).withColumn("value", F.floor("value").cast("double"))
    click, view, error = (rows.filter(F.col("name") == n) for n in ("click", "view", "error"))
    return [
        ("clicks_total", "Clicks", "counter", metrics.counter(click, ("key",))),
        ("views_now", "Views", "gauge", metrics.gauge(view, ("ts", "event_id"), ("key",))),
        ("errors", "Errors", "histogram", metrics.histogram(error, ("key",))),
    ]


def _hist_lines_sql():
    label = "replace(label, '{kind', '{kind')"
    parts = []
    for x in [*map(str, _BOUNDS), "+Inf"]:
        cond = "" if x == "+Inf" else f" FILTER (floor(value) <= {x})"
        parts.append(f"SELECT 'errors_bucket' || replace({label}, ',user=', ',le=\"{x}\",user=') "
                     f"|| ' ' || count(*){cond} AS line FROM s WHERE name = 'error' GROUP BY label")
    parts.append("SELECT 'errors_sum' || label || ' ' || CAST(sum(floor(value)) AS VARCHAR) "
                 "FROM s WHERE name = 'error' GROUP BY label")
    parts.append("SELECT 'errors_count' || label || ' ' || count(*) FROM s "
                 "WHERE name = 'error' GROUP BY label")
    return " UNION ALL ".join(parts)


@query("sink_exposition", f"""WITH {_SAMPLES_SQL}, g AS (SELECT label,
  max(event_id) FILTER (op = 'set') AS last_set FROM s WHERE name = 'view' GROUP BY 1)
SELECT unnest(['# HELP clicks_total Clicks', '# TYPE clicks_total counter', '',
  '# HELP views_now Views', '# TYPE views_now gauge', '', '# HELP errors Errors',
  '# TYPE errors histogram']) AS line
UNION ALL SELECT 'clicks_total' || label || ' ' || CAST(sum(floor(value)) AS VARCHAR) FROM s
  WHERE name = 'click' GROUP BY label
UNION ALL SELECT 'views_now' || s.label || ' ' ||
  CAST(sum(CASE op WHEN 'dec' THEN -floor(value) ELSE floor(value) END) AS VARCHAR)
  FROM s JOIN g ON s.label = g.label WHERE name = 'view'
  AND (last_set IS NULL OR event_id >= last_set) GROUP BY s.label
UNION ALL {_hist_lines_sql()}""")
def _(spark, sf):
    path = scratch_dir(spark, "exposition")
    metrics.write_exposition(metrics.exposition(_blocks(spark, sf)), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("sort_labels", f"""WITH {_SAMPLES_SQL}, c AS (SELECT name, label, count(*) AS n FROM s
  GROUP BY 1, 2) SELECT name, label, row_number() OVER (PARTITION BY name ORDER BY
  regexp_extract(label, 'kind="(\\w+)"', 1), regexp_extract(label, 'user="(\\d+)"', 1))
  AS position FROM c""")
def _(spark, sf):
    from pyspark.sql import Window

    groups = samples(spark, sf).groupBy("name", "key").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("name").orderBy("key")
    return groups.select("name", format_labels(F.col("key")).alias("label"),
                         F.row_number().over(w).cast("long").alias("position"))


# Three accepted hits per client and day; every client and hit of the log takes part.
@query("win_rate_limit", f"""WITH RECURSIVE {_ACCESS_SQL},
h AS (SELECT event_id, client, us, row_number() OVER (PARTITION BY client ORDER BY us, event_id)
  AS rn FROM a),
f AS (SELECT event_id, client, us, rn, true AS accepted, [us] AS kept FROM h WHERE rn = 1
  UNION ALL
  SELECT h.event_id, h.client, h.us, h.rn,
    len(list_filter(f.kept, lambda t: t > h.us - 86400000000)) < 3,
    CASE WHEN len(list_filter(f.kept, lambda t: t > h.us - 86400000000)) < 3
      THEN list_append(list_filter(f.kept, lambda t: t > h.us - 86400000000), h.us)
      ELSE list_filter(f.kept, lambda t: t > h.us - 86400000000) END
  FROM f JOIN h ON h.client = f.client AND h.rn = f.rn + 1)
SELECT event_id, client, accepted FROM f""")
def _(spark, sf):
    hits = access_log(spark, sf).select("event_id", "client", "ts")
    return ratelimit.decide(hits, max_requests=3, window_seconds=86_400).select(
        "event_id", "client", "accepted")


@query("set_map_overlay", """SELECT event_id, 'app=base,k=' || (props ->> '$.k') ||
  CASE WHEN event_id % 2 = 0 THEN ',user=' || user_id ELSE '' END AS merged FROM events""")
def _(spark, sf):
    base = F.create_map(F.lit("app"), F.lit("base"), F.lit("k"), F.lit("default"))
    mine = F.from_json("props", "map<string,string>")
    bound = F.when(F.col("event_id") % 2 == 0,
                   F.create_map(F.lit("user"), F.col("user_id").cast("string"))).otherwise(
        F.create_map().cast("map<string,string>"))
    merged = label_key(F.map_concat(base, mine, bound))
    text = F.array_join(F.transform(merged, lambda p: F.concat(p["key"], F.lit("="), p["value"])),
                        ",")
    return b.events(spark, sf).select("event_id", text.alias("merged"))
