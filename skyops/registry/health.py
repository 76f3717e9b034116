"""Health-check queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from skyops.operators import health
from skyops.plans.health import health_run
from skyops.registry import bindings as b
from skyops.registry import query
from skyops.registry.bindings import table
from skyops.session import scratch_dir
from skyops.sources import checks as source

# -- inputs --------------------------------------------------------------------------------

_CHECK = ("CASE event_type WHEN 'click' THEN 'cpu' WHEN 'view' THEN 'memory' "
          "WHEN 'error' THEN 'disk' WHEN 'signup' THEN 'swap' ELSE 'network' END")
_STATUS = ("CASE WHEN value < 60 THEN 'OK' WHEN value < 100 THEN 'WARNING' "
           "WHEN value < 200 THEN 'CRITICAL' ELSE 'ERROR' END")
_CHECK_COLS = [
    ("event_id", "event_id"), ("host", "user_id"), ("check", _CHECK), ("status", _STATUS),
    ("value", "value"), ("threshold", "CAST(70 AS DOUBLE)"),
    ("message", "concat('value ', CAST(value AS VARCHAR(30)))"),
]


def check_rows(spark, sf):
    """Results with their run: one run per host and day."""
    cols = [f"{e} AS `{c}`" for c, e in _CHECK_COLS]
    return b.events(spark, sf).selectExpr("date_format(ts, 'yyyy-MM-dd') AS run", *cols)


_CHECKS_SQL = "c AS (SELECT strftime(ts, '%Y-%m-%d') AS run, " + ", ".join(
    f'{e} AS "{c}"' for c, e in _CHECK_COLS) + """ FROM events),
latest AS (SELECT * FROM c QUALIFY
  row_number() OVER (PARTITION BY host, run, "check" ORDER BY event_id DESC) = 1)"""
_SEV = "CASE status WHEN 'OK' THEN 0 WHEN 'WARNING' THEN 1 WHEN 'CRITICAL' THEN 2 ELSE 3 END"
_REPORT_SQL = f"""rep AS (SELECT host, run, count(*) AS total,
  count(*) FILTER (status = 'OK') AS ok, count(*) FILTER (status = 'WARNING') AS warning,
  count(*) FILTER (status = 'CRITICAL') AS critical, count(*) FILTER (status = 'ERROR') AS error,
  arg_max(status, {_SEV}) AS overall_status,
  string_agg("check" || ':' || status, ',' ORDER BY "check") AS checks FROM latest GROUP BY 1, 2)"""
_KEYS = ("host", "run")


def _latest(spark, sf):
    return health.latest_results(check_rows(spark, sf), _KEYS, ("event_id",))


def _names(c):
    return F.array_join(F.transform(c, lambda x: F.concat(x["check"], F.lit(":"), x["status"])),
                        ",")


@query("agg_health_report", f"""WITH {_CHECKS_SQL}, {_REPORT_SQL} SELECT *,
  CASE overall_status WHEN 'CRITICAL' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END AS exit_code
  FROM rep""")
def _(spark, sf):
    return health.report(_latest(spark, sf), _KEYS).withColumn("checks", _names(F.col("checks")))


_THRESHOLDS_SQL = """t(chk, warning, critical) AS (VALUES ('cpu', 75.0, 95.0),
  ('memory', 80.0, 95.0), ('disk', 80.0, 150.0), ('swap', 50.0, 80.0))"""
_USER = [("cpu", 75.0, None), ("disk", None, 150.0)]
_ALERTS_SQL = f"""{_CHECKS_SQL}, {_THRESHOLDS_SQL}, al AS (SELECT host, run, "check", status,
  value, CAST(coalesce(CASE WHEN status = 'CRITICAL' THEN critical ELSE warning END, threshold)
  AS DOUBLE) AS threshold, message FROM latest LEFT JOIN t ON chk = "check"
  WHERE status IN ('WARNING', 'CRITICAL', 'ERROR'))"""


def _user(spark):
    return spark.createDataFrame(_USER, "check string, warning double, critical double")


@query("join_check_thresholds", f"WITH {_ALERTS_SQL} SELECT * FROM al")
def _(spark, sf):
    config = health.thresholds(spark, _user(spark))
    return health.result_alerts(_latest(spark, sf), config).select(
        "host", "run", "check", "status", "value", "threshold", "message")


@query("src_thresholds", f"""WITH {_CHECKS_SQL}, {_THRESHOLDS_SQL}
SELECT "check", CAST(coalesce(max(warning), 80) AS DOUBLE) AS warning, CAST(max(critical) AS DOUBLE) AS critical,
  count(*) AS results FROM c LEFT JOIN t ON chk = "check" GROUP BY 1""")
def _(spark, sf):
    path = scratch_dir(spark, "thresholds")
    _user(spark).write.json(path)
    config = health.thresholds(spark, source.read_thresholds(spark, path))
    seen = check_rows(spark, sf).groupBy("check").agg(F.count(F.lit(1)).alias("results"))
    return health.check_thresholds(seen, config).join(seen, "check")


_HOOKS = [{"url": "http://pager", "on": ["critical", "error"]}, {"url": "http://chat"},
          {"url": "http://mail", "on": ["WARNING", "warning"]}, {"url": "http://none", "on": []}]


@query("join_alert_routes", f"""WITH {_ALERTS_SQL}, r(url, status) AS (VALUES
  ('http://pager', 'CRITICAL'), ('http://pager', 'ERROR'), ('http://chat', 'CRITICAL'),
  ('http://mail', 'WARNING'))
SELECT host, run, url, count(*) AS alerts, string_agg("check" || ':' || status, ',' ORDER BY
  "check") AS payload FROM al JOIN r USING (status) GROUP BY 1, 2, 3""")
def _(spark, sf):
    alerts = health.result_alerts(_latest(spark, sf), health.thresholds(spark, _user(spark)))
    out = health.route_alerts(alerts, health.routes_frame(spark, _HOOKS), _KEYS)
    parsed = F.from_json("payload", "source string, alerts array<struct<check:string,"
                                    "status:string,value:double,threshold:double,message:string>>")
    return out.withColumn("payload", _names(parsed["alerts"]))


@query("pipe_health", f"""WITH {_ALERTS_SQL}, {_REPORT_SQL}, r(url, status) AS (VALUES
  ('http://pager', 'CRITICAL'), ('http://pager', 'ERROR'), ('http://chat', 'CRITICAL'), ('http://mail', 'WARNING')),
sent AS (SELECT host, run, url, string_agg("check" || ':' || status, ',' ORDER BY "check") AS what FROM al JOIN r USING (status)
  GROUP BY 1, 2, 3),
hooks AS (SELECT host, run, string_agg(url || ' ' || what, ';' ORDER BY url) AS payloads FROM sent GROUP BY 1, 2),
n AS (SELECT host, run, count(*) AS alerts FROM al GROUP BY 1, 2)
SELECT rep.*, CASE overall_status WHEN 'CRITICAL' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END AS exit_code,
  coalesce(alerts, 0) AS alerts, coalesce(payloads, '') AS payloads FROM rep
  LEFT JOIN n ON rep.host = n.host AND rep.run = n.run LEFT JOIN hooks ON rep.host = hooks.host AND rep.run = hooks.run""")
def _(spark, sf):
    """The whole run: report, alerts, and what each webhook is sent."""
    out = health_run(check_rows(spark, sf), _KEYS, ("event_id",), _HOOKS, _user(spark))
    alerts = out["alerts"].groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("alerts"))
    parsed = F.from_json("payload", "source string, alerts array<struct<check:string,status:string>>")
    line = F.concat("url", F.lit(" "), _names(parsed["alerts"]))
    sent = out["payloads"].withColumn("line", line).groupBy(*_KEYS).agg(
        F.array_join(F.sort_array(F.collect_list("line")), ";").alias("payloads"))  # a line a webhook
    report = out["report"].withColumn("checks", _names(F.col("checks")))
    return report.join(alerts, list(_KEYS), "left").join(sent, list(_KEYS), "left").withColumns(
        {"alerts": F.coalesce("alerts", F.lit(0)), "payloads": F.coalesce("payloads", F.lit(""))})


_PRODUCERS = {
    "events": ("events", """concat('{"check": "ev', event_id % 7, '", "status": "', CASE event_id % 3 WHEN 0 THEN 'OK' WHEN 1 THEN 'WARNING'
      ELSE 'odd' END, '", "value": ', event_id, '}')"""),
    "orders": ("orders", """concat('{"check": "order", "status": "CRITICAL", "value": ', o_orderkey, ', "threshold": 5, "message": "',
      o_orderstatus, '"}')"""),
    "suppliers": ("supplier", "CASE WHEN s_suppkey % 4 = 0 THEN 'not json' ELSE concat('  {\"check\": \"sup\", \"value\": ', s_suppkey, '}  ') END"),
}
_PRODUCED_SQL = """SELECT 'events' AS producer, CASE event_id % 3 WHEN 2 THEN 'ev' || event_id % 7 ELSE 'ev' || event_id % 7 END AS "check",
    CASE event_id % 3 WHEN 0 THEN 'OK' WHEN 1 THEN 'WARNING' ELSE 'ERROR' END AS status,
    CASE WHEN event_id % 3 = 2 THEN 0.0 ELSE CAST(event_id AS DOUBLE) END AS value FROM events
  UNION ALL SELECT 'orders', 'order', 'CRITICAL', CAST(o_orderkey AS DOUBLE) FROM orders
  UNION ALL SELECT 'suppliers', CASE WHEN s_suppkey % 4 = 0 THEN 'unknown' ELSE 'sup' END, 'ERROR',
    CASE WHEN s_suppkey % 4 = 0 THEN 0.0 ELSE CAST(s_suppkey AS DOUBLE) END FROM supplier"""


@query("udf_check", f"""SELECT producer, "check", status, count(*) AS n, CAST(sum(value) AS DOUBLE) AS total
FROM ({_PRODUCED_SQL}) GROUP BY 1, 2, 3""")
def _(spark, sf):
    """Checks of a user's own: any producers of one JSON line a check, read by the one contract."""
    lines = None
    for name, (source_table, line) in _PRODUCERS.items():
        part = table(spark, sf, source_table).selectExpr(f"'{name}' AS producer", f"{line} AS value")
        lines = part if lines is None else lines.unionByName(part)
    return health.parse_results(lines, keep=("producer",)).groupBy("producer", "check", "status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query("flt_checks", f"""WITH {_CHECKS_SQL} SELECT "check", count(*) AS n FROM c
  WHERE "check" IN ('cpu', 'disk') GROUP BY 1""")
def _(spark, sf):
    rows = health.select_checks(check_rows(spark, sf), [" CPU ", "Disk"])
    return rows.groupBy("check").agg(F.count(F.lit(1)).alias("n"))


# -- check results as text -------------------------------------------------------------------

_OUT = """CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN concat('{{"check": "cpu", "value": ', event_id)
  WHEN 2 THEN concat('{{"check": "disk", "status": "BAD", "value": ', event_id, '}}')
  WHEN 3 THEN '{{"status": "OK"}}'
  WHEN 4 THEN concat('{{"check": "swap", "status": "WARNING", "value": "', value, '", "message": "m"}}')
  WHEN 5 THEN concat('{{"check": "mem", "status": "OK", "value": "high", "timestamp": "t', event_id, '"}}')
  ELSE concat('{{"check": "{check}", "status": "', {status}, '", "value": ', value,
    ', "threshold": 80, "message": "v", "timestamp": "2024", "details": {{"id": ', event_id, '}}}}') END"""
_OUT_TEXT = _OUT.format(check="net", status=_STATUS)


@query("src_check_results", f"""WITH o AS (SELECT event_id, value, {_STATUS} AS st FROM events)
SELECT CASE WHEN k IN (0, 1, 3) THEN 'unknown' WHEN k = 2 THEN 'disk'
  WHEN k = 4 THEN 'swap' WHEN k = 5 THEN 'mem' ELSE 'net' END AS "check",
  CASE WHEN k IN (0, 1, 2, 5) THEN 'ERROR' WHEN k = 3 THEN 'OK' WHEN k = 4 THEN 'WARNING' ELSE st END
    AS status,
  CASE WHEN k IN (4, 6, 7) THEN value ELSE 0 END AS value,
  CAST(CASE WHEN k IN (6, 7) THEN 80 ELSE 0 END AS DOUBLE) AS threshold,
  CASE k WHEN 0 THEN 'Script produced no output' WHEN 1 THEN 'Invalid JSON output'
    WHEN 2 THEN 'Unexpected error: ''BAD'' is not a valid Status' WHEN 3 THEN ''
    WHEN 4 THEN 'm' WHEN 5 THEN 'Unexpected error: not a number' ELSE 'v' END AS message,
  CASE WHEN k IN (6, 7) THEN '2024' ELSE '2024-02-01T00:00:00Z' END AS timestamp,
  CASE WHEN k IN (6, 7) THEN event_id END AS detail_id
FROM (SELECT *, event_id % 8 AS k FROM o)""")
def _(spark, sf):
    path = scratch_dir(spark, "checks")
    b.events(spark, sf).selectExpr(f"{_OUT_TEXT} AS value").write.text(path)
    now = F.lit(dt.datetime(2024, 2, 1)).cast("timestamp")
    rows = source.read_check_results(spark, path, now)
    return rows.select(
        "check", "status", "value", "threshold", "message",
        "timestamp", F.get_json_object("details", "$.id").cast("bigint").alias("detail_id"))


# -- host samples ------------------------------------------------------------------------------

_TICKS = [("user", "event_id * 300 + CAST(floor(value) AS BIGINT) % 97 * 3"), ("nice", "event_id"),
          ("system", "event_id * 2"), ("idle", "event_id * 60"), ("iowait", "event_id * 3"),
          ("irq", "CAST(0 AS BIGINT)"), ("softirq", "event_id"), ("steal", "CAST(0 AS BIGINT)")]


def tick_samples(spark, sf):
    return b.events(spark, sf).selectExpr(
        "event_id", "ts", "user_id AS host", *[f"{e} AS `{c}`" for c, e in _TICKS])


_TICKS_SQL = "s AS (SELECT event_id, user_id AS host, " + ", ".join(
    f'{e} AS "{c}"' for c, e in _TICKS) + ' FROM events)'


@query("win_counter_delta", f"""WITH {_TICKS_SQL} SELECT event_id, host,
  "user" - lag("user") OVER w AS d_user, idle - lag(idle) OVER w AS d_idle FROM s
  WINDOW w AS (PARTITION BY host ORDER BY event_id)""")
def _(spark, sf):
    return health.counter_delta(tick_samples(spark, sf), "host", "ts", "event_id",
                                ("user", "idle")).select("event_id", "host", "d_user", "d_idle")


@query("agg_cpu", f"""WITH {_TICKS_SQL}, t AS (SELECT event_id, host,
  "user" + nice + system + idle + iowait + irq + softirq + steal AS total,
  "user" + nice + system + irq + softirq + steal AS busy FROM s),
d AS (SELECT event_id, host, total - lag(total) OVER w AS dt, busy - lag(busy) OVER w AS db FROM t
  WINDOW w AS (PARTITION BY host ORDER BY event_id)),
v AS (SELECT event_id, host, CASE WHEN dt = 0 THEN 0 ELSE round_even(db / dt * 100, 1) END AS value
  FROM d WHERE dt IS NOT NULL)
SELECT event_id, host, value, CASE WHEN round_even(value, 0) >= 95 THEN 'CRITICAL'
  WHEN round_even(value, 0) >= 80 THEN 'WARNING' ELSE 'OK' END AS status FROM v""")
def _(spark, sf):
    return health.cpu_status(tick_samples(spark, sf), threshold=80).drop("ts")


@query("agg_memory", """WITH m AS (SELECT event_id, (1048576 + event_id * 7) // 1024 AS total_mb,
  (1048576 + event_id * 7 - CAST(floor(value * 2000) AS BIGINT)) // 1024 AS used_mb FROM events),
v AS (SELECT event_id, round_even(used_mb / total_mb * 100, 1) AS value FROM m)
SELECT event_id, value, CASE WHEN round_even(value, 0) >= 95 THEN 'CRITICAL'
  WHEN round_even(value, 0) >= 80 THEN 'WARNING' ELSE 'OK' END AS status FROM v""")
def _(spark, sf):
    rows = b.events(spark, sf).selectExpr(
        "event_id", "1048576 + event_id * 7 AS total_kb",
        "CAST(floor(value * 2000) AS BIGINT) AS available_kb")
    return health.memory_status(rows).select("event_id", "value", "status")


_MOUNTS = [("event_id", "event_id"), ("host", "user_id"), ("mount", "concat('/', event_type)"),
           ("filesystem", "CASE WHEN event_id % 6 = 0 THEN 'tmpfs' ELSE '/dev/sda' END"),
           ("usage_pct", "CAST(floor(value) AS BIGINT) % 101")]


@query("agg_disk", "WITH m AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _MOUNTS) + """
  FROM events), w AS (SELECT * FROM m WHERE filesystem <> 'tmpfs' QUALIFY row_number() OVER
  (PARTITION BY host ORDER BY usage_pct DESC, event_id) = 1)
SELECT host, usage_pct AS value, CASE WHEN usage_pct > 0 THEN mount ELSE '/' END AS mount,
  CASE WHEN usage_pct >= 95 THEN 'CRITICAL' WHEN usage_pct >= 80 THEN 'WARNING' ELSE 'OK' END
  AS status FROM w""")
def _(spark, sf):
    mounts = b.events(spark, sf).selectExpr(*[f"{e} AS {c}" for c, e in _MOUNTS])
    return health.disk_status(mounts, ("host",), "event_id")


@query("agg_network", """WITH p AS (SELECT user_id AS host, strftime(ts, '%Y-%m-%d') AS run,
  CASE event_id % 3 WHEN 0 THEN 'ping' WHEN 1 THEN 'dns' ELSE 'port' END AS kind,
  CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'OK' END AS result, value AS latency FROM events),
a AS (SELECT host, run, count(*) AS total_checks, count(*) FILTER (result = 'FAIL') AS failures,
  CAST(coalesce(max(CASE WHEN kind = 'ping' THEN round_even(latency, 0) END), 0) AS BIGINT)
  AS worst_latency FROM p GROUP BY 1, 2)
SELECT *, CASE WHEN failures > total_checks // 2 THEN 'CRITICAL'
  WHEN failures > 0 OR worst_latency >= 100 THEN 'WARNING' ELSE 'OK' END AS status FROM a""")
def _(spark, sf):
    probes = b.events(spark, sf).selectExpr(
        "user_id AS host", "date_format(ts, 'yyyy-MM-dd') AS run",
        "CASE event_id % 3 WHEN 0 THEN 'ping' WHEN 1 THEN 'dns' ELSE 'port' END AS kind",
        "CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'OK' END AS result",
        "value AS latency_ms")
    return health.network_status(probes, ("host", "run"))


_PROC = [("pid", "event_id"), ("host", "user_id"), ("cpu", "value"),
         ("command", "concat('/usr/bin/', event_type, 'd')"),
         ("state", "CASE WHEN event_id % 40 = 0 THEN 'Z' WHEN event_id % 41 = 0 THEN 'Zs' "
                   "ELSE 'S' END")]


def _processes(spark, sf):
    return b.events(spark, sf).selectExpr(
        "date_format(ts, 'yyyy-MM-dd') AS run", *[f"{e} AS {c}" for c, e in _PROC])


_PROC_SQL = "p AS (SELECT strftime(ts, '%Y-%m-%d') AS run, " + ", ".join(
    f"{e} AS {c}" for c, e in _PROC) + " FROM events)"


@query("agg_processes", f"""WITH {_PROC_SQL}, a AS (SELECT host, run,
  CAST((count(*) FILTER (contains(command, 'view')) = 0) AS BIGINT)
  + CAST((count(*) FILTER (contains(command, 'click')) = 0) AS BIGINT) AS missing,
  count(*) FILTER (state LIKE 'Z%') AS zombies FROM p GROUP BY 1, 2)
SELECT *, missing + zombies AS value, CASE WHEN missing > 0 THEN 'CRITICAL' WHEN zombies > 0
  THEN 'WARNING' ELSE 'OK' END AS status FROM a""")
def _(spark, sf):
    return health.process_status(_processes(spark, sf), ("host", "run"), ("view", "click"))


@query("top_cpu_processes", f"""WITH {_PROC_SQL} SELECT host, pid, cpu, command, rank FROM
  (SELECT *, CAST(row_number() OVER (PARTITION BY host ORDER BY cpu DESC, pid) AS INTEGER) AS rank
  FROM p) WHERE rank <= 5""")
def _(spark, sf):
    return health.top_processes(_processes(spark, sf), ("host",)).select(
        "host", "pid", "cpu", "command", "rank")


@query("agg_containers", """WITH c AS (SELECT user_id AS host, strftime(ts, '%Y-%m-%d') AS run,
  CASE WHEN user_id % 10 = 0 THEN 'stopped' WHEN user_id % 10 = 1 THEN 'not_installed'
    ELSE 'running' END AS daemon, event_type <> 'view' AS up,
  event_type = 'error' AND value > 60 AS sick FROM events),
a AS (SELECT host, run, max(daemon) AS daemon, count(*) FILTER (up) AS running, count(*) AS total,
  count(*) FILTER (up AND sick) AS unhealthy FROM c GROUP BY 1, 2)
SELECT *, CASE WHEN daemon = 'running' THEN total - running ELSE 0 END AS stopped,
  CASE WHEN daemon = 'running' THEN unhealthy ELSE 0 END AS value,
  CASE WHEN daemon = 'not_installed' THEN 'OK' WHEN daemon = 'stopped' THEN 'WARNING'
    WHEN unhealthy > 0 THEN 'CRITICAL' WHEN total > running THEN 'WARNING' ELSE 'OK' END AS status
FROM a""")
def _(spark, sf):
    rows = b.events(spark, sf).selectExpr(
        "user_id AS host", "date_format(ts, 'yyyy-MM-dd') AS run",
        "CASE WHEN user_id % 10 = 0 THEN 'stopped' WHEN user_id % 10 = 1 THEN 'not_installed' "
        "ELSE 'running' END AS daemon",
        "CASE WHEN event_type = 'view' THEN 'exited' ELSE 'running' END AS state",
        "CASE WHEN event_type = 'error' AND value > 60 THEN 'unhealthy' ELSE 'healthy' END "
        "AS health")
    return health.container_status(health.container_counts(rows, ("host", "run")))


@query("agg_db_health", """WITH d AS (SELECT o_orderkey, o_orderstatus <> 'F' AS connected,
  o_custkey % 101 AS connections, CASE WHEN o_orderkey % 50 = 0 THEN 0 ELSE 100 END AS max_c,
  o_totalprice * 4 AS lag FROM orders),
v AS (SELECT *, CASE WHEN connected AND max_c > 0 THEN round_even(connections / max_c * 100, 1)
  ELSE 0 END AS value FROM d)
SELECT o_orderkey, value, CASE WHEN NOT connected OR round_even(value, 0) >= 95
  OR round_even(lag, 0) >= 1048576 THEN 'CRITICAL' WHEN round_even(value, 0) >= 80 THEN 'WARNING'
  ELSE 'OK' END AS status FROM v""")
def _(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_orderstatus <> 'F' AS connected", "o_custkey % 101 AS connections",
        "CASE WHEN o_orderkey % 50 = 0 THEN 0 ELSE 100 END AS max_connections",
        "o_totalprice * 4 AS lag_bytes")
    return health.database_status(rows).select("o_orderkey", "value", "status")


_CALLS = [("event_id", "event_id"), ("host", "user_id"), ("url", "concat('/', event_type)"),
          ("http_code", "CASE WHEN event_id % 13 = 0 THEN 0 WHEN event_id % 7 = 0 THEN 503 "
                        "ELSE 200 END"), ("seconds", "value / 50")]


@query("agg_endpoints", "WITH c AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _CALLS) + """
  FROM events), s AS (SELECT *, CAST(round_even(seconds * 1000, 0) AS BIGINT) AS ms FROM c),
t AS (SELECT *, CASE WHEN http_code = 0 THEN 'CRITICAL' WHEN http_code <> 200 OR ms >= 2000
  THEN 'WARNING' ELSE 'OK' END AS st FROM s)
SELECT host, CASE WHEN bool_or(st = 'CRITICAL') THEN 'CRITICAL' WHEN bool_or(st = 'WARNING')
  THEN 'WARNING' ELSE 'OK' END AS status, count(*) AS total,
  count(*) FILTER (st = 'CRITICAL') AS failed, max(ms) AS worst_ms FROM t GROUP BY 1""")
def _(spark, sf):
    calls = b.events(spark, sf).selectExpr(*[f"{e} AS {c}" for c, e in _CALLS])
    return health.endpoint_summary(health.endpoint_status(calls), ("host",))
