"""Log parsing, trailing statistics and alert queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from skyops.functions import logs as fn
from skyops.functions.thresholds import compare
from skyops.operators import alerts, logs
from skyops.plans.log_check import log_check
from skyops.registry import bindings as b
from skyops.registry import query
from skyops.session import scratch_dir
from skyops.sinks import events as sink
from skyops.sources import logs as source

_AS_OF = dt.datetime(2024, 2, 1)
_AS_OF_US = 1706745600000000


def _as_of():
    return F.lit(_AS_OF).cast("timestamp")


def _pairs(c):
    """A context map as sorted text."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(c)),
                                    lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def _shown(df):
    return df.select("event_id", F.unix_micros("ts").alias("us"), "level", "logger", "message",
                     _pairs("context").alias("context"))


_ALIASES = [("DEBUG", "DEBUG"), ("INFO", "INFO"), ("WARNING", "WARNING"), ("WARN", "WARNING"),
            ("ERROR", "ERROR"), ("ERR", "ERROR"), ("CRITICAL", "CRITICAL"),
            ("FATAL", "CRITICAL"), ("CRIT", "CRITICAL")]


def _infer(c):
    return ("CASE " + " ".join(f"WHEN contains(upper({c}), '{k}') THEN '{v}'"
                               for k, v in _ALIASES) + " ELSE 'INFO' END")


def _alias(c):
    return (f"CASE upper({c}) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _ALIASES)
            + f" ELSE upper({c}) END")


_TIME = """CASE WHEN {s} IS NULL OR {s} IN ('', '0', 'false') THEN {other}
  WHEN json_type(j, '$.{k}') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN
    CAST(round(CAST({s} AS DOUBLE) * 1000000) AS BIGINT)
  ELSE coalesce(epoch_us(try_strptime({s}, ['%Y-%m-%dT%H:%M:%S.%fZ', '%Y-%m-%dT%H:%M:%SZ',
    '%Y-%m-%dT%H:%M:%S.%f', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%d %H:%M:%S.%f', '%Y-%m-%d %H:%M:%S'])),
    {now}) END"""


def _time_sql():
    out = str(_AS_OF_US)
    for k in ("time", "ts", "timestamp"):
        out = _TIME.format(k=k, s=f"(j ->> '$.{k}')", other=out, now=_AS_OF_US)
    return out


def _str(k):
    return (f"CASE WHEN json_type(j, '$.{k}') = 'NULL' THEN 'None' "
            f"ELSE (j ->> '$.{k}') END")


_JSON = f"""lines AS ({b.LINES_SQL}),
js AS (SELECT event_id, CASE WHEN trim(value) LIKE '{{%' AND json_valid(trim(value))
  THEN CAST(trim(value) AS JSON) END AS j FROM lines),
json_e AS (SELECT event_id, {_time_sql()} AS us,
  {_alias(f"coalesce({_str('level')}, {_str('severity')}, 'INFO')")} AS level,
  coalesce({_str('logger_name')}, {_str('logger')}, {_str('name')}, '') AS logger,
  coalesce({_str('message')}, {_str('msg')}, '') AS message,
  CASE WHEN json_type(j, '$.context') = 'OBJECT' THEN 'k=' || (j ->> '$.context.k') ELSE '' END
    AS context
  FROM js WHERE j IS NOT NULL)"""
_RE = (r"'^(?:<\d+>)?(\w{3}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2})\s+(\S+)\s+"
       r"(\S+?)(?:\[(\d+)\])?:\s+(.*)$'")
_SYSLOG = f"""sys AS (SELECT event_id, regexp_extract(trim(value), {_RE}, 1) AS t,
  regexp_extract(trim(value), {_RE}, 2) AS host, regexp_extract(trim(value), {_RE}, 3) AS app,
  regexp_extract(trim(value), {_RE}, 4) AS pid, regexp_extract(trim(value), {_RE}, 5) AS msg
  FROM lines WHERE regexp_matches(trim(value), {_RE})),
sys_e AS (SELECT event_id, coalesce(epoch_us(try_strptime('2024 ' || regexp_replace(t, '\\s+', ' ', 'g'),
    '%Y %b %d %H:%M:%S')), {_AS_OF_US}) AS us, {_infer('msg')} AS level, app AS logger,
  msg AS message, 'hostname=' || host || CASE WHEN pid <> '' THEN ',pid=' || pid ELSE '' END
    AS context FROM sys)"""
_PLAIN = f"""plain_e AS (SELECT event_id, {_AS_OF_US} AS us, {_infer('trim(value)')} AS level,
  '' AS logger, trim(value) AS message, '' AS context FROM lines WHERE trim(value) <> '')"""
_AUTO = f"""{_JSON}, {_SYSLOG}, {_PLAIN},
auto AS (SELECT * FROM json_e UNION ALL
  SELECT * FROM sys_e WHERE event_id NOT IN (SELECT event_id FROM json_e) UNION ALL
  SELECT * FROM plain_e WHERE event_id NOT IN (SELECT event_id FROM json_e)
    AND event_id NOT IN (SELECT event_id FROM sys_e))"""


def _parsed(spark, sf, parser):
    return logs.parse(b.log_lines(spark, sf), parser, as_of=_as_of(), keep=("event_id",))


@query("log_parse_json", f"WITH {_JSON} SELECT * FROM json_e")
def _(spark, sf):
    return _shown(_parsed(spark, sf, fn.parse_json))


@query("log_parse_syslog", f"WITH {_JSON}, {_SYSLOG} SELECT * FROM sys_e")
def _(spark, sf):
    return _shown(_parsed(spark, sf, fn.parse_syslog))


@query("log_parse_plain", f"WITH {_JSON}, {_PLAIN} SELECT * FROM plain_e")
def _(spark, sf):
    return _shown(_parsed(spark, sf, fn.parse_plain))


@query("log_parse_auto", f"WITH {_AUTO} SELECT * FROM auto")
def _(spark, sf):
    return _shown(_parsed(spark, sf, None))


@query("udf_parser", f"""WITH {_AUTO} SELECT level, count(*) AS n FROM auto
  WHERE contains(message, 'user') GROUP BY 1""")
def _(spark, sf):
    def only_users(line, as_of):
        entry = fn.parse_auto(line, as_of)
        return F.when(F.contains(entry["message"], F.lit("user")), entry)

    rows = logs.parse(b.log_lines(spark, sf), only_users, as_of=_as_of())
    return rows.groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@query("log_infer_level", f"""WITH lines AS ({b.LINES_SQL}) SELECT {_infer('value')} AS level,
  count(*) AS n FROM lines GROUP BY 1""")
def _(spark, sf):
    level = fn.infer_level(F.col("value")).alias("level")
    return b.log_lines(spark, sf).groupBy(level).agg(F.count(F.lit(1)).alias("n"))


@query("log_parse_time", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN epoch_us(ts)
  WHEN 1 THEN epoch_us(ts) // 1000000 * 1000000 WHEN 2 THEN epoch_us(ts) END AS us FROM events""")
def _(spark, sf):
    text = F.expr("""CASE event_id % 4
      WHEN 0 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
      WHEN 1 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss')
      WHEN 2 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')
      ELSE date_format(ts, "yyyy-MM-dd HH:mm:ss'Z'") END""")
    return b.events(spark, sf).select(
        "event_id", F.unix_micros(fn.parse_time_text(text)).alias("us"))


@query("log_error_flags", f"""WITH l AS ({b.LOGS_SQL}) SELECT level,
  level IN ('ERROR', 'CRITICAL') AS is_error, level = 'WARNING' AS is_warning, count(*) AS n
  FROM l GROUP BY 1""")
def _(spark, sf):
    return b.logs(spark, sf).groupBy(
        "level", fn.is_error(F.col("level")).alias("is_error"),
        fn.is_warning(F.col("level")).alias("is_warning")).agg(F.count(F.lit(1)).alias("n"))


@query("src_log_lines", f"WITH {_AUTO} SELECT level, logger, message, context FROM auto")
def _(spark, sf):
    path = scratch_dir(spark, "log")
    b.log_lines(spark, sf).select("value").write.text(path)
    entries = logs.parse(source.read_lines(spark, path), as_of=_as_of())
    return entries.select("level", "logger", "message", _pairs("context").alias("context"))


@query("src_alert_rules", """SELECT p_name || ' ' || p_partkey AS name,
  list_extract(['total_entries', 'error_count', 'warning_count', 'error_rate', 'throughput'],
    CAST(p_partkey % 5 + 1 AS INTEGER)) AS metric,
  list_extract(['>', '<', '>=', '<=', '=='], CAST(p_size % 5 + 1 AS INTEGER)) AS operator,
  p_retailprice AS threshold, CAST(CASE WHEN p_partkey % 4 = 0 THEN 300 ELSE p_size * 60 END AS INTEGER) AS window_seconds,
  CASE WHEN p_partkey % 3 = 0 THEN 'warning' WHEN p_partkey % 3 = 1 THEN 'info' ELSE 'critical' END AS severity,
  CASE WHEN p_partkey % 7 = 0 THEN 'stdout' ELSE 'file,' || p_brand END AS channels FROM part""")
def _(spark, sf):
    """A rule for each part, some without the fields that have defaults, written and read as files."""
    path = scratch_dir(spark, "rules")
    pick = lambda names, at: F.array(*[F.lit(n) for n in names])[(F.col(at) % 5).cast("int")]
    key = F.col("p_partkey")
    rules = b.table(spark, sf, "part").select(
        F.concat_ws(" ", "p_name", key.cast("string")).alias("name"),
        pick(alerts.METRICS, "p_partkey").alias("metric"), pick((">", "<", ">=", "<=", "=="), "p_size").alias("operator"),
        F.col("p_retailprice").alias("threshold"),
        F.when(key % 4 != 0, F.col("p_size") * 60).alias("window_seconds"),
        F.when(key % 3 == 1, "info").when(key % 3 == 2, "critical").alias("severity"),
        F.when(key % 7 != 0, F.array(F.lit("file"), "p_brand")).alias("channels"))
    rules.select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    return source.read_alert_rules(spark, path).select(
        "name", "metric", "operator", "threshold", "window_seconds", "severity", F.concat_ws(",", "channels").alias("channels"))


# -- counts and rates -----------------------------------------------------------------

_COUNTS = """count(*) AS total_entries, count(*) FILTER (level = 'ERROR') AS error_count,
  count(*) FILTER (level = 'CRITICAL') AS critical_count,
  count(*) FILTER (level = 'WARNING') AS warning_count,
  count(*) FILTER (level = 'DEBUG') AS debug_count,
  count(*) FILTER (level NOT IN ('ERROR', 'CRITICAL', 'WARNING', 'DEBUG')) AS info_count"""
_COUNT_NAMES = ("total_entries", "error_count", "critical_count", "warning_count", "debug_count",
                "info_count")


@query("agg_level_counts", f"""WITH l AS ({b.LOGS_SQL}) SELECT logger, {_COUNTS},
  min(us) AS start_us, max(us) AS end_us FROM l GROUP BY 1""")
def _(spark, sf):
    stats = logs.rolling_stats(b.logs(spark, sf), ["logger"])
    return stats.select("logger", *_COUNT_NAMES, F.unix_micros("window_start").alias("start_us"),
                        F.unix_micros("window_end").alias("end_us"))


@query("agg_rates", f"""WITH l AS ({b.LOGS_SQL}) SELECT logger,
  round(count(*) FILTER (level IN ('ERROR', 'CRITICAL')) / count(*), 9) AS error_rate,
  round(CASE WHEN max(us) > min(us) THEN count(*) / ((max(us) - min(us)) / 1e6) ELSE 0 END, 9)
    AS throughput FROM l GROUP BY 1""")
def _(spark, sf):
    stats = logs.rolling_stats(b.logs(spark, sf), ["logger"])
    return stats.select("logger", F.round("error_rate", 9).alias("error_rate"),
                        F.round("throughput", 9).alias("throughput"))


def _trailing_sql(keys, n, name="t"):
    part = f"PARTITION BY {keys}" if keys else ""
    cols = f"{keys}, " if keys else ""
    return f"""{name} AS (SELECT DISTINCT {cols}us, ts, count(*) OVER w AS total_entries,
  count(*) FILTER (level = 'ERROR') OVER w AS error_count,
  count(*) FILTER (level = 'CRITICAL') OVER w AS critical_count,
  count(*) FILTER (level = 'WARNING') OVER w AS warning_count,
  count(*) FILTER (level = 'DEBUG') OVER w AS debug_count,
  count(*) FILTER (level NOT IN ('ERROR', 'CRITICAL', 'WARNING', 'DEBUG')) OVER w AS info_count,
  min(us) OVER w AS start_us
  FROM l WINDOW w AS ({part} ORDER BY us RANGE BETWEEN {n * 1000000} PRECEDING AND CURRENT ROW))"""


_RATES = """(error_count + critical_count) / total_entries AS error_rate,
  CASE WHEN us > start_us THEN total_entries / ((us - start_us) / 1e6) ELSE 0 END AS throughput"""


@query("win_trailing_stats", f"""WITH l AS ({b.LOGS_SQL}), {_trailing_sql('logger', 86400)}
SELECT logger, us, total_entries, error_count, critical_count, warning_count, debug_count,
  info_count, start_us, round(error_rate, 9) AS error_rate, round(throughput, 9) AS throughput
FROM (SELECT *, {_RATES} FROM t)""")
def _(spark, sf):
    stats = logs.trailing_stats(b.logs(spark, sf), ["logger"], 86_400)
    return stats.select("logger", F.unix_micros("ts").alias("us"), *_COUNT_NAMES,
                        F.unix_micros("window_start").alias("start_us"),
                        F.round("error_rate", 9).alias("error_rate"),
                        F.round("throughput", 9).alias("throughput"))


@query("win_trailing_global", f"""WITH l AS ({b.LOGS_SQL}), {_trailing_sql('', 300)}
SELECT us, total_entries, error_count, critical_count, start_us FROM t""")
def _(spark, sf):
    stats = logs.trailing_stats(b.logs(spark, sf), (), 300)
    return stats.select(F.unix_micros("ts").alias("us"), "total_entries", "error_count",
                        "critical_count", F.unix_micros("window_start").alias("start_us"))


# -- rules and alerts -----------------------------------------------------------------

_OPS = {">": "{v} > {t}", "<": "{v} < {t}", ">=": "{v} >= {t}", "<=": "{v} <= {t}",
        "==": "abs({v} - {t}) < 1e-9"}
_EVAL = f"l AS ({b.LOGS_SQL}), {_trailing_sql('', 3600, 't3600')}, " \
        f"{_trailing_sql('', 7200, 't7200')}, ev AS (" + " UNION ALL ".join(
    f"SELECT '{r['name']}' AS name, '{r['metric']}' AS metric, '{r['operator']}' AS operator, "
    f"CAST({r['threshold']} AS DOUBLE) AS threshold, '{r.get('severity', 'warning')}' AS severity,"
    f" us, CAST({r['metric']} AS DOUBLE) AS value, "
    + _OPS[r["operator"]].format(v=r["metric"], t=r["threshold"]) + " AS breached "
    f"FROM (SELECT *, {_RATES} FROM t{r['window_seconds']})"
    for r in b.RULES if r["name"] != "unknown_metric") + ")"
_CHANGES = f"""{_EVAL}, ch AS (SELECT *, CASE WHEN breached THEN 'firing' ELSE 'resolved' END
  AS state FROM (SELECT *, lag(breached, 1, false) OVER (PARTITION BY name ORDER BY us) AS was
  FROM ev) WHERE breached <> was)"""
_MSG = """printf('[%s] %s: %s — %s is %.4f (threshold: %s %s)', upper(state), upper(severity),
  name, metric, value, operator, CAST(threshold AS VARCHAR))"""


def _events(spark, sf):
    return alerts.rule_events(b.logs(spark, sf), b.RULES)


@query("join_rules", f"""WITH {_EVAL} SELECT name, us, round(value, 9) AS value, breached FROM ev""")
def _(spark, sf):
    return alerts.rule_values(b.logs(spark, sf), b.RULES).select(
        "name", F.unix_micros("ts").alias("us"), F.round("value", 9).alias("value"), "breached")


@query("flt_threshold", """SELECT op, count(*) FILTER (CASE op WHEN '>' THEN value > 50
  WHEN '<' THEN value < 50 WHEN '>=' THEN value >= 50 WHEN '<=' THEN value <= 50
  ELSE abs(value - 50) < 1e-9 END) AS hits FROM events,
  (VALUES ('>'), ('<'), ('>='), ('<='), ('==')) o(op) GROUP BY 1""")
def _(spark, sf):
    value = F.col("value")
    hits = [F.struct(F.lit(op).alias("op"),
                     F.count_if(compare(F.lit(op), value, F.lit(50.0))).alias("hits"))
            for op in (">", "<", ">=", "<=", "==")]
    return b.events(spark, sf).agg(F.array(*hits).alias("h")).select(F.inline("h"))


@query("udf_metric_ops", """SELECT event_id % 5 AS k, count(*) FILTER (CASE event_id % 5
  WHEN 0 THEN value > 40 WHEN 1 THEN value < 40 WHEN 2 THEN value >= 40 WHEN 3 THEN value <= 40
  ELSE abs(value - 40) < 1e-9 END) AS hits FROM events GROUP BY 1""")
def _(spark, sf):
    ops = F.array(*[F.lit(o) for o in (">", "<", ">=", "<=", "==")])
    op = F.element_at(ops, (F.col("event_id") % 5 + 1).cast("int"))
    return b.events(spark, sf).groupBy((F.col("event_id") % 5).alias("k")).agg(
        F.count_if(compare(op, F.col("value"), F.lit(40.0))).alias("hits"))


@query("win_alert_transitions", f"""WITH {_CHANGES} SELECT name, us, state,
  round(value, 9) AS value FROM ch""")
def _(spark, sf):
    return _events(spark, sf).select("name", F.unix_micros("ts").alias("us"), "state",
                                     F.round("value", 9).alias("value"))


@query("win_firing_now", f"""WITH {_CHANGES} SELECT name, max(us) AS us FROM ch GROUP BY 1
  HAVING arg_max(state, us) = 'firing'""")
def _(spark, sf):
    now = alerts.firing_now(_events(spark, sf), (), "ts")
    return now.select("name", F.unix_micros("ts").alias("us"))


@query("alert_message", f"WITH {_CHANGES} SELECT us, {_MSG} AS message FROM ch")
def _(spark, sf):
    return _events(spark, sf).select(F.unix_micros("ts").alias("us"),
                                     alerts.message().alias("message"))


@query("sink_alerts", f"""WITH {_CHANGES} SELECT name AS alert, severity, metric,
  round(value, 9) AS value, threshold, operator, state, us, {_MSG} AS message FROM ch
  WHERE name IN ('high_error_rate', 'excessive_errors')""")
def _(spark, sf):
    path = scratch_dir(spark, "alerts")
    sink.write_alerts(sink.for_channel(_events(spark, sf), "file"), path)
    back = spark.read.schema("alert string, severity string, metric string, value double, "
                             "threshold double, operator string, state string, "
                             "triggered_at double, message string").json(path)
    return back.select("alert", "severity", "metric", F.round("value", 9).alias("value"),
                       "threshold", "operator", "state",
                       F.round(F.col("triggered_at") * 1e6).cast("bigint").alias("us"), "message")


@query("sink_json_logs", f"""WITH l AS ({b.LOGS_SQL})
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST((us // 1000) % 1000 AS VARCHAR), 3, '0')
  || 'Z' AS "timestamp", level, logger AS logger_name, message,
  'service' AS service, props ->> '$.k' AS k FROM l""")
def _(spark, sf):
    path = scratch_dir(spark, "json-logs")
    sink.write_json_logs(b.logs(spark, sf), path, {"service": "service", "k": "default"})
    back = spark.read.schema("timestamp string, level string, logger_name string, message string, "
                             "context map<string,string>").json(path)
    return back.select("timestamp", "level", "logger_name", "message",
                       F.col("context")["service"].alias("service"), F.col("context")["k"].alias("k"))


_CHECK_AS_OF = dt.datetime(2024, 1, 15, 12)
_CHECK_RULES = [
    {"name": "any_errors", "metric": "error_count", "operator": ">=", "threshold": 1,
     "window_seconds": 864000, "severity": "critical"},
    {"name": "quiet", "metric": "throughput", "operator": "<", "threshold": 0.5,
     "window_seconds": 864000},
    {"name": "never", "metric": "error_rate", "operator": ">", "threshold": 1.0,
     "window_seconds": 864000},
]


@query("pipe_log_check", f"""WITH {_AUTO.replace(str(_AS_OF_US), '1705320000000000')},
s AS (SELECT {_COUNTS}, min(us) AS start_us, max(us) AS us FROM auto
  WHERE us BETWEEN 1705320000000000 - 864000000000 AND 1705320000000000), r AS (SELECT *, {_RATES} FROM s)
SELECT 'any_errors' AS name, round(CAST(error_count AS DOUBLE), 9) AS value FROM r
  WHERE error_count >= 1
UNION ALL SELECT 'quiet', round(throughput, 9) FROM r WHERE throughput < 0.5
UNION ALL SELECT 'never', round(error_rate, 9) FROM r WHERE error_rate > 1.0""")
def _(spark, sf):
    events = log_check(b.log_lines(spark, sf), _CHECK_RULES, F.lit(_CHECK_AS_OF).cast("timestamp"))
    return events.select("name", F.round("value", 9).alias("value"))
