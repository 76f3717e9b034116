"""Stand-in inputs: how the given tables feed the operators.

Each projection is a list of (column, SQL expression) whose text both Spark and the checking
engine accept, so the input shaping is the same on both sides; the operators are not shared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


RAW = [
    ("row_ord", "p_partkey"),
    ("pl_name", "CASE WHEN p_partkey % 101 = 0 THEN NULL WHEN p_partkey % 5 = 0 "
                "THEN concat('  ', p_name, ' ') ELSE p_name END"),
    ("hostname", "CASE WHEN p_partkey % 97 = 0 THEN '  ' ELSE p_brand END"),
    ("discoverymethod", "CASE WHEN p_partkey % 3 = 0 THEN concat(p_type, ' ') ELSE p_type END"),
    ("disc_year", "CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 211 = 0 THEN 1900 "
                  "ELSE 1990 + p_size % 30 END"),
    ("pl_orbper", "CAST(p_retailprice / 7 AS DOUBLE)"),
    ("pl_rade", "CAST(p_size - 2 AS DOUBLE)"),
    ("pl_bmasse", "p_retailprice"),
    ("pl_eqt", "CAST((p_partkey * 7) % 2000 AS DOUBLE)"),
    ("st_teff", "CAST(CASE WHEN p_partkey % 307 = 0 THEN 200000 ELSE 3000 + p_partkey % 4000 END "
                "AS DOUBLE)"),
    ("st_rad", "CAST(0.5 + (p_partkey % 40) / 10.0 AS DOUBLE)"),
    ("st_mass", "CAST(CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE 0.1 * (1 + p_partkey % 30) END "
                "AS DOUBLE)"),
    ("sy_dist", "CAST(1 + p_partkey % 997 AS DOUBLE)"),
    ("default_flag", "CASE WHEN p_partkey % 4 = 3 THEN 0 ELSE 1 END"),
]

QUERY = [
    ("pl_name", "concat(p_name, ' ', CAST(p_partkey AS VARCHAR(20)))"),
    ("hostname", "p_brand"),
    ("discovery_method", "p_type"),
    ("disc_year", "CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE 1990 + p_size % 30 END"),
    ("orbital_period", "CAST(p_retailprice / 7 AS DOUBLE)"),
    ("pl_rade", "CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST(p_size - 2 AS DOUBLE) END"),
    ("pl_bmasse", "CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_retailprice END"),
    ("pl_eqt", "CASE WHEN p_partkey % 29 = 0 THEN NULL "
               "ELSE CAST((p_partkey * 7) % 2000 AS DOUBLE) END"),
    ("st_teff", "CAST(3000 + p_partkey % 4000 AS DOUBLE)"),
    ("st_rad", "CAST(0.5 + (p_partkey % 40) / 10.0 AS DOUBLE)"),
    ("sy_dist", "CAST(1 + p_partkey % 997 AS DOUBLE)"),
    ("ra", "CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE CAST((p_partkey * 37) % 360 AS DOUBLE) END"),
    ("dec", "CAST(p_partkey % 181 - 90 AS DOUBLE)"),
]


def project(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS `{c}`" for c, e in columns])


def sql(columns: list[tuple[str, str]], source: str) -> str:
    return "SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in columns) + f" FROM {source}"


def raw_catalog(spark, sf) -> DataFrame:
    return project(table(spark, sf, "part"), RAW)


def query_catalog(spark, sf) -> DataFrame:
    return project(table(spark, sf, "part"), QUERY)


RAW_SQL = sql(RAW, "part")
QUERY_SQL = sql(QUERY, "part")


# -- events as logs ------------------------------------------------------------------

_LEVELS = {"error": "ERROR", "purchase": "CRITICAL", "signup": "WARNING", "view": "DEBUG",
           "click": "NOTICE"}
LEVEL_CASE = ("CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _LEVELS.items())
              + " END")
MESSAGE = "concat(event_type, ' of ', CAST(value AS VARCHAR(30)), ' by user')"


def events(spark, sf) -> DataFrame:
    """Events with a zoned timestamp."""
    df = table(spark, sf, "events")
    return df.withColumn("ts", df["ts"].cast("timestamp"))


def logs(spark, sf) -> DataFrame:
    """Parsed log entries: (event_id, ts, level, logger, message, context)."""
    return events(spark, sf).selectExpr(
        "event_id", "ts", f"{LEVEL_CASE} AS level", "CAST(user_id AS STRING) AS logger",
        f"{MESSAGE} AS message", "from_json(props, 'map<string,string>') AS context")


LOGS_SQL = f"""SELECT event_id, ts, epoch_us(ts) AS us, {LEVEL_CASE} AS level,
  CAST(user_id AS VARCHAR) AS logger, {MESSAGE} AS message, props FROM events"""

# One text line per event: JSON in several spellings, syslog with and without a pid, plain text.
_LINE = """CASE event_id % 12
  WHEN 0 THEN concat('{{"timestamp": "', {iso}, '", "level": "', lower({level}), '", "logger_name": "u', user_id, '", "message": "', {msg}, '", "context": ', props, '}}')
  WHEN 1 THEN concat('{{"ts": ', {epoch}, ', "severity": "warn", "logger": "u', user_id, '", "msg": "', {msg}, '", "context": "none"}}')
  WHEN 2 THEN concat('  {{"timestamp": "", "time": "', {plain}, '", "level": "fatal", "name": "n', user_id, '"}}')
  WHEN 3 THEN concat('{{"message": "no time", "level": null, "context": ', props, '}}')
  WHEN 4 THEN concat('[', user_id, ', "not an object"]')
  WHEN 5 THEN concat('<34>', {syslog}, ' host', user_id, ' app[', event_id, ']: ', {msg})
  WHEN 6 THEN concat({syslog}, ' host', user_id, ' cron: job ', {msg}, ' warn')
  WHEN 7 THEN concat('Feb 31 10:00:00 host', user_id, ' app: bad date fatal')
  WHEN 8 THEN concat('  info: error text ', event_id)
  WHEN 9 THEN concat('plain ', {level}, ' line ', event_id, ' ')
  WHEN 10 THEN '   '
  ELSE concat('{{"ts": "', {plain}, '", "message": broken ', event_id) END"""

LINE_SPARK = _LINE.format(
    iso="date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")", level=LEVEL_CASE, msg=MESSAGE,
    epoch="CAST(unix_seconds(ts) AS STRING)", plain="date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
    syslog="concat(date_format(ts, 'MMM'), lpad(date_format(ts, 'd'), 3, ' '), "
           "date_format(ts, ' HH:mm:ss'))")
LINE_SQL = _LINE.format(
    iso="strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')", level=LEVEL_CASE, msg=MESSAGE,
    epoch="CAST(epoch_us(ts) // 1000000 AS VARCHAR)", plain="strftime(ts, '%Y-%m-%d %H:%M:%S')",
    syslog="concat(strftime(ts, '%b'), lpad(strftime(ts, '%-d'), 3, ' '), "
           "strftime(ts, ' %H:%M:%S'))")


def log_lines(spark, sf) -> DataFrame:
    """(event_id, value): raw text lines."""
    return events(spark, sf).selectExpr("event_id", f"{LINE_SPARK} AS value")


LINES_SQL = f"SELECT event_id, ts, {LINE_SQL} AS value FROM events"

RULES = [
    {"name": "high_error_rate", "metric": "error_rate", "operator": ">", "threshold": 0.5,
     "window_seconds": 3600, "severity": "critical", "channels": ["stdout", "file"]},
    {"name": "low_throughput", "metric": "throughput", "operator": "<", "threshold": 0.001,
     "window_seconds": 3600, "severity": "warning"},
    {"name": "excessive_errors", "metric": "error_count", "operator": ">=", "threshold": 6,
     "window_seconds": 7200, "severity": "critical", "channels": ["stdout", "file", "webhook"]},
    {"name": "exactly_three", "metric": "warning_count", "operator": "==", "threshold": 3.0,
     "window_seconds": 3600, "severity": "info"},
    {"name": "unknown_metric", "metric": "latency", "operator": ">", "threshold": 1,
     "window_seconds": 3600},
]
