"""Health checks: classification of host samples, reports, thresholds and alert routes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyops.functions.text import float_text, strip
from skyops.operators.timeline import bucketed_lag, time_bucket

# Status order, default thresholds, routes, file systems a disk check skips.
STATUSES = ("OK", "WARNING", "CRITICAL", "ERROR")
DEFAULT_THRESHOLDS = (
    ("cpu", 80.0, 95.0),
    ("memory", 80.0, 95.0),
    ("disk", 80.0, 95.0),
    ("swap", 50.0, 80.0),
)
DEFAULT_WARNING = 80.0
DEFAULT_ON = ("CRITICAL",)
ALERTING = ("WARNING", "CRITICAL", "ERROR")
SKIPPED_FILESYSTEMS = r"^(tmpfs|devtmpfs|overlay|none|devfs|map)"
CPU_CRITICAL_RATIO = 1.1875
CPU_CRITICAL_FALLBACK = 95
DB_CRITICAL_PERCENT = 95
CRITICAL_PROCESSES = ("sshd", "cron")
TOP_PROCESSES = 5


def severity(status: Column) -> Column:
    """OK 0, WARNING 1, CRITICAL 2, ERROR 3."""
    order = F.array(*[F.lit(s) for s in STATUSES])
    return (F.array_position(order, status) - 1).cast("int")


def worst(status: Column) -> Column:
    """Highest severity of a group; OK when there is none."""
    return F.coalesce(F.max_by(status, severity(status)), F.lit("OK"))


# -- results ---------------------------------------------------------------------------

_RAW = ("check string, status string, value string, threshold string, message string, "
        "timestamp string, details string, duration_ms double")


def parse_results(lines: DataFrame, column: str = "value", now: Column | None = None,
                  keep: Sequence[str] = ()) -> DataFrame:
    """One JSON object per line to typed results; what cannot be read becomes an ERROR result."""
    now = F.current_timestamp() if now is None else now
    body = strip(F.coalesce(F.col(column), F.lit("")))
    rows = lines.select(*keep, body.alias("_body")).select(
        *keep, "_body", F.from_json(F.when(F.col("_body").startswith("{"), F.col("_body")),
                                    _RAW + ", _bad string",
                                    {"columnNameOfCorruptRecord": "_bad"}).alias("_r"))
    r = F.col("_r")
    status = F.coalesce(r["status"], F.lit("ERROR"))
    value = F.coalesce(r["value"], F.lit("0")).try_cast("double")
    threshold = F.coalesce(r["threshold"], F.lit("0")).try_cast("double")
    error = (
        F.when(F.length("_body") == 0, "Script produced no output")
        .when(r.isNull() | r["_bad"].isNotNull(), "Invalid JSON output")
        .when(~status.isin(*STATUSES), F.concat(F.lit("Unexpected error: '"), status,
                                               F.lit("' is not a valid Status")))
        .when(value.isNull() | threshold.isNull(), "Unexpected error: not a number")
    )
    text_now = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = rows.select(*keep, "_r", error.alias("_error"), status.alias("_status"),
                       value.alias("_value"), threshold.alias("_threshold"))
    bad = F.col("_error").isNotNull()
    return rows.select(
        *keep,
        F.coalesce(F.when(r["_bad"].isNull(), r["check"]), F.lit("unknown")).alias("check"),
        F.when(bad, "ERROR").otherwise(F.col("_status")).alias("status"),
        F.when(bad, 0.0).otherwise(F.col("_value")).alias("value"),
        F.when(bad, 0.0).otherwise(F.col("_threshold")).alias("threshold"),
        F.coalesce("_error", r["message"], F.lit("")).alias("message"),
        F.when(bad, text_now).otherwise(F.coalesce(r["timestamp"], text_now)).alias("timestamp"),
        F.when(bad, F.to_json(F.create_map(F.lit("error"), F.col("_error"))))
        .otherwise(F.coalesce(r["details"], F.lit("{}"))).alias("details"),
        F.coalesce(r["duration_ms"], F.lit(0.0)).alias("duration_ms"),
    )


def select_checks(results: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Only the named checks, trimmed and case-folded; no names keeps all."""
    if not names:
        return results
    return results.filter(F.lower(strip(F.col("check"))).isin(*[n.strip().lower() for n in names]))


def latest_results(results: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One result per (run keys, check): a run holds each check once."""
    columns = results.columns
    return (results.groupBy(*keys, "check")
            .agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_r"))
            .select("_r.*"))


def report(results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts, overall status, exit code and the checks of each run, by name.

    Rows are one per (run, check), so the nested list is as long as the list of checks.
    """
    status = F.col("status")
    entry = F.struct("check", "status", "value", "threshold", "message")
    rows = results.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(status == s).alias(s.lower()) for s in STATUSES],
        worst(status).alias("overall_status"),
        F.sort_array(F.collect_list(entry)).alias("checks"))
    return rows.withColumn("exit_code", exit_code(F.col("overall_status")))


def exit_code(overall: Column) -> Column:
    return F.when(overall == "CRITICAL", 2).when(overall == "WARNING", 1).otherwise(0)


# -- thresholds and alerts -----------------------------------------------------------------

def thresholds(spark: SparkSession, user: DataFrame | None = None) -> DataFrame:
    """Defaults with user rows (check, warning, critical) laid over them, field by field."""
    base = spark.createDataFrame(list(DEFAULT_THRESHOLDS),
                                 "check string, warning double, critical double")
    if user is None:
        return base
    d, u = base.alias("d"), user.alias("u")
    return d.join(u, F.col("d.check") == F.col("u.check"), "full_outer").select(
        F.coalesce("d.check", "u.check").alias("check"),
        F.coalesce("u.warning", "d.warning").alias("warning"),
        F.coalesce("u.critical", "d.critical").alias("critical"))


def warning_threshold(checks: DataFrame, config: DataFrame) -> DataFrame:
    """The warning threshold of every check name, 80 where none is set."""
    cfg = config.select("check", "warning")
    return checks.join(cfg, "check", "left").select(
        "check", F.coalesce("warning", F.lit(DEFAULT_WARNING)).alias("warning"))


def check_thresholds(checks: DataFrame, config: DataFrame) -> DataFrame:
    """Both thresholds of every check name; the critical one is null where none is set."""
    return checks.join(config, "check", "left").select(
        "check", F.coalesce("warning", F.lit(DEFAULT_WARNING)).alias("warning"), "critical")


def result_alerts(results: DataFrame, config: DataFrame) -> DataFrame:
    """WARNING / CRITICAL / ERROR results with the configured threshold, else their own."""
    hits = results.filter(F.col("status").isin(*ALERTING)).withColumnRenamed("threshold", "_own")
    limit = F.when(F.col("status") == "CRITICAL", F.col("critical")).otherwise(F.col("warning"))
    return (hits.join(config, "check", "left")
            .withColumn("threshold", F.coalesce(limit, F.col("_own")))
            .drop("_own", "warning", "critical"))


def routes_frame(spark: SparkSession, hooks: Sequence[dict]) -> DataFrame:
    """(url, status) rows of the configured webhooks."""
    rows = sorted({(h.get("url", ""), s.upper()) for h in hooks for s in h.get("on", DEFAULT_ON)})
    return spark.createDataFrame(rows, "url string, status string")


def route_alerts(alerts: DataFrame, routes: DataFrame, keys: Sequence[str],
                 source: str = "skyops") -> DataFrame:
    """One payload per (run, webhook) with at least one matching alert."""
    entry = F.struct("check", "status", "value", "threshold", "message")
    grouped = alerts.join(routes, "status").groupBy(*keys, "url").agg(
        F.count(F.lit(1)).alias("alerts"), F.sort_array(F.collect_list(entry)).alias("_list"))
    payload = F.to_json(F.struct(F.lit(source).alias("source"), F.col("_list").alias("alerts")))
    return grouped.withColumn("payload", payload).drop("_list")


# -- classification of host samples -----------------------------------------------------------

def _status(critical: Column, warning: Column) -> Column:
    return F.when(critical, "CRITICAL").when(warning, "WARNING").otherwise("OK")


def steep_critical(threshold: int) -> int:
    """Three quarters of the way from the threshold to 100, in whole percent."""
    return threshold + (100 - threshold) * 3 // 4


def cpu_critical(threshold: int) -> int:
    limit = round(threshold * CPU_CRITICAL_RATIO)
    return CPU_CRITICAL_FALLBACK if limit > 100 else limit


def counter_delta(samples: DataFrame, host: str, ts: str, order: str, counters: Sequence[str],
                  bucket_seconds: int = 3600) -> DataFrame:
    """Change of cumulative counters since the host's previous sample (null for the first)."""
    pair = F.struct(*counters)
    rows = bucketed_lag(samples, [host], F.struct(ts, order),
                        time_bucket(F.col(ts), bucket_seconds), pair, "_before")
    return rows.withColumns(
        {f"d_{c}": F.col(c) - F.col("_before")[c] for c in counters}).drop("_before")


def cpu_status(samples: DataFrame, host: str = "host", ts: str = "ts", order: str = "event_id",
               threshold: int = 80) -> DataFrame:
    """Busy share between consecutive samples of /proc/stat style tick counters."""
    ticks = ("user", "nice", "system", "idle", "iowait", "irq", "softirq", "steal")
    total = sum((F.col(t) for t in ticks[1:]), F.col(ticks[0]))
    rows = samples.withColumn("total", total).withColumn(
        "busy", F.col("total") - F.col("idle") - F.col("iowait"))
    d = counter_delta(rows, host, ts, order, ("total", "busy"))
    share = F.bround(F.try_divide(F.col("d_busy").cast("double"), F.col("d_total")) * 100, 1)
    value = F.coalesce(share, F.lit(0.0))
    whole = F.rint("value")
    return (
        d.filter(F.col("d_total").isNotNull())
        .select(host, ts, order, value.alias("value"))
        .withColumn("status", _status(whole >= cpu_critical(threshold), whole >= threshold))
    )


def memory_status(samples: DataFrame, threshold: int = 80) -> DataFrame:
    """Used share of (total_kb, available_kb), in whole megabytes."""
    total = F.expr("total_kb div 1024")
    used = F.expr("(total_kb - available_kb) div 1024")
    value = F.when(total > 0, F.bround(used / total * 100, 1)).otherwise(0.0)
    whole = F.rint("value")
    return samples.withColumn("value", value).withColumn(
        "status", _status(whole >= steep_critical(threshold), whole >= threshold))


def disk_status(mounts: DataFrame, keys: Sequence[str], order: str,
                threshold: int = 80) -> DataFrame:
    """Fullest real file system per run; the first listed wins a tie, and nothing used is "/"."""
    real = mounts.filter(~F.col("filesystem").rlike(SKIPPED_FILESYSTEMS))
    worst_mount = F.max_by("mount", F.struct("usage_pct", -F.col(order)))
    rows = real.groupBy(*keys).agg(F.max("usage_pct").alias("value"), worst_mount.alias("mount"))
    value = F.col("value")
    return rows.withColumns({
        "mount": F.when(value > 0, F.col("mount")).otherwise("/"),
        "status": _status(value >= steep_critical(threshold), value >= threshold)})


def network_status(probes: DataFrame, keys: Sequence[str], threshold: int = 100) -> DataFrame:
    """Failed probes of (kind, result, latency_ms); latency counts for pings only."""
    latency = F.when(F.col("kind") == "ping", F.rint("latency_ms"))
    rows = probes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("result") == "FAIL").alias("failures"),
        F.greatest(F.coalesce(F.max(latency), F.lit(0.0)), F.lit(0.0)).cast("long")
        .alias("worst_latency"))
    failures = F.col("failures")
    return rows.withColumn("status", _status(
        failures > F.expr("total_checks div 2"),
        (failures > 0) | (F.col("worst_latency") >= threshold)))


def process_status(processes: DataFrame, keys: Sequence[str],
                   expected: Sequence[str] = CRITICAL_PROCESSES, threshold: int = 0) -> DataFrame:
    """Expected names no command contains, and zombies, per run."""
    missing = sum((F.when(F.bool_or(F.contains("command", F.lit(e))), 0).otherwise(1)
                   for e in expected), F.lit(0))
    rows = processes.groupBy(*keys).agg(
        missing.cast("long").alias("missing"),
        F.count_if(F.col("state").startswith("Z")).alias("zombies"))
    return rows.withColumns({
        "value": F.col("missing") + F.col("zombies"),
        "status": _status(F.col("missing") > 0, F.col("zombies") > threshold)})


def top_processes(processes: DataFrame, keys: Sequence[str], n: int = TOP_PROCESSES) -> DataFrame:
    """The n busiest processes of each run; Spark prunes each partition to n rows per run first."""
    w = Window.partitionBy(*keys).orderBy(F.desc("cpu"), "pid")
    return processes.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def container_status(counts: DataFrame) -> DataFrame:
    """From (daemon, running, total, unhealthy): daemon is running, stopped or not_installed."""
    up = F.col("daemon") == "running"
    stopped = F.col("total") - F.col("running")
    status = (
        F.when(F.col("daemon") == "not_installed", "OK")
        .when(F.col("daemon") == "stopped", "WARNING")
        .otherwise(_status(F.col("unhealthy") > 0, stopped > 0)))
    return counts.withColumns({
        "stopped": F.when(up, stopped).otherwise(0),
        "value": F.when(up, F.col("unhealthy")).otherwise(0), "status": status})


def container_counts(containers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Containers (daemon, state, health) to the counts ``container_status`` reads."""
    running = F.col("state") == "running"
    return containers.groupBy(*keys).agg(
        F.max("daemon").alias("daemon"), F.count_if(running).alias("running"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(running & (F.col("health") == "unhealthy")).alias("unhealthy"))


def database_status(samples: DataFrame, threshold: int = 80,
                    max_lag: int = 1_048_576) -> DataFrame:
    """From (connected, connections, max_connections, lag_bytes)."""
    share = F.bround(F.col("connections") / F.col("max_connections") * 100, 1)
    value = F.when(F.col("connected") & (F.col("max_connections") > 0), share).otherwise(0.0)
    whole = F.rint("value")
    critical = (~F.col("connected") | (whole >= DB_CRITICAL_PERCENT)
                | (F.rint(F.coalesce("lag_bytes", F.lit(0)).cast("double")) >= max_lag))
    return samples.withColumn("value", value).withColumn(
        "status", _status(critical, whole >= threshold))


def endpoint_status(calls: DataFrame, threshold: int = 2000, expected: int = 200) -> DataFrame:
    """From (http_code, seconds): per call the status and the whole milliseconds."""
    ms = F.rint(F.col("seconds") * 1000).cast("long")
    status = _status(F.col("http_code") == 0,
                     (F.col("http_code") != expected) | (F.col("response_ms") >= threshold))
    return calls.withColumn("response_ms", ms).withColumn("status", status)


def endpoint_summary(calls: DataFrame, keys: Sequence[str]) -> DataFrame:
    return calls.groupBy(*keys).agg(
        worst(F.col("status")).alias("status"), F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "CRITICAL").alias("failed"),
        F.max("response_ms").alias("worst_ms"))


def usage_message(kind: str, value: str = "value") -> Column:
    return F.concat(F.lit(f"{kind} usage at "), float_text(F.col(value)), F.lit("%"))
