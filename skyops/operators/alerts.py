"""Threshold rules over statistics: evaluation, fire/resolve transitions, encodings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyops.functions.text import float_text
from skyops.functions.thresholds import OPERATORS, compare
from skyops.operators import logs
from skyops.operators.timeline import MICROS, WINDOWS_PER_BUCKET, bucket_plan, bucketed_lag, time_bucket
from skyops.schemas import ALERT_RULES

# Metrics a rule may name, severities, and rule defaults.
METRICS = ("total_entries", "error_count", "warning_count", "error_rate", "throughput")
SEVERITIES = ("info", "warning", "critical")
DEFAULT_SEVERITY = "warning"
DEFAULT_CHANNELS = ("stdout",)


def rules_frame(spark: SparkSession, rules: Sequence[dict]) -> DataFrame:
    """Rule mappings to rows. Rules are configuration: a short list known to the driver."""
    rows = []
    for r in rules:
        severity = r.get("severity", DEFAULT_SEVERITY)
        if r["operator"] not in OPERATORS:
            raise ValueError(f"unknown operator {r['operator']!r}")
        if severity not in SEVERITIES:
            raise ValueError(f"unknown severity {severity!r}")
        rows.append((r["name"], r["metric"], r["operator"], float(r["threshold"]),
                     int(r.get("window_seconds", logs.DEFAULT_WINDOW)), severity,
                     list(r.get("channels", DEFAULT_CHANNELS))))
    return spark.createDataFrame(rows, ALERT_RULES)


def clean_rules(rows: DataFrame) -> DataFrame:
    """Defaults and enum checks for rules read from files; a bad rule fails the query."""
    severity = F.coalesce("severity", F.lit(DEFAULT_SEVERITY))
    bad = (F.col("name").isNull() | F.col("metric").isNull() | F.col("threshold").isNull()
           | ~F.coalesce(F.col("operator").isin(*OPERATORS), F.lit(False))
           | ~severity.isin(*SEVERITIES))
    return rows.select(
        F.when(bad, F.raise_error(F.concat(F.lit("bad alert rule: "),
                                           F.coalesce("name", F.lit("?")))))
        .otherwise(F.col("name")).alias("name"),
        "metric", "operator", "threshold",
        F.coalesce("window_seconds", F.lit(logs.DEFAULT_WINDOW)).alias("window_seconds"),
        severity.alias("severity"),
        F.coalesce("channels", F.array(*[F.lit(c) for c in DEFAULT_CHANNELS])).alias("channels"),
    )


def evaluate(stats: DataFrame, rules: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per (statistics row, rule on one of its metrics) with ``value`` and ``breached``.

    Rules are a short list of configuration, so they go to the statistics: a shuffle by metric would put all
    rows of a metric into one task.
    """
    long = stats.select(
        *keep,
        F.inline(F.array(*[F.struct(F.lit(m).alias("metric"),
                                    F.col(m).cast("double").alias("value")) for m in METRICS])))
    hit = compare(F.col("operator"), F.col("value"), F.col("threshold"))
    return long.join(F.broadcast(rules), "metric").withColumn("breached", hit)


def transitions(evaluated: DataFrame, keys: Sequence[str], tick: str,
                bucket_seconds: float = 600, count: int | None = None) -> DataFrame:
    """Rows where a rule starts to fire or is resolved, per rule and key, in tick order.

    One task sees the ticks of one rule, key and bucket of time; ``rule_events`` chooses the bucket by
    the density of the entries, and the number of tasks by the ``count`` of evaluated rows.
    """
    order = F.col(tick)
    rows = bucketed_lag(evaluated, ["name", *keys], order, time_bucket(order, bucket_seconds),
                        F.col("breached"), "_was", count)
    was = F.coalesce("_was", F.lit(False))
    return (
        rows.filter(F.col("breached") != was)
        .withColumn("state", F.when(F.col("breached"), "firing").otherwise("resolved"))
        .drop("_was", "breached")
    )


def firing_now(changes: DataFrame, keys: Sequence[str], tick: str) -> DataFrame:
    """Rules whose latest transition is a firing one."""
    columns = changes.columns
    return (
        changes.groupBy("name", *keys)
        .agg(F.max_by(F.struct(*columns), tick).alias("_last"))
        .select("_last.*")
        .filter(F.col("state") == "firing")
    )


def message(state="state", severity="severity", name="name", metric="metric", value="value",
            operator="operator", threshold="threshold") -> Column:
    return F.concat(
        F.format_string("[%s] %s: %s — %s is %.4f (threshold: %s ", F.upper(state),
                        F.upper(severity), F.col(name), F.col(metric), F.col(value),
                        F.col(operator)),
        float_text(F.col(threshold)), F.lit(")"))


def event_json(tick: str = "ts") -> Column:
    """One JSON object per alert event."""
    return F.to_json(F.struct(
        F.col("name").alias("alert"), F.col("severity"), F.col("metric"), F.col("value"),
        F.col("threshold"), F.col("operator"), F.col("state"),
        (F.unix_micros(tick) / 1e6).alias("triggered_at"), message().alias("message")))


def _window(rule: dict) -> int:
    return int(rule.get("window_seconds", logs.DEFAULT_WINDOW))


def _values(ticks: DataFrame, rules: Sequence[dict], keys: Sequence[str], ts: str, width: int, rows: int) -> DataFrame:
    out = None
    for w in sorted({_window(r) for r in rules}):
        stats = logs.trailing_stats_of(ticks, keys, w, ts, width, rows)
        mine = rules_frame(ticks.sparkSession, [r for r in rules if _window(r) == w])
        part = evaluate(stats, mine, [*keys, ts])
        out = part if out is None else out.unionByName(part)
    return out


def _bucket(entries: DataFrame, rules: Sequence[dict], keys: Sequence[str], ts: str) -> tuple[int, int]:
    return bucket_plan(entries, keys, F.unix_micros(ts), max(map(_window, rules)) * MICROS * WINDOWS_PER_BUCKET)


def rule_values(entries: DataFrame, rules: Sequence[dict], keys: Sequence[str] = (),
                ts: str = "ts") -> DataFrame:
    """Trailing statistics of each rule's own window, joined to the rules; all windows share one table of ticks."""
    width, rows = _bucket(entries, rules, keys, ts)
    return _values(logs.entry_ticks(entries, keys, ts), rules, keys, ts, width, rows)


def rule_events(entries: DataFrame, rules: Sequence[dict], keys: Sequence[str] = (),
                ts: str = "ts") -> DataFrame:
    """``rule_values`` as transitions."""
    width, rows = _bucket(entries, rules, keys, ts)
    values = _values(logs.entry_ticks(entries, keys, ts), rules, keys, ts, width, rows)
    return transitions(values, keys, ts, width / MICROS, rows * len(rules))
