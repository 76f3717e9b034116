"""Log entries to level counts, rates and trailing statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyops.functions import logs
from skyops.functions.text import strip
from skyops.operators.timeline import ticks_of, trailing_sums, trailing_sums_of

# Levels that have their own counter; every other level counts as info.
COUNTED_LEVELS = ("ERROR", "CRITICAL", "WARNING", "DEBUG")
COUNTERS = ("total_entries", "error_count", "critical_count", "warning_count", "debug_count",
            "info_count")
DEFAULT_WINDOW = 300

Parser = Callable[..., Column]


def parse(lines: DataFrame, parser: Parser | None = None, column: str = "value",
          as_of: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Lines to entries; lines that give no entry are dropped.

    Without a parser the mixed form is read (JSON, else syslog, else plain text). Any function
    of shape ``(line, as_of) -> struct`` may take its place.
    """
    if parser is None:
        return parse_mixed(lines, column, as_of, keep)
    entry = parser(F.col(column), as_of)
    return lines.select(*keep, F.inline(F.array_compact(F.array(entry))))


def parse_mixed(lines: DataFrame, column: str = "value", as_of: Column | None = None,
                keep: Sequence[str] = ()) -> DataFrame:
    """The mixed form with the JSON map and the syslog parts of a line computed once each."""
    as_of = F.current_timestamp() if as_of is None else as_of
    body, tree, parts = F.col("_body"), F.col("_tree"), F.col("_parts")
    staged = (
        lines.select(*keep, strip(F.col(column)).alias("_body"))
        .filter(F.length("_body") > 0)
        .select(*keep, "_body", logs.json_map(body).alias("_tree"))
        .select(*keep, "_body", "_tree",
                F.when(tree.isNull(), logs.syslog_parts(body)).alias("_parts"))
    )
    from_json = logs.json_fields(tree, body, as_of)
    from_syslog = logs.syslog_fields(parts, as_of)
    plain = logs.plain_fields(body, as_of)
    return staged.select(*keep, *[
        F.when(tree.isNotNull(), from_json[n]).when(parts.isNotNull(), from_syslog[n])
        .otherwise(plain[n]).alias(n)
        for n in logs.FIELDS])


def level_counts(level: str = "level") -> dict[str, Column]:
    """The six counters as aggregate columns."""
    c = F.col(level)
    out = {"total_entries": F.count(F.lit(1))}
    for name in COUNTED_LEVELS:
        out[f"{name.lower()}_count"] = F.count_if(c == name)
    out["info_count"] = F.count_if(~F.coalesce(c.isin(*COUNTED_LEVELS), F.lit(False)))
    return out


def error_rate(total="total_entries", errors="error_count", critical="critical_count") -> Column:
    rate = F.try_divide((F.col(errors) + F.col(critical)).cast("double"), F.col(total))
    return F.coalesce(rate, F.lit(0.0))


def throughput(start="window_start", end="window_end", total="total_entries") -> Column:
    seconds = (F.unix_micros(end) - F.unix_micros(start)) / 1e6
    return F.when(seconds > 0, F.col(total) / seconds).otherwise(0.0)


def with_rates(stats: DataFrame) -> DataFrame:
    return stats.withColumns({"error_rate": error_rate(), "throughput": throughput()})


def rolling_stats(entries: DataFrame, keys: Sequence[str] = (), since: Column | None = None,
                  ts: str = "ts") -> DataFrame:
    """Counters, window bounds and rates of all entries (from ``since`` on), per key."""
    rows = entries if since is None else entries.filter(F.col(ts) >= since)
    stats = rows.groupBy(*keys).agg(
        *[c.alias(n) for n, c in level_counts().items()],
        F.min(ts).alias("window_start"), F.max(ts).alias("window_end"))
    return with_rates(stats)


def entry_ticks(entries: DataFrame, keys: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """The counters of every distinct (keys, time): what trailing windows of any length start from."""
    return ticks_of(entries, keys, F.unix_micros(ts), level_counts())


def trailing_stats_of(ticks: DataFrame, keys: Sequence[str], window_seconds: int, ts: str, width: int,
                      rows: int | None = None) -> DataFrame:
    sums = trailing_sums_of(ticks, keys, ts, COUNTERS, window_seconds, width, rows)
    return with_rates(sums.withColumn("window_end", F.col(ts)))


def trailing_stats(entries: DataFrame, keys: Sequence[str] = (),
                   window_seconds: int = DEFAULT_WINDOW, ts: str = "ts") -> DataFrame:
    """Statistics over the closed window [ts - N, ts] at every time an entry arrives."""
    sums = trailing_sums(entries, keys, ts, level_counts(), window_seconds)
    return with_rates(sums.withColumn("window_end", F.col(ts)))
