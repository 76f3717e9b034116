"""Alert events and structured log lines as JSON text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyops.operators import alerts


def write_alerts(events: DataFrame, path: str, tick: str = "ts") -> None:
    """Append one JSON line per event."""
    events.select(alerts.event_json(tick).alias("value")).write.mode("append").text(path)


def for_channel(events: DataFrame, channel: str) -> DataFrame:
    """Events of the rules that declare a channel."""
    return events.filter(F.array_contains("channels", channel))


def iso_millis(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def json_log_line(defaults: dict[str, str] | None = None, context: str = "context") -> Column:
    """timestamp, level, logger_name, message and, when not empty, the merged context."""
    base = F.create_map(*[F.lit(x) for kv in (defaults or {}).items() for x in kv])
    merged = F.map_concat(base.cast("map<string,string>"),
                          F.coalesce(F.col(context), F.create_map().cast("map<string,string>")))
    return F.to_json(F.struct(
        iso_millis(F.col("ts")).alias("timestamp"), F.col("level"),
        F.col("logger").alias("logger_name"), F.col("message"),
        F.when(F.size(merged) > 0, merged).alias("context")))


def write_json_logs(entries: DataFrame, path: str, defaults: dict[str, str] | None = None) -> None:
    entries.select(json_log_line(defaults).alias("value")).write.mode("append").text(path)
