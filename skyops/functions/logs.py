"""Log line parsing as column expressions: JSON, syslog, plain text, and the mixed form.

Every parser maps a text column to a nullable ``struct<ts,level,logger,message,context>``.
``as_of`` stands for "now": it dates entries without a time and gives syslog its year.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyops.functions.text import strip

# The syslog (RFC 3164) line pattern, and level aliases in matching order.
SYSLOG = (
    r"^(?:<\d+>)?"
    r"(\w{3}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2})\s+"
    r"(\S+)\s+"
    r"(\S+?)(?:\[(\d+)\])?:\s+"
    r"(.*)$"
)
LEVEL_ALIASES = {
    "DEBUG": "DEBUG",
    "INFO": "INFO",
    "WARNING": "WARNING",
    "WARN": "WARNING",
    "ERROR": "ERROR",
    "ERR": "ERROR",
    "CRITICAL": "CRITICAL",
    "FATAL": "CRITICAL",
    "CRIT": "CRITICAL",
}
# Key names tried in order.
TIME_KEYS = ("timestamp", "ts", "time")
LEVEL_KEYS = ("level", "severity")
LOGGER_KEYS = ("logger_name", "logger", "name")
MESSAGE_KEYS = ("message", "msg")

_TIME_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}(T\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?Z?|" \
             r" \d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?)$"
_MAP = "map<string,string>"
_NUMBER = r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$"


def infer_level(text: Column) -> Column:
    """The first alias found anywhere in the text, else INFO."""
    upper = F.upper(text)
    aliases = iter(LEVEL_ALIASES.items())
    word, level = next(aliases)
    chain = F.when(F.contains(upper, F.lit(word)), level)
    for word, level in aliases:
        chain = chain.when(F.contains(upper, F.lit(word)), level)
    return chain.otherwise("INFO")


def normal_level(level: Column) -> Column:
    """Upper case with known aliases folded; unknown levels stay."""
    upper = F.upper(level)
    aliases = F.create_map(*[F.lit(x) for pair in LEVEL_ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(aliases, upper), upper)


def parse_time_text(text: Column) -> Column:
    """The six accepted date-time spellings, read as UTC with fractions kept; else null."""
    plain = F.translate(text, "TZ", " ")
    return F.when(text.rlike(_TIME_TEXT), plain.try_cast("timestamp"))


def epoch_time(seconds: Column) -> Column:
    return F.timestamp_micros(F.round(seconds * 1e6).cast("bigint"))


def is_error(level: Column) -> Column:
    return level.isin("ERROR", "CRITICAL")


def is_warning(level: Column) -> Column:
    return level == "WARNING"


# Each line form is split in two: a parsed piece (JSON map, syslog parts), which a plan computes
# once per line, and the entry fields read off that piece.

FIELDS = ("ts", "level", "logger", "message", "context")


def empty_context() -> Column:
    return F.create_map().cast(_MAP)


def json_map(body: Column) -> Column:
    """Top-level keys of an object line with their values as text; null for any other line."""
    return F.from_json(F.when(body.startswith("{") & body.endswith("}"), body), _MAP)


def _text(tree: Column, key: str) -> Column:
    """Value of a key as text: null when the key is absent, ``None`` for a JSON null."""
    value = F.try_element_at(tree, F.lit(key))
    return F.coalesce(value, F.when(F.map_contains_key(tree, key), F.lit("None")))


def _first_text(tree: Column, keys, default: str) -> Column:
    return F.coalesce(*[_text(tree, k) for k in keys], F.lit(default))


def json_time(tree: Column, body: Column, as_of: Column) -> Column:
    """First truthy time key: a number is an epoch, text one of the known spellings, else now."""
    picked = as_of
    for key in reversed(TIME_KEYS):
        text = F.try_element_at(tree, F.lit(key))
        truthy = text.isNotNull() & ~text.isin("", "0", "0.0", "-0.0", "false", "[]", "{}")
        quoted = body.rlike(f'"{key}"\\s*:\\s*"')
        number = F.when(text.rlike(_NUMBER), F.when(~quoted, text.try_cast("double")))
        here = F.coalesce(parse_time_text(text), epoch_time(number), as_of)
        picked = F.when(truthy, here).otherwise(picked)
    return picked


def json_fields(tree: Column, body: Column, as_of: Column) -> dict[str, Column]:
    context = F.try_element_at(tree, F.lit("context"))
    return {
        "ts": json_time(tree, body, as_of),
        "level": normal_level(_first_text(tree, LEVEL_KEYS, "INFO")),
        "logger": _first_text(tree, LOGGER_KEYS, ""),
        "message": _first_text(tree, MESSAGE_KEYS, ""),
        "context": F.coalesce(F.from_json(F.when(context.startswith("{"), context), _MAP),
                              empty_context()),
    }


def syslog_parts(body: Column) -> Column:
    """[time, host, app, pid or '', message] of a syslog line; null for any other line."""
    parts = F.split(F.regexp_replace(body, SYSLOG, "$1\x01$2\x01$3\x01$4\x01$5"), "\x01", 5)
    return F.when(body.rlike(SYSLOG), parts)


def syslog_fields(parts: Column, as_of: Column) -> dict[str, Column]:
    """The year comes from ``as_of``; an impossible date reads as now."""
    when = F.concat_ws(" ", F.year(as_of).cast("string"), F.regexp_replace(parts[0], r"\s+", " "))
    host, pid = F.lit("hostname"), F.lit("pid")
    return {
        "ts": F.coalesce(F.try_to_timestamp(when, F.lit("yyyy MMM d HH:mm:ss")), as_of),
        "level": infer_level(parts[4]),
        "logger": parts[2],
        "message": parts[4],
        "context": F.when(parts[3] == "", F.create_map(host, parts[1]))
        .otherwise(F.create_map(host, parts[1], pid, parts[3])),
    }


def plain_fields(body: Column, as_of: Column) -> dict[str, Column]:
    return {"ts": as_of, "level": infer_level(body), "logger": F.lit(""), "message": body,
            "context": empty_context()}


def _struct(fields: dict[str, Column]) -> Column:
    return F.struct(*[fields[n].alias(n) for n in FIELDS])


def _once(piece: Column, entry) -> Column:
    """``entry(piece)`` with the piece computed once; null when the piece is null."""
    return F.get(F.transform(F.array(piece), lambda p: F.when(p.isNotNull(), entry(p))), 0)


def parse_json(line: Column, as_of: Column | None = None) -> Column:
    """A JSON object line, else null."""
    as_of = F.current_timestamp() if as_of is None else as_of
    body = strip(line)
    return _once(json_map(body), lambda tree: _struct(json_fields(tree, body, as_of)))


def parse_syslog(line: Column, as_of: Column | None = None) -> Column:
    """A syslog line, else null."""
    as_of = F.current_timestamp() if as_of is None else as_of
    return _once(syslog_parts(strip(line)),
                 lambda parts: _struct(syslog_fields(parts, as_of)))


def parse_plain(line: Column, as_of: Column | None = None) -> Column:
    """Any non-blank line."""
    as_of = F.current_timestamp() if as_of is None else as_of
    body = strip(line)
    return F.when(F.length(body) > 0, _struct(plain_fields(body, as_of)))


def parse_auto(line: Column, as_of: Column | None = None) -> Column:
    """JSON, else syslog, else plain text; null for a blank line."""
    return F.coalesce(parse_json(line, as_of), parse_syslog(line, as_of),
                      parse_plain(line, as_of))
