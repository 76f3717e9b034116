"""Secret patterns and redaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (pattern name, regular expression, severity, words one of which every match
# contains, in lower case).
PATTERNS = (
    ("aws_access_key", r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b", "error", ("akia", "asia")),
    ("aws_secret_key", r"(?i)\baws_secret_access_key\b\s*[:=]\s*[\"']?[A-Za-z0-9/+=]{40}", "error",
     ("aws_secret_access_key",)),
    ("api_key", r"(?i)\b(?:api[_-]?key|access[_-]?token|auth[_-]?token|secret[_-]?key|token)\b"
                r"\s*[:=]\s*[\"']?[A-Za-z0-9_\-]{16,}", "error", ("key", "token")),
    ("password", r"(?i)\b(?:password|passwd|pwd)\b\s*[:=]\s*[\"']?[^\s\"']{4,}", "error",
     ("password", "passwd", "pwd")),
    ("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", "error", ("private key-----",)),
    ("connection_string", r"(?i)\b(?:postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqp)"
                          r"://[^\s:@/]+:[^\s:@/]+@[^\s\"']+", "error", ("://",)),
    ("github_token", r"\bgh[pousr]_[A-Za-z0-9]{36,}\b", "error",
     ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    ("slack_token", r"\bxox[abprs]-[A-Za-z0-9\-]{10,}", "error", ("xox",)),
)


def suspicious(text: Column, patterns=PATTERNS) -> Column:
    """Whether some pattern's word occurs at all: plain substring tests on text lowered once."""
    words = sorted({w for p in patterns for w in p[3]})

    def any_word(low: Column) -> Column:
        test = F.contains(low, F.lit(words[0]))
        for w in words[1:]:
            test = test | F.contains(low, F.lit(w))
        return test

    return F.get(F.transform(F.array(F.lower(text)), any_word), 0)


def findings(line: Column, patterns=PATTERNS) -> Column:
    """Every match of every pattern in a line: ``array<struct<pattern,severity,matched>>``."""
    def named(name: str, severity: str):
        return lambda m: F.struct(F.lit(name).alias("pattern"), F.lit(severity).alias("severity"),
                                  m.alias("matched"))

    parts = [F.transform(F.regexp_extract_all(line, F.lit(p), F.lit(0)), named(name, severity))
             for name, p, severity, _ in patterns]
    return F.concat(*parts)


def redact(text: Column) -> Column:
    """``***`` for up to eight characters, else the first and last four around it."""
    return F.when(F.length(text) <= 8, "***").otherwise(
        F.concat(F.left(text, F.lit(4)), F.lit("***"), F.right(text, F.lit(4))))
