"""Row validation with reasons, duplicate routing, and the validation report."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyops.functions.text import float_text, is_blank, strip

# Required columns and (column, exclusive low, inclusive high) bounds.
REQUIRED = ("pl_name", "hostname")
RANGES = (
    ("pl_orbper", 0.0, None),
    ("pl_rade", 0.0, None),
    ("pl_bmasse", 0.0, None),
    ("pl_eqt", 0.0, None),
    ("st_teff", 0.0, 100_000.0),
    ("st_rad", 0.0, None),
    ("st_mass", 0.0, None),
    ("sy_dist", 0.0, None),
    ("disc_year", 1900.0, 2100.0),
)
# Fixed values of the query-side rule set: (column, operator, bound).
QUERY_REQUIRED = ("pl_name", "hostname", "discovery_method")
QUERY_RULES = (
    ("disc_year", ">=", 1900),
    ("disc_year", "<=", 2100),
    ("orbital_period", ">", 0),
    ("pl_rade", ">", 0),
    ("pl_bmasse", ">", 0),
    ("pl_eqt", ">", 0),
    ("st_teff", ">", 0),
    ("st_rad", ">", 0),
    ("sy_dist", ">", 0),
    ("ra", ">=", 0),
    ("ra", "<=", 360),
    ("dec", ">=", -90),
    ("dec", "<=", 90),
)


def _entry(text: str | Column, number: Column | None = None) -> Column:
    """A violated rule: message text and, for bounds, the number to append."""
    return F.struct((F.lit(text) if isinstance(text, str) else text).alias("text"),
                    (F.lit(None) if number is None else number).cast("double").alias("number"))


def required_reasons(fields: Iterable[str] = REQUIRED) -> list[Column]:
    return [
        F.when(F.col(f).isNull(), _entry(f"Missing required field: {f}"))
        .when(is_blank(F.col(f)), _entry(f"Empty required field: {f}"))
        for f in fields
    ]


def range_reasons(rules: Sequence[tuple] = RANGES) -> list[Column]:
    """One nullable entry per bound. Text columns are cast; what does not cast is reported."""
    out = []
    for field, low, high in rules:
        raw = F.col(field)
        number = raw.try_cast("double")
        real = ~F.isnan(number)
        out.append(F.when(raw.isNotNull() & number.isNull(),
                          _entry(F.concat(F.lit(f"Non-numeric value for {field}: '"),
                                          raw.cast("string"), F.lit("'")))))
        if low is not None:
            out.append(F.when(real & (number <= low),
                              _entry(f"{field} must be > {low}, got ", number)))
        if high is not None:
            out.append(F.when(real & (number > high),
                              _entry(f"{field} must be <= {high}, got ", number)))
    return out


def bound_reasons(rules: Sequence[tuple] = QUERY_RULES) -> list[Column]:
    """Entries of the query-side rule set; null passes every bound."""
    fails = {
        ">": lambda c, b: c <= b,
        ">=": lambda c, b: c < b,
        "<=": lambda c, b: c > b,
    }
    return [
        F.when(fails[op](F.col(f), F.lit(bound)), _entry(f"{f} must be {op} {bound}"))
        for f, op, bound in rules
    ]


def missing_reasons(fields: Iterable[str] = QUERY_REQUIRED) -> list[Column]:
    return [F.when(F.col(f).isNull(), _entry(f"Missing required field: {f}")) for f in fields]


def is_broken(reasons: Sequence[Column]) -> Column:
    """Whether any rule is violated: plain comparisons, no arrays and no text."""
    return reduce(lambda a, b: a | b, [r.isNotNull() for r in reasons])


def default_rules() -> list[Column]:
    return required_reasons() + range_reasons()


def with_reasons(df: DataFrame, reasons: Sequence[Column] | None = None) -> DataFrame:
    """Add ``reasons array<string>``: empty when the row is valid.

    The list is built, and numbers formatted, only for rows that break a rule.
    """
    reasons = default_rules() if reasons is None else reasons
    broken = F.array_compact(F.array(*reasons))
    text = F.transform(broken, lambda e: F.concat(
        e["text"], F.coalesce(float_text(e["number"]), F.lit(""))))
    return df.withColumn("reasons", F.when(is_broken(reasons), text).otherwise(
        F.array().cast("array<string>")))


def route(df: DataFrame, key: str = "pl_name", ordinal: str = "row_ord") -> DataFrame:
    """Label every row valid / invalid / duplicate; the first valid row of a stripped key wins.

    The winner of each key is a map-side-combined minimum, and rows meet it again on the
    unique ordinal, so no task ever holds all rows of a hot key.
    """
    rules = default_rules()
    checked = with_reasons(df, rules)
    winners = (
        df.filter(~is_broken(rules))
        .groupBy(strip(F.col(key)).alias("_key"))
        .agg(F.min(ordinal).alias(ordinal))
        .select(ordinal, F.lit(True).alias("_first"))
    )
    outcome = (
        F.when(F.size("reasons") > 0, "invalid")
        .when(F.col("_first"), "valid")
        .otherwise("duplicate")
    )
    return (
        checked.join(winners, ordinal, "left")
        .withColumn("outcome", outcome)
        .drop("_first")
    )


def first_by_key(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Keep the first row (lowest ordinal) of every stripped, non-null key."""
    columns = df.columns
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(strip(F.col(key)).alias("_key"))
        .agg(F.min_by(F.struct(*columns), ordinal).alias("_row"))
        .select("_row.*")
    )


def valid_rows(df: DataFrame, key: str = "pl_name", ordinal: str = "row_ord") -> DataFrame:
    """Only the rows ``route`` calls valid, in one shuffle."""
    return first_by_key(df.filter(~is_broken(default_rules())), key, ordinal)


def report_columns() -> list[Column]:
    """The counts of a validation report, over an ``outcome`` column."""
    outcome = F.col("outcome")
    return [
        F.count(F.lit(1)).alias("checked"),
        F.count_if(outcome == "valid").alias("valid"),
        F.count_if(outcome == "invalid").alias("invalid"),
        F.count_if(outcome == "duplicate").alias("duplicate"),
        F.count_if(outcome != "valid").alias("failed"),
    ]


def validation_report(routed: DataFrame) -> DataFrame:
    return routed.agg(*report_columns())


def sample_invalid(routed: DataFrame, ordinal: str = "row_ord", n: int = 5) -> DataFrame:
    """First ``n`` invalid rows in input order, reasons joined by ``; ``."""
    return (
        routed.filter(F.col("outcome") == "invalid")
        .orderBy(ordinal)
        .limit(n)
        .withColumn("reasons", F.concat_ws("; ", "reasons"))
    )
