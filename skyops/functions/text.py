"""String and path helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Unicode-aware strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove all outer whitespace, tabs and newlines included."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return F.length(strip(c)) == 0


def float_text(c: Column) -> Column:
    """A double in shortest plain notation: 1.0, 10000000.0, 1e-05, 1e+16, inf, nan."""
    d = c.cast("double")
    s = d.cast("string")
    size = F.abs(d)
    mantissa = F.regexp_replace(F.split_part(s, F.lit("E"), F.lit(1)), r"\.0$", "")
    exponent = F.split_part(s, F.lit("E"), F.lit(2)).try_cast("int")
    signed = F.concat(F.when(exponent < 0, "-").otherwise("+"),
                      F.format_string("%02d", F.abs(exponent)))
    plain = F.regexp_replace(s.try_cast("decimal(38,20)").cast("string"), r"0+$", "")
    return (
        F.when(F.isnan(d), "nan")
        .when(size == float("inf"), F.when(d > 0, "inf").otherwise("-inf"))
        .when((size == 0) | ((size >= 1e-3) & (size < 1e7)), s)
        .when((size >= 1e-4) & (size < 1e16), F.regexp_replace(plain, r"\.$", ".0"))
        .otherwise(F.concat(mantissa, F.lit("e"), signed))
    )


def path_join(path: Column) -> Column:
    """Dotted form of an ``array<string>`` key path."""
    return F.array_join(path, ".")


def path_parent(path: Column) -> Column:
    """The path without its last step; the root is its own parent."""
    return F.slice(path, F.lit(1), F.greatest(F.size(path) - 1, F.lit(0)))


def path_prefixes(path: Column) -> Column:
    """All prefixes of a path, the path itself included, the root (empty path) left out."""
    return F.when(F.size(path) == 0, F.array().cast("array<array<string>>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(path), F.lit(1))),
                    lambda i: F.slice(path, F.lit(1), i))
    )


def path_get(tree: Column, *keys: str, default=None, as_type: str = "string") -> Column:
    """Look a key path up in a VARIANT; a missing step or null gives ``default``."""
    path = "$" + "".join("['" + k.replace("'", "\\'") + "']" for k in keys)
    found = F.try_variant_get(tree, path, as_type)
    return found if default is None else F.coalesce(found, F.lit(default).cast(as_type))
