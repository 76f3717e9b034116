"""Catalog transforms, filters, pages and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyops.functions.text import strip
from skyops.operators.ranks import slice_of

# Unit ratios and the temperate range.
JUPITER_RADIUS_IN_EARTH_RADII = 11.209
JUPITER_MASS_IN_EARTH_MASSES = 317.828
TEMPERATE_MIN_K = 180.0
TEMPERATE_MAX_K = 310.0
# Columns a page may be sorted by, summarised parameters, display names.
SORTABLE = ("pl_name", "hostname", "discovery_method", "disc_year",
            "pl_bmasse", "pl_rade", "orbital_period", "sy_dist")
MAX_PAGE = 100
PARAMETERS = ("orbital_period", "pl_rade", "pl_bmasse", "pl_eqt", "st_teff")
DISPLAY_COLUMNS = ("pl_name", "hostname", "discovery_method", "disc_year", "orbital_period",
                   "pl_rade", "pl_bmasse", "pl_eqt", "sy_dist")
DISPLAY_NAMES = {
    "pl_name": "Planet", "hostname": "Host Star", "discovery_method": "Method",
    "disc_year": "Year", "orbital_period": "Period (days)", "pl_rade": "Radius (R⊕)",
    "pl_bmasse": "Mass (M⊕)", "pl_eqt": "Eq. Temp (K)", "st_teff": "Stellar Teff (K)",
    "st_rad": "Stellar Radius (R☉)", "sy_dist": "Distance (pc)",
    "ra": "RA (°)", "dec": "Dec (°)",
}
# Reference lines of the mass-radius plane.
EARTH_LINE = (1.0, 1.0)
JUPITER_LINE = (317.8, 11.2)


# -- transform ---------------------------------------------------------------

def radius_in_jupiter(c: Column) -> Column:
    return c / F.lit(JUPITER_RADIUS_IN_EARTH_RADII)


def mass_in_jupiter(c: Column) -> Column:
    return c / F.lit(JUPITER_MASS_IN_EARTH_MASSES)


def is_temperate(c: Column) -> Column:
    """Inclusive range test; null and NaN are false."""
    return F.coalesce(c.between(TEMPERATE_MIN_K, TEMPERATE_MAX_K), F.lit(False))


def transform(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw 12-column rows to the 15 clean columns (plus any ``keep`` columns)."""
    return raw.select(
        *keep,
        strip(F.col("pl_name")).alias("pl_name"),
        strip(F.col("hostname")).alias("hostname"),
        strip(F.col("discoverymethod")).alias("discovery_method"),
        F.col("disc_year"),
        F.col("pl_orbper").alias("orbital_period_days"),
        F.col("pl_rade").alias("radius_earth"),
        radius_in_jupiter(F.col("pl_rade")).alias("radius_jupiter"),
        F.col("pl_bmasse").alias("mass_earth"),
        mass_in_jupiter(F.col("pl_bmasse")).alias("mass_jupiter"),
        F.col("pl_eqt").alias("equilibrium_temp_k"),
        F.col("st_teff").alias("stellar_teff_k"),
        F.col("st_rad").alias("stellar_radius_solar"),
        F.col("st_mass").alias("stellar_mass_solar"),
        F.col("sy_dist").alias("distance_pc"),
        is_temperate(F.col("pl_eqt")).alias("is_habitable_zone"),
    )


# -- filters and projections ---------------------------------------------------

def conjunctive_filter(df: DataFrame, *, discovery_method=None, hostname=None,
                       year_min=None, year_max=None, mass_min=None, mass_max=None,
                       radius_min=None, radius_max=None) -> DataFrame:
    """AND of the given bounds; nulls never satisfy a bound."""
    tests = [
        (discovery_method, lambda v: F.col("discovery_method") == v),
        (hostname, lambda v: F.col("hostname") == v),
        (year_min, lambda v: F.col("disc_year") >= v),
        (year_max, lambda v: F.col("disc_year") <= v),
        (mass_min, lambda v: F.col("pl_bmasse") >= v),
        (mass_max, lambda v: F.col("pl_bmasse") <= v),
        (radius_min, lambda v: F.col("pl_rade") >= v),
        (radius_max, lambda v: F.col("pl_rade") <= v),
    ]
    clauses = [test(value) for value, test in tests if value is not None]
    return df.filter(reduce(lambda a, b: a & b, clauses)) if clauses else df


def search(df: DataFrame, term: str) -> DataFrame:
    """Case-insensitive substring over name, host or method; % and _ act as wildcards."""
    if not term:
        raise ValueError("search term must not be empty")
    pattern = F.lit(f"%{term}%")
    return df.filter(F.ilike("pl_name", pattern) | F.ilike("hostname", pattern)
                     | F.ilike("discovery_method", pattern))


#: Rows that a page may keep as a top-k of each task; further on, pages are found by partition counts.
DEEP_PAGE = 10_000


def order_nulls(column: str, descending: bool = False) -> Column:
    """Nulls last when ascending, first when descending."""
    c = F.col(column)
    return c.desc_nulls_first() if descending else c.asc_nulls_last()


def page(df: DataFrame, sort_by: str = "pl_name", sort_order: str = "asc",
         offset: int = 0, limit: int = 20, tie: str = "pl_name") -> DataFrame:
    """One page in a total order: the sort column, then the key."""
    if sort_by not in SORTABLE:
        raise ValueError(f"sort_by must be one of {sorted(SORTABLE)}")
    if sort_order not in ("asc", "desc"):
        raise ValueError("sort_order must be asc or desc")
    if offset < 0 or not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"offset must be >= 0 and limit between 1 and {MAX_PAGE}")
    order = [order_nulls(sort_by, sort_order == "desc")]
    if tie != sort_by:
        order.append(F.col(tie).asc_nulls_last())
    if offset + limit > DEEP_PAGE:
        return slice_of(df.orderBy(*order), offset, limit)
    return df.orderBy(*order).offset(offset).limit(limit)


def search_page(df: DataFrame, term: str, offset: int = 0, limit: int = 20) -> DataFrame:
    return page(search(df, term), "pl_name", "asc", offset, limit)


def point_lookup(df: DataFrame, name: str) -> DataFrame:
    """The row of one exact name as JSON without its null fields; no row means not found."""
    hit = df.filter(F.col("pl_name") == name)
    return hit.select("pl_name", F.to_json(F.struct(*df.columns)).alias("record"))


def method_table(df: DataFrame, methods: list[str] | None = None) -> DataFrame:
    """Display columns, numbers to two decimals, rows of the wanted methods (none given: all)."""
    rows = df.filter(F.col("discovery_method").isin(methods)) if methods else df
    doubles = {n for n, t in df.dtypes if t in ("double", "float")}
    return rows.select(*[F.round(c, 2).alias(c) if c in doubles else F.col(c)
                         for c in DISPLAY_COLUMNS])


def display_table(df: DataFrame) -> DataFrame:
    """The 13 columns in name order under their display names."""
    return (df.select(*DISPLAY_NAMES).orderBy(F.col("pl_name").asc_nulls_last())
            .withColumnsRenamed(DISPLAY_NAMES))


def mass_radius(df: DataFrame) -> DataFrame:
    """Rows with mass and radius in log axes, and the regime against the reference lines."""
    m, r = F.col("pl_bmasse"), F.col("pl_rade")
    regime = (
        F.when((m <= EARTH_LINE[0]) & (r <= EARTH_LINE[1]), "earth-like")
        .when((m >= JUPITER_LINE[0]) & (r >= JUPITER_LINE[1]), "jupiter-like")
        .otherwise("between")
    )
    return df.dropna(subset=["pl_bmasse", "pl_rade"]).select(
        "pl_name", "discovery_method", "pl_bmasse", "pl_rade",
        F.log10(F.when(m > 0, m)).alias("log_mass"),
        F.log10(F.when(r > 0, r)).alias("log_radius"),
        regime.alias("regime"),
    )


def sky_map(df: DataFrame) -> DataFrame:
    """Rows with a position; right ascension centred on zero."""
    ra = F.col("ra")
    return df.dropna(subset=["ra", "dec"]).select(
        "pl_name", "discovery_method", "ra", "dec",
        F.when(ra > 180, ra - 360).otherwise(ra).alias("ra_shifted"),
    )


# -- aggregates ------------------------------------------------------------------

def total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_count"))


def count_by(df: DataFrame, column: str, as_name: str) -> DataFrame:
    return df.groupBy(F.col(column).alias(as_name)).agg(F.count(F.lit(1)).alias("count"))


def by_method(df: DataFrame, column: str = "discovery_method") -> DataFrame:
    """Count per method, most frequent first, names break ties."""
    return count_by(df, column, "method").orderBy(F.desc("count"), F.asc_nulls_last("method"))


def by_year(df: DataFrame, column: str = "disc_year") -> DataFrame:
    return count_by(df.filter(F.col(column).isNotNull()), column, "year").orderBy("year")


def summary_columns(parameters=PARAMETERS) -> list[Column]:
    out = []
    for p in parameters:
        c = F.col(p).cast("double")
        out.append(F.struct(
            F.lit(p).alias("parameter"),
            F.round(F.min(c), 4).alias("min_val"),
            F.round(F.max(c), 4).alias("max_val"),
            F.round(F.avg(c), 4).alias("mean_val"),
        ))
    return out


def distributions(df: DataFrame, parameters=PARAMETERS) -> DataFrame:
    """min / max / mean of every parameter in one pass, one row per parameter."""
    return df.agg(F.array(*summary_columns(parameters)).alias("p")).select(F.inline("p"))


def kpis(df: DataFrame) -> DataFrame:
    low, high = F.min("disc_year"), F.max("disc_year")
    span = F.concat(low.cast("string"), F.lit("–"), high.cast("string"))
    return df.agg(
        F.count(F.lit(1)).alias("total_planets"),
        F.countDistinct("discovery_method").alias("discovery_methods"),
        F.countDistinct("hostname").alias("host_stars"),
        F.coalesce(span, F.lit("N/A")).alias("year_range"),
    )


def source_query(df: DataFrame, limit: int | None = None,
                 default_flag: str = "default_flag") -> DataFrame:
    """Default rows of the source table with the raw columns; a limit takes the first names."""
    from skyops.schemas import RAW_COLUMNS

    rows = df.filter(F.col(default_flag) == 1).select(*RAW_COLUMNS)
    if limit is not None and limit > 0:
        rows = rows.orderBy(F.col("pl_name").asc_nulls_last()).limit(limit)
    return rows
