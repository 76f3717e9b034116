"""Position tables: cone joins and header catalogs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyops.functions import sky
from skyops.session import cut_and_total, cut_lineage

# Header keywords of an observation, in order, and the catalog entry fields.
OBSERVATION_KEYWORDS = ("OBJECT", "RA", "DEC", "FILTER", "EXPTIME", "DATE-OBS", "INSTRUME",
                        "TELESCOP", "OBSERVER", "AIRMASS", "GAIN", "RDNOISE", "IMAGETYP", "BUNIT")
CATALOG_FIELDS = ("filename", "object", "ra_deg", "dec_deg", "filter", "exptime", "instrument",
                  "telescope", "date_obs", "imagetyp", "naxis1", "naxis2", "airmass", "fov_arcmin")
#: Rows of either side that meet in a piece of a cell; pairs to compare, and rows to read, of a task.
SIDE, PAIRS, ROWS = 1000, 10_000_000, 1_000_000


def cone_join(positions: DataFrame, fields: DataFrame, radius_deg: float,
              ra: str = "ra", dec: str = "dec", center_ra: str = "center_ra",
              center_dec: str = "center_dec") -> DataFrame:
    """All (position, field) pairs within ``radius_deg``, with ``separation_arcmin``.

    The sky is cut into declination bands one radius high and, within a band, into right
    ascension cells at least one radius wide at its widest point. A field is copied to the cells
    its cone can touch (three bands, a few cells each; all cells of a band only next to a pole),
    which makes the join an equi join on the cell; the exact separation then decides. Copied rows
    are the fields, the side that should be smaller. Tasks are as many as the pairs to compare ask for,
    since these grow faster than the bytes by which Spark counts tasks (``_in_pieces``).
    """
    r = float(radius_deg)
    band_height = max(r, 1e-6)
    last_band = int(math.ceil(180.0 / band_height)) - 1

    def band_of(d: Column) -> Column:
        return F.least(F.floor((d + 90.0) / band_height).cast("long"), F.lit(last_band))

    def cells_in(band: Column) -> Column:
        """Cells of a band: 360 / width, where width is a radius at the band's lowest |dec|."""
        low = band * band_height - 90.0
        flattest = F.when((low <= 0) & (low + band_height >= 0), F.lit(0.0)).otherwise(
            F.least(F.abs(low), F.abs(low + band_height)))
        return F.greatest(F.floor(360.0 * F.cos(F.radians(flattest)) / band_height), F.lit(1)) \
            .cast("long")

    def cell_of(a: Column, n: Column) -> Column:
        return F.least(F.floor(F.pmod(a, F.lit(360.0)) / 360.0 * n).cast("long"), n - 1)

    p = (positions.filter(F.col(ra).isNotNull() & F.col(dec).isNotNull())
         .withColumn("_band", band_of(F.col(dec)))
         .withColumn("_cell", cell_of(F.col(ra), cells_in(F.col("_band")))))
    band = band_of(F.col(center_dec))
    f = (fields.filter(F.col(center_ra).isNotNull() & F.col(center_dec).isNotNull())
         .withColumn("_band", F.explode(F.sequence(F.greatest(band - 1, F.lit(0)),
                                                   F.least(band + 1, F.lit(last_band)))))
         .withColumn("_n", cells_in(F.col("_band"))))
    # half-width in right ascension of a cone: asin(sin r / cos dec), everything at a pole
    ratio = math.sin(math.radians(min(r, 90.0))) / F.cos(F.radians(center_dec))
    near_pole = (F.abs(center_dec) + r >= 90.0) | (ratio >= 1.0)
    half = F.when(~near_pole, F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) + 1e-9)
    width = F.lit(360.0) / F.col("_n")
    first = F.floor((F.col(center_ra) - half) / width).cast("long")
    last = F.floor((F.col(center_ra) + half) / width).cast("long")
    whole = near_pole | (last - first + 1 >= F.col("_n"))
    cells = F.when(whole, F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).otherwise(
        F.transform(F.sequence(first, last), lambda i: F.pmod(i, F.col("_n"))))
    f = f.withColumn("_cell", F.explode(cells)).drop("_n")
    p, f = _in_pieces(p, f)
    sep = sky.separation(F.col(center_ra), F.col(center_dec), F.col(ra), F.col(dec))
    return (p.join(f, _PIECE).withColumn("separation_arcmin", sep)
            .filter(F.col("separation_arcmin") <= r * 60.0).drop(*_PIECE))


_PIECE = ["_band", "_cell", "_across", "_down"]


def _in_pieces(p: DataFrame, f: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt to tasks by cell and piece: a crowded cell is cut into ``across`` x ``down`` pieces.

    A position is in one column of pieces and a field in one row, so each pair meets once, and a piece
    compares about ``SIDE`` x ``SIDE`` pairs however crowded its cell is. Only crowded cells are written.
    """
    cell = ["_band", "_cell"]
    pieces = [F.greatest(F.ceil(F.col(n) / SIDE), F.lit(1)).cast("long").alias(a) for n, a in (("_np", "_nx"), ("_nf", "_ny"))]
    sizes = p.groupBy(cell).agg(F.count(F.lit(1)).alias("_np")).join(f.groupBy(cell).agg(F.count(F.lit(1)).alias("_nf")), cell)
    work = F.col("_np").cast("double") * F.col("_nf") / PAIRS + (F.col("_np") + F.col("_nf")) / ROWS
    crowded, tasks = cut_and_total(sizes, work, F.col("_np") * F.col("_nf") > SIDE * SIDE)
    crowded = crowded.select(*cell, *pieces)
    tasks = max(1, math.ceil(tasks))

    def dealt(rows: DataFrame, own: str, mine: str, other: str, others: str) -> DataFrame:
        plain = [c.name for c in rows.schema if not any(t in c.dataType.simpleString() for t in ("map<", "variant"))]
        at = F.pmod(F.xxhash64(*[F.col(f"`{n}`") for n in plain]), F.coalesce(F.col(mine), F.lit(1).cast("long")))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(others), F.lit(1).cast("long")) - 1))
        return (rows.join(crowded, cell, "left").withColumn(own, at).withColumn(other, every).drop("_nx", "_ny")
                .repartition(tasks, *_PIECE))

    return dealt(p, "_across", "_nx", "_down", "_ny"), dealt(f, "_down", "_ny", "_across", "_nx")


# -- headers ---------------------------------------------------------------------------------

def observation_keys(cards: Column, all_keywords: bool = False) -> Column:
    """The observation keywords that are present, or every keyword."""
    if all_keywords:
        return cards
    return F.map_filter(cards, lambda k, v: k.isin(*OBSERVATION_KEYWORDS) & v.isNotNull())


def _number(cards: Column, key: str) -> Column:
    return F.try_element_at(cards, F.lit(key)).try_cast("double")


def header_columns(headers: DataFrame, cards: str = "cards") -> DataFrame:
    """Add the WCS columns the sky functions read."""
    c = F.col(cards)
    numbers = {"crpix1": "CRPIX1", "crpix2": "CRPIX2", "crval1": "CRVAL1", "crval2": "CRVAL2",
               "cd11": "CD1_1", "cd12": "CD1_2", "cd21": "CD2_1", "cd22": "CD2_2",
               "cdelt1": "CDELT1", "cdelt2": "CDELT2", "crota2": "CROTA2"}
    out = {n: _number(c, k) for n, k in numbers.items()}
    out |= {n: F.try_element_at(c, F.lit(k))
            for n, k in (("ctype1", "CTYPE1"), ("ctype2", "CTYPE2"))}
    out |= {n: F.try_element_at(c, F.lit(k)).try_cast("int")
            for n, k in (("naxis1", "NAXIS1"), ("naxis2", "NAXIS2"))}
    return headers.withColumns(out)


def catalog_entries(headers: DataFrame, filename: str = "filename",
                    cards: str = "cards") -> DataFrame:
    """The 14 catalog fields; positions fall back to the WCS reference point."""
    rows = header_columns(headers, cards)
    c = F.col(cards)
    text = lambda k: F.try_element_at(c, F.lit(k))
    fov = sky.field_geometry()["fov_arcmin"]
    return rows.select(
        F.col(filename).alias("filename"), text("OBJECT").alias("object"),
        F.coalesce(_number(c, "RA"), F.col("crval1")).alias("ra_deg"),
        F.coalesce(_number(c, "DEC"), F.col("crval2")).alias("dec_deg"),
        text("FILTER").alias("filter"), _number(c, "EXPTIME").alias("exptime"),
        text("INSTRUME").alias("instrument"), text("TELESCOP").alias("telescope"),
        text("DATE-OBS").alias("date_obs"), text("IMAGETYP").alias("imagetyp"),
        "naxis1", "naxis2", _number(c, "AIRMASS").alias("airmass"),
        F.when(fov.isNotNull(), F.format_string("%.1fx%.1f", fov["width"], fov["height"]))
        .alias("fov_arcmin"))


def sort_by_date(entries: DataFrame) -> DataFrame:
    """Observation order; a missing date sorts as the empty text, file names break ties."""
    return entries.orderBy(F.coalesce("date_obs", F.lit("")), "filename")


def with_position(ordered: DataFrame) -> DataFrame:
    """Add the 1-based place of each row of a sorted table, counted by partition: no task sees all rows."""
    rows = cut_lineage(ordered.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))  # a row for each partition
    within = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("_part", part).join(starts, "_part").withColumn(
        "position", F.col("_start") + within + 1).drop("_id", "_part", "_start")


def write_catalog(entries: DataFrame, path: str, fmt: str = "csv") -> None:
    """The sorted catalog as CSV with header or as JSON lines with null keys kept."""
    rows = sort_by_date(entries.select(*CATALOG_FIELDS))
    if fmt == "csv":
        rows.write.option("header", True).mode("overwrite").csv(path)
    elif fmt == "json":
        rows.write.option("ignoreNullFields", False).mode("overwrite").json(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
