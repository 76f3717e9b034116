"""Image files (FITS) to header rows and pixel strips.

Spark lists the files and spreads them over tasks. A header is read block by block, skipping the
data of the units, and pixels are read strip by strip at their byte offsets, so that neither needs a
file in memory; a file larger than a task's memory is many strips. Compressed files can only be read
from their start: their headers stream, and their pixels are decompressed whole, a strip at a time.
Unreadable files become rows with an error.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Recognised suffixes, any case, each also with .gz.
SUFFIXES = (".fits", ".fit", ".fts")
_NAME = r"(?i)\.(fits|fit|fts)(\.gz)?$"
_BLOCK = 2880
_DTYPES = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}

HEADERS = "path string, filename string, cards map<string,string>, extensions int, error string"
TILE_ROWS = ("path string, filename string, height int, width int, y0 int, x0 int, h int, w int, "
             "px array<double>, error string")


def _card_value(text: str) -> str | None:
    """The value part of a card as text: strings unquoted, T/F as true/false."""
    text = text.strip()
    if text.startswith("'"):
        end, out = 1, []
        while end < len(text):
            if text[end] == "'":
                if text[end + 1:end + 2] == "'":
                    out.append("'")
                    end += 2
                    continue
                break
            out.append(text[end])
            end += 1
        return "".join(out).rstrip()
    value = text.split("/", 1)[0].strip()
    if value in ("T", "F"):
        return "true" if value == "T" else "false"
    return value or None


def _header(file, start: int) -> tuple[dict[str, str], int]:
    """Cards of the header at ``start`` of a file and the offset of the block after it."""
    cards, at = {}, start
    file.seek(start)
    while True:
        block = file.read(_BLOCK)
        if len(block) < _BLOCK:
            raise ValueError("truncated header")
        at += _BLOCK
        for i in range(0, _BLOCK, 80):
            card = block[i:i + 80].decode("ascii", "replace")
            key = card[:8].strip()
            if key == "END":
                return cards, at
            if card[8:10] == "= ":
                value = _card_value(card[10:])
                if value is not None:
                    cards.setdefault(key, value)
            elif key in ("HISTORY", "COMMENT"):
                cards[key] = (cards[key] + "\n" if key in cards else "") + card[8:].strip()


def _units(file, size: int | None = None) -> Iterator[tuple[dict, int, tuple]]:
    """(cards, data offset, shape slowest axis first) of every header-data unit; data is skipped, not read.

    Without a known size a missing block is the end.
    """
    at, n = 0, 0
    while size is None or at + _BLOCK <= size:
        if size is None and n:
            file.seek(at)
            if not file.read(1):
                return
        cards, at = _header(file, at)
        if n == 0 and "SIMPLE" not in cards:
            raise ValueError("no SIMPLE card")
        axes = [int(cards[f"NAXIS{i + 1}"]) for i in range(int(cards.get("NAXIS", "0")))]
        shape = tuple(reversed(axes)) if cards.get("XTENSION", "IMAGE") == "IMAGE" else ()
        yield cards, at, shape
        length = abs(int(cards.get("BITPIX", "8"))) // 8 * int(cards.get("GCOUNT", "1")) * (
            (int(np.prod(axes)) if axes else 0) + int(cards.get("PCOUNT", "0")))
        at += -(-length // _BLOCK) * _BLOCK
        n += 1


def _open(path: str):
    """The file of a URI for reading at offsets, and its size; compressed files stream and have none."""
    local = path.startswith(("file:", "/"))
    files, at = (fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")) if local else fs.FileSystem.from_uri(path)
    if path.lower().endswith(".gz"):
        return gzip.open(files.open_input_file(at)), None
    return files.open_input_file(at), files.get_file_info(at).size


def _image_unit(units) -> tuple[dict, int, tuple[int, int]]:
    """The first unit with image data (the primary one if it has any): cards, offset, and the shape without axes of length 1."""
    for n, (cards, at, shape) in enumerate(units):
        if not shape or 0 in shape or (n > 0 and len(shape) < 2):
            continue
        flat = tuple(k for k in shape if k != 1)
        if len(flat) != 2:
            raise ValueError(f"image has {len(flat)} dimensions after squeezing; expected 2")
        return cards, at, flat
    raise ValueError("no image data found")


def _values(raw: np.ndarray, cards: dict) -> np.ndarray:
    """Stored numbers as floats: scaled, with non-finite and blank values as NaN."""
    image = raw.astype(np.float64)
    if "BLANK" in cards and raw.dtype.kind != "f":
        image[raw == int(cards["BLANK"])] = np.nan
    image = image * float(cards.get("BSCALE", "1")) + float(cards.get("BZERO", "0"))
    image[~np.isfinite(image)] = np.nan
    return image


def read_rows(file, cards: dict, at: int, shape: tuple[int, int], first: int, count: int) -> np.ndarray:
    """Image rows ``first`` up to ``first + count`` of the unit whose data begin at ``at``."""
    dtype = np.dtype(_DTYPES[int(cards["BITPIX"])])
    length = count * shape[1] * dtype.itemsize
    file.seek(at + first * shape[1] * dtype.itemsize)
    data = file.read(length)
    if len(data) < length:
        raise ValueError("truncated data")
    return _values(np.frombuffer(data, dtype).reshape(count, shape[1]), cards)


def decode_image(data: bytes) -> np.ndarray:
    """The image of a file's bytes as a 2-D float array."""
    file = io.BytesIO(data)
    cards, at, shape = _image_unit(_units(file, len(data)))
    return read_rows(file, cards, at, shape, 0, shape[0])


# -- Spark side ---------------------------------------------------------------------------------

def list_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """The paths of the image files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    return files.select("path").filter(F.col("path").rlike(_NAME))


def _each(paths: DataFrame, one, schema: str) -> DataFrame:
    """Rows of ``one(row)`` for each row; an exception becomes a row of nulls with its text."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                name = row.path.rsplit("/", 1)[-1]
                try:
                    rows = [(row.path, name, *r, None) for r in one(row)]
                except Exception as e:
                    rows = [(row.path, name, *[None] * (len(names) - 3), f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(rows, columns=names)

    return paths.mapInPandas(run, schema)


def read_headers(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Primary header cards and number of units of each file below a folder."""

    def one(row):
        file, size = _open(row.path)
        with file:
            units = [cards for cards, _, _ in _units(file, size)]
        return [(units[0], len(units))]

    return _each(list_files(spark, path, recursive), one, HEADERS)


_PLANS = "path string, filename string, height int, width int, offset bigint, step int, cards map<string,string>, error string"


def read_tiles(spark: SparkSession, path: str, recursive: bool = True, tile: int = 256) -> DataFrame:
    """Pixels of each file below a folder in tiles of at most ``tile`` x ``tile``.

    Headers say where the pixels are; then every ``tile`` image rows are a row of their own, which a task reads at
    its offset. The rows of a compressed file stay together, since it is read from its start.
    """
    keep = ("BITPIX", "BLANK", "BSCALE", "BZERO")

    def plan(row):
        file, size = _open(row.path)
        with file:
            cards, at, (height, width) = _image_unit(_units(file, size))
        if size is not None and at + height * width * np.dtype(_DTYPES[int(cards["BITPIX"])]).itemsize > size:
            raise ValueError("truncated data")
        return [(height, width, at, tile if size is not None else height, {k: cards[k] for k in keep if k in cards})]

    def strip(row):
        file, _ = _open(row.path)
        cards, shape, out = dict(row.cards), (int(row.height), int(row.width)), []
        with file:
            for y in range(int(row.y0), int(row.y0 + row.h), tile):
                rows = read_rows(file, cards, int(row.offset), shape, y, min(tile, int(row.y0 + row.h) - y))
                out += [(*shape, y, x, *part.shape, part.ravel()) for x in range(0, shape[1], tile) for part in [rows[:, x : x + tile]]]
        return out

    plans = _each(list_files(spark, path, recursive), plan, _PLANS)
    good = plans.filter(F.col("error").isNull()).withColumn("y0", F.explode(F.sequence(F.lit(0), F.col("height") - 1, F.col("step"))))
    dealt = good.select("path", "height", "width", "offset", "cards", "y0", F.least("step", F.col("height") - F.col("y0")).alias("h"))
    tiles = _each(dealt.repartition("path", "y0"), strip, TILE_ROWS)
    none = [F.lit(None).cast(c.split(" ", 1)[1]).alias(c.split()[0]) for c in TILE_ROWS.split(", ")[2:-1]]
    bad = plans.filter(F.col("error").isNotNull()).select("path", "filename", *none, "error")
    clean = F.transform("px", lambda v: F.when(~F.isnan(v), v))
    return tiles.withColumn("px", clean).unionByName(bad)


def split_bad(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable rows, rows of files that could not be read)."""
    return rows.filter(F.col("error").isNull()).drop("error"), rows.filter(
        F.col("error").isNotNull()).select("path", "filename", "error")
