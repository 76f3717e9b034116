"""Image, stacking and sky-coordinate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyops.functions import sky as fn
from skyops.operators import images, sky
from skyops.plans.reduce import reduce_and_stack
from skyops.registry import query
from skyops.registry.bindings import QUERY_SQL, query_catalog, table
from skyops.session import cut_lineage, scratch_dir
from skyops.sources import images as source

# -- input: embeddings as 8 x 8 frames -------------------------------------------------------------
# A tenth of the frames are bias, dark and flat each; every fourth frame misses its last row, some
# pixels are bad, and one light frame in nine holds a spike.

_KIND = ("CASE vec_id % 10 WHEN 0 THEN 'bias' WHEN 1 THEN 'dark' WHEN 2 THEN 'flat' "
         "ELSE 'light' END")
_BASE = "CASE vec_id % 10 WHEN 0 THEN 200 WHEN 1 THEN 260 WHEN 2 THEN 8200 ELSE 1200 END"
_ROWS = "CASE WHEN vec_id % 10 > 2 AND vec_id % 4 = 3 THEN 7 ELSE 8 END"
_EXP = "CAST(CASE WHEN vec_id % 10 = 1 THEN 60 WHEN vec_id % 2 = 0 THEN 120 ELSE 60 END AS DOUBLE)"


def frames(spark, sf):
    e = table(spark, sf, "embeddings")
    value = ("transform(embedding, (x, i) -> CASE WHEN (vec_id + i) % 37 = 0 THEN NULL "
             "WHEN vec_id % 10 = 2 AND (i = 5 OR i = 40) THEN 300D "
             "WHEN vec_id % 9 = 4 AND i = vec_id % 64 THEN 65000D "
             f"ELSE CAST(round(CAST(x AS DOUBLE) * 1000, 0) + {_BASE} AS DOUBLE) END)")
    return e.selectExpr(
        "vec_id AS frame_id", f"{_KIND} AS imagetyp", "label AS field", f"{_EXP} AS exptime",
        "0 AS y0", "0 AS x0", f"{_ROWS} AS h", "8 AS w",
        f"slice({value}, 1, 8 * {_ROWS}) AS px")


def pixels(spark, sf, kind=None):
    f = frames(spark, sf)
    if kind:
        f = f.filter(F.col("imagetyp") == kind)
    return images.to_pixels(f, ("frame_id", "imagetyp", "field", "exptime"))


_PX = f"""px AS (SELECT frame_id, imagetyp, field, exptime, i // 8 AS y, i % 8 AS x, h,
  CASE WHEN (frame_id + i) % 37 = 0 THEN NULL
    WHEN frame_id % 10 = 2 AND (i = 5 OR i = 40) THEN 300
    WHEN frame_id % 9 = 4 AND i = frame_id % 64 THEN 65000
    ELSE round(CAST(val AS DOUBLE) * 1000, 0) + base END AS v
  FROM (SELECT vec_id AS frame_id, {_KIND} AS imagetyp, label AS field, {_EXP} AS exptime,
    {_BASE} AS base, {_ROWS} AS h, unnest(embedding) AS val,
    unnest(range(len(embedding))) AS i FROM embeddings) WHERE i < 8 * h)"""
_BIAS = "bias AS (SELECT y, x, median(v) AS v FROM px WHERE imagetyp = 'bias' GROUP BY 1, 2)"
_DARK = """dark AS (SELECT p.y, p.x, median(p.v - b.v) AS v FROM px p JOIN bias b
  ON p.y = b.y AND p.x = b.x WHERE imagetyp = 'dark' GROUP BY 1, 2)"""
_FLAT = """flat0 AS (SELECT p.y, p.x, median(p.v - b.v - d.v) AS v FROM px p
  JOIN bias b ON p.y = b.y AND p.x = b.x JOIN dark d ON p.y = d.y AND p.x = d.x
  WHERE imagetyp = 'flat' GROUP BY 1, 2),
flat AS (SELECT y, x, CASE WHEN m <= 0 THEN 1 WHEN v / m >= 0.1 THEN v / m END AS v
  FROM flat0, (SELECT median(v) AS m FROM flat0))"""
_CAL = f"""{_PX}, {_BIAS}, {_DARK}, {_FLAT},
cal AS (SELECT frame_id, field, p.y, p.x, p.h,
  (p.v - b.v - d.v * (exptime / 60)) / f.v AS v FROM px p
  JOIN bias b ON p.y = b.y AND p.x = b.x JOIN dark d ON p.y = d.y AND p.x = d.x
  JOIN flat f ON p.y = f.y AND p.x = f.x WHERE imagetyp = 'light')"""
_DARK_EXP = 60.0


def _depth(spark, sf):
    """Frames of the kind with the most: none of their masters combines more."""
    return images.stack_depth(frames(spark, sf), ["imagetyp"])


def _masters(spark, sf):
    depth = _depth(spark, sf)
    bias = cut_lineage(images.master_bias(pixels(spark, sf, "bias"), depth))
    dark = cut_lineage(images.master_dark(pixels(spark, sf, "dark"), bias, depth))
    flat = cut_lineage(images.master_flat(pixels(spark, sf, "flat"), bias, dark, depth))
    return bias, dark, flat


def _rounded(df, *columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


@query("agg_image_stats", f"""WITH {_PX} SELECT frame_id, min(v) AS min_adu, max(v) AS max_adu,
  round(avg(v), 6) AS mean_adu, round(median(v), 6) AS median_adu,
  round(stddev_pop(v), 6) AS std_adu,
  round(count(*) FILTER (v IS NULL) / count(*), 6) AS nan_fraction FROM px GROUP BY 1""")
def _(spark, sf):
    stats = images.image_stats(pixels(spark, sf))
    return _rounded(stats, "mean_adu", "median_adu", "std_adu", "nan_fraction")


@query("agg_master_bias", f"WITH {_PX}, {_BIAS} SELECT CAST(y AS INTEGER) AS y, "
       "CAST(x AS INTEGER) AS x, v FROM bias")
def _(spark, sf):
    return images.master_bias(pixels(spark, sf, "bias"), _depth(spark, sf))


@query("agg_master_cards", f"""SELECT imagetyp, count(*) AS ncombine, 'median' AS combine, CAST(max(h) AS INTEGER) AS naxis2,
  8 AS naxis1, max(exptime) AS exptime FROM (SELECT {_KIND} AS imagetyp, {_ROWS} AS h, {_EXP} AS exptime FROM embeddings)
WHERE imagetyp <> 'light' GROUP BY 1""")
def _(spark, sf):
    """NCOMBINE, method, shape and exposure of each master frame."""
    return images.master_cards(frames(spark, sf).where("imagetyp <> 'light'"))


@query("agg_master_dark", f"WITH {_PX}, {_BIAS}, {_DARK} SELECT CAST(y AS INTEGER) AS y, "
       "CAST(x AS INTEGER) AS x, v FROM dark")
def _(spark, sf):
    return _masters(spark, sf)[1]


@query("agg_master_flat", f"WITH {_PX}, {_BIAS}, {_DARK}, {_FLAT} SELECT CAST(y AS INTEGER) AS y, "
       "CAST(x AS INTEGER) AS x, round(v, 9) AS v FROM flat")
def _(spark, sf):
    return _rounded(_masters(spark, sf)[2], "v", places=9)


@query("agg_flat_norm", f"""WITH {_PX}, m AS (SELECT frame_id, median(v) AS m FROM px
  WHERE imagetyp = 'flat' GROUP BY 1)
SELECT frame_id, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x,
  round(CASE WHEN m <= 0 THEN 1 WHEN v / m >= 0.1 THEN v / m END, 9) AS v
FROM px JOIN m USING (frame_id) WHERE imagetyp = 'flat'""")
def _(spark, sf):
    rows = pixels(spark, sf, "flat").select("frame_id", "y", "x", "v")
    return _rounded(images.normalize_flat(rows, ("frame_id",)), "v", places=9)


@query("join_calibrate", f"""WITH {_CAL} SELECT frame_id, CAST(y AS INTEGER) AS y,
  CAST(x AS INTEGER) AS x, round(v, 6) AS v FROM cal""")
def _(spark, sf):
    bias, dark, flat = _masters(spark, sf)
    out = images.calibrate(pixels(spark, sf, "light"), bias, dark, flat, _DARK_EXP,
                           normalized=True)
    return _rounded(out.select("frame_id", "y", "x", "v"), "v")


@query("join_calibrate_tiles", f"""WITH {_CAL} SELECT frame_id, CAST(y AS INTEGER) AS y,
  CAST(x AS INTEGER) AS x, round(v, 6) AS v FROM cal""")
def _(spark, sf):
    bias, dark, flat = (images.tiles_of_rows(m) for m in _masters(spark, sf))
    light = images.row_tiles(frames(spark, sf).filter(F.col("imagetyp") == "light"), ("frame_id", "exptime"))
    out = images.calibrate_tiles(light, bias, dark, flat, _DARK_EXP)
    return _rounded(images.to_pixels(out), "v")


@query("join_shape_check", f"""WITH {_PX} SELECT frame_id, CAST(max(y) + 1 AS INTEGER) AS height,
  CAST(max(x) + 1 AS INTEGER) AS width FROM px GROUP BY 1 HAVING max(y) <> 7 OR max(x) <> 7""")
def _(spark, sf):
    return images.shape_mismatch(images.shapes(frames(spark, sf), ["frame_id"]), 8, 8)


_CROP = """al AS (SELECT p.frame_id, p.field, p.y - (p.h - m.h) // 2 AS y, p.x, p.v
  FROM {src} p JOIN (SELECT field, min(h) AS h FROM {src} GROUP BY 1) m ON p.field = m.field
  WHERE p.y - (p.h - m.h) // 2 >= 0 AND p.y - (p.h - m.h) // 2 < m.h)"""
_LIGHT = f"{_PX}, l AS (SELECT * FROM px WHERE imagetyp = 'light'), {_CROP.format(src='l')}"


def _aligned(spark, sf):
    f = frames(spark, sf).filter(F.col("imagetyp") == "light")
    rows = images.to_pixels(f, ("frame_id", "field"))
    return images.align_crop(rows, images.shapes(f, ["field", "frame_id"]), ["field"]), f


@query("agg_align_crop", f"""WITH {_LIGHT} SELECT frame_id, field, CAST(y AS INTEGER) AS y,
  CAST(x AS INTEGER) AS x, v FROM al""")
def _(spark, sf):
    return _aligned(spark, sf)[0].select("frame_id", "field", "y", "x", "v")


_YX = "field, CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x"


@query("agg_stack_median", f"WITH {_LIGHT} SELECT {_YX}, round(median(v), 6) AS v FROM al "
       "GROUP BY field, y, x")
def _(spark, sf):
    rows, f = _aligned(spark, sf)
    return _rounded(images.stack_median(rows, ["field"], images.stack_depth(f, ["field"])), "v")


@query("agg_stack_mean", f"WITH {_LIGHT} SELECT {_YX}, round(avg(v), 6) AS v FROM al "
       "GROUP BY field, y, x")
def _(spark, sf):
    return _rounded(images.stack_mean(_aligned(spark, sf)[0], ["field"]), "v")


def _clip_sql():
    out = ["k0 AS (SELECT field, y, x, v, true AS used FROM al)"]
    for i in range(1, 6):
        out.append(f"""s{i} AS (SELECT field, y, x, median(v) FILTER (used) AS m,
  stddev_pop(v) FILTER (used) AS s FROM k{i - 1} GROUP BY 1, 2, 3),
k{i} AS (SELECT a.field, a.y, a.x, v, coalesce((v - m) / (CASE WHEN s = 0 THEN 1 ELSE s END)
  BETWEEN -3 AND 3, true) AS used FROM k{i - 1} a JOIN s{i} s ON a.field = s.field AND a.y = s.y AND a.x = s.x)""")
    return ", ".join(out)


_CLIP = (f"WITH {_LIGHT}, {_clip_sql()} SELECT {_YX}, round(avg(v) FILTER (used), 6) AS v FROM k5 "
         "GROUP BY field, y, x")


@query("agg_stack_sigma_clip", _CLIP)
def _(spark, sf):
    rows, f = _aligned(spark, sf)
    return _rounded(images.stack_sigma_clip(rows, ["field"], depth=images.stack_depth(f, ["field"])), "v")


@query("agg_stack_sigma_clip_deep", _CLIP)
def _(spark, sf):
    """The path of stacks deeper than an array can hold: windows over pixel rows."""
    return _rounded(images.stack_sigma_clip(_aligned(spark, sf)[0], ["field"]), "v")


@query("agg_stack_sigma_clip_tiles", _CLIP)
def _(spark, sf):
    f = frames(spark, sf).filter(F.col("imagetyp") == "light")
    tiles = images.align_crop_tiles(f, ["field"])
    return _rounded(images.stack_tiles(tiles, ["field"], "sigma_clip", depth=images.stack_depth(f, ["field"])), "v")


_TRIMMED = "CASE WHEN count(v) > 2 THEN (sum(v) - min(v) - max(v)) / (count(v) - 2) ELSE avg(v) END"


def trimmed_mean(values):
    """A combine function of a user: each pixel's mean without its least and greatest value."""
    import numpy as np

    n = np.isfinite(values).sum(axis=0)
    total = np.nansum(values, axis=0)
    ends = np.where(n > 2, np.nanmin(values, axis=0, initial=np.inf) + np.nanmax(values, axis=0, initial=-np.inf), 0.0)
    return np.where(n > 0, total - ends, np.nan) / np.maximum(np.where(n > 2, n - 2, n), 1)


@query("udaf_combine", f"WITH {_LIGHT}, {_clip_sql()} " + " UNION ALL ".join(
    f"SELECT '{m}' AS method, {_YX}, round({e}, 6) AS v FROM k5 GROUP BY field, y, x"
    for m, e in (("median", "median(v)"), ("mean", "avg(v)"), ("sigma_clip", "avg(v) FILTER (used)"), ("trimmed", _TRIMMED))))
def _(spark, sf):
    """The named methods and a user's function, over the frames aligned once."""
    f = frames(spark, sf).filter(F.col("imagetyp") == "light")
    tiles = cut_lineage(images.align_crop_tiles(f, ["field"]))
    depth = images.stack_depth(f, ["field"])
    parts = {m: images.stack_tiles(tiles, ["field"], m, depth=depth) for m in images.ARRAY_COMBINERS}
    parts["trimmed"] = images.stack_custom(tiles, ["field"], trimmed_mean, depth=depth)
    out = None
    for m, rows in parts.items():
        part = rows.select(F.lit(m).alias("method"), "field", "y", "x", F.round("v", 6).alias("v"))
        out = part if out is None else out.unionByName(part)
    return out


@query("agg_median_bracketed", f"WITH {_LIGHT} SELECT {_YX}, round(median(v), 6) AS v FROM al "
       "GROUP BY field, y, x")
def _(spark, sf):
    from skyops.operators.quantiles import median_by

    rows, _ = _aligned(spark, sf)
    return _rounded(median_by(rows, ["field", "y", "x"], "v", "v", accuracy=20), "v")


@query("pipe_reduce_stack", f"""WITH {_CAL}, {_CROP.format(src='cal')}, {_clip_sql()},
st AS (SELECT field, y, x, avg(v) FILTER (used) AS v FROM k5 GROUP BY 1, 2, 3)
SELECT field, round(min(v), 5) AS min_adu, round(max(v), 5) AS max_adu,
  round(avg(v), 5) AS mean_adu, round(median(v), 5) AS median_adu, round(stddev_pop(v), 5) AS std_adu,
  round(count(*) FILTER (v IS NULL) / count(*), 6) AS nan_fraction FROM st GROUP BY 1""")
def _(spark, sf):
    out = reduce_and_stack(frames(spark, sf), "sigma_clip", "field", _DARK_EXP)
    stats = _rounded(out["stats"], "min_adu", "max_adu", "mean_adu", "median_adu", "std_adu", places=5)
    return _rounded(stats, "nan_fraction")


# -- display -----------------------------------------------------------------------------------

_UNIT = f"""{_PX}, lim AS (SELECT frame_id, min(v) AS vmin, max(v) AS vmax FROM px GROUP BY 1),
u AS (SELECT frame_id, field, imagetyp, y, x, CASE WHEN v IS NOT NULL
  THEN least(greatest((v - vmin) / (vmax - vmin), 0), 1) END AS u FROM px JOIN lim USING (frame_id))"""


@query("img_interval", f"WITH {_PX} SELECT frame_id, min(v) AS vmin, max(v) AS vmax FROM px "
       "GROUP BY 1")
def _(spark, sf):
    return images.minmax_interval(pixels(spark, sf))


def _zscale_sql():
    out = ["""z0 AS (SELECT frame_id, v, CAST(row_number() OVER (PARTITION BY frame_id ORDER BY v) AS DOUBLE) AS r,
  true AS used, false AS few, 0.0 AS slope FROM px WHERE v IS NOT NULL)""",
           """size AS (SELECT frame_id, count(*) AS n, min(v) AS lo, max(v) AS hi, median(v) AS med FROM z0 GROUP BY 1)"""]
    for i in range(1, 6):
        out.append(f"""m{i} AS (SELECT frame_id, avg(r) FILTER (used) AS mr, avg(v) FILTER (used) AS mv FROM z{i - 1} GROUP BY 1),
f{i} AS (SELECT frame_id, coalesce(sum((r - mr) * (v - mv)) FILTER (used)
  / nullif(sum((r - mr) * (r - mr)) FILTER (used), 0), 0) AS slope FROM z{i - 1} JOIN m{i} USING (frame_id) GROUP BY 1),
o{i} AS (SELECT z.*, f.slope AS b, (v - mv) - f.slope * (r - mr) AS off FROM z{i - 1} z JOIN m{i} USING (frame_id) JOIN f{i} f USING (frame_id)),
d{i} AS (SELECT frame_id, stddev_pop(off) FILTER (used) AS s FROM o{i} GROUP BY 1),
bad{i} AS (SELECT frame_id, r FROM o{i} JOIN d{i} USING (frame_id) WHERE abs(off) > 2.5 * s),
u{i} AS (SELECT o.frame_id, o.v, o.r, o.few, o.b, n, NOT EXISTS (SELECT 1 FROM bad{i} x WHERE x.frame_id = o.frame_id
  AND abs(x.r - o.r) <= floor(n * 0.01 / 2)) AS used FROM o{i} o JOIN size USING (frame_id)),
z{i} AS (SELECT frame_id, v, r, used, few OR count(*) FILTER (used) OVER (PARTITION BY frame_id) < greatest(5, n // 2) AS few,
  b AS slope FROM u{i})""")
    return ", ".join(out)


@query("img_interval_zscale", f"""WITH {_PX}, {_zscale_sql()},
e AS (SELECT frame_id, any_value(slope) / 0.25 AS rise, bool_or(few) AS few FROM z5 GROUP BY 1)
SELECT frame_id, round(CASE WHEN few THEN lo ELSE greatest(lo, med - ((n + 1) // 2 - 1) * rise) END, 4) AS vmin,
  round(CASE WHEN few THEN hi ELSE least(hi, med + (n - (n + 1) // 2) * rise) END, 4) AS vmax
FROM size JOIN e USING (frame_id)""")
def _(spark, sf):
    return _rounded(images.zscale_interval(pixels(spark, sf)), "vmin", "vmax", places=4)


_STRETCHES = {
    "linear": "u", "sqrt": "sqrt(u)", "log": "ln(1000 * u + 1) / ln(1001)",
    "asinh": "ln(u / 0.1 + sqrt((u / 0.1) * (u / 0.1) + 1)) / ln(10 + sqrt(101))",
}


@query("img_stretch", f"WITH {_UNIT} SELECT frame_id, CAST(y AS INTEGER) AS y, "
       "CAST(x AS INTEGER) AS x, " + ", ".join(
           f"round({e}, 6) AS {k}" for k, e in _STRETCHES.items()) + " FROM u")
def _(spark, sf):
    rows = pixels(spark, sf).select("frame_id", "y", "x", "v")
    unit = images.scale_pixels(rows, images.minmax_interval(rows), ["frame_id"], "linear")
    return unit.select("frame_id", "y", "x", *[
        F.round(images.stretch(F.col("shown"), k), 6).alias(k) for k in _STRETCHES])


@query("join_rgb", f"""WITH {_UNIT}, c AS (SELECT field, imagetyp, y, x, avg(u) AS u FROM u
  GROUP BY 1, 2, 3, 4)
SELECT r.field, CAST(r.y AS INTEGER) AS y, CAST(r.x AS INTEGER) AS x,
  round(coalesce(sqrt(r.u), 0), 6) AS r, round(coalesce(sqrt(g.u), 0), 6) AS g,
  round(coalesce(sqrt(b.u), 0), 6) AS b
FROM (SELECT * FROM c WHERE imagetyp = 'light') r
JOIN (SELECT * FROM c WHERE imagetyp = 'dark') g ON r.field = g.field AND r.y = g.y AND r.x = g.x
JOIN (SELECT * FROM c WHERE imagetyp = 'flat') b ON r.field = b.field AND r.y = b.y AND r.x = b.x""")
def _(spark, sf):
    rows = pixels(spark, sf)
    unit = images.scale_pixels(rows, images.minmax_interval(rows), ["frame_id"], "linear")
    mean = unit.groupBy("imagetyp", "field", "y", "x").agg(F.avg("shown").alias("u"))
    shown = mean.withColumn("shown", images.stretch(F.col("u"), "sqrt"))
    r, g, b = (shown.filter(F.col("imagetyp") == k) for k in ("light", "dark", "flat"))
    return _rounded(images.rgb(r, g, b, ["field"]), "r", "g", "b")


# -- files --------------------------------------------------------------------------------------

def _written(spark, sf):
    """A folder of frames as FITS files; every eleventh is cut short, every seventh is compressed."""
    import gzip

    import numpy as np
    import pandas as pd
    import pyarrow.fs as fs

    folder = scratch_dir(spark, "images")

    def card(key, value):
        return f"{key:<8}= {value:>20}".ljust(80)

    def encode(batches):
        files, at = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/"))
        files.create_dir(at)
        for pdf in batches:
            names = []
            for row in pdf.itertuples():
                px = np.array([np.nan if v is None else v for v in row.px], dtype=float)
                cards = [card("SIMPLE", "T"), card("BITPIX", -64), card("NAXIS", 2),
                         card("NAXIS1", row.w), card("NAXIS2", row.h),
                         card("OBJECT", f"'field {row.field}'"),
                         card("IMAGETYP", f"'{row.imagetyp}'"), card("EXPTIME", row.exptime),
                         card("CRVAL1", row.frame_id % 360), card("CRVAL2", row.frame_id % 90),
                         card("FILTER", f"'F{row.frame_id % 3}'"), card("INSTRUME", "'it''s one'"),
                         card("TELESCOP", f"'T{row.field}' / aperture"), card("AIRMASS", 1 + row.frame_id % 8 / 8),
                         card("DATE-OBS", f"'2024-01-{row.frame_id % 28 + 1:02d}'"),
                         "END".ljust(80)]
                head = "".join(cards).encode().ljust(2880)
                body = px.astype(">f8").tobytes()
                data = head + body.ljust(-(-len(body) // 2880) * 2880, b"\0")
                name = f"f{row.frame_id}.fits"
                if row.frame_id % 11 == 0:
                    data = data[:100]
                elif row.frame_id % 7 == 0:
                    data, name = gzip.compress(data), name + ".gz"
                with files.open_output_stream(f"{at}/{name}", compression=None) as out:
                    out.write(data)
                names.append(name)
            yield pd.DataFrame({"name": names})

    frames(spark, sf).mapInPandas(encode, "name string").write.format("noop").mode("overwrite").save()
    return folder


_FILES = """fl AS (SELECT vec_id, 'f' || vec_id || '.fits' ||
  CASE WHEN vec_id % 11 <> 0 AND vec_id % 7 = 0 THEN '.gz' ELSE '' END AS filename,
  vec_id % 11 = 0 AS bad, {kind} AS imagetyp, label, {exp} AS exptime, {rows} AS h FROM embeddings)
""".format(kind=_KIND, exp=_EXP, rows=_ROWS)


_HEADER_FIELDS = {
    "object": "'field ' || label", "ra_deg": "CAST(vec_id % 360 AS DOUBLE)", "dec_deg": "CAST(vec_id % 90 AS DOUBLE)",
    "filter": "'F' || vec_id % 3", "exptime": "exptime", "instrument": "'it''s one'", "telescope": "'T' || label",
    "date_obs": "'2024-01-' || lpad(CAST(vec_id % 28 + 1 AS VARCHAR), 2, '0')", "imagetyp": "imagetyp", "naxis1": "8", "naxis2": "h",
    "airmass": "1 + CAST(vec_id % 8 AS DOUBLE) / 8", "fov_arcmin": "CAST(NULL AS VARCHAR)"}


@query("src_image_headers", f"WITH {_FILES} SELECT filename, " + ", ".join(
    f'CASE WHEN NOT bad THEN {e} END AS "{c}"' for c, e in _HEADER_FIELDS.items()) + " FROM fl")
def _(spark, sf):
    return sky.catalog_entries(source.read_headers(spark, _written(spark, sf)))


@query("src_image_pixels", f"""WITH {_FILES}, {_PX} SELECT filename, count(*) AS pixels,
  count(v) AS good, CAST(sum(v) AS DOUBLE) AS total FROM fl JOIN px ON frame_id = vec_id
  WHERE NOT bad GROUP BY 1""")
def _(spark, sf):
    tiles, _bad = source.split_bad(source.read_tiles(spark, _written(spark, sf), tile=5))
    return images.to_pixels(tiles, ("filename",)).groupBy("filename").agg(
        F.count(F.lit(1)).alias("pixels"), F.count("v").alias("good"), F.sum("v").alias("total"))


# -- sky ------------------------------------------------------------------------------------------

_HEAD = [
    ("id", "p_partkey"),
    ("crpix1", "CAST(512 AS DOUBLE)"), ("crpix2", "CAST(256 AS DOUBLE)"),
    ("crval1", "CAST((p_partkey * 37) % 360 AS DOUBLE)"),
    ("crval2", "CAST(p_partkey % 171 - 85 AS DOUBLE)"),
    ("cd11", "CASE WHEN p_partkey % 3 <> 0 THEN -0.0001 * (1 + p_size) END"),
    ("cd12", "CASE WHEN p_partkey % 3 <> 0 THEN 0.00001 * (p_partkey % 7) END"),
    ("cd21", "CASE WHEN p_partkey % 3 <> 0 THEN 0.00001 * (p_partkey % 5) END"),
    ("cd22", "CASE WHEN p_partkey % 3 <> 0 THEN 0.0001 * (1 + p_size) END"),
    ("cdelt1", "CASE WHEN p_partkey % 3 = 0 THEN -0.0002 * (1 + p_size) END"),
    ("cdelt2", "CASE WHEN p_partkey % 3 = 0 THEN 0.0002 * (1 + p_size) END"),
    ("crota2", "CASE WHEN p_partkey % 6 = 0 THEN CAST(p_partkey % 45 AS DOUBLE) END"),
    ("ctype1", "CASE p_partkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 'RA---SIN' WHEN 2 THEN 'LINEAR' "
               "ELSE 'RA---TAN' END"),
    ("ctype2", "CASE WHEN p_partkey % 8 <> 0 THEN 'DEC--TAN' END"),
    ("naxis1", "1024"), ("naxis2", "512"),
]


def headers(spark, sf):
    return table(spark, sf, "part").selectExpr(*[
        f"CAST({e} AS DOUBLE) AS {c}" if c.startswith(("cd", "cr")) else f"{e} AS {c}"
        for c, e in _HEAD])


_HEAD_SQL = "hd AS (SELECT " + ", ".join(
    f"CAST({e} AS DOUBLE) AS {c}" if c.startswith(("cd", "cr")) else f"{e} AS {c}"
    for c, e in _HEAD) + """ FROM part),
mx AS (SELECT *, coalesce(cd11, cdelt1 * cos(radians(coalesce(crota2, 0)))) AS a,
  coalesce(cd12, -cdelt2 * sin(radians(coalesce(crota2, 0)))) AS b,
  coalesce(cd21, cdelt1 * sin(radians(coalesce(crota2, 0)))) AS c,
  coalesce(cd22, cdelt2 * cos(radians(coalesce(crota2, 0)))) AS d FROM hd)"""


def _sky_sql(px, py, tag):
    """ra / dec of a pixel through the native sphere (theta, phi), not the shortcut."""
    xi = f"(a * ({px} + 1 - crpix1) + b * ({py} + 1 - crpix2))"
    eta = f"(c * ({px} + 1 - crpix1) + d * ({py} + 1 - crpix2))"
    r = f"sqrt({xi} * {xi} + {eta} * {eta})"
    theta = f"atan2(degrees(1), {r})"
    phi = f"atan2({xi}, -({eta}))"
    d0 = "radians(crval2)"
    dec = (f"degrees(asin(sin({theta}) * sin({d0}) - cos({theta}) * cos({phi} - pi()) * cos({d0}) "
           f"* -1))")
    ra = (f"crval1 + degrees(atan2(-cos({theta}) * sin({phi} - pi()), sin({theta}) * cos({d0}) "
          f"- cos({theta}) * sin({d0}) * cos({phi} - pi())))")
    ra = f"(({ra}) - 360 * floor(({ra}) / 360))"
    return f"round({ra}, 6) AS {tag}_ra, round({dec}, 6) AS {tag}_dec"


@query("wcs_scales", f"""WITH {_HEAD_SQL} SELECT id, round((s1 + s2) / 2 * 3600, 4) AS scale_arcsec,
  round(s1 * naxis1 * 60, 2) AS fov_w, round(s2 * naxis2 * 60, 2) AS fov_h
FROM (SELECT *, sqrt(a * a + c * c) AS s1, sqrt(b * b + d * d) AS s2 FROM mx)""")
def _(spark, sf):
    s1, s2 = fn.scales(fn.plate_matrix())
    return headers(spark, sf).select(
        "id", F.round((s1 + s2) / 2 * 3600, 4).alias("scale_arcsec"),
        F.round(s1 * F.col("naxis1") * 60, 2).alias("fov_w"),
        F.round(s2 * F.col("naxis2") * 60, 2).alias("fov_h"))


@query("wcs_rotation", f"""WITH {_HEAD_SQL} SELECT id, round(CASE WHEN cd11 IS NOT NULL
  THEN degrees(atan2(cd12, cd11)) ELSE coalesce(crota2, 0) END, 6) AS rotation FROM mx""")
def _(spark, sf):
    return headers(spark, sf).select("id", F.round(fn.rotation(), 6).alias("rotation"))


@query("wcs_projection", f"""WITH {_HEAD_SQL} SELECT CASE WHEN contains(ctype1, '-')
  THEN string_split(ctype1, '-')[-1] ELSE 'UNKNOWN' END AS projection, count(*) AS n
  FROM mx WHERE ctype1 IS NOT NULL AND ctype2 IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    rows = headers(spark, sf).filter("ctype1 IS NOT NULL AND ctype2 IS NOT NULL")
    return rows.groupBy(fn.projection(F.col("ctype1")).alias("projection")).agg(
        F.count(F.lit(1)).alias("n"))


@query("wcs_pixel_to_sky", f"""WITH {_HEAD_SQL} SELECT id, {_sky_sql("100.0", "30.5", "p")}
  FROM mx WHERE ctype1 = 'RA---TAN'""")
def _(spark, sf):
    rows = headers(spark, sf).withColumn("s", fn.pixel_to_sky(F.lit(100.0), F.lit(30.5)))
    return rows.filter(F.col("s").isNotNull()).select(
        "id", F.round("s.ra", 6).alias("p_ra"), F.round("s.dec", 6).alias("p_dec"))


@query("wcs_sky_to_pixel", f"""WITH {_HEAD_SQL} SELECT id, CAST(100 AS DOUBLE) AS x,
  CAST(30.5 AS DOUBLE) AS y FROM mx WHERE ctype1 = 'RA---TAN'""")
def _(spark, sf):
    rows = headers(spark, sf).withColumn("s", fn.pixel_to_sky(F.lit(100.0), F.lit(30.5)))
    rows = rows.withColumn("q", fn.sky_to_pixel(F.col("s.ra"), F.col("s.dec")))
    return rows.filter(F.col("q").isNotNull()).select(
        "id", F.round("q.x", 5).alias("x"), F.round("q.y", 5).alias("y"))


_CORNERS = [("0.0", "0.0"), ("1023.0", "0.0"), ("1023.0", "511.0"), ("0.0", "511.0")]


@query("wcs_field_geometry", f"""WITH {_HEAD_SQL} SELECT id, {_sky_sql("512.0", "256.0", "center")},
  {", ".join(_sky_sql(x, y, f"corner{k}") for k, (x, y) in enumerate(_CORNERS))},
  round((sqrt(a * a + c * c) + sqrt(b * b + d * d)) / 2 * 3600, 4) AS scale,
  round(sqrt(a * a + c * c) * 1024 * 60, 2) AS fov_w, round(sqrt(b * b + d * d) * 512 * 60, 2) AS fov_h,
  round(CASE WHEN cd11 IS NOT NULL THEN degrees(atan2(cd12, cd11)) ELSE coalesce(crota2, 0) END, 2)
    AS rotation, 'TAN' AS projection
FROM mx WHERE ctype1 = 'RA---TAN'""")
def _(spark, sf):
    rows = headers(spark, sf).withColumn("g", fn.field_geometry()).filter(F.col("g").isNotNull())
    places = {"center": F.col("g.center")} | {f"corner{k}": F.col("g.corners")[k] for k in range(len(_CORNERS))}
    return rows.select(
        "id", *[F.round(at[c], 6).alias(f"{name}_{c}") for name, at in places.items() for c in ("ra", "dec")],
        F.col("g.pixel_scale_arcsec").alias("scale"), F.col("g.fov_arcmin.width").alias("fov_w"),
        F.col("g.fov_arcmin.height").alias("fov_h"),
        F.col("g.rotation_deg").alias("rotation"), F.col("g.projection").alias("projection"))


_HAVERSINE = """2 * asin(least(1, sqrt(pow(sin(radians({d2} - {d1}) / 2), 2) + cos(radians({d1}))
  * cos(radians({d2})) * pow(sin(radians({a2} - {a1}) / 2), 2))))"""


@query("sky_separation", f"""WITH q AS ({QUERY_SQL}) SELECT pl_name, round(degrees({
    _HAVERSINE.format(a1='10.5', d1='20.25', a2='ra', d2='"dec"')}) * 60, 4) AS arcmin FROM q
  WHERE ra IS NOT NULL""")
def _(spark, sf):
    sep = fn.separation(F.lit(10.5), F.lit(20.25), F.col("ra"), F.col("dec"))
    return query_catalog(spark, sf).filter("ra IS NOT NULL").select(
        "pl_name", F.round(sep, 4).alias("arcmin"))


_FIELDS = [("field_id", "s_suppkey"), ("center_ra", "CAST((s_suppkey * 53) % 360 + 0.25 AS DOUBLE)"),
           ("center_dec", "CAST((s_suppkey * 29) % 181 - 90 + 0.125 * (s_suppkey % 3 - 1) AS DOUBLE)")]


@query("join_cone", f"""WITH q AS ({QUERY_SQL}), f AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _FIELDS)}
  FROM supplier), s AS (SELECT pl_name, field_id, degrees({
    _HAVERSINE.format(a1='center_ra', d1='least(90, greatest(-90, center_dec))', a2='ra', d2='"dec"')}) * 60 AS arcmin
  FROM q, f WHERE ra IS NOT NULL)
SELECT pl_name, field_id, round(arcmin, 3) AS arcmin FROM s WHERE arcmin <= 180""")
def _(spark, sf):
    fields = table(spark, sf, "supplier").selectExpr(*[f"{e} AS {c}" for c, e in _FIELDS])
    fields = fields.withColumn("center_dec", F.least(F.greatest("center_dec", F.lit(-90.0)),
                                                     F.lit(90.0)))
    pairs = sky.cone_join(query_catalog(spark, sf), fields, 3.0)
    return pairs.select("pl_name", "field_id", F.round("separation_arcmin", 3).alias("arcmin"))


# -- headers -----------------------------------------------------------------------------------------

_CARDS = """map_filter(map('OBJECT', p_name, 'FILTER', p_brand,
  'EXPTIME', CASE WHEN p_partkey % 5 = 0 THEN 'bad' ELSE CAST(p_size AS STRING) END,
  'RA', CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey % 360 AS STRING) END,
  'CRVAL1', '12.5', 'CRVAL2', '-3.5', 'CRPIX1', '512', 'CRPIX2', '256', 'CD1_1', '-0.001',
  'CD2_2', '0.001', 'CTYPE1', CASE WHEN p_partkey % 3 = 0 THEN 'RA---TAN' END,
  'CTYPE2', 'DEC--TAN', 'NAXIS1', '1024', 'NAXIS2', '512', 'INSTRUME', p_type, 'IMAGETYP', 'light',
  'TELESCOP', CASE WHEN p_partkey % 4 <> 0 THEN concat('T', p_size) END, 'AIRMASS', CAST(1 + p_size / 100 AS STRING),
  'DATE-OBS', CASE WHEN p_partkey % 7 <> 0 THEN concat('2024-01-', lpad(p_size, 2, '0')) END),
  (k, v) -> v IS NOT NULL)"""


def cards(spark, sf):
    return table(spark, sf, "part").selectExpr("concat('f', p_partkey, '.fits') AS filename",
                                               f"{_CARDS} AS cards")


_ENTRY_SQL = """en AS (SELECT p_partkey, 'f' || p_partkey || '.fits' AS filename, p_name AS object,
  CAST(CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 360 ELSE 12.5 END AS DOUBLE) AS ra_deg,
  CAST(-3.5 AS DOUBLE) AS dec_deg, p_brand AS "filter",
  CAST(CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS DOUBLE) AS exptime,
  p_type AS instrument, CASE WHEN p_partkey % 4 <> 0 THEN 'T' || p_size END AS telescope,
  CASE WHEN p_partkey % 7 <> 0 THEN '2024-01-' || lpad(CAST(p_size AS VARCHAR), 2, '0') END
    AS date_obs, 'light' AS imagetyp, 1024 AS naxis1, 512 AS naxis2, round(1 + p_size / 100, 6) AS airmass,
  CASE WHEN p_partkey % 3 = 0 THEN '61.4x30.7' END AS fov_arcmin FROM part)"""
_ENTRIES = f"WITH {_ENTRY_SQL} SELECT * EXCLUDE (p_partkey) FROM en"


@query("xf_catalog_entry", _ENTRIES)
def _(spark, sf):
    return _rounded(sky.catalog_entries(cards(spark, sf)), "airmass")


@query("xf_observation_keys", """SELECT 'f' || p_partkey || '.fits' AS filename,
  'OBJECT,' || CASE WHEN p_partkey % 2 = 0 THEN 'RA,' ELSE '' END || 'FILTER,EXPTIME' ||
  CASE WHEN p_partkey % 7 <> 0 THEN ',DATE-OBS' ELSE '' END || ',INSTRUME' ||
  CASE WHEN p_partkey % 4 <> 0 THEN ',TELESCOP' ELSE '' END || ',AIRMASS,IMAGETYP' AS keys FROM part""")
def _(spark, sf):
    rank = F.array(*[F.lit(k) for k in sky.OBSERVATION_KEYWORDS])
    keys = F.map_keys(sky.observation_keys(F.col("cards")))
    return cards(spark, sf).select(
        "filename", F.array_join(F.filter(rank, lambda k: F.array_contains(keys, k)), ",")
        .alias("keys"))


@query("sort_catalog_date", f"""WITH {_ENTRY_SQL} SELECT filename, date_obs,
  row_number() OVER (ORDER BY coalesce(date_obs, ''), filename) AS position FROM en""")
def _(spark, sf):
    entries = sky.catalog_entries(cards(spark, sf)).select("filename", "date_obs")
    return sky.with_position(sky.sort_by_date(entries))


@query("sink_image_catalog", _ENTRIES)
def _(spark, sf):
    path = scratch_dir(spark, "image-catalog")
    sky.write_catalog(sky.catalog_entries(cards(spark, sf)), path, "csv")
    back = spark.read.option("header", True).schema(
        "filename string, object string, ra_deg double, dec_deg double, filter string, "
        "exptime double, instrument string, telescope string, date_obs string, imagetyp string, "
        "naxis1 int, naxis2 int, airmass double, fov_arcmin string").csv(path)
    return _rounded(back, "airmass")
