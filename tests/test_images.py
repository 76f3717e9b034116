import gzip
import io
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyops.functions import sky as fn
from skyops.operators import images, sky
from skyops.operators.quantiles import median_by
from skyops.sources import images as source


def frame_rows(spark, frames, **extra):
    rows = [(i, 0, 0, *f.shape, [None if np.isnan(v) else float(v) for v in f.ravel()],
             *[e[i] for e in extra.values()]) for i, f in enumerate(frames)]
    types = "".join(f", {k} double" for k in extra)
    return spark.createDataFrame(rows, "frame_id int, y0 int, x0 int, h int, w int, "
                                       "px array<double>" + types).withColumn("field", F.lit(1))


def as_array(df, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r.y, r.x] = np.nan if r.v is None else r.v
    return out


def flat_image(spark, value):
    return images.to_pixels(frame_rows(spark, [np.full((2, 2), float(value))])).drop("frame_id")


def test_calibration_anchors(spark):
    sci = images.to_pixels(frame_rows(spark, [np.full((2, 2), 1000.0)], exptime=[120.0]),
                           ("frame_id", "exptime"))
    one = lambda df: {r.v for r in df.collect()}
    assert one(images.calibrate(sci, bias=flat_image(spark, 200))) == {800.0}
    dark = flat_image(spark, 100)
    assert one(images.calibrate(sci, dark=dark, dark_exptime=60.0)) == {800.0}
    assert one(images.calibrate(sci, dark=dark)) == {900.0}
    flat = images.to_pixels(frame_rows(spark, [np.array([[1.0, 1.0], [1.0, 0.0]])])).drop("frame_id")
    got = {(r.y, r.x): r.v for r in images.calibrate(sci, flat=flat).collect()}
    assert got == {(0, 0): 1000.0, (0, 1): 1000.0, (1, 0): 1000.0, (1, 1): None}


@pytest.fixture(scope="module")
def cube():
    rng = np.random.default_rng(1)
    c = rng.normal(1000, 5, (14, 5, 6))
    c[3, 1, 1] = 65000
    c[5, 0, :3] = np.nan
    c[7, 2, 2] = -9000
    return c


@pytest.mark.parametrize("method,want", [
    ("median", lambda c: np.nanmedian(c, axis=0)), ("mean", lambda c: np.nanmean(c, axis=0))])
def test_stacks_in_both_forms(spark, cube, method, want):
    tiles = frame_rows(spark, list(cube))
    pixels = images.to_pixels(tiles, ("frame_id", "field"))
    for got in (images.combine_pixels(pixels, ["field"], method), images.stack_tiles(tiles, ["field"], method)):
        assert np.allclose(as_array(got, cube.shape[1:]), want(cube))


def stack_of(spark, *columns):
    """One pixel for each column of values, as frames of one row."""
    return images.to_pixels(frame_rows(spark, [np.array([f], float) for f in zip(*columns)]), ("frame_id", "field"))


def test_sigma_clip_by_hand(spark):
    nan, steady = np.nan, [10, 12] * 6
    pixels = stack_of(spark, [*steady, 900], [*steady, nan], [7] * 13, [nan] * 13, [*steady[:-1], 900, -900])
    got = as_array(images.stack_sigma_clip(pixels, ["field"]), (1, 5))[0]
    # the outlier goes; bad values count for nothing; equal values stay; no value gives none
    assert got[0] == 11 and got[1] == 11 and got[2] == 7 and np.isnan(got[3])
    # 900 and -900 are within three deviations of 10 at first: median 10, deviation about 353
    assert got[4] == pytest.approx((6 * 10 + 5 * 12) / 13)


def test_a_pixel_whose_values_are_all_clipped_stays(spark):
    pixels = stack_of(spark, [1, 3], [5, 5])
    rows = images.stack_sigma_clip(pixels, ["field"], 0.5, 0.5).collect()
    assert {(r.x, r.v) for r in rows} == {(0, None), (1, 5.0)}


@pytest.mark.parametrize("n", [1, 2, 3, 10, 501, 4000])
def test_median_of_groups(spark, n):
    rng = np.random.default_rng(n)
    for values in (rng.normal(size=n), rng.integers(0, 3, n).astype(float)):
        df = spark.createDataFrame([(1, float(v)) for v in values] + [(1, None), (2, 5.0), (3, None), (None, 2.0)],
                                   "g int, v double")
        for accuracy in (100, 10_000):
            rows = median_by(df, ["g"], "v", extra={"n": F.count("v")}, accuracy=accuracy).collect()
            assert {r.g: (r.median, r.n) for r in rows} == {
                1: (pytest.approx(np.median(values)), n), 2: (5.0, 1), 3: (None, 0), None: (2.0, 1)}


def test_calibration_by_row_tiles(spark):
    frames = [np.arange(12.0).reshape(3, 4), np.arange(8.0).reshape(2, 4)]
    bias = images.to_pixels(frame_rows(spark, [np.full((3, 4), 1.0)])).drop("frame_id")
    out = images.to_pixels(images.calibrate_tiles(images.row_tiles(frame_rows(spark, frames)), images.tiles_of_rows(bias)))
    assert np.array_equal(as_array(out.filter("frame_id = 0"), (3, 4)), frames[0] - 1)
    assert np.array_equal(as_array(out.filter("frame_id = 1"), (2, 4)), frames[1] - 1)


def test_crop_to_common_shape(spark):
    a, b = np.arange(120.0).reshape(10, 12), np.arange(88.0).reshape(8, 11)
    tiles = frame_rows(spark, [a, b])
    shapes = images.shapes(tiles, ["field", "frame_id"])
    cropped = images.align_crop(images.to_pixels(tiles, ("frame_id", "field")), shapes, ["field"])
    got = as_array(cropped.filter("frame_id = 0"), (8, 11))
    assert np.array_equal(got, a[1:9, 0:11])
    other = images.to_pixels(images.align_crop_tiles(tiles, ["field"]), ("frame_id",))
    assert np.array_equal(as_array(other.filter("frame_id = 0"), (8, 11)), a[1:9, 0:11])
    assert np.array_equal(as_array(other.filter("frame_id = 1"), (8, 11)), b)


def test_statistics(spark, cube):
    tiles = frame_rows(spark, [cube[5], np.full((2, 2), np.nan)])
    rows = {r.frame_id: r for r in images.image_stats(images.to_pixels(tiles)).collect()}
    assert rows[0].std_adu == pytest.approx(np.nanstd(cube[5]))
    assert rows[0].nan_fraction == pytest.approx(3 / 30)
    assert rows[1].median_adu is None and rows[1].nan_fraction == 1.0


def card(key, value):
    return f"{key:<8}= {value:>20}".ljust(80)


def fits(array, bitpix, extra=(), primary=True):
    cards = [card("SIMPLE", "T") if primary else card("XTENSION", "'IMAGE   '"),
             card("BITPIX", bitpix)]
    shape = [] if array is None else list(array.shape[::-1])
    cards += [card("NAXIS", len(shape))] + [card(f"NAXIS{i + 1}", n) for i, n in enumerate(shape)]
    cards += [*extra, "END".ljust(80)]
    head = "".join(cards).encode()
    head = head.ljust(-(-len(head) // 2880) * 2880)
    body = b"" if array is None else array.tobytes()
    return head + body.ljust(-(-len(body) // 2880) * 2880, b"\0")


def test_image_files(spark, tmp_path):
    a = np.arange(12, dtype=">i2").reshape(3, 4)
    f = np.array([[1.0, np.inf], [np.nan, 4.0]], dtype=">f4").reshape(1, 2, 2)
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.FITS").write_bytes(fits(a, 16, [card("BZERO", 100), card("BSCALE", 2),
                                                   card("BLANK", 5), card("OBJECT", "'M 31''s'")]))
    (tmp_path / "sub" / "b.fit.gz").write_bytes(gzip.compress(
        fits(None, 8) + fits(f, -32, primary=False)))
    (tmp_path / "c.fts").write_bytes(b"junk")
    (tmp_path / "d.txt").write_bytes(b"no image")
    heads = {r.filename: r for r in source.read_headers(spark, str(tmp_path)).collect()}
    assert set(heads) == {"a.FITS", "b.fit.gz", "c.fts"}
    assert heads["a.FITS"].cards["OBJECT"] == "M 31's" and heads["b.fit.gz"].extensions == 2
    assert heads["c.fts"].error
    assert source.read_headers(spark, str(tmp_path), recursive=False).count() == 2
    tiles, bad = source.split_bad(source.read_tiles(spark, str(tmp_path), tile=2))
    assert [r.filename for r in bad.collect()] == ["c.fts"]
    px = images.to_pixels(tiles, ("filename",))
    want = a * 2.0 + 100
    want[a == 5] = np.nan
    assert np.array_equal(as_array(px.filter("filename = 'a.FITS'"), (3, 4)), want, equal_nan=True)
    got = as_array(px.filter("filename = 'b.fit.gz'"), (2, 2))
    assert np.array_equal(got, [[1, np.nan], [np.nan, 4]], equal_nan=True)


def test_display_limits(spark):
    rng = np.random.default_rng(2)
    frames = [np.append(rng.normal(100, 1, 990), np.full(10, 1e5)).reshape(20, 50), np.full((20, 50), 3.0),
              np.arange(1000.0).reshape(20, 50), np.array([[1.0, 2.0]])]
    rows = {r.frame_id: r for r in images.zscale_interval(images.to_pixels(frame_rows(spark, frames))).collect()}
    assert 90 < rows[0].vmin < 100 < rows[0].vmax < 200  # outliers are left out
    assert (rows[1].vmin, rows[1].vmax) == (3, 3)
    assert (rows[2].vmin, rows[2].vmax) == (pytest.approx(0), pytest.approx(999))  # a line keeps its ends
    assert (rows[3].vmin, rows[3].vmax) == (1, 2)


def test_reference_pixel_maps_to_reference_value(spark):
    h = spark.createDataFrame([(10.0, 20.0, 150.0, -30.0, -1e-3, 0.0, 0.0, 1e-3, "RA---TAN",
                                "DEC--TAN", 40, 60)],
                              "crpix1 double, crpix2 double, crval1 double, crval2 double, "
                              "cd11 double, cd12 double, cd21 double, cd22 double, ctype1 string, "
                              "ctype2 string, naxis1 int, naxis2 int").withColumns(
        {c: F.lit(None).cast("double") for c in ("cdelt1", "cdelt2", "crota2")})
    s = h.select(fn.pixel_to_sky(F.lit(9.0), F.lit(19.0)).alias("s")).first().s
    assert (s.ra, s.dec) == (pytest.approx(150.0), pytest.approx(-30.0))
    g = h.select(fn.field_geometry().alias("g")).first().g
    assert g.fov_arcmin.width == pytest.approx(2.4) and g.pixel_scale_arcsec == pytest.approx(3.6)
    assert h.select(fn.sky_to_pixel(F.lit(330.0), F.lit(30.0)).alias("p")).first().p is None


@pytest.mark.parametrize("radius", [0.5, 4.0, 35.0, 100.0])
def test_cone_join_against_brute_force(spark, radius):
    rng = np.random.default_rng(int(radius * 10))
    def points(n):
        ra = np.append(rng.uniform(0, 360, n), [0, 359.99, 10, 180, 0])
        dec = np.append(np.degrees(np.arcsin(rng.uniform(-1, 1, n))), [0, 0, 89.9, -89.95, 90])
        return [(i, float(a), float(d)) for i, (a, d) in enumerate(zip(ra, dec))]
    p, f = points(250), points(40)
    pos = spark.createDataFrame(p, "p long, ra double, dec double")
    fields = spark.createDataFrame(f, "f long, center_ra double, center_dec double")
    got = [(r.p, r.f) for r in sky.cone_join(pos, fields, radius).collect()]
    def vec(a, d):
        a, d = np.radians(a), np.radians(d)
        return np.array([np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)])
    want = [(i, j) for i, a, d in p for j, b, e in f
            if np.degrees(np.arctan2(np.linalg.norm(np.cross(vec(a, d), vec(b, e))),
                                     vec(a, d) @ vec(b, e))) <= radius]
    assert sorted(got) == sorted(want)


def test_cone_join_cuts_a_crowded_cell_into_pieces(spark, monkeypatch):
    """All rows in one cell: pairs once each, repeated rows kept, and tasks by the pairs, none with most of them."""
    monkeypatch.setattr(sky, "SIDE", 10)
    monkeypatch.setattr(sky, "PAIRS", 500)
    pos = spark.createDataFrame([(i, 10 + i / 1e4, 5.0) for i in [*range(200), 7, 7]], "p long, ra double, dec double")
    fields = spark.createDataFrame([(i, 10.0, 5 + i / 1e4) for i in range(100)], "f long, center_ra double, center_dec double")
    pairs = sky.cone_join(pos, fields, 3.0)
    rows = [(r.p, r.f, r.at) for r in pairs.withColumn("at", F.spark_partition_id()).collect()]
    assert sorted(r[:2] for r in rows) == sorted((p, f) for p in [*range(200), 7, 7] for f in range(100))
    by_task = Counter(r[2] for r in rows)
    assert len(by_task) > 10 and max(by_task.values()) < 0.2 * len(rows)


# -- strips, deep stacks, display limits over many tasks --------------------------------------------

def cut(spark, frames, rng):
    """The same frames, each cut into tiles of its own at chance rows and columns."""
    rows = []
    for i, f in enumerate(frames):
        ys = [0, *sorted(rng.choice(range(1, f.shape[0]), 2, replace=False)), f.shape[0]]
        xs = [0, *sorted(rng.choice(range(1, f.shape[1]), 2, replace=False)), f.shape[1]]
        for y0, y1 in zip(ys, ys[1:]):
            for x0, x1 in zip(xs, xs[1:]):
                part = f[y0:y1, x0:x1]
                rows.append((i, int(y0), int(x0), *part.shape, [None if np.isnan(v) else float(v) for v in part.ravel()], 1))
    return spark.createDataFrame(rows, "frame_id int, y0 int, x0 int, h int, w int, px array<double>, field int").repartition(4)


@pytest.mark.parametrize("deep", [1 << 20, 28, 13])
@pytest.mark.parametrize("method", ["median", "mean", "sigma_clip"])
def test_strips_of_any_tiling_equal_windows(spark, cube, method, deep, monkeypatch):
    """Narrow strips, and below the depth of 14 frames the windows, give the same pixels."""
    monkeypatch.setattr(images, "DEEP", deep)
    tiles = cut(spark, list(cube), np.random.default_rng(deep))
    got = as_array(images.stack_tiles(tiles, ["field"], method), (5, 6))
    pixels = images.to_pixels(frame_rows(spark, list(cube)), ("frame_id", "field"))
    want = as_array(images.combine_pixels(pixels, ["field"], method), (5, 6))
    np.testing.assert_allclose(got, want, rtol=1e-12)


@pytest.mark.parametrize("limits", [(3.0, 3.0), (0.5, 0.5), (1.0, 2.0)])
def test_clipping_in_arrays_equals_windows(spark, limits):
    rng = np.random.default_rng(4)
    cube = rng.normal(0, 3, (9, 4, 5)).round(1)
    cube[rng.random(cube.shape) < 0.2] = np.nan
    cube[:, 0, 0], cube[:, 0, 1] = np.nan, 7
    pixels = images.to_pixels(frame_rows(spark, list(cube)), ("frame_id", "field"))
    got, want = (as_array(images.stack_sigma_clip(pixels, ["field"], *limits, depth=d), (4, 5)) for d in (9, None))
    np.testing.assert_allclose(got, want, rtol=1e-12)


def test_tiles_are_combined_without_pixel_rows(spark, cube):
    plan = images.stack_tiles(frame_rows(spark, list(cube)), ["field"], "sigma_clip")._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and "Window" not in plan


def test_a_function_of_the_user(spark, cube):
    tiles = cut(spark, list(cube), np.random.default_rng(0))
    got = as_array(images.stack_custom(tiles, ["field"], lambda m: np.nanmax(m, axis=0) - np.nanmin(m, axis=0)), (5, 6))
    np.testing.assert_allclose(got, np.nanmax(cube, axis=0) - np.nanmin(cube, axis=0))


def test_shallow_stacks_are_refused(spark, cube):
    tiles = frame_rows(spark, list(cube[:1]))
    with pytest.raises(ValueError, match="at least 2"):
        images.stack_depth(tiles, ["field"])
    assert images.stack_depth(tiles.limit(0), ["field"]) == 0


def plain_zscale(values, contrast=0.25):
    v = np.sort(values[np.isfinite(values)])
    n = len(v)
    r, used, slope, few = np.arange(1.0, n + 1), np.ones(n, bool), 0.0, False
    for _ in range(5):
        if used.any():
            x, y = r - r[used].mean(), v - v[used].mean()
            sxx = (x[used] ** 2).sum()
            slope = (x[used] * y[used]).sum() / sxx if sxx else 0.0
            off = y - slope * x
            bad = r[np.abs(off) > 2.5 * off[used].std() + 1e-12 * (v[-1] - v[0])]
        else:
            slope, bad = 0.0, r[:0]
        reach = np.floor(n * 0.01 / 2)
        used = ~(np.abs(r[:, None] - bad[None]) <= reach).any(axis=1)
        few = few or used.sum() < max(5, n // 2)
    rise, center = slope / contrast, (n + 1) // 2
    if few:
        return v[0], v[-1]
    return max(v[0], np.median(v) - (center - 1) * rise), min(v[-1], np.median(v) + (n - center) * rise)


def test_display_limits_against_plain_fit(spark):
    rng = np.random.default_rng(8)
    frames = [rng.normal(100, 10, 3000), np.r_[rng.normal(100, 10, 900), rng.normal(5000, 900, 60)], rng.integers(0, 3, 700).astype(float),
              np.full(40, 5.0), np.arange(300.0), np.r_[np.nan, 1.0, 2.0], rng.exponential(50, 2500), rng.standard_cauchy(1500)]
    rows = [(i, k, None if np.isnan(v) else float(v)) for i, f in enumerate(frames) for k, v in enumerate(f)]
    got = images.zscale_interval(spark.createDataFrame(rows, "frame_id int, x int, v double").repartition(5)).collect()
    assert sorted(r.frame_id for r in got) == list(range(len(frames)))
    for r in got:
        np.testing.assert_allclose((r.vmin, r.vmax), plain_zscale(frames[r.frame_id]), rtol=1e-9, atol=1e-9, err_msg=str(r))


def test_ranks_of_one_group_span_tasks(spark):
    """No window sees a row of the group: windows are over one row for each group and partition."""
    from skyops.operators.ranks import with_ranks

    rows = spark.range(20_000).selectExpr("CAST(NULL AS INT) AS g", "id % 7 AS v")
    ranked = with_ranks(rows, ["g"], ["v"]).cache()
    assert [r.rank for r in ranked.orderBy("rank").collect()] == list(range(20_000))
    assert ranked.where("n <> 20000").count() == 0
    assert ranked.groupBy("v").agg(F.min("rank").alias("a"), F.max("rank").alias("b")).where("b - a + 1 <> (20000 - v + 6) DIV 7").count() == 0
    windows = [line for line in with_ranks(rows, ["g"], ["v"])._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window" in line]
    assert windows and all("_part" in line or "_rows" in line for line in windows)


def fits_bytes(image, bitpix=-64, extra=()):
    cards = [f"{k:<8}= {v:>20}".ljust(80) for k, v in (("SIMPLE", "T"), ("BITPIX", bitpix), ("NAXIS", 2), ("NAXIS1", image.shape[1]),
                                                     ("NAXIS2", image.shape[0]), *extra)]
    head = "".join([*cards, "END".ljust(80)]).encode()
    body = image.astype({-64: ">f8", 16: ">i2"}[bitpix]).tobytes()
    return head.ljust(-(-len(head) // 2880) * 2880) + body.ljust(-(-len(body) // 2880) * 2880, b"\0")


class Counted(io.BytesIO):
    """A file that knows how many bytes were read."""

    count = 0

    def read(self, n=-1):
        data = super().read(n)
        self.count += len(data)
        return data


def test_headers_are_read_without_pixels():
    image = np.zeros((2000, 500))
    file = Counted(fits_bytes(image) + fits_bytes(image))
    units = list(source._units(file, len(file.getbuffer())))
    assert len(units) == 2 and file.count == 2 * 2880


def test_strips_are_read_at_their_offsets(spark, tmp_path):
    rng = np.random.default_rng(3)
    image = rng.integers(-900, 900, (57, 23))
    (tmp_path / "a.fits").write_bytes(fits_bytes(image, 16, (("BZERO", 100), ("BSCALE", 2), ("BLANK", int(image[4, 4])))))
    (tmp_path / "b.FITS.gz").write_bytes(gzip.compress(fits_bytes(image.astype(float))))
    (tmp_path / "c.fit").write_bytes(fits_bytes(image.astype(float))[:9000])
    (tmp_path / "d.fts.gz").write_bytes(gzip.compress(fits_bytes(image.astype(float))[:9000]))
    (tmp_path / "e.fits").write_bytes(b"SIMPLE")
    tiles, bad = source.split_bad(source.read_tiles(spark, str(tmp_path), tile=10))
    assert {r.filename for r in bad.collect()} == {"c.fit", "d.fts.gz", "e.fits"}
    rows = tiles.collect()
    assert max(r.h for r in rows) == max(r.w for r in rows) == 10 and len(rows) == 2 * 6 * 3
    for name, want in (("a.fits", np.where(image == image[4, 4], np.nan, image * 2.0 + 100)), ("b.FITS.gz", image.astype(float))):
        got = as_array(images.to_pixels(tiles.filter(F.col("filename") == name), ("filename",)), image.shape)
        np.testing.assert_array_equal(got, want)
    file = Counted(fits_bytes(image.astype(float)))
    cards, at, shape = source._image_unit(source._units(file, len(file.getbuffer())))
    file.count = 0
    np.testing.assert_array_equal(source.read_rows(file, cards, at, shape, 30, 2), image[30:32])
    assert file.count == 2 * 23 * 8
    plan = source.list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
