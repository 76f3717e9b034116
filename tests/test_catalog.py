import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from skyops.operators import catalog, quality
from skyops.plans import ingest
from skyops.schemas import RAW_CATALOG, RUNS, STORED_CATALOG
from skyops.session import scratch_dir
from skyops.sinks import audit, export, upsert
from skyops.sources import catalog as source


def raw(spark, *rows):
    base = {"pl_name": "n", "hostname": "h", "pl_rade": 1.0}
    names = [c.split()[0] for c in RAW_CATALOG.split(", ")]
    data = [(i, *[{**base, **r}.get(c) for c in names]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "row_ord long, " + RAW_CATALOG)


def outcomes(df):
    return {r.row_ord: (r.outcome, list(r.reasons)) for r in quality.route(df).collect()}


def test_duplicates_by_stripped_name(spark):
    got = outcomes(raw(spark, {"pl_name": "A b"}, {"pl_name": "A b "}, {"pl_name": "C"}))
    assert [got[i][0] for i in range(3)] == ["valid", "duplicate", "valid"]


def test_invalid_row_never_claims_the_name(spark):
    got = outcomes(raw(spark, {"pl_name": "A", "pl_rade": 0.0}, {"pl_name": "A"}))
    assert got[0] == ("invalid", ["pl_rade must be > 0.0, got 0.0"])
    assert got[1][0] == "valid"


def test_reasons_of_bad_rows(spark):
    got = outcomes(raw(spark, {"pl_name": None, "hostname": "\t "}, {"disc_year": 1900},
                       {"st_teff": 2e5}, {"pl_orbper": float("nan")}, {"pl_orbper": -1e-5},
                       {"disc_year": 1901}))
    assert got[0][1] == ["Missing required field: pl_name", "Empty required field: hostname"]
    assert got[1][1] == ["disc_year must be > 1900.0, got 1900.0"]
    assert got[2][1] == ["st_teff must be <= 100000.0, got 200000.0"]
    assert got[3][0] == "valid"
    assert got[4][1] == ["pl_orbper must be > 0.0, got -1e-05"]
    assert got[5][0] in ("valid", "duplicate")


def test_non_numeric_text(spark):
    df = spark.createDataFrame([(0, "n", "h", "abc")], "row_ord long, pl_name string, "
                               "hostname string, pl_rade string")
    rows = quality.with_reasons(df, quality.range_reasons([("pl_rade", 0.0, None)])).collect()
    assert rows[0].reasons == ["Non-numeric value for pl_rade: 'abc'"]


def test_temperate_bounds_inclusive(spark):
    df = spark.createDataFrame([(t,) for t in (179.9, 180.0, 310.0, 310.1, None)], "t double")
    got = [r[0] for r in df.select(catalog.is_temperate(F.col("t"))).collect()]
    assert got == [False, True, True, False, False]


def test_valid_rows_equals_route(spark):
    df = raw(spark, *[{"pl_name": f"n{i % 7} ", "pl_rade": float(i % 5)} for i in range(100)])
    want = {k for k, v in outcomes(df).items() if v[0] == "valid"}
    assert {r.row_ord for r in quality.valid_rows(df).collect()} == want


@pytest.fixture(scope="module")
def five(spark):
    rows = [("Test-1 b", "Test-1", "Transit", 2018, 3.0, 1.0, 5.0),
            ("Test-2 b", "Test-2", "Transit", 2020, 30.0, None, 120.0),
            ("Test-3 b", "Test-3", "Imaging", 2022, None, 12.0, None),
            ("Other a", "Other", "Radial Velocity", 1999, 9.0, 2.0, 480.5),
            ("Far_100% c", "Far", "Transit", None, 1.0, 4.0, 900.0)]
    df = spark.createDataFrame(rows, "pl_name string, hostname string, discovery_method string, "
                               "disc_year int, orbital_period double, pl_rade double, "
                               "pl_bmasse double")
    return df.withColumns({c: F.lit(1.0) for c in
                           ("pl_eqt", "st_teff", "st_rad", "sy_dist", "ra", "dec")})


def test_filters(five):
    assert catalog.conjunctive_filter(five, year_min=2018, year_max=2022).count() == 3
    assert catalog.conjunctive_filter(five, mass_min=100, mass_max=500).count() == 2
    assert catalog.conjunctive_filter(five).count() == 5


def test_search_pages(five):
    assert catalog.total(catalog.search(five, "test")).first()[0] == 3
    names = [r.pl_name for r in catalog.search_page(five, "Test", 1, 1).collect()]
    assert names == ["Test-2 b"]
    assert catalog.search(five, "t_st-3").count() == 1
    assert catalog.search(five, "%").count() == 5


def test_page_order_and_errors(five):
    up = [r.pl_bmasse for r in catalog.page(five, "pl_bmasse").collect()]
    down = [r.pl_bmasse for r in catalog.page(five, "pl_bmasse", "desc").collect()]
    assert up == [5.0, 120.0, 480.5, 900.0, None] and down == up[::-1]
    for bad in ({"sort_by": "id"}, {"limit": 0}, {"limit": 101}, {"offset": -1},
                {"sort_order": "up"}):
        with pytest.raises(ValueError):
            catalog.page(five, **bad)


def test_empty_statistics(five):
    none = five.limit(0)
    assert catalog.kpis(none).first().year_range == "N/A"
    assert all(r.min_val is None for r in catalog.distributions(none).collect())


def test_point_lookup_drops_nulls(five):
    text = catalog.point_lookup(five, "Test-3 b").first().record
    assert "orbital_period" not in text and '"pl_rade":12.0' in text
    assert catalog.point_lookup(five, "none").count() == 0


def test_json_source_quarantines(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"pl_name": "A", "x": 1}, {"pl_name": "B", "disc_year": "z"}]')
    good, bad = source.split_quarantine(
        source.read_catalog_json(spark, str(tmp_path)).cache())
    assert [r.pl_name for r in good.collect()] == ["A"] and bad.count() == 1


def test_missing_table_is_empty(spark, tmp_path):
    assert source.read_catalog_table(spark, str(tmp_path / "none")).count() == 0


def test_votable_documents_are_whole(spark, five, tmp_path):
    import xml.etree.ElementTree as et

    path = str(tmp_path / "v")
    export.write_votable(five.withColumn("hostname", F.lit("a<b&c>")).repartition(3), path)
    rows = 0
    for f in (tmp_path / "v").glob("part-*"):
        root = et.fromstring(f.read_text())
        trs = root.findall(".//{*}TR")
        rows += len(trs)
        assert len(root.findall(".//{*}FIELD")) == 13
        assert all(t.findall("{*}TD")[1].text == "a<b&c>" for t in trs)
    assert rows == 5


def test_ingest_upsert_and_audit(spark):
    path = scratch_dir(spark, "t")
    first = raw(spark, {"pl_name": "A"}, {"pl_name": "B"}, {"pl_name": "A"}, {"pl_rade": -1.0})
    t0, t1 = (F.lit(dt.datetime(2024, m, 1)).cast("timestamp") for m in (1, 2))
    run = ingest.ingest(first, f"{path}/c", f"{path}/r", 1, now=t0)
    assert (run["status"], run["records_loaded"], run["records_failed_validation"]) == (
        "success", 2, 2)
    ingest.ingest(raw(spark, {"pl_name": "B", "pl_rade": None}), f"{path}/c", f"{path}/r", 2,
                  run_id="two", now=t1)
    rows = {r.pl_name: r for r in upsert.read_table(spark, f"{path}/c").collect()}
    assert rows["B"].run_id == "two" and rows["B"].radius_earth is None
    assert rows["B"].ingested_at.month == 1 and rows["B"].updated_at.month == 2
    assert rows["A"].updated_at.month == 1
    dry = ingest.ingest(first, f"{path}/c", f"{path}/r", 3, dry_run=True)
    assert dry["status"] == "dry_run" and dry["records_loaded"] == 0
    with pytest.raises(Exception):
        ingest.ingest(first.drop("hostname"), f"{path}/c", f"{path}/r", 3)
    runs = spark.read.schema(RUNS).parquet(f"{path}/r")
    assert sorted(r.status for r in runs.collect()) == ["dry_run", "failed", "success", "success"]
    assert audit.recent_runs(runs, 1).first().status == "failed"


def files_of(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in pathlib.Path(path).rglob("part-*")}


def test_a_write_touches_the_buckets_it_meets(spark, tmp_path):
    path = str(tmp_path / "t")
    now = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp")
    many = upsert.stamp(catalog.transform(raw(spark, *({"pl_name": f"p{k}"} for k in range(200)))), "r", now)
    assert len(upsert.write_upsert(many, path, 1)) == upsert.BUCKETS
    before = files_of(path)
    one = many.where("pl_name = 'p7'").withColumns({"mass_earth": F.lit(9.0), "run_id": F.lit("s"), "ingested_at": F.current_timestamp()})
    assert len(upsert.write_upsert(one, path, 2)) == 1
    after = files_of(path)
    assert len({f.split("/")[0] for f in before.keys() ^ after.keys()}) == 1
    rows = {r.pl_name: r for r in upsert.read_table(spark, path).collect()}
    assert len(rows) == 200 and rows["p7"].mass_earth == 9.0 and rows["p7"].ingested_at == dt.datetime(2024, 1, 1)
    # a repeated write, and one that comes after a later one, change nothing
    upsert.write_upsert(one.withColumn("mass_earth", F.lit(1.0)), path, 2)
    upsert.write_upsert(many, path, 1)
    assert {r.pl_name: r for r in upsert.read_table(spark, path).collect()} == rows
    assert upsert.write_upsert(many.limit(0), path, 3) == []


def test_keys_of_several_columns_and_nulls(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "a string, b int, v array<int>, w double"
    write = lambda rows, seq, **kw: upsert.write_upsert(spark.createDataFrame(rows, schema), path, seq, ["a", "b"], schema, (), 4, **kw)
    assert upsert.read_table(spark, path, schema).collect() == []
    write([("x", 1, [1], 1.0), (None, 1, [2], 2.0), ("x", None, None, 3.0)], 1)
    write([(None, 1, [3], 5.0), ("y", 1, [4], 4.0)], 2, combine=lambda o, n: {"w": F.coalesce(o["w"], F.lit(0.0)) + n["w"]})
    got = sorted(map(tuple, upsert.read_table(spark, path, schema).collect()), key=str)
    assert got == sorted([("x", 1, [1], 1.0), (None, 1, [3], 7.0), ("x", None, None, 3.0), ("y", 1, [4], 4.0)], key=str)


def test_seed_only_into_an_empty_table(spark):
    seed, target = spark.range(5), spark.createDataFrame([], STORED_CATALOG)
    assert upsert.seed_if_empty(target, seed).count() == 5
    assert upsert.seed_if_empty(seed, seed).count() == 0
    assert target.columns == upsert.stamp(catalog.transform(raw(spark, {"pl_name": "A"})), "r").columns


def test_deep_pages_equal_shallow_ones(spark, five, monkeypatch):
    many = five.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(60)))).withColumn(
        "pl_name", F.concat("pl_name", F.lit(" "), F.col("k").cast("string"))).drop("k").repartition(4)
    for offset, order in ((0, "asc"), (37, "desc"), (290, "asc"), (305, "asc"), (400, "desc")):
        want = catalog.page(many, "pl_bmasse", order, offset, 20).collect()
        with monkeypatch.context() as m:
            m.setattr(catalog, "DEEP_PAGE", 0)
            assert catalog.page(many, "pl_bmasse", order, offset, 20).collect() == want
