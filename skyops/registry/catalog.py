"""Catalog, validation, sink and ingest queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from skyops.operators import catalog, quality
from skyops.plans import ingest, statistics
from skyops.registry import query
from skyops.registry.bindings import QUERY_SQL, RAW_SQL, query_catalog, raw_catalog, table
from skyops.schemas import RAW_COLUMNS, RUNS
from skyops.session import scratch_dir
from skyops.sinks import audit, export, upsert
from skyops.sources import catalog as source

# -- reference SQL fragments --------------------------------------------------

_STRIP = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
_RULES = [("pl_orbper", 0.0, None), ("pl_rade", 0.0, None), ("pl_bmasse", 0.0, None),
          ("pl_eqt", 0.0, None), ("st_teff", 0.0, 100000.0), ("st_rad", 0.0, None),
          ("st_mass", 0.0, None), ("sy_dist", 0.0, None), ("disc_year", 1900.0, 2100.0)]


def _reasons_sql() -> str:
    out = []
    for f in ("pl_name", "hostname"):
        out.append(f"CASE WHEN {f} IS NULL THEN 'Missing required field: {f}' "
                   f"WHEN trim({f}) = '' THEN 'Empty required field: {f}' END")
    for f, low, high in _RULES:
        out.append(f"CASE WHEN {f} <= {low} THEN '{f} must be > {low}, got ' "
                   f"|| CAST(CAST({f} AS DOUBLE) AS VARCHAR) END")
        if high is not None:
            out.append(f"CASE WHEN {f} > {high} THEN '{f} must be <= {high}, got ' "
                       f"|| CAST(CAST({f} AS DOUBLE) AS VARCHAR) END")
    return "list_filter([" + ", ".join(out) + "], lambda x: x IS NOT NULL)"


_CHECKED = f"raw AS ({RAW_SQL}), checked AS (SELECT *, {_reasons_sql()} AS reasons FROM raw)"
_ROUTED = f"""{_CHECKED}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY len(reasons) > 0, trim(pl_name) ORDER BY row_ord) AS rn
  FROM checked),
routed AS (SELECT *, CASE WHEN len(reasons) > 0 THEN 'invalid' WHEN rn > 1 THEN 'duplicate'
  ELSE 'valid' END AS outcome FROM ranked)"""
_CLEAN_COLS = """trim(pl_name) AS pl_name, trim(hostname) AS hostname,
  trim(discoverymethod) AS discovery_method, CAST(disc_year AS INTEGER) AS disc_year,
  pl_orbper AS orbital_period_days, pl_rade AS radius_earth, pl_rade / 11.209 AS radius_jupiter,
  pl_bmasse AS mass_earth, pl_bmasse / 317.828 AS mass_jupiter, pl_eqt AS equilibrium_temp_k,
  st_teff AS stellar_teff_k, st_rad AS stellar_radius_solar, st_mass AS stellar_mass_solar,
  sy_dist AS distance_pc, coalesce(pl_eqt >= 180 AND pl_eqt <= 310, false) AS is_habitable_zone"""
_Q = f"q AS ({QUERY_SQL})"


def _clean_out(df, *keep):
    """Clean columns with the two derived ratios rounded for comparison."""
    cols = [c for c in df.columns if c not in keep]
    return df.select(*keep, *[F.round(c, 9).alias(c) if c.endswith("_jupiter") else F.col(c)
                              for c in cols])


_CLEAN_OUT = _CLEAN_COLS.replace("pl_rade / 11.209", "round(pl_rade / 11.209, 9)").replace(
    "pl_bmasse / 317.828", "round(pl_bmasse / 317.828, 9)")


# -- validation --------------------------------------------------------------

@query("val_required", f"""WITH raw AS ({RAW_SQL}) SELECT row_ord, array_to_string(list_filter([
  CASE WHEN pl_name IS NULL THEN 'Missing required field: pl_name'
       WHEN trim(pl_name) = '' THEN 'Empty required field: pl_name' END,
  CASE WHEN hostname IS NULL THEN 'Missing required field: hostname'
       WHEN trim(hostname) = '' THEN 'Empty required field: hostname' END], lambda x: x IS NOT NULL),
  '; ') AS reasons FROM raw
  WHERE pl_name IS NULL OR hostname IS NULL OR trim(pl_name) = '' OR trim(hostname) = ''""")
def _(spark, sf):
    df = quality.with_reasons(raw_catalog(spark, sf), quality.required_reasons())
    return df.filter(F.size("reasons") > 0).select(
        "row_ord", F.concat_ws("; ", "reasons").alias("reasons"))


@query("val_ranges", f"WITH {_CHECKED} SELECT row_ord, array_to_string(list_filter(reasons, "
       "lambda x: contains(x, 'must be')), '; ') AS reasons FROM checked "
       "WHERE len(list_filter(reasons, lambda x: contains(x, 'must be'))) > 0")
def _(spark, sf):
    df = quality.with_reasons(raw_catalog(spark, sf), quality.range_reasons())
    return df.filter(F.size("reasons") > 0).select(
        "row_ord", F.concat_ws("; ", "reasons").alias("reasons"))


@query("val_route", f"WITH {_ROUTED} SELECT row_ord, outcome, "
       "array_to_string(reasons, '; ') AS reasons FROM routed")
def _(spark, sf):
    return quality.route(raw_catalog(spark, sf)).select(
        "row_ord", "outcome", F.concat_ws("; ", "reasons").alias("reasons"))


@query("val_query_ranges", f"""WITH {_Q}, r AS (SELECT pl_name, list_filter([
  CASE WHEN pl_name IS NULL THEN 'Missing required field: pl_name' END,
  CASE WHEN hostname IS NULL THEN 'Missing required field: hostname' END,
  CASE WHEN discovery_method IS NULL THEN 'Missing required field: discovery_method' END,
  CASE WHEN disc_year < 1900 THEN 'disc_year must be >= 1900' END,
  CASE WHEN disc_year > 2100 THEN 'disc_year must be <= 2100' END,
  CASE WHEN orbital_period <= 0 THEN 'orbital_period must be > 0' END,
  CASE WHEN pl_rade <= 0 THEN 'pl_rade must be > 0' END,
  CASE WHEN pl_bmasse <= 0 THEN 'pl_bmasse must be > 0' END,
  CASE WHEN pl_eqt <= 0 THEN 'pl_eqt must be > 0' END,
  CASE WHEN st_teff <= 0 THEN 'st_teff must be > 0' END,
  CASE WHEN st_rad <= 0 THEN 'st_rad must be > 0' END,
  CASE WHEN sy_dist <= 0 THEN 'sy_dist must be > 0' END,
  CASE WHEN ra < 0 THEN 'ra must be >= 0' END, CASE WHEN ra > 360 THEN 'ra must be <= 360' END,
  CASE WHEN "dec" < -90 THEN 'dec must be >= -90' END,
  CASE WHEN "dec" > 90 THEN 'dec must be <= 90' END], lambda x: x IS NOT NULL) AS reasons FROM q)
SELECT pl_name, array_to_string(reasons, '; ') AS reasons FROM r WHERE len(reasons) > 0""")
def _(spark, sf):
    reasons = quality.missing_reasons() + quality.bound_reasons()
    df = quality.with_reasons(query_catalog(spark, sf), reasons)
    return df.filter(F.size("reasons") > 0).select(
        "pl_name", F.concat_ws("; ", "reasons").alias("reasons"))


@query("win_first_by_key", f"WITH raw AS ({RAW_SQL}) SELECT trim(pl_name) AS name, "
       "min(row_ord) AS row_ord FROM raw WHERE pl_name IS NOT NULL GROUP BY 1")
def _(spark, sf):
    from skyops.functions.text import strip

    df = quality.first_by_key(raw_catalog(spark, sf), "pl_name", "row_ord")
    return df.select(strip(F.col("pl_name")).alias("name"), "row_ord")


@query("agg_validation_report", f"""WITH {_ROUTED} SELECT count(*) AS checked,
  count(*) FILTER (outcome = 'valid') AS valid, count(*) FILTER (outcome = 'invalid') AS invalid,
  count(*) FILTER (outcome = 'duplicate') AS duplicate,
  count(*) FILTER (outcome <> 'valid') AS failed FROM routed""")
def _(spark, sf):
    return quality.validation_report(quality.route(raw_catalog(spark, sf)))


@query("sample_invalid", f"WITH {_ROUTED} SELECT row_ord, pl_name, array_to_string(reasons, '; ') "
       "AS reasons FROM routed WHERE outcome = 'invalid' ORDER BY row_ord LIMIT 5")
def _(spark, sf):
    return quality.sample_invalid(quality.route(raw_catalog(spark, sf))).select(
        "row_ord", "pl_name", "reasons")


# -- transform ---------------------------------------------------------------

@query("xf_catalog", f"WITH {_ROUTED} SELECT row_ord, {_CLEAN_OUT} FROM routed "
       "WHERE outcome = 'valid'")
def _(spark, sf):
    rows = quality.valid_rows(raw_catalog(spark, sf))
    return _clean_out(catalog.transform(rows, ("row_ord",)), "row_ord")


@query("xf_units", f"WITH raw AS ({RAW_SQL}) SELECT row_ord, "
       "round(pl_rade / 11.209, 9) AS radius_jupiter, "
       "round(pl_bmasse / 317.828, 9) AS mass_jupiter FROM raw")
def _(spark, sf):
    return raw_catalog(spark, sf).select(
        "row_ord", F.round(catalog.radius_in_jupiter(F.col("pl_rade")), 9).alias("radius_jupiter"),
        F.round(catalog.mass_in_jupiter(F.col("pl_bmasse")), 9).alias("mass_jupiter"))


@query("xf_habitable", f"WITH {_Q} SELECT is_habitable_zone, count(*) AS n FROM "
       "(SELECT CASE WHEN pl_eqt >= 180 AND pl_eqt <= 310 THEN true ELSE false END "
       "AS is_habitable_zone FROM q) GROUP BY 1")
def _(spark, sf):
    flag = catalog.is_temperate(F.col("pl_eqt")).alias("is_habitable_zone")
    return query_catalog(spark, sf).groupBy(flag).agg(F.count(F.lit(1)).alias("n"))


@query("xf_strip", f"WITH raw AS ({RAW_SQL}) SELECT row_ord, "
       + ", ".join(f"{_STRIP.format(c=c)} AS {c}"
                   for c in ("pl_name", "hostname", "discoverymethod")) + " FROM raw")
def _(spark, sf):
    from skyops.functions.text import strip

    return raw_catalog(spark, sf).select(
        "row_ord", *[strip(F.col(c)).alias(c) for c in ("pl_name", "hostname", "discoverymethod")])


# -- filters, pages ------------------------------------------------------------

@query("flt_conjunctive", f"""WITH {_Q} SELECT pl_name, discovery_method, disc_year, pl_bmasse,
  pl_rade FROM q WHERE discovery_method = 'ECONOMY' AND disc_year >= 2000 AND disc_year <= 2015
  AND pl_bmasse >= 900 AND pl_bmasse <= 1050 AND pl_rade >= 5 AND pl_rade <= 30""")
def _(spark, sf):
    df = catalog.conjunctive_filter(
        query_catalog(spark, sf), discovery_method="ECONOMY", year_min=2000, year_max=2015,
        mass_min=900, mass_max=1050, radius_min=5, radius_max=30)
    return df.select("pl_name", "discovery_method", "disc_year", "pl_bmasse", "pl_rade")


@query("flt_search", f"""WITH {_Q} SELECT pl_name, hostname, discovery_method FROM q
  WHERE pl_name ILIKE '%r_d w%' OR hostname ILIKE '%r_d w%' OR discovery_method ILIKE '%r_d w%'
  ORDER BY pl_name LIMIT 20 OFFSET 10""")
def _(spark, sf):
    return catalog.search_page(query_catalog(spark, sf), "R_d W", 10, 20).select(
        "pl_name", "hostname", "discovery_method")


@query("flt_search_total", f"""WITH {_Q} SELECT count(*) AS total_count FROM q
  WHERE pl_name ILIKE '%brand#1%' OR hostname ILIKE '%brand#1%'
  OR discovery_method ILIKE '%brand#1%'""")
def _(spark, sf):
    return catalog.total(catalog.search(query_catalog(spark, sf), "brand#1"))


@query("flt_point", f"""WITH {_Q} SELECT pl_name, hostname, disc_year, ra IS NULL AS ra_dropped
  FROM q WHERE pl_name = (SELECT max(pl_name) FROM q WHERE ra IS NULL)""")
def _(spark, sf):
    df = query_catalog(spark, sf)
    name = df.filter(F.col("ra").isNull()).agg(F.max("pl_name")).first()[0]
    hit = catalog.point_lookup(df, name)
    field = lambda key: F.get_json_object("record", f"$.{key}")
    return hit.select("pl_name", field("hostname").alias("hostname"),
                      field("disc_year").cast("int").alias("disc_year"),
                      (~F.contains("record", F.lit('"ra"'))).alias("ra_dropped"))


@query("flt_in_list", f"""WITH {_Q} SELECT pl_name, hostname, discovery_method, disc_year,
  round(orbital_period, 2) AS orbital_period, round(pl_rade, 2) AS pl_rade,
  round(pl_bmasse, 2) AS pl_bmasse, round(pl_eqt, 2) AS pl_eqt, round(sy_dist, 2) AS sy_dist
  FROM q WHERE discovery_method IN ('SMALL', 'LARGE')""")
def _(spark, sf):
    return catalog.method_table(query_catalog(spark, sf), ["SMALL", "LARGE"])


@query("prj_mass_radius", f"""WITH {_Q} SELECT pl_name, discovery_method, pl_bmasse, pl_rade,
  round(CASE WHEN pl_bmasse > 0 THEN log10(pl_bmasse) END, 9) AS log_mass,
  round(CASE WHEN pl_rade > 0 THEN log10(pl_rade) END, 9) AS log_radius,
  CASE WHEN pl_bmasse <= 1 AND pl_rade <= 1 THEN 'earth-like'
       WHEN pl_bmasse >= 317.8 AND pl_rade >= 11.2 THEN 'jupiter-like' ELSE 'between' END AS regime
  FROM q WHERE pl_bmasse IS NOT NULL AND pl_rade IS NOT NULL""")
def _(spark, sf):
    return catalog.mass_radius(query_catalog(spark, sf)).withColumns(
        {c: F.round(c, 9) for c in ("log_mass", "log_radius")})


@query("prj_sky_map", f"""WITH {_Q} SELECT pl_name, discovery_method, ra, "dec",
  CASE WHEN ra > 180 THEN ra - 360 ELSE ra END AS ra_shifted
  FROM q WHERE ra IS NOT NULL AND "dec" IS NOT NULL""")
def _(spark, sf):
    return catalog.sky_map(query_catalog(spark, sf))


@query("page_sorted", f"""WITH {_Q} SELECT pl_name, discovery_method, pl_bmasse FROM q
  WHERE disc_year >= 1995 ORDER BY pl_bmasse DESC NULLS FIRST, pl_name ASC NULLS LAST
  LIMIT 20 OFFSET 40""")
def _(spark, sf):
    rows = catalog.conjunctive_filter(query_catalog(spark, sf), year_min=1995)
    return catalog.page(rows, "pl_bmasse", "desc", 40, 20).select(
        "pl_name", "discovery_method", "pl_bmasse")


# -- aggregates ------------------------------------------------------------------

@query("agg_total", f"WITH {_Q} SELECT count(*) AS total_count FROM q WHERE disc_year >= 2005")
def _(spark, sf):
    return catalog.total(catalog.conjunctive_filter(query_catalog(spark, sf), year_min=2005))


@query("agg_by_method", f"WITH {_Q} SELECT discovery_method AS method, count(*) AS count "
       "FROM q GROUP BY 1")
def _(spark, sf):
    return catalog.by_method(query_catalog(spark, sf))


@query("agg_by_year", f"WITH {_Q} SELECT disc_year AS year, count(*) AS count FROM q "
       "WHERE disc_year IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return catalog.by_year(query_catalog(spark, sf))


@query("agg_distributions", f"WITH {_Q} " + " UNION ALL ".join(
    f"SELECT '{p}' AS parameter, round(min({p}), 4) AS min_val, round(max({p}), 4) AS max_val, "
    f"round(avg({p}), 4) AS mean_val FROM q" for p in catalog.PARAMETERS))
def _(spark, sf):
    return catalog.distributions(query_catalog(spark, sf))


@query("agg_kpis", f"""WITH {_Q} SELECT count(*) AS total_planets,
  count(DISTINCT discovery_method) AS discovery_methods, count(DISTINCT hostname) AS host_stars,
  coalesce(min(disc_year) || '–' || max(disc_year), 'N/A') AS year_range FROM q""")
def _(spark, sf):
    return catalog.kpis(query_catalog(spark, sf))


_BIG = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("pipe_statistics", """WITH b AS (SELECT *, CAST(year(l_shipdate) AS INTEGER) AS y
  FROM lineitem)
SELECT 'total' AS section, 'all' AS item, count(*) AS count, CAST(NULL AS DOUBLE) AS min_val,
  CAST(NULL AS DOUBLE) AS max_val, CAST(NULL AS DOUBLE) AS mean_val FROM b
UNION ALL SELECT 'by_method', l_returnflag, count(*), NULL, NULL, NULL FROM b GROUP BY 2
UNION ALL SELECT 'by_year', CAST(y AS VARCHAR), count(*), NULL, NULL, NULL FROM b
  WHERE y IS NOT NULL GROUP BY 2 """ + " ".join(
    f"UNION ALL SELECT 'distribution', '{p}', NULL, round(min({p}), 4), round(max({p}), 4), "
    f"round(avg({p}), 4) FROM b" for p in _BIG))
def _(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("y", F.year("l_shipdate"))
    return statistics.statistics_long(rows, _BIG, "l_returnflag", "y")


# -- sources -----------------------------------------------------------------------

@query("src_catalog_json", f"WITH raw AS ({RAW_SQL}) SELECT "
       + ", ".join(f"CAST({c} AS INTEGER) AS {c}" if c == "disc_year" else c
                   for c in RAW_COLUMNS) + " FROM raw")
def _(spark, sf):
    path = scratch_dir(spark, "raw-json")
    raw_catalog(spark, sf).withColumn("unknown_key", F.lit(1)).write.json(path)
    good, _bad = source.split_quarantine(source.read_catalog_json(spark, path, multi_line=False))
    return good


@query("src_catalog_select", f"""WITH raw AS ({RAW_SQL}) SELECT pl_name, hostname,
  CAST(disc_year AS INTEGER) AS disc_year FROM raw WHERE default_flag = 1""")
def _(spark, sf):
    return catalog.source_query(raw_catalog(spark, sf)).select(
        "pl_name", "hostname", F.col("disc_year").cast("int").alias("disc_year"))


@query("src_catalog_table", f"WITH {_Q} SELECT " + ", ".join(
    f'"{c}" AS "{shown}"' for c, shown in catalog.DISPLAY_NAMES.items()) + " FROM q")
def _(spark, sf):
    path = scratch_dir(spark, "catalog")
    query_catalog(spark, sf).write.parquet(path)
    return catalog.display_table(source.read_catalog_table(spark, path))


# -- sinks -------------------------------------------------------------------------

_T0 = dt.datetime(2024, 1, 1)
_T1 = dt.datetime(2024, 2, 1)


def _stored_slice(spark, sf, cond):
    raw = raw_catalog(spark, sf).filter(cond).withColumn(
        "pl_name", F.concat_ws(" ", F.lit("obj"), F.col("row_ord").cast("string")))
    return catalog.transform(raw)


@query("sink_upsert", f"""WITH raw AS ({RAW_SQL})
SELECT 'obj ' || row_ord AS pl_name, trim(hostname) AS hostname,
  CASE WHEN again THEN mass2 ELSE pl_bmasse END AS mass_earth,
  CASE WHEN again THEN 'run-2' ELSE 'run-1' END AS run_id,
  CASE WHEN row_ord % 2 = 0 THEN '2024-01-01' ELSE '2024-02-01' END AS ingested_on,
  CASE WHEN again THEN '2024-02-01' ELSE '2024-01-01' END AS updated_on
FROM (SELECT *, CASE WHEN row_ord % 9 = 0 THEN NULL ELSE pl_bmasse * 2 END AS mass2,
  row_ord % 3 = 0 OR row_ord % 2 = 1 AS again FROM raw)""")
def _(spark, sf):
    path = scratch_dir(spark, "catalog")
    first = upsert.stamp(_stored_slice(spark, sf, "row_ord % 2 = 0"), "run-1",
                         F.lit(_T0).cast("timestamp"))
    second = _stored_slice(spark, sf, "row_ord % 3 = 0 OR row_ord % 2 = 1").withColumn(
        "mass_earth", F.when(F.split_part("pl_name", F.lit(" "), F.lit(2)).cast("long") % 9 != 0,
                             F.col("mass_earth") * 2))
    second = upsert.stamp(second, "run-2", F.lit(_T1).cast("timestamp"))
    for rows, seq in ((first, 1), (second, 2), (first, 1)):  # the first comes again and changes nothing
        upsert.write_upsert(rows, path, seq)
    return upsert.read_table(spark, path).select(
        "pl_name", "hostname", "mass_earth", "run_id",
        F.date_format("ingested_at", "yyyy-MM-dd").alias("ingested_on"),
        F.date_format("updated_at", "yyyy-MM-dd").alias("updated_on"))


@query("join_upsert", """SELECT coalesce(c.c_custkey, o.o_custkey) AS k,
  coalesce(c.c_name, 'new') AS kept, CASE WHEN o.o_custkey IS NOT NULL THEN o.n ELSE 0 END AS n
FROM customer c FULL OUTER JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o
ON c.c_custkey = o.o_custkey""")
def _(spark, sf):
    old = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_name").alias("kept"),
        F.lit(0).cast("long").alias("n"))
    new = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(
        F.lit("new").alias("kept"), F.count(F.lit(1)).alias("n"))
    return upsert.merge(old, new, "k", ("kept",))


def _runs(spark, sf):
    """One run per order: started on the order date, an hour long, a few left open."""
    o = table(spark, sf, "orders")
    start = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp"))
                               + F.col("o_orderkey") * 1000)
    n = F.col("o_custkey")
    return o.select(
        F.col("o_orderkey").cast("string").alias("run_id"), start.alias("started_at"),
        F.when(F.col("o_orderkey") % 50 != 0, start + F.expr("INTERVAL 90 SECONDS"))
        .alias("completed_at"),
        F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "P",
                                                            "dry_run")
        .otherwise("success").alias("status"),
        n.alias("records_extracted"), n.alias("records_validated"),
        F.lit(0).cast("long").alias("records_failed_validation"),
        n.alias("records_transformed"), n.alias("records_loaded"),
        F.lit(None).cast("string").alias("error_message"))


_RUNS_SQL = """runs AS (SELECT CAST(o_orderkey AS VARCHAR) AS run_id,
  epoch_us(o_orderdate) + o_orderkey * 1000 AS us, o_orderkey, o_custkey AS records_loaded,
  CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'P' THEN 'dry_run' ELSE 'success' END AS status
  FROM orders)"""


@query("sink_run_audit", f"""WITH {_RUNS_SQL} SELECT status, count(*) AS runs,
  CAST(sum(records_loaded) AS BIGINT) AS loaded FROM runs GROUP BY 1""")
def _(spark, sf):
    path = scratch_dir(spark, "runs")
    runs = _runs(spark, sf)
    for status in ("success", "failed", "dry_run"):
        audit.append_runs(runs.filter(F.col("status") == status), path)
    return spark.read.schema(RUNS).parquet(path).groupBy("status").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("records_loaded").alias("loaded"))


@query("top_recent_runs", f"WITH {_RUNS_SQL} SELECT run_id, status, us AS started_us FROM runs "
       "ORDER BY us DESC, run_id LIMIT 10")
def _(spark, sf):
    return audit.recent_runs(_runs(spark, sf)).select(
        "run_id", "status", F.unix_micros("started_at").alias("started_us"))


@query("agg_run_summary", f"""WITH {_RUNS_SQL} SELECT status, count(*) AS runs,
  count(*) FILTER (o_orderkey % 50 = 0) AS still_open,
  CAST(count(*) FILTER (o_orderkey % 50 <> 0) * 90 AS DOUBLE) AS seconds,
  CAST(sum(records_loaded) AS BIGINT) AS loaded FROM runs GROUP BY 1""")
def _(spark, sf):
    runs = audit.with_duration(_runs(spark, sf))
    return runs.groupBy("status").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("duration_seconds").isNull()).alias("still_open"),
        F.sum("duration_seconds").alias("seconds"), F.sum("records_loaded").alias("loaded"))


@query("sink_seed_if_empty", "SELECT 'empty' AS target, count(*) AS inserted FROM customer "
       "UNION ALL SELECT 'filled', 0")
def _(spark, sf):
    seed = table(spark, sf, "customer").select("c_custkey")
    filled = table(spark, sf, "supplier").select("s_suppkey")
    count = F.count(F.lit(1)).alias("inserted")
    return (upsert.seed_if_empty(filled.limit(0), seed).agg(count)
            .select(F.lit("empty").alias("target"), "inserted")
            .unionByName(upsert.seed_if_empty(filled, seed).agg(count)
                         .select(F.lit("filled").alias("target"), "inserted")))


_EXPORT_ORACLE = f'WITH {_Q} SELECT * FROM q'


@query("sink_export_csv", _EXPORT_ORACLE)
def _(spark, sf):
    path = scratch_dir(spark, "csv")
    export.write_csv(query_catalog(spark, sf), path)
    return export.read_csv(spark, path)


@query("sink_export_json", _EXPORT_ORACLE)
def _(spark, sf):
    path = scratch_dir(spark, "json")
    export.write_json(query_catalog(spark, sf), path)
    return export.read_json(spark, path)


@query("sink_export_votable", _EXPORT_ORACLE)
def _(spark, sf):
    path = scratch_dir(spark, "votable")
    export.write_votable(query_catalog(spark, sf), path)
    return export.read_votable(spark, path)


# -- ingest ------------------------------------------------------------------------

@query("pipe_ingest", f"""WITH {_ROUTED}, n AS (SELECT count(*) AS records_extracted,
  count(*) FILTER (outcome = 'valid') AS records_validated, count(*) FILTER (outcome <> 'valid') AS records_failed_validation,
  count(*) FILTER (outcome = 'valid') AS records_transformed, count(*) FILTER (outcome = 'valid') AS records_loaded FROM routed)
SELECT {_CLEAN_OUT}, 'run-1' AS run_id, 'success' AS status, records_extracted, records_validated, records_failed_validation,
  records_transformed, records_loaded FROM routed, n WHERE outcome = 'valid'""")
def _(spark, sf):
    """The stored catalog, each row with the audit record of the run that wrote it."""
    path = scratch_dir(spark, "ingest")
    raw = raw_catalog(spark, sf).withColumn("disc_year", F.col("disc_year").cast("int"))
    ingest.ingest(raw, f"{path}/catalog", f"{path}/runs", 1, run_id="run-1")
    stored = _clean_out(upsert.read_table(spark, f"{path}/catalog").drop("ingested_at", "updated_at"))
    runs = spark.read.schema(RUNS).parquet(f"{path}/runs").drop("started_at", "completed_at", "error_message")
    return stored.join(runs, "run_id")


@query("pipe_validate_only", f"""WITH {_ROUTED} SELECT 'validated' AS status,
  count(*) AS extracted, count(*) FILTER (outcome = 'valid') AS validated,
  count(*) FILTER (outcome <> 'valid') AS failed FROM routed""")
def _(spark, sf):
    run, routed = ingest.validate_only(raw_catalog(spark, sf))
    report = quality.validation_report(routed)
    assert run["records_extracted"] == run["records_validated"] + run["records_failed_validation"]
    return report.select(F.lit(run["status"]).alias("status"), F.col("checked").alias("extracted"),
                         F.col("valid").alias("validated"), "failed")
