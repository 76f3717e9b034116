"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from skyops.operators import catalog, health
from skyops.registry.bindings import events, table
from skyops.schemas import QUERY_CATALOG
from skyops.session import scratch_dir

SF = "/root/testdata/sf0.001"


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "1000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "val_route", "xf_catalog", "win_trailing_stats", "win_trailing_global",
    "win_alert_transitions", "agg_gauge", "agg_drift", "join_rules", "join_cone",
    "agg_master_flat", "join_calibrate", "join_calibrate_tiles", "pipe_reduce_stack", "agg_stack_sigma_clip",
    "agg_stack_sigma_clip_tiles", "img_interval_zscale", "secret_scan"])
def test_no_cross_join_and_no_row_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in text


def test_filters_and_columns_reach_the_scan(spark):
    path = scratch_dir(spark, "catalog")
    spark.createDataFrame([], QUERY_CATALOG).write.parquet(path)
    df = spark.read.parquet(path)
    rows = catalog.conjunctive_filter(df, discovery_method="Transit", year_min=2000)
    text = plan(catalog.total(rows))
    assert "EqualTo(discovery_method,Transit)" in text
    assert "GreaterThanOrEqual(disc_year,2000)" in text
    assert "pl_bmasse" not in text


def test_page_is_a_top_k(spark):
    df = table(spark, SF, "part").select(F.col("p_name").alias("pl_name"),
                                         F.col("p_retailprice").alias("pl_bmasse"))
    assert "TakeOrderedAndProject" in plan(catalog.page(df, "pl_bmasse", "desc", 10, 5))


def test_top_k_per_group_is_pruned_before_the_shuffle(spark):
    rows = events(spark, SF).selectExpr("user_id AS host", "event_id AS pid", "value AS cpu")
    assert "WindowGroupLimit" in plan(health.top_processes(rows, ["host"]))


def test_statistics_scan_once(spark):
    text = plan(entry.queries()["pipe_statistics"](spark, SF))
    assert text.count("FileScan parquet") == 1


def test_scratch_follows_the_session_setting(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_shuffle_files_go_with_the_write(spark):
    """What a write shuffled is gone soon after it, without the driver's garbage collection; the setting is as before."""
    import time
    from concurrent.futures import ThreadPoolExecutor
    from pathlib import Path

    from skyops.session import cut_lineage

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {f for d in disk.localDirs() for f in Path(d.getPath()).rglob("shuffle_*.data")}
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = held(), spark.conf.get(name)
    rows = spark.range(10_000).withColumn("k", F.col("id") % 100)
    with ThreadPoolExecutor(4) as pool:
        counted, *_ = pool.map(cut_lineage, [rows.groupBy("k").count().join(rows, "k").repartition(n, "id") for n in (3, 4, 5, 6)])
    end = time.time() + 20
    while held() - before and time.time() < end:
        time.sleep(0.1)
    assert not held() - before
    assert spark.conf.get(name) == setting
    assert counted.where("count = 100").count() == 10_000
