"""Sliding-window request limiting on a stream.

A micro-batch is decided by the batch operator, which sorts and streams the hits of a busy client
through a task and never holds them: the last accepted times of its clients come before its hits. What is
stored is those times, at most M a client, in a bucketed table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyops.operators import ratelimit
from skyops.operators.ratelimit import DEFAULT_MAX, DEFAULT_WINDOW
from skyops.session import cut_lineage
from skyops.sinks import upsert

#: ``times``: the last accepted ones; ``before``: those before batch ``done`` - 1, so that it can be decided again.
STATE = "client string, times array<bigint>, before array<bigint>, done bigint"
DECISIONS = "seq bigint, client string, accepted boolean"


def limit_batches(out: str, state: str, client: str = "client", ts: str = "ts", seq: str = "event_id",
                  max_requests: int = DEFAULT_MAX, window_seconds: int = DEFAULT_WINDOW,
                  buckets: int = upsert.BUCKETS) -> Callable[[DataFrame, int], None]:
    """Per-batch function: writes (seq, client, accepted) of every hit below ``out``.

    Hits of a batch are decided in time order. A hit that comes in a later batch than its time is decided by what
    was accepted by then. A repeated batch gives the same decisions and leaves the same state.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, n = batch.sparkSession, batch_id + 1
        hits = cut_lineage(batch.select(F.col(client).cast("string").alias("client"), F.unix_micros(ts).alias("us"),
                                        F.col(seq).cast("bigint").alias("seq"), F.lit(False).alias("known")))
        clients = hits.select(F.col("client").alias("_client")).distinct()
        stored = upsert.read_table(spark, state, STATE).join(clients, F.col("client").eqNullSafe(F.col("_client")), "left_semi")
        past = cut_lineage(stored.select("client", F.when(F.col("done") >= n, F.col("before")).otherwise(F.col("times")).alias("before")))
        earlier = past.select("client", F.explode("before").alias("us"), F.lit(-1).cast("bigint").alias("seq"), F.lit(True).alias("known"))
        rows = hits.unionByName(earlier).withColumn("ts", F.timestamp_micros("us"))
        decided = cut_lineage(ratelimit.decide(rows, "client", "ts", "seq", max_requests, window_seconds))
        decided.where(~F.col("known")).select("seq", "client", "accepted").write.mode("overwrite").parquet(f"{out}/b={batch_id:012d}")
        latest = Window.partitionBy("client").orderBy(F.desc("us"), F.desc("seq"))
        last = decided.where("accepted").select("client", "us", F.row_number().over(latest).alias("k")).where(F.col("k") <= max_requests)
        times = last.groupBy("client").agg(F.sort_array(F.collect_list("us")).alias("times"))  # at most M a client
        none = F.array().cast("array<bigint>")
        old = past.select(F.col("client").alias("_client"), "before")
        new = times.join(old, F.col("client").eqNullSafe(F.col("_client")), "left").select("client", "times", F.coalesce("before", none).alias("before"), F.lit(n).cast("bigint").alias("done"))
        upsert.write_upsert(new, state, n, "client", STATE, (), buckets)

    return write


def read_decisions(spark, out: str) -> DataFrame:
    return spark.read.schema(DECISIONS).parquet(f"{out}/b=*")
