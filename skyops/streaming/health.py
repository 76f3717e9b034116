"""Latest check results of a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyops.operators import health
from skyops.sinks import upsert


def latest_results_table(path: str, schema: str, keys: Sequence[str], order: str,
                         buckets: int = upsert.BUCKETS) -> Callable[[DataFrame, int], None]:
    """A per-batch function that keeps the latest result, by ``order``, of each (keys, check)."""

    def newest(old: Column, new: Column) -> dict[str, Column]:
        late = old.isNotNull() & (old[order] > new[order])
        names = [c.split()[0].strip("`") for c in schema.split(", ")]
        return {c: F.when(late, old[c]).otherwise(new[c]) for c in names}

    def write(batch: DataFrame, batch_id: int) -> None:
        latest = health.latest_results(batch, keys, (order,))
        upsert.write_upsert(latest, path, batch_id + 1, [*keys, "check"], schema, (), buckets, newest)

    return write
