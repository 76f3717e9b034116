"""Adding columns to a DataFrame by Arrow batches, in slices of bounded text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

SLICE_BYTES = 1 << 20


def slices(values: pa.Array | pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of texts and lists each, or of one row that is longer."""
    start = size = 0
    for i, n in enumerate(row_bytes(values)):
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if len(values) > start:
        yield start, len(values)


def row_bytes(values: pa.Array | pa.RecordBatch) -> list[int]:
    """About how many bytes the texts and lists of each row have."""
    total = np.zeros(len(values), np.int64)
    for column in values.columns if isinstance(values, pa.RecordBatch) else [values]:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) or pa.types.is_binary(column.type):
            total += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        elif pa.types.is_list(column.type):
            total += 8 * pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return total.tolist()


def append(df: DataFrame, fields: list[StructField], make: Callable[[], Callable]) -> DataFrame:
    """``df`` with ``fields`` added; they replace columns of the same names.

    ``make()`` runs once in each task and returns ``fn(batch) -> list of arrays``; a batch is a slice.
    """
    kept = df.drop(*(f.name for f in fields))
    out = StructType([*kept.schema.fields, *fields])
    names = out.fieldNames()

    def run(batches):
        fn = make()
        for whole in batches:
            for start, end in slices(whole):
                b = whole.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([*b.columns, *fn(b)], names=names)

    return kept.mapInArrow(run, out)
