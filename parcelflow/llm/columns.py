"""Small helpers the operators share: reading tables, Arrow text columns, folds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text that one step inside a task works on.
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(folds: int) -> Column:
    """crc32 of doc_id as text, modulo ``folds``; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end, and where each text starts; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], (at - at[0]).astype(np.int64)


def by_bytes(batches: Iterator[pa.RecordBatch], name: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of the named texts, or one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or the first of ``wanted_1``, ``wanted_2`` … that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (wanted, *(f"{wanted}_{k}" for k in range(1, len(taken) + 2))) if n.lower() not in taken)


def with_texts_mapped(df: DataFrame, into: str, kind: str, start: Callable[[], Callable[[pa.RecordBatch], pa.Array]], drop: tuple[str, ...] = (), step: int = STEP_BYTES) -> DataFrame:
    """``df`` with a column that an Arrow function makes from its rows, about ``step`` bytes of ``text`` at a time.

    ``start`` is called once per task and gives the function. Columns in ``drop``
    are not returned; all others pass through unchanged. ``into`` must be a name that
    none of these has, see :func:`free_name`.
    """
    kept = [f for f in df.schema.fields if f.name not in drop]
    if into.lower() in {f.name.lower() for f in kept}:
        raise ValueError(f"there is a column {into!r} already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for batch in by_bytes(batches, "text", step):
            made = make(batch)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), made], [*(f.name for f in kept), into])

    return df.mapInArrow(run, StructType([*kept, *StructType.fromDDL(f"{into} {kind}")]))
