"""What several operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts travel to Python workers in batches of about this size.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column = "text") -> Column:
    """A text column whose nulls are empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def public_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file; it must lie at the same path on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


def bounded_batches(spark: SparkSession) -> None:
    """Bound what one batch to a Python worker holds, whatever the session had set.

    Sets only how rows are batched, which changes no result.
    """
    for name, value in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS)),
        ("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)),
    ):
        spark.conf.set(name, value)


#: Texts of a batch that are worked on at a time, so that temporary arrays stay small.
SLICE_BYTES = 1 << 20


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, list[bytes]]]:
    """Runs of ``column``'s texts as bytes (null: empty) with their first row, SLICE_BYTES at a time, about."""
    texts = batch.column(column).cast(pa.binary())
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    part = (np.cumsum(lengths) - lengths) // SLICE_BYTES
    starts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    for start, end in zip(starts, [*starts[1:], batch.num_rows]):
        yield start, [t or b"" for t in texts.slice(start, end - start).to_pylist()]


def release() -> None:
    """Give freed memory back to the machine, for workers go on to other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not this C library: memory is kept for reuse


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, releasing memory after each result and at the end."""

    @wraps(run)
    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch
            del batch
            release()
        release()

    return released


def runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple[int, ...], pa.RecordBatch]]:
    """Slices of sorted batches between changes of whole-number ``keys``, each with its key.

    A key whose rows lie in several batches comes in several slices on end.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        new[0] = True
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(new).tolist()
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield tuple(int(c[start]) for c in columns), batch.slice(start, end - start)


def matrix(vectors: pa.Array, dtype: type = np.float64) -> np.ndarray:
    """An array of rows from lists of one length."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 0)


def finite(vector: str) -> Column:
    """Whether a vector is there, has components and all of them are finite numbers."""
    numbers = F.col(vector).cast("array<double>")
    each = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(each & (F.size(numbers) > 0), F.lit(False))
