"""Token counts of documents in flat token files that have no index.

A flat file is nothing but ids of two or four bytes, each document followed by
the end-of-document id. Blocks of a file are read and searched on their own; a
prefix scan over the blocks then joins a document that lies across them.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage
from .bpe import byte_bpe, encoded, text_batches
from .common import bounded_batches, public_vocabulary
from .ranges import RangeReader, file_blocks, spread, write_bytes

#: The vocabulary's own end-of-document id. Texts cannot produce it here: its
#: string in a text is encoded as ordinary text.
END_ID = 50256

#: Bytes searched at a time.
BLOCK_BYTES = 4 << 20

# A key in the order files: whether it is null, itself, and the separator.
_KEY_BYTES = 1 + 8 + 2
_KEY_FIELDS = [("null", "u1"), ("key", "<i8"), ("end", "<u2")]


def _pack_key(key: int | None) -> bytes:
    return struct.pack("<Bq", key is None, key or 0)


def write_flat_tokens(
    documents: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    vocabulary: str | None = None,
) -> None:
    """Encode texts into flat files of 16-bit ids below ``path``/kind=tokens.

    Documents lie in the order in which tasks meet them, which no shuffle
    changes. Files of the same names below ``path``/kind=order list the keys in
    that order, written by the same tasks. A null text counts as empty; a null
    key stays null.
    """
    vocabulary = vocabulary or public_vocabulary()
    bounded_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary, special=False)
        if max(bpe.size - 1, end_id) >= 1 << 16:
            raise ValueError("this vocabulary does not fit 16-bit ids")
        met = 0
        for batch in batches:
            keys = batch.column("_key").to_pylist()
            for at, texts in text_batches(batch, "_text"):
                ids = [np.frombuffer(i, "<u4").astype("<u2").tobytes() for i in encoded(texts, bpe)]
                order = [_pack_key(k) for k in keys[at : at + len(texts)]]
                place = range(met, met + len(texts))
                met += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(["tokens"] * len(ids) + ["order"] * len(ids)),
                        pa.array([*place, *place], pa.int64()),
                        pa.array([*ids, *order], pa.binary()),
                    ],
                    ["kind", "met", "data"],
                )

    narrow = documents.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    rows = narrow.mapInArrow(run, "kind string, met bigint, data binary")
    rows = rows.sortWithinPartitions("kind", "met")
    write_bytes(rows, "data", path, np.array([end_id], "<u2").tobytes(), by="kind")


def count_tokens(
    spark: SparkSession, path: str, end_id: int = END_ID, width: int = 2, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Tokens of every document in the flat files below ``path``: (path, ordinal, n_tokens).

    Documents are numbered from 0 within a file; the end id does not count. Ids
    after the last end id are a document too. Empty documents count 0, and an
    empty file has none.
    """
    bounded_batches(spark)
    if block_bytes % width:
        raise ValueError("a block must hold whole ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = RangeReader()
        for batch in batches:
            for row in batch.to_pylist():
                if row["length"] % width:
                    raise ValueError(f"{row['path']} does not hold whole ids")
                data = reader.read(row["path"], row["offset"], row["size"])
                ends = np.flatnonzero(np.frombuffer(data, f"<u{width}") == end_id)
                ends = ends + row["offset"] // width
                last = row["offset"] + row["size"] == row["length"]
                if last and (not len(ends) or ends[-1] + 1 < row["length"] // width):
                    ends = np.append(ends, row["length"] // width)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["path"]]),
                        pa.array([row["block"]], pa.int64()),
                        pa.array([len(ends)], pa.int64()),
                        pa.array([int(ends[0]) if len(ends) else None], pa.int64()),
                        pa.array([int(ends[-1]) if len(ends) else None], pa.int64()),
                        pa.array([np.diff(ends) - 1], pa.list_(pa.int64())),
                    ],
                    ["path", "block", "n_ends", "first_end", "last_end", "inner"],
                )
        reader.close()

    blocks = spread(file_blocks(spark, path, block_bytes), 4)
    schema = "path string, block bigint, n_ends bigint, first_end bigint, last_end bigint, inner array<bigint>"
    found = stage(blocks.mapInArrow(run, schema), "token-blocks")
    # The scan: four numbers per block, each file on its own. The counts stay where they are until then.
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = found.select(
        "path",
        "block",
        F.coalesce(F.sum("n_ends").over(earlier), F.lit(0)).alias("_before"),
        F.coalesce(F.last("last_end", ignorenulls=True).over(earlier), F.lit(-1)).alias("_carry"),
    )
    carried = found.where("n_ends > 0").hint("merge").join(before, ["path", "block"])
    lengths = F.concat(F.array(F.col("first_end") - F.col("_carry") - 1), F.col("inner"))
    each = carried.select("path", "_before", F.posexplode(lengths).alias("_at", "n_tokens"))
    return each.select("path", (F.col("_before") + F.col("_at")).alias("ordinal"), "n_tokens")


def document_order(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Keys in the order of the flat files: (file, ordinal, key)."""
    bounded_batches(spark)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = RangeReader()
        for batch in batches:
            for row in batch.to_pylist():
                data = reader.read(row["path"], row["offset"], row["size"])
                fields = np.frombuffer(data, dtype=_KEY_FIELDS)
                first = row["offset"] // _KEY_BYTES
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["path"]] * len(fields)),
                        pa.array(np.arange(first, first + len(fields))),
                        pa.array(fields["key"], pa.int64(), mask=fields["null"] == 1),
                    ],
                    ["path", "ordinal", "key"],
                )
        reader.close()

    blocks = spread(file_blocks(spark, f"{path}/kind=order", _KEY_BYTES << 16), 4)
    return blocks.mapInArrow(run, "path string, ordinal bigint, key bigint").withColumnRenamed("key", key)


def document_token_counts(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Token count of every document written by ``write_flat_tokens``: (key, n_tokens)."""
    file = F.element_at(F.split("path", "/"), -1)
    counts = count_tokens(spark, f"{path}/kind=tokens").withColumn("_file", file).drop("path")
    keys = document_order(spark, path, key).withColumn("_file", file).drop("path")
    # Both sides grow with the data, however well their shuffle files compress.
    return keys.hint("merge").join(counts, ["_file", "ordinal"]).select(key, "n_tokens")
