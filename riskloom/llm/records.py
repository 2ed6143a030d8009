"""Token sequences in length-delimited binary records, with an offset index.

A record is

    length of the payload     8 bytes
    masked CRC-32 of those    4 bytes
    payload
    masked CRC-32 of it       4 bytes
    guard                     1 byte, a line feed

and its payload is one flag byte (1: the key is null), the key (8 bytes,
signed), the width of an id (1 byte) and the ids. All numbers are little-endian.
A checksum is rotated and shifted before it is stored, so that checksums of data
that hold checksums stay meaningful.

Files follow each other in key order, as do the records within one. The index is
made from the written files, so it holds for whatever copy of a task was kept.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage
from .bpe import byte_bpe, encoded, text_batches
from .common import bounded_batches, public_vocabulary, release
from .ranges import RangeReader, file_blocks, spread, write_bytes

GUARD = b"\n"

#: Documents in one file, about.
ROWS_PER_FILE = 4096

_HEAD = struct.Struct("<QI")
_KEY = struct.Struct("<BqB")
_CRC = struct.Struct("<I")
_AROUND = _HEAD.size + _CRC.size + len(GUARD)

#: Bytes of neighbouring records that one read fetches.
_READ_BYTES = 4 << 20


def masked(crc: int) -> int:
    """A checksum as it is stored: turned right by 15 bits, plus a constant."""
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def pack_record(key: int | None, ids: bytes, width: int) -> bytes:
    """One record, without its guard, of 32-bit ``ids`` stored in ``width`` bytes each."""
    body = np.frombuffer(ids, dtype="<u4").astype(f"<u{width}").tobytes()
    payload = _KEY.pack(key is None, key or 0, width) + body
    length = struct.pack("<Q", len(payload))
    return b"".join(
        [length, _CRC.pack(masked(zlib.crc32(length))), payload, _CRC.pack(masked(zlib.crc32(payload)))]
    )


def record_length(data: memoryview, at: int, place: str) -> int:
    """Payload length of the record at ``at``, checked."""
    length, crc = _HEAD.unpack_from(data, at)
    if masked(zlib.crc32(data[at : at + 8])) != crc:
        raise ValueError(f"{place}: damaged record length at byte {at}")
    return length


def unpack_record(data: memoryview, at: int, place: str) -> tuple[int | None, np.ndarray, int]:
    """Key and ids of the record at ``at``, checked, and where the next one begins."""
    begin = at + _HEAD.size
    end = begin + record_length(data, at, place)
    if masked(zlib.crc32(data[begin:end])) != _CRC.unpack_from(data, end)[0]:
        raise ValueError(f"{place}: damaged record at byte {at}")
    null, key, width = _KEY.unpack_from(data, begin)
    ids = np.frombuffer(data[begin + _KEY.size : end], dtype=f"<u{width}")
    return None if null else key, ids, end + _CRC.size + len(GUARD)


def write_records(
    documents: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    vocabulary: str | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> DataFrame:
    """Encode texts, append ``end_id`` and write records below ``path``; returns the index.

    Records ascend by key, nulls first; rows of equal keys are ordered by text.
    Null texts count as empty: their record holds the end id alone. The index
    has a row per record: (key, path, file, offset, length, start, n_tokens),
    ``start`` being the ids before it. An empty table gives an empty index.
    """
    spark = documents.sparkSession
    vocabulary = vocabulary or public_vocabulary()
    bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary)
        width = 2 if max(bpe.size - 1, end_id) < 1 << 16 else 4
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            keys = batch.column("_key").to_pylist()
            for at, texts in text_batches(batch, "_text"):
                ids = encoded(texts, bpe)
                rows = [pack_record(k, i + end, width) for k, i in zip(keys[at:], ids)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["record"])
            # A worker goes on to other tasks, so what a batch took goes back.
            batch = texts = ids = rows = None
            release()

    narrow = documents.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    files = max(1, ceil(narrow.select("_key").count() / rows_per_file))
    ordered = narrow.repartitionByRange(files, "_key").sortWithinPartitions("_key", "_text")
    write_bytes(ordered.mapInArrow(run, "record binary"), "record", f"{path}/records", GUARD)
    return write_index(spark, path, key)


def write_index(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Index the record files below ``path`` by reading them through, and store the index there.

    Files come in the order of their least keys, nulls first, whatever their names.
    """
    bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = RangeReader()
        for batch in batches:
            for uri, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                for rows in _scan(reader, uri, length):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([r[0] for r in rows], pa.int64()),
                            pa.array([uri] * len(rows), pa.string()),
                            pa.array([r[1] for r in rows], pa.int64()),
                            pa.array([r[2] for r in rows], pa.int64()),
                            pa.array([r[3] for r in rows], pa.int64()),
                        ],
                        ["key", "path", "offset", "length", "n_tokens"],
                    )
        reader.close()

    files = file_blocks(spark, f"{path}/records", 1 << 62).select("path", "length")
    schema = "key bigint, path string, offset bigint, length bigint, n_tokens bigint"
    found = stage(spread(files, 2, "path").mapInArrow(run, schema), "record-places")
    # One row per file. Files follow each other by their first key: names of files do not sort by their numbers.
    first = F.min(F.struct(F.col("key").isNotNull().alias("known"), "key")).alias("_first")
    each = found.groupBy("path").agg(F.sum("n_tokens").alias("_tokens"), first)
    earlier = Window.orderBy("_first", "path").rowsBetween(Window.unboundedPreceding, -1)
    before = each.select("path", F.coalesce(F.sum("_tokens").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("path").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    index = found.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    index = index.join(before, "path").select(
        F.col("key").alias(key),
        "path",
        "offset",
        "length",
        (F.col("_before") + F.col("_inside")).alias("start"),
        "n_tokens",
    )
    index.write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


def _scan(reader: RangeReader, uri: str, length: int) -> Iterator[list[tuple]]:
    """Places of all records of a file, read in blocks: lists of (key, offset, length, ids)."""
    at = 0
    while at < length:
        size = min(_READ_BYTES, length - at)
        data = memoryview(reader.read(uri, at, size))
        need = record_length(data, 0, uri) + _AROUND
        if need > size:
            data = memoryview(reader.read(uri, at, need))
        rows, here = [], 0
        while here + _HEAD.size <= len(data):
            whole = record_length(data, here, uri) + _AROUND
            if here + whole > len(data):
                break
            null, key, width = _KEY.unpack_from(data, here + _HEAD.size)
            count = (whole - _AROUND - _KEY.size) // width
            rows.append((None if null else key, at + here, whole, count))
            here += whole
        yield rows
        at += here


def read_records(index: DataFrame, key: str = "doc_id", seed: int | None = None) -> DataFrame:
    """Records by their index: (key, start, n_tokens, ids, ids_crc32), checksums verified.

    ``index`` may be any selection of index rows. Runs of neighbouring records
    are read together; with a ``seed`` every record is fetched on its own in
    an order drawn with that seed.
    """
    return _read(index, key, seed, with_ids=True)


def record_digests(index: DataFrame, key: str = "doc_id") -> DataFrame:
    """As ``read_records``, without the ids themselves."""
    return _read(index, key, None, with_ids=False)


def _read(index: DataFrame, key: str, seed: int | None, with_ids: bool) -> DataFrame:
    bounded_batches(index.sparkSession)
    schema = "key bigint, start bigint, n_tokens bigint, ids binary, ids_crc32 bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = RangeReader()
        for batch in batches:
            places = batch.to_pylist()
            at = 0
            while at < len(places):
                first = last = places[at]
                upto, size = at + 1, first["length"]
                while upto < len(places) and size < _READ_BYTES:
                    step = places[upto]
                    if step["path"] != last["path"] or step["offset"] != last["offset"] + last["length"]:
                        break
                    last, size, upto = step, size + step["length"], upto + 1
                data = memoryview(reader.read(first["path"], first["offset"], size))
                out = []
                for place in places[at:upto]:
                    found, ids, _ = unpack_record(data, place["offset"] - first["offset"], place["path"])
                    wide = ids.astype("<u4").tobytes()
                    out.append((found, place["start"], len(ids), wide if with_ids else None, zlib.crc32(wide)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [*[pa.int64()] * 3, pa.binary(), pa.int64()])],
                    ["key", "start", "n_tokens", "ids", "ids_crc32"],
                )
                at = upto
        reader.close()

    places = index.select("path", "offset", "length", "start")
    if seed is None:
        chunk = F.floor(F.col("offset") / _READ_BYTES)
        places = spread(places, ROWS_PER_FILE, "path", chunk).sortWithinPartitions("path", "offset")
    else:
        places = places.orderBy(F.xxhash64(F.lit(seed), "path", "offset"))
    rows = places.mapInArrow(run, schema).withColumnRenamed("key", key)
    return rows if with_ids else rows.drop("ids")
