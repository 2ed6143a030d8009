"""Binary files written by Spark tasks, and read back by byte range.

Rows of bytes go out through Spark's own text writer, whose committer makes a
repeated or speculative task leave one copy, on any file system Spark writes to.
The writer puts a separator after each row; a format has to count with it.
Reads open a file at an offset, so a file of any size is read in blocks.
"""

from __future__ import annotations

from math import ceil

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bytes(rows: DataFrame, column: str, path: str, separator: bytes, by: str | None = None) -> None:
    """Write ``column`` row after row, ``separator`` after each; one file per task (and ``by``)."""
    wide = [by] if by else []
    writer = rows.select(*wide, F.col(column).cast("string").alias("value")).write
    writer = writer.option("encoding", "ISO-8859-1").option("lineSep", separator.decode("latin-1"))
    (writer.partitionBy(by) if by else writer).text(path)


def file_blocks(spark: SparkSession, path: str, block_bytes: int) -> DataFrame:
    """Every block of every file below ``path``: (path, length, block, offset, size)."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    last = F.greatest(F.ceil(F.col("length") / block_bytes) - 1, F.lit(0)).cast("long")
    placed = files.where("length > 0").select(
        "path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block")
    )
    offset = F.col("block") * block_bytes
    return placed.select(
        "*", offset.alias("offset"), F.least(F.lit(block_bytes), F.col("length") - offset).alias("size")
    )


def spread(df: DataFrame, rows_each: int, *by: str | Column) -> DataFrame:
    """Few but heavy rows over as many tasks as their number asks for."""
    return df.repartition(max(1, ceil(df.count() / rows_each)), *by)


class RangeReader:
    """Reads bytes of files by offset, keeping the last file open."""

    def __init__(self) -> None:
        self._uri: str | None = None
        self._file = None

    def read(self, uri: str, offset: int, size: int) -> bytes:
        if uri != self._uri:
            self.close()
            place = "file://" + uri[5:] if uri.startswith("file:/") and uri[6:7] != "/" else uri
            system, path = pafs.FileSystem.from_uri(place)
            self._file, self._uri = system.open_input_file(path), uri
        data = self._file.read_at(size, offset)
        if len(data) != size:
            raise EOFError(f"{uri} ends before byte {offset + size}")
        return data

    def close(self) -> None:
        if self._file is not None:
            self._file.close()
        self._file = self._uri = None
