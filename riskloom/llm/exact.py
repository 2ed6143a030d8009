"""Exact deduplication against an index of texts seen before.

The index is a minimal perfect hash over the distinct digests of the historical
rows: every digest has a slot of its own, and the slot holds the full digest
and where the row lives that stays. A perfect hash sends strangers to some slot
too, so a lookup counts only if all bytes of the digest agree. New rows that
are not in the index are grouped among themselves.

New rows are grouped by digest before the lookup, so a text that a third of all
rows share is looked up once; the index is cut into shards of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import whole

#: Distinct digests in one shard of the index, about.
SHARD_DIGESTS = 50_000

#: Bits of a level per digest left: fewer make the index smaller, more make it shallower.
GAMMA = 2.0

_MAX_LEVELS = 64


def _spots(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Position of each digest in a level of ``size`` bits."""
    seed = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    mixed = (words[:, level % 4] ^ seed) * np.uint64(0xBF58476D1CE4E5B9) + words[:, (level + 1) % 4]
    mixed ^= mixed >> np.uint64(31)
    return (mixed % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash over distinct 32-byte digests, in levels of bits.

    In each level the digests that meet no other there set a bit; the rest go
    on to the next. A digest's slot is the number of bits set before its own.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self._ranks = [np.cumsum(bits) - bits for bits in levels]
        self._before = np.concatenate([[0], np.cumsum([int(bits.sum()) for bits in levels])])

    @classmethod
    def build(cls, digests: np.ndarray) -> PerfectHash:
        """``digests``: an array (n, 32) of bytes without repeats."""
        left = np.ascontiguousarray(digests).view("<u8").reshape(-1, 4)
        levels: list[np.ndarray] = []
        while len(left):
            if len(levels) == _MAX_LEVELS:
                raise ValueError("digests repeat")
            size = max(8, int(GAMMA * len(left)))
            at = _spots(left, len(levels), size)
            met = np.bincount(at, minlength=size)
            levels.append((met == 1).astype(np.int64))
            left = left[met[at] != 1]
        return cls(levels)

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """A slot for each digest: its own if it is a member, else any or -1."""
        words = np.ascontiguousarray(digests).view("<u8").reshape(-1, 4)
        out = np.full(len(words), -1, dtype=np.int64)
        open_rows = np.arange(len(words))
        for level, bits in enumerate(self.levels):
            if not len(open_rows):
                break
            at = _spots(words[open_rows], level, len(bits))
            hit = bits[at] == 1
            out[open_rows[hit]] = self._before[level] + self._ranks[level][at[hit]]
            open_rows = open_rows[~hit]
        return out

    def dumps(self) -> list[bytes]:
        return [np.packbits(bits.astype(bool)).tobytes() for bits in self.levels]

    @classmethod
    def loads(cls, sizes: list[int], packed: list[bytes]) -> PerfectHash:
        bits = [np.unpackbits(np.frombuffer(p, "u1"), count=n) for n, p in zip(sizes, packed)]
        return cls([b.astype(np.int64) for b in bits])


def normalized(text: str | Column = "text") -> Column:
    """A text without blanks, tabs and line ends; null counts as empty."""
    return F.translate(whole(text), " \t\n\x0b\f\r", "")


def digest_rows(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, digest, row), staged; ``row`` tells rows of equal keys apart."""
    rows = documents.select(
        F.col(key).alias("key"),
        F.length(whole(text)).cast("long").alias("n_chars"),
        F.unhex(F.sha2(normalized(text), 256)).alias("digest"),
    )
    return stage(rows.withColumn("row", F.monotonically_increasing_id()), "digests")


def _rank() -> Column:
    """Least for the winner: the longest text, then the smallest key, nulls last.

    Rows that tie in all go by their place.
    """
    return F.struct(
        (-F.col("n_chars")).alias("short"), F.col("key").isNull().alias("absent"), F.col("key"), F.col("row")
    )


def winners(rows: DataFrame) -> DataFrame:
    """The row that stays of each digest: (digest, best, size)."""
    return rows.groupBy("digest").agg(F.min(_rank()).alias("best"), F.count("*").alias("size"))


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int").alias("shard")


_INDEX = "shard int, sizes array<int>, levels array<binary>, digests binary, locators binary"


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard: the perfect hash, and by slot the digests and the winners' rows.

    ``history`` has distinct digests: (digest, best, …), as ``winners`` gives them.
    """

    def build(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(groups))
        digests = np.frombuffer(b"".join(table.column("digest").to_pylist()), "u1").reshape(-1, 32)
        locators = table.column("row").to_numpy().astype("<i8")
        perfect = PerfectHash.build(digests)
        slots = perfect.slots(digests)
        placed, rows = np.empty_like(digests), np.empty_like(locators)
        placed[slots], rows[slots] = digests, locators
        yield pa.RecordBatch.from_arrays(
            [
                table.column("shard").combine_chunks()[:1],
                pa.array([[len(bits) for bits in perfect.levels]], pa.list_(pa.int32())),
                pa.array([perfect.dumps()], pa.list_(pa.binary())),
                pa.array([placed.tobytes()], pa.binary()),
                pa.array([rows.tobytes()], pa.binary()),
            ],
            ["shard", "sizes", "levels", "digests", "locators"],
        )

    narrow = history.select(_shard(shards), "digest", F.col("best.row").alias("row"))
    return narrow.groupBy("shard").applyInArrow(build, _INDEX)


def lookup(distinct: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Whether each distinct digest is in the index: (digest, locator), null for strangers."""

    def probe(asked: pa.Table, held: pa.Table) -> pa.Table:
        names = asked.column("digest").to_pylist()
        found: list[int | None] = [None] * len(names)
        if names and held.num_rows:
            [part] = held.to_pylist()
            digests = np.frombuffer(b"".join(names), "u1").reshape(-1, 32)
            stored = np.frombuffer(part["digests"], "u1").reshape(-1, 32)
            locators = np.frombuffer(part["locators"], "<i8")
            slots = PerfectHash.loads(part["sizes"], part["levels"]).slots(digests)
            same = (slots >= 0) & (stored[slots] == digests).all(axis=1)
            for at in np.flatnonzero(same).tolist():
                found[at] = int(locators[slots[at]])
        return pa.table({"digest": pa.array(names, pa.binary()), "locator": pa.array(found, pa.int64())})

    asked = distinct.select(_shard(shards), "digest").groupBy("shard")
    return asked.cogroup(index.groupBy("shard")).applyInArrow(probe, "digest binary, locator bigint")


def deduplicate(history: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Group the rows of both inputs, as ``digest_rows`` gives them, by equal text.

    Returns the staged groups (digest, best, size) and, for the new rows' digests, where
    the historical winner lives (digest, locator), null for texts not seen before. A new
    row may replace a historical winner. Either input may be empty.
    """
    old = stage(winners(history), "history")
    fresh = stage(winners(new), "fresh")
    shards = max(1, ceil(max(old.count(), fresh.count()) / SHARD_DIGESTS))
    index = stage(build_index(old, shards), "perfect-hash")
    found = stage(lookup(fresh, index, shards), "lookup")
    strangers = fresh.join(found.where("locator IS NULL"), "digest", "left_semi")
    members = fresh.join(found.where("locator IS NOT NULL"), "digest", "left_semi")
    known = old.unionByName(members).groupBy("digest").agg(F.min("best").alias("best"), F.sum("size").alias("size"))
    return stage(known.unionByName(strangers), "groups"), found


def split_history(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with keys in the lower half of their range as history, the others as new."""
    middle = rows.select(((F.min("key") + F.max("key")) / 2).alias("middle")).first()["middle"]
    older = F.coalesce(F.col("key") <= F.lit(middle), F.lit(False))
    return rows.where(older), rows.where(~older)


def exact_groups(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Exact duplicates of a table: (key, keep_id, group_size, kept, text_sha256), a row per row.

    Texts are equal when they agree without blanks, tabs and line ends; the
    longest original stays, of those the one with the smallest key (a null key
    is the largest). Null texts count as empty and are equal to one another.
    Rows that repeat in full keep one of them. An empty table gives no rows.
    """
    rows = digest_rows(documents, key, text)
    groups, _ = deduplicate(*split_history(rows))
    return rows.join(groups, "digest").select(
        F.col("key").alias(key),
        F.col("best.key").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that ``exact_groups`` keeps, with all their columns."""
    rows = digest_rows(documents, key, text)
    groups, _ = deduplicate(*split_history(rows))
    wins = groups.select("digest", F.col("best.key").alias("keep"))
    # A row travels as one struct, so that no column's name can clash.
    marked = documents.select(
        F.struct("*").alias("whole"),
        F.col(key).alias("key"),
        F.unhex(F.sha2(normalized(text), 256)).alias("digest"),
    )
    same = (marked["digest"] == wins["digest"]) & marked["key"].eqNullSafe(wins["keep"])
    kept = marked.join(wins, same, "left_semi")
    # Only rows that repeat in key and text can still be there twice.
    twice = rows.groupBy("key", "digest").count().where("count > 1").limit(1).count()
    return (kept.dropDuplicates(["key", "digest"]) if twice else kept).select("whole.*")
