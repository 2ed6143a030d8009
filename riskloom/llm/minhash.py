"""Near-duplicate documents by HyperMinHash, confirmed on full shingle sets.

Every shingle falls into one of the buckets of a document's signature by a few
bits of its hash; of the least hash in a bucket only the number of leading
zeros and some bits after them are kept. A bucket without shingles takes the
register of another, chosen in an order fixed for that bucket. Groups of
registers form bands, and documents that agree in a band are candidates.

1. Documents with the same set are one class, and only its smallest id goes on.
2. In each band bucket every document is paired with the bucket's first and
   last, not with all others, and a pair is confirmed on the full sets if its
   corrected estimate does not rule it out.
3. Links join into components. In buckets that still hold several components,
   documents with too many shingles that no other has are out, and the others
   are all compared, block by block: a block joins what it finds linked as it
   goes, so it compares on registers, and then on full sets, only documents that
   are not yet joined. No link between candidates is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import bounded_batches, lean, runs, slices

SHINGLE_WORDS = 5

#: A link needs 100 * intersection >= percent * union; this is the percentage of the query.
LINK_PERCENT = 85

#: Registers of a signature, dealt into bands of as many rows as let a pair at
#: the threshold escape all bands with at most this chance.
REGISTERS = 256
ESCAPE = 3e-9

#: A register: 6 bits of leading zeros, then this many bits of mantissa.
MANTISSA = 10

#: Candidates whose estimate lies this many of its standard deviations at the
#: threshold below it are not compared in full.
ESTIMATE_DEVIATIONS = 6.3

#: Documents of a bucket that are compared with each other, or with as many more, at a time,
#: and about the bytes of their sets.
BLOCK = 512
BLOCK_BYTES = 16 << 20

#: Up to this many ids (8 MB) go to every task to pick their rows; rows of more
#: ids are met by a shuffle.
FEW_IDS = 1_000_000

_MASK = 0xFFFFFFFFFFFFFFFF


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IS_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])


def word_spans(data: bytes, separator: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``data``: runs of bytes that are no separators."""
    gap = np.ones(len(data) + 2, dtype=bool)
    gap[1:-1] = separator[np.frombuffer(data, dtype=np.uint8)]
    change = np.flatnonzero(gap[1:] != gap[:-1])
    return change[::2], change[1::2]


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    lengths = ends - starts
    words = np.ndarray((len(data) + 1,), dtype="<u8", buffer=data + bytes(8), strides=(1,))
    out = mix(lengths.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    for k in range(4):
        rows = np.flatnonzero(lengths > 8 * k) if k else np.arange(len(lengths))
        if not len(rows):
            break
        spare = np.clip(8 * (k + 1) - lengths[rows], 0, 7).astype(np.uint64) * np.uint64(8)
        part = words[starts[rows] + 8 * k] & (np.uint64(_MASK) >> spare)
        out[rows] = mix(out[rows] ^ part)
    for row in np.flatnonzero(lengths > 32).tolist():
        out[row] = xxhash.xxh64_intdigest(data[starts[row] : ends[row]])
    return out


def shingle_sets(texts: list[bytes], size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text of fewer words has its whole sequence as one shingle; a text without
    words has none.
    """
    data = b"\n".join(texts).translate(_LOWER)
    starts, ends = word_spans(data)
    words = word_hashes(data, starts, ends)
    edges = np.cumsum([0, *(len(t) + 1 for t in texts)])
    upto = np.searchsorted(starts, edges)
    rolled = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    for k in range(size):
        turn = np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) & _MASK)
        rolled = mix(rolled + turn) ^ words[k : len(words) - size + 1 + k]
    rolled = mix(rolled)
    sets = []
    for i, j in zip(upto[:-1].tolist(), upto[1:].tolist()):
        if j - i >= size:
            ordered = np.sort(rolled[i : j - size + 1])
            sets.append(ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])])
        elif j > i:
            sets.append(np.array([xxhash.xxh64_intdigest(words[i:j].tobytes(), j - i)], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


@lru_cache(maxsize=1)
def _fill_order() -> np.ndarray:
    """For each bucket, the order in which the others may lend it a register."""
    keys = mix(np.arange(REGISTERS * REGISTERS, dtype=np.uint64)).reshape(REGISTERS, REGISTERS)
    return np.argsort(keys, axis=1)


@lru_cache(maxsize=1)
def _fill_rank() -> np.ndarray:
    return np.argsort(_fill_order(), axis=1)


@lru_cache
def banding(percent: int) -> tuple[int, int]:
    """(rows, bands): the longest bands that a pair at ``percent`` escapes with a chance of ESCAPE at most."""
    for rows in range(REGISTERS, 0, -1):
        bands = REGISTERS // rows
        if (1 - (percent / 100) ** rows) ** bands <= ESCAPE:
            return rows, bands
    raise ValueError(f"{REGISTERS} registers do not find pairs at {percent} %")


@lru_cache
def _band_order(percent: int) -> np.ndarray:
    rows, bands = banding(percent)
    keys = mix(np.arange(REGISTERS, dtype=np.uint64) + np.uint64(1 << 20))
    return np.argsort(keys)[: rows * bands].reshape(bands, rows)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of each non-empty set, as an array of (sets, REGISTERS)."""
    least = np.zeros((len(sets), REGISTERS), dtype=np.uint64)
    full = np.zeros((len(sets), REGISTERS), dtype=bool)
    shift = np.uint64(64 - REGISTERS.bit_length() + 1)
    for row, hashes in enumerate(sets):
        # Hashes ascend, so a bucket's first is its least.
        bucket = (hashes >> shift).astype(np.int64)
        first = np.concatenate([[True], bucket[1:] != bucket[:-1]])
        least[row, bucket[first]] = hashes[first]
        full[row, bucket[first]] = True
    rest = least << np.uint64(REGISTERS.bit_length() - 1)
    # Exact in a double: 53 bits decide the leading zeros.
    zeros = (53 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]).astype(np.uint64)
    after = np.where(zeros < 53, rest << np.minimum(zeros + np.uint64(1), np.uint64(63)), 0)
    registers = ((zeros << np.uint64(MANTISSA)) | (after >> np.uint64(64 - MANTISSA))).astype(np.uint16)
    return _fill(registers, full)


def _fill(registers: np.ndarray, full: np.ndarray) -> np.ndarray:
    order = _fill_order()
    rank = _fill_rank()
    count = full.sum(axis=1)
    out = registers.copy()
    # Few full buckets: find the best lender of every bucket at once.
    for row in np.flatnonzero(count < 24).tolist():
        lenders = np.flatnonzero(full[row])
        best = lenders[np.argmin(rank[:, lenders], axis=1)]
        out[row] = np.where(full[row], registers[row], registers[row, best])
    rows, empty = np.nonzero(~full & (count >= 24)[:, None])
    for attempt in range(REGISTERS):
        if not len(rows):
            break
        lender = order[empty, attempt]
        lends = full[rows, lender]
        out[rows[lends], empty[lends]] = registers[rows[lends], lender[lends]]
        rows, empty = rows[~lends], empty[~lends]
    return out


def band_keys(registers: np.ndarray, percent: int) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    picked = registers[:, _band_order(percent)].astype(np.uint64)
    out = np.broadcast_to(np.arange(picked.shape[1], dtype=np.uint64) + np.uint64(1), picked.shape[:2])
    for row in range(picked.shape[2]):
        out = mix(out ^ (picked[:, :, row] << np.uint64(16)) + np.uint64(row))
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from registers that agree, less those that agree by chance.

    Two registers over different least hashes still agree if their leading
    zeros and mantissa do: with a chance of about 2 ** -MANTISSA / 3.
    """
    agree = (a == b).mean(axis=-1)
    chance = 2.0**-MANTISSA / 3
    return np.clip((agree - chance) / (1 - chance), 0, 1)


def least_estimate(percent: int) -> float:
    """The estimate below which pairs are not compared in full."""
    share = percent / 100
    return share - ESTIMATE_DEVIATIONS * (share * (1 - share) / REGISTERS) ** 0.5


def profiles(documents: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """(id, n_shingles, print, bands): the set's size, 128-bit fingerprint and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, (at, texts) in ((b, part) for b in batches for part in slices(b)):
            sets = shingle_sets(texts)
            some = [s for s in sets if len(s)]
            keys = iter(band_keys(signatures(some), percent).astype("<u8") if some else ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(at, len(texts)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(keys).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                ["id", "n_shingles", "print", "bands"],
            )

    narrow = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return narrow.mapInArrow(lean(run), "id bigint, n_shingles bigint, print binary, bands binary")


def band_rows(reps: DataFrame, percent: int) -> DataFrame:
    """(key, id): one row per band."""
    bands = banding(percent)[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), "<i8")
            ids = np.repeat(batch.column("id").to_numpy(), bands)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids)], ["key", "id"])

    return reps.select("id", "bands").mapInArrow(run, "key bigint, id bigint")


def bucket_members(bands: DataFrame) -> DataFrame:
    """(key, id, first, last, n): rows of the buckets that hold several ids, with their first, last and number of rows.

    Bands are moved once: a window reads the rows that an aggregate and a join would each have moved.
    """
    bucket = Window.partitionBy("key")
    ends = {"first": F.min("id").over(bucket), "last": F.max("id").over(bucket), "n": F.count("*").over(bucket)}
    return bands.withColumns(ends).where("first <> last")


def _only(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is one of ``ids``, a staged table of distinct ids."""
    return rows.join(F.broadcast(ids) if ids.count() <= FEW_IDS else ids, "id", "left_semi")


def full_sets(documents: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """(id, n, registers, hashes) of the wanted ids, n the number of hashes, hashes ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, (at, texts) in ((b, part) for b in batches for part in slices(b)):
            sets = shingle_sets(texts)
            batch = batch.slice(at, len(texts)).filter(pa.array([len(s) > 0 for s in sets]))
            sets = [s for s in sets if len(s)]
            some = signatures(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.astype("<u2").tobytes() for s in some], pa.binary()),
                    pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary()),
                ],
                ["id", "n", "registers", "hashes"],
            )

    narrow = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    # Rows that repeat an id are all compared, as one document with several texts.
    return _only(narrow, wanted).mapInArrow(lean(run), "id bigint, n bigint, registers binary, hashes binary")


def _both(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """Pairs (a, b) with ``column`` of either document as x and y."""
    one = sets.select(F.col("id").alias("a"), F.col(column).alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col(column).alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    The estimate needs the registers alone; full sets travel for the pairs it leaves.
    """
    floor = least_estimate(percent)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in "xy"]
            yield batch.filter(pa.array(estimate(*sides) >= floor)).select(["a", "b"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for left, right in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(side.as_buffer(), "<u8") for side in (left, right))
                shared = len(x) + len(y) - len(np.union1d(x, y))
                good.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])

    near = _both(pairs, sets, "registers").mapInArrow(likely, "a bigint, b bigint")
    near = stage(near.distinct(), "likely")
    if near.count() <= FEW_IDS // 2:
        # Few pairs: only the sets they name travel.
        named = near.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        sets = _only(sets, stage(named, "named"))
    return _both(near, sets, "hashes").mapInArrow(linked, "a bigint, b bigint")


def _ordered(one: Column, two: Column) -> list[Column]:
    return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")]


def components(links: DataFrame) -> DataFrame:
    """Smallest id reachable over ``links`` (a, b): (id, component), ids without links left out.

    Alternates two steps until nothing changes: every id passes its smallest
    neighbour to the larger ones, then to the smaller ones and itself. The result is
    a set of stars. Each step is written down, so its lineage is one scan.
    """
    edges = stage(links.where("a <> b").select(*_ordered(F.col("a"), F.col("b"))).distinct(), "links")
    before = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
        large = stage(large.where("a <> b").distinct(), "large-star")
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        met = large.join(least, "b")
        small = met.select(F.col("m").alias("x"), F.col("a").alias("y")).union(met.select("m", "b"))
        edges = stage(small.where("x <> y").select(*_ordered(F.col("x"), F.col("y"))).distinct(), "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("b").alias("id"), F.col("a").alias("component"))
        before = now


def _pairs(rows: DataFrame, *partners: str) -> DataFrame:
    """Distinct pairs of ``id`` with each of ``partners``."""
    met = rows.select("id", F.explode(F.array(*partners)).alias("other")).where("id <> other")
    return met.select(*_ordered(F.col("id"), F.col("other"))).distinct()


def near_duplicates(
    documents: DataFrame, key: str = "doc_id", text: str = "text", percent: int = LINK_PERCENT
) -> DataFrame:
    """Near-duplicate classes: (key, n_shingles, component_id, kept), a row per row.

    Documents are linked when their sets of five-word shingles, A-Z in lower
    case, overlap by ``percent`` of their union; ``component_id`` is the smallest key
    reachable. A null or empty text, or one without words, has no shingles and
    is linked with nothing. A null key stays on its own. An empty table gives no
    rows. Rows that repeat a key count once in each class and share its result.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    every = stage(profiles(documents, key, text, percent), "profiles")
    known = every.where("n_shingles > 0 AND id IS NOT NULL")
    classes = known.groupBy("print").agg(F.min("id").alias("rep"), F.count("*").alias("n")).where("n > 1")
    copies = known.select("id", "print").join(classes, "print").where("id <> rep").select("id", "print", "rep")
    copies = stage(copies.distinct(), "copies")
    # By print too: a key that repeats with another text goes on with that one.
    reps = known.join(copies, ["id", "print"], "left_anti")
    members = stage(bucket_members(band_rows(reps, percent)), "members")
    pairs = stage(_pairs(members, "first", "last"), "pairs")
    wanted = stage(members.select("id").distinct(), "wanted")
    sets = stage(full_sets(documents, key, text, wanted), "sets")
    links = stage(confirm(pairs, sets, percent), "confirmed")
    links = links.unionByName(stage(_left_links(members, links, sets, percent), "left"))
    every_link = links.unionByName(copies.select(F.col("rep").alias("a"), F.col("id").alias("b")))
    found = stage(components(every_link), "components")
    return (
        every.select("id", "n_shingles")
        .join(found.withColumnRenamed("id", "other"), F.col("id") == F.col("other"), "left")
        .select(F.col("id").alias(key), "n_shingles", F.coalesce("component", "id").alias("component_id"))
        .withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
    )


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows (key, id, component) of the buckets that hold several components."""
    ends = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return rows.join(ends.where("low <> high").select("key"), "key", "left_semi")


def _tokens(sets: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, hash): every shingle of ``docs``, a staged table of distinct ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(h, "<i8") for h in batch.column("hashes").to_pylist()]
            ids = np.repeat(batch.column("id").to_numpy(), [len(p) for p in parts])
            hashes = np.concatenate([*parts, np.zeros(0, "<i8")])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(hashes)], ["id", "hash"])

    return _only(sets, docs).select("id", "hashes").mapInArrow(run, "id bigint, hash bigint")


def _able(mixed: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Rows (key, id, component, n) of ``mixed`` that may have a link to another component of their bucket, with (shared).

    What two documents of different components have in common, other components
    have in common too, and a link needs percent / (100 + percent) of both sizes together.
    """
    held = tokens.join(mixed.select("id", "component").distinct(), "id")
    met = held.groupBy("hash").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    met = met.where("low <> high").select("hash")
    shared = held.join(met, "hash").groupBy("id").agg(F.count("*").alias("shared"))
    rows = mixed.select("key", "id", "component", "n").join(shared, "id")
    least = rows.groupBy("key").agg(F.min("n").alias("least"))
    partner = F.greatest(F.col("least"), F.ceil(F.col("n") * percent / 100))
    able = (100 + percent) * F.col("shared") >= percent * (F.col("n") + partner)
    return _mixed(rows.join(least, "key").where(able).drop("least"))


def _left_links(members: DataFrame, links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of one bucket that its first and last did not bring together.

    They may leave out pairs that are joined without them.
    """
    rows = members.where("n > 2").select("key", "id").join(components(links), "id", "left")
    rows = stage(_mixed(rows.withColumn("component", F.coalesce("component", "id"))), "mixed")
    tokens = _tokens(sets, stage(rows.select("id").distinct(), "left-over"))
    # An id that repeats with several texts counts with the shortest, which rules out the least.
    sizes = sets.groupBy("id").agg(F.min("n").alias("n"))
    able = stage(_able(rows.join(sizes, "id"), tokens, percent), "able")
    # Only the sets that are still to be compared travel.
    return _compared(able, _only(sets, stage(able.select("id").distinct(), "able-ids")), percent)


def _compared(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join the documents of one bucket and different components as all their links do.

    A bucket is cut into blocks and every two blocks meet in a task of their own, so
    no bucket is too large; only links leave it. A pair is looked at in the first
    bucket that its documents share.
    """
    keys = mixed.groupBy("id").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") * 8 / BLOCK_BYTES))
    sizes = mixed.groupBy("key").agg(blocks.alias("slots"))
    held = mixed.join(sizes, "key").withColumn("slot", F.pmod(F.xxhash64("id"), F.col("slots")))
    held = held.join(keys, "id").join(sets.select("id", "registers", "hashes"), "id")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("other")
    held = held.select("key", "id", "component", "shared", "keys", "registers", "hashes", "slot", other)
    held = held.withColumns({"low": F.least("slot", "other"), "high": F.greatest("slot", "other")}).drop("other")
    place = ["key", "low", "high"]
    dealt = held.repartition(*place).sortWithinPartitions(*place)
    floor = least_estimate(percent)

    def block(rows: pa.Table) -> pa.RecordBatch:
        ids, shared, slot = (rows.column(c).to_numpy() for c in ("id", "shared", "slot"))
        joined = rows.column("component").to_numpy().copy()
        registers = np.frombuffer(b"".join(rows.column("registers").to_pylist()), "<u2").reshape(-1, REGISTERS)
        hashes = [np.frombuffer(h.as_buffer(), "<u8") for h in rows.column("hashes")]
        n = np.array([len(h) for h in hashes])
        named, key = [frozenset(k) for k in rows.column("keys").to_pylist()], rows.column("key")[0].as_py()
        apart = rows.column("low")[0].as_py() != rows.column("high")[0].as_py()
        found: list[tuple[int, int]] = []
        for i in range(len(ids) - 1):
            go = (joined[i + 1 :] != joined[i]) & (ids[i + 1 :] != ids[i])
            go &= 100 * np.minimum(n[i], n[i + 1 :]) >= percent * np.maximum(n[i], n[i + 1 :])
            go &= (100 + percent) * np.minimum(shared[i], shared[i + 1 :]) >= percent * (n[i] + n[i + 1 :])
            if apart:
                go &= slot[i + 1 :] != slot[i]
            near = i + 1 + np.flatnonzero(go)
            near = near[estimate(registers[near], registers[i][None]) >= floor]
            for j in near.tolist():
                if joined[j] == joined[i] or min(named[i] & named[j]) != key:
                    continue
                both = len(np.intersect1d(hashes[i], hashes[j], assume_unique=True))
                if 100 * both >= percent * (len(hashes[i]) + len(hashes[j]) - both):
                    found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                    joined[joined == joined[j]] = joined[i]
        columns = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for where, part in runs(batches, *place):
            if where != now and parts:
                yield block(pa.Table.from_batches(parts))
                parts = []
            now = where
            parts.append(part)
        if parts:
            yield block(pa.Table.from_batches(parts))

    return dealt.mapInArrow(lean(run), "a bigint, b bigint").distinct()


def without_near_copies(
    documents: DataFrame, key: str = "doc_id", text: str = "text", percent: int = LINK_PERCENT
) -> DataFrame:
    """One document of each near-duplicate class, with all its columns."""
    gone = near_duplicates(documents, key, text, percent).where("NOT kept").select(F.col(key).alias("gone")).distinct()
    rows = documents.select(F.struct("*").alias("whole"), F.col(key).cast("long").alias("mine"))
    return rows.join(gone, rows["mine"] == gone["gone"], "left_anti").select("whole.*")
