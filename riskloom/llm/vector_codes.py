"""Product codes of vectors, learned by Lloyd's rounds over two trees at once.

Vectors become whole numbers and are cut into parts. The parts of a block of
vectors hang in a tree of boxes that is built once and kept with the sums of its
nodes; the entries of a codebook hang in another, built anew each round. Both are
descended together. The least and the greatest distance between two boxes decide
which pairs of nodes go on; a node left with a single entry is assigned whole, by
its kept sum. Leaves that still have several entries compare them with each of
their parts, in whole numbers, so the result is that of comparing all with all.

A round leaves the driver one row per entry and part, and sends back the
codebooks; neither grows with the vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import bounded_batches, finite, matrix

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024

#: Vectors of one tree, and parts in one of its leaves.
BLOCK_ROWS = 4096
LEAF = 32

#: Whole numbers beyond this could overflow squared distances.
LARGEST = 1 << 26

_FAR = np.iinfo(np.int64).max


@dataclass
class BoxTree:
    """Points in a balanced tree of boxes: level by level the low and high corner and the sum of each node."""

    order: np.ndarray
    points: np.ndarray
    low: list[np.ndarray]
    high: list[np.ndarray]
    sums: list[np.ndarray]

    @property
    def depth(self) -> int:
        return len(self.low) - 1

    def edges(self, level: int) -> np.ndarray:
        return (np.arange((1 << level) + 1) * len(self.points)) >> level

    @classmethod
    def build(cls, points: np.ndarray, leaf: int) -> BoxTree:
        depth = max(0, (len(points) // leaf).bit_length() - 1)
        tree = cls(np.arange(len(points)), points, [], [], [])
        for level in range(depth):
            edges, next_edges = tree.edges(level), tree.edges(level + 1)
            for node in range(1 << level):
                start, end, middle = edges[node], edges[node + 1], next_edges[2 * node + 1]
                if end - start > 1:
                    rows = tree.order[start:end]
                    here = points[rows]
                    widest = here[:, np.argmax(here.max(axis=0) - here.min(axis=0))]
                    tree.order[start:end] = rows[np.argpartition(widest, middle - start)]
        tree.points = points[tree.order]
        for level in range(depth + 1):
            starts = tree.edges(level)[:-1]
            tree.low.append(np.minimum.reduceat(tree.points, starts))
            tree.high.append(np.maximum.reduceat(tree.points, starts))
            tree.sums.append(np.add.reduceat(tree.points, starts))
        return tree

    def to_bytes(self) -> bytes:
        nodes = [np.concatenate(x) for x in (self.low, self.high, self.sums)]
        return b"".join(x.astype("<i8").tobytes() for x in (self.order, self.points, *nodes))

    @classmethod
    def from_bytes(cls, data: bytes, count: int, leaf: int) -> BoxTree:
        depth = max(0, (count // leaf).bit_length() - 1)
        nodes = (2 << depth) - 1
        values = np.frombuffer(data, "<i8")
        order, rest = values[:count], values[count:].reshape(-1, (len(values) - count) // (count + 3 * nodes))
        points, *corners = np.split(rest, [count + i * nodes for i in range(3)])
        cuts = [(1 << level) - 1 for level in range(1, depth + 1)]
        return cls(order, points, *(np.split(x, cuts) for x in corners))


def assign(parts: BoxTree, entries: BoxTree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry of each part, ties to the lower index: (codes, counts, sums).

    Codes are in the order the parts were given in; counts and sums are by entry.
    """
    size, many = parts.points.shape[1], len(entries.points)
    codes = np.full(len(parts.points), -1, dtype=np.int64)
    counts, sums = np.zeros(many, dtype=np.int64), np.zeros((many, size), dtype=np.int64)
    left, right = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    level = 0
    while len(left):
        at, of = min(level, parts.depth), min(level, entries.depth)
        low, high = parts.low[at][left], parts.high[at][left]
        entry_low, entry_high = entries.low[of][right], entries.high[of][right]
        gap = np.maximum(0, np.maximum(entry_low - high, low - entry_high))
        reach = np.maximum(high - entry_low, entry_high - low)
        bound = np.full(1 << at, _FAR)
        np.minimum.at(bound, left, (reach * reach).sum(axis=1))
        # An entry as far as the bound may tie, so it stays.
        go = (gap * gap).sum(axis=1) <= bound[left]
        left, right = left[go], right[go]
        edges, entry_edges = parts.edges(at), entries.edges(of)
        if of == entries.depth:
            alone = np.bincount(left, minlength=1 << at)[left] == 1
            alone &= entry_edges[right + 1] - entry_edges[right] == 1
            for node, entry in zip(left[alone].tolist(), entries.order[entry_edges[right[alone]]].tolist()):
                codes[edges[node] : edges[node + 1]] = entry
                counts[entry] += edges[node + 1] - edges[node]
                sums[entry] += parts.sums[at][node]
            left, right = left[~alone], right[~alone]
            if at == parts.depth:
                break
        if at < parts.depth:
            left, right = np.concatenate([2 * left, 2 * left + 1]), np.concatenate([right, right])
        if of < entries.depth:
            left, right = np.concatenate([left, left]), np.concatenate([2 * right, 2 * right + 1])
        level += 1
    by_node = np.argsort(left, kind="stable")
    nodes, first = np.unique(left[by_node], return_index=True)
    for node, some in zip(nodes.tolist(), np.split(right[by_node], first[1:])):
        start, end = edges[node], edges[node + 1]
        near = np.sort(np.concatenate([entries.order[entry_edges[e] : entry_edges[e + 1]] for e in some]))
        values = entries.points[np.argsort(entries.order)[near]]
        gap = parts.points[start:end, None] - values[None]
        # The first of the least: entries ascend by index.
        best = near[np.argmin((gap * gap).sum(axis=2), axis=1)]
        codes[start:end] = best
        counts += np.bincount(best, minlength=many)
        np.add.at(sums, best, parts.points[start:end])
    out = np.empty_like(codes)
    out[parts.order] = codes
    return out, counts, sums


def _blocks(kept: DataFrame, size: int, parts: int) -> DataFrame:
    """(ids, labels, trees): the trees of up to BLOCK_ROWS vectors, one for each part position."""
    label = kept.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            values = matrix(rows.column("vec"), np.int64)
            if np.abs(values).max() > LARGEST:
                raise ValueError(f"a component exceeds {LARGEST // SCALE} in size")
            trees = [BoxTree.build(x, LEAF).to_bytes() for x in np.split(values, parts, axis=1)]
            whole = pa.array([0, rows.num_rows], pa.int32())
            columns = [pa.ListArray.from_arrays(whole, rows.column(c)) for c in ("id", "label")]
            return pa.RecordBatch.from_arrays([*columns, pa.array([trees], pa.list_(pa.binary()))], ["ids", "labels", "trees"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = BLOCK_ROWS - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == BLOCK_ROWS:
                    yield block(held)
                    held = []
        if held:
            yield block(held)

    return kept.mapInArrow(run, f"ids array<bigint>, labels array<{label}>, trees array<binary>")


def _trees(codebooks: list[np.ndarray]) -> list[BoxTree]:
    return [BoxTree.build(book, 1) for book in codebooks]


def _rounded(blocks: DataFrame, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: floored means of what each entry is nearest to."""
    spark = blocks.sparkSession
    sent = spark.sparkContext.broadcast(codebooks)
    width = codebooks[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _trees(sent.value)
        total = [(np.zeros(len(b), dtype=np.int64), np.zeros(b.shape, dtype=np.int64)) for b in sent.value]
        for batch in batches:
            for ids, trees in zip(batch.column("ids"), batch.column("trees")):
                for tree, book, (counts, sums) in zip(trees, entries, total):
                    _, more, added = assign(BoxTree.from_bytes(tree.as_py(), len(ids), LEAF), book)
                    counts += more
                    sums += added
        for part, (counts, sums) in enumerate(total):
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used), part)),
                    pa.array(used),
                    pa.array(counts[used]),
                    pa.array(sums[used].tolist(), pa.list_(pa.int64())),
                ],
                ["part", "entry", "n", "sums"],
            )

    partial = blocks.mapInArrow(run, "part bigint, entry bigint, n bigint, sums array<bigint>")
    added = [F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(width)]
    found = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*added).alias("sums")).collect()
    sent.destroy()
    new = [book.copy() for book in codebooks]
    for row in found:
        new[row["part"]][row["entry"]] = [int(s) // row["n"] for s in row["sums"]]
    return new


def _coded(blocks: DataFrame, codebooks: list[np.ndarray], label: str) -> DataFrame:
    """(id, label, code, error) under the final codebooks."""
    sent = blocks.sparkSession.sparkContext.broadcast(codebooks)
    hexed = np.array([f"{i:02x}" for i in range(ENTRIES)], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _trees(sent.value)
        for batch in batches:
            for ids, labels, trees in zip(*(batch.column(c) for c in ("ids", "labels", "trees"))):
                error = np.zeros(len(ids), dtype=np.int64)
                code = np.full(len(ids), "", dtype=object)
                for data, tree, book in zip(trees, entries, sent.value):
                    parts = BoxTree.from_bytes(data.as_py(), len(ids), LEAF)
                    codes, _, _ = assign(parts, tree)
                    gap = parts.points - book[codes[parts.order]]
                    error[parts.order] += (gap * gap).sum(axis=1)
                    code += hexed[codes]
                yield pa.RecordBatch.from_arrays(
                    [ids.values, labels.values, pa.array(code, pa.string()), pa.array(error)],
                    ["id", "label", "code", "error"],
                )

    return blocks.mapInArrow(run, f"id bigint, label {label}, code string, error bigint")


def compress(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of all vectors, (key, label, code, error), and the codebooks they refer to.

    A component x counts as floor(1024 * x). Codebooks start from the parts of the 256
    smallest keys, or of all rows if they are fewer. ``code`` has two hex digits for
    each part; ``error`` is the squared distance to what the code stands for.

    Vectors that are null or empty or hold a null or non-finite component are
    dropped, as are those of another length than the vector of the smallest key.
    That length has to be a multiple of ``parts``, and components lie within
    65536 of zero, else this fails. Keys are whole numbers; a null key comes last
    in the order, and rows that repeat a key are vectors of their own. An empty
    table gives no rows and codebooks without entries.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    whole = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * SCALE))
    kept = vectors.where(finite(vector)).select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), whole.alias("vec"))
    ranked = lambda rows, n: rows.orderBy(F.asc_nulls_last("id"), "vec").limit(n).select("vec").collect()
    kind = kept.schema["label"].dataType.simpleString()
    first = ranked(kept, 1)
    if not first:
        return spark.createDataFrame([], f"id bigint, label {kind}, code string, error bigint").withColumnsRenamed({"id": key, "label": label}), []
    size = len(first[0]["vec"])
    if size % parts:
        raise ValueError(f"vectors of {size} components do not divide into {parts} parts")
    kept = kept.where(F.size("vec") == size)
    start = np.array([r["vec"] for r in ranked(kept, ENTRIES)], dtype=np.int64)
    codebooks = np.split(start, parts, axis=1)
    blocks = stage(_blocks(kept, size, parts), "blocks")
    for _ in range(rounds):
        codebooks = _rounded(blocks, codebooks)
    coded = stage(_coded(blocks, codebooks, kind), "codes")
    return coded.withColumnsRenamed({"id": key, "label": label}), codebooks


def codebooks_digest(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all components, by part, entry and position, as decimals between commas."""
    text = ",".join(str(x) for book in codebooks for x in book.reshape(-1).tolist())
    return hashlib.sha256(text.encode()).hexdigest()


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with the error summed over equal labels, nulls together.

    Errors are summed within tasks first, so one label may have most rows.
    """
    summed = coded.groupBy(F.col(label).alias("of_label")).agg(F.sum("error").alias("label_error"))
    met = coded.join(summed, coded[label].eqNullSafe(summed["of_label"]))
    return met.drop("of_label")
