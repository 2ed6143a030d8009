"""Nearest neighbours by vantage-point trees, one for each shard of the vectors.

A small vantage-point tree over a sample deals all vectors into regions, and a
region of many vectors into several shards of bounded size by a hash.
The task of a shard builds a tree over its vectors and asks it with every query
that comes.

A query first asks one shard of its own region. The distance of the k-th vector
found there bounds all that follows: the triangle inequality passes over the
regions, and in a shard the subtrees, whose vectors all lie further off. Pruning
is relaxed by a factor: a subtree is left out if ``factor`` times its least
possible distance exceeds the bound. Factor one is exact; with a larger one each
distance returned is at most ``factor`` times the exact one of its rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from ..session import stage
from .common import bounded_batches, finite, matrix, runs

#: Vectors of one shard, as the bytes of their components in double precision.
SHARD_BYTES = 8 << 20

#: Queries that one copy of a shard answers; a shard with more is copied.
SHARD_QUERIES = 16_384

#: Rows in the sample that regions are drawn from, and the most regions.
SAMPLE_ROWS = 4096
MAX_REGIONS = 256

#: Vectors in a leaf of a tree.
LEAF = 256

#: Part of the distances by which bounds give way to rounding.
SLACK = 1e-12

_NONE = np.iinfo(np.int64).max


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row of ``left`` to each of ``right``, components added in order."""
    total = np.zeros((len(left), len(right)))
    with np.errstate(over="ignore"):
        for at in range(left.shape[1]):
            gap = left[:, at, None] - right[None, :, at]
            gap *= gap
            total += gap
    return np.sqrt(total)


@dataclass
class Split:
    """Rows by their distance to a vantage point: the nearer half, and the rest."""

    vantage: int
    near: Split | np.ndarray
    far: Split | np.ndarray
    near_span: tuple[float, float]
    far_span: tuple[float, float]


class VantageTree:
    """Vantage-point tree over the rows of ``points`` with their ``ids``."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.points, self.ids, self.leaf = points, ids, leaf
        self.root = self._grow(np.arange(len(points)))

    def _grow(self, rows: np.ndarray) -> Split | np.ndarray:
        if len(rows) <= self.leaf:
            return rows
        # A point at the edge sees the others at more different distances.
        edge = int(np.argmax(distances(self.points[rows[:1]], self.points[rows])[0]))
        vantage, rows = int(rows[edge]), np.delete(rows, edge)
        away = distances(self.points[vantage][None], self.points[rows])[0]
        order = np.argsort(away, kind="stable")
        near, far = np.array_split(order, 2)
        spans = [(float(away[half[0]]), float(away[half[-1]])) for half in (near, far)]
        return Split(vantage, self._grow(rows[near]), self._grow(rows[far]), *spans)

    def search(
        self, queries: np.ndarray, own: np.ndarray, k: int, bound: np.ndarray, factor: float = 1.0
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of the query, id, distance) of the k nearest within ``bound``, ties to smaller ids.

        A query doesn't find its ``own`` id.
        """
        best = np.full((len(queries), k), np.inf)
        who = np.full((len(queries), k), _NONE)
        limit = bound.copy()

        def offer(asking: np.ndarray, rows: np.ndarray, away: np.ndarray) -> None:
            fit = (away <= limit[asking, None]) & (self.ids[rows][None] != own[asking, None])
            hit = fit.any(axis=1)
            asking, away, fit = asking[hit], away[hit], fit[hit]
            if not len(asking):
                return
            scores = np.hstack([best[asking], np.where(fit, away, np.inf)])
            names = np.hstack([who[asking], np.where(fit, self.ids[rows][None], _NONE)])
            order = np.lexsort((names, scores), axis=-1)[:, :k]
            best[asking] = np.take_along_axis(scores, order, axis=1)
            who[asking] = np.take_along_axis(names, order, axis=1)
            limit[asking] = np.minimum(limit[asking], best[asking, k - 1])

        def visit(node: Split | np.ndarray, asking: np.ndarray) -> None:
            if not len(asking):
                return
            if isinstance(node, np.ndarray):
                offer(asking, node, distances(queries[asking], self.points[node]))
                return
            away = distances(queries[asking], self.points[node.vantage][None])
            offer(asking, np.array([node.vantage]), away)
            away = away[:, 0]

            def within(span: tuple[float, float]) -> np.ndarray:
                least = np.maximum(span[0] - away, away - span[1]) - SLACK * (away + span[1])
                return factor * least <= limit[asking]

            first = away <= (node.near_span[1] + node.far_span[0]) / 2
            visit(node.near, asking[first & within(node.near_span)])
            visit(node.far, asking[within(node.far_span)])
            visit(node.near, asking[~first & within(node.near_span)])

        if len(self.points):
            visit(self.root, np.arange(len(queries)))
        row, place = np.nonzero(who != _NONE)
        return row, who[row, place], best[row, place]


class Regions:
    """A vantage-point tree whose leaves are numbered regions of the space."""

    def __init__(self, sample: np.ndarray, regions: int):
        self.count = 0
        self.root = self._draw(sample, regions)

    def _draw(self, sample: np.ndarray, regions: int) -> int | tuple:
        if regions > 1 and len(sample) > 1:
            away = distances(sample[:1], sample)[0]
            vantage = sample[int(np.argmax(away))]
            away = distances(vantage[None], sample)[0]
            radius = float(np.quantile(away, (regions // 2) / regions))
            near = away <= radius
            if near.any() and not near.all():
                halves = self._draw(sample[near], regions // 2), self._draw(sample[~near], regions - regions // 2)
                return (vantage, radius, *halves)
        self.count += 1
        return self.count - 1

    def of(self, points: np.ndarray) -> np.ndarray:
        """The region of each row."""
        out = np.zeros(len(points), dtype=np.int64)

        def go(node: int | tuple, rows: np.ndarray) -> None:
            if isinstance(node, int):
                out[rows] = node
                return
            vantage, radius, near, far = node
            inside = distances(vantage[None], points[rows])[0] <= radius
            go(near, rows[inside])
            go(far, rows[~inside])

        go(self.root, np.arange(len(points)))
        return out

    def least(self, points: np.ndarray) -> np.ndarray:
        """For each row, the least distance that a vector of each region can have."""
        out = np.zeros((len(points), self.count))

        def go(node: int | tuple, least: np.ndarray) -> None:
            if isinstance(node, int):
                out[:, node] = least
                return
            vantage, radius, near, far = node
            away = distances(vantage[None], points)[0]
            give = SLACK * (away + radius)
            go(near, np.maximum(least, away - radius - give))
            go(far, np.maximum(least, radius - away - give))

        go(self.root, np.zeros(len(points)))
        return out


def _usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, size, vec) of rows with an id and a vector that is finite and not zero."""
    kind = rows.schema[vector].dataType
    vec = F.col(vector) if isinstance(kind.elementType, FloatType) else F.col(vector).cast("array<double>")
    some = F.exists(F.col(vector).cast("array<double>"), lambda x: x != 0)
    kept = rows.where(F.col(key).isNotNull() & finite(vector) & some)
    return kept.select(F.col(key).cast("long").alias("id"), F.size(vector).alias("size"), vec.alias("vec"))


def _routed(rows: DataFrame, regions: Regions, size: int) -> DataFrame:
    """Rows with their region; vectors of another length than ``size`` are of region -1."""
    schema = rows.schema.simpleString()[len("struct<") : -1] + ",region:bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            region = np.full(batch.num_rows, -1, dtype=np.int64)
            fits = np.flatnonzero(batch.column("size").to_numpy() == size)
            region[fits] = regions.of(matrix(batch.column("vec").take(pa.array(fits))).reshape(-1, size))
            yield batch.append_column("region", pa.array(region))

    return rows.mapInArrow(run, schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """(query, rank, id, score): the k nearest of each query."""
    place = F.row_number().over(Window.partitionBy("query").orderBy("score", "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


_SHARD = ["size", "region", "piece"]


def _pick(key: str) -> Column:
    """The piece of its region that a row lies in: by vector too, should a key repeat."""
    return F.pmod(F.xxhash64(key, "vec"), F.col("pieces"))


def _search(vectors: DataFrame, pieces: DataFrame, visits: DataFrame, k: int, factor: float) -> DataFrame:
    """(query, id, score): what each visit (query, vec, bound, shard) finds in its shard.

    A shard's vectors come before its queries, so a task holds one shard and
    one batch of queries at a time. Shards with many queries are dealt out in slots.
    """
    slots = visits.groupBy(*_SHARD).agg(F.ceil(F.count("*") / SHARD_QUERIES).alias("slots"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("slot")
    held = vectors.join(pieces, ["size", "region"]).withColumn("piece", _pick("id")).join(slots, _SHARD)
    held = held.select(*_SHARD, every, F.lit(0).alias("kind"), "id", "vec", F.lit(0.0).alias("bound"))
    slot = F.pmod(F.xxhash64("query", "vec"), F.col("slots")).alias("slot")
    asked = visits.join(slots, _SHARD)
    asked = asked.select(*_SHARD, slot, F.lit(1).alias("kind"), F.col("query").alias("id"), "vec", "bound")
    group = [*_SHARD, "slot"]
    both = held.unionByName(asked).repartition(*group).sortWithinPartitions(*group, "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, points, ids, tree = None, [], [], None
        for (*shard, kind), part in runs(batches, *group, "kind"):
            if shard != now:
                now, points, ids, tree = shard, [], [], None
            part_points, part_ids = matrix(part.column("vec")), part.column("id").to_numpy()
            if not kind:
                points.append(part_points)
                ids.append(part_ids)
                continue
            if tree is None:
                tree = VantageTree(np.concatenate(points), np.concatenate(ids))
            bound = part.column("bound").to_numpy()
            row, who, score = tree.search(part_points, part_ids, k, bound, factor)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part_ids[row]), pa.array(who), pa.array(score)], ["query", "id", "score"]
            )

    return both.mapInArrow(run, "query bigint, id bigint, score double")


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    factor: float = 1.0,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The k nearest ``vectors`` of each query: (query_id, rank, key, score).

    ``score`` is the Euclidean distance in double precision; equal ones go by
    the smaller key. Both tables have whole-number keys. Rows without a key, and
    vectors that are null, empty or zero or hold a null or non-finite component,
    take no part. A query doesn't find rows of its own key, and only vectors of its
    own length; it has fewer rows if there are fewer than k. Rows that repeat a key
    are candidates each. A query key with several distinct vectors is asked with each,
    and the k nearest of all pairs are returned. Empty tables give no rows.
    """
    if factor < 1:
        raise ValueError("the factor is at least one")
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows, asked = _usable(vectors, key, vector), _usable(queries, key, vector)
    common = rows.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    size, count = (common["size"], common["count"]) if common else (1, 0)
    wanted = min(MAX_REGIONS, -(-count * 8 * size // SHARD_BYTES))
    sample = np.zeros((0, size))
    if wanted > 1:
        picked = rows.where(F.col("size") == size).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS)
        sample = np.array([r["vec"] for r in picked.select("vec").collect()], dtype=np.float64)
    regions = Regions(sample, wanted)
    held = stage(_routed(rows, regions, size), "vectors")
    asked = stage(_routed(asked, regions, size).withColumnRenamed("id", "query").distinct(), "queries")
    many = F.ceil(F.count("*") * F.col("size") * 8 / SHARD_BYTES)
    pieces = stage(held.groupBy("size", "region").agg(many.alias("pieces")), "pieces")

    home = asked.join(pieces, ["size", "region"]).withColumn("piece", _pick("query"))
    home = home.withColumn("bound", F.lit(float("inf")))
    found = stage(_search(held, pieces, home, k, factor), "found-at-home")
    bounds = _ranked(found, k).where(F.col("rank") == k).select("query", F.col("score").alias("bound"))
    bounded = asked.join(bounds, "query", "left").fillna(float("inf"), ["bound"])

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, bound = batch.column("size").to_numpy(), batch.column("bound").to_numpy()
            other = np.flatnonzero(sizes != size)
            own = np.flatnonzero(sizes == size)
            points = matrix(batch.column("vec").take(pa.array(own))).reshape(-1, size)
            row, region = np.nonzero(factor * regions.least(points) <= bound[own, None])
            picked = batch.take(pa.array(np.concatenate([own[row], other])))
            to = np.concatenate([region, np.full(len(other), -1)]).astype(np.int64)
            yield picked.append_column("to", pa.array(to))

    schema = bounded.schema.simpleString()[len("struct<") : -1] + ",to:bigint"
    visits = bounded.mapInArrow(reach, schema).withColumnsRenamed({"region": "home", "to": "region"})
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))
    visits = visits.join(pieces, ["size", "region"]).withColumn("piece", every)
    done = (F.col("region") == F.col("home")) & (F.col("piece") == _pick("query"))
    visits = stage(visits.where(~done).select("query", "vec", "bound", *_SHARD), "visits")
    found = found.unionByName(_search(held, pieces, visits, k, factor))
    return _ranked(found, k).select(
        F.col("query").alias("query_id"), "rank", F.col("id").alias(key), "score"
    )
