"""Isolation forest per transaction (Liu, Ting and Zhou, 2008)."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import flag
from ..session import stage
from .ordered import exact_quantiles

# Functions of this module travel with the tasks that use them, so executors
# need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TREE_SCHEMA = (
    "tree int, rows int, feature array<int>, cut array<double>, "
    "left array<int>, right array<int>, path array<double>"
)
_FRACTION_BITS = 53
AUTO_CUT = -0.5


def average_path(rows: int) -> float:
    """Mean depth at which a search tree of ``rows`` keys misses."""
    if rows <= 1:
        return 0.0
    if rows == 2:
        return 1.0
    return 2.0 * (np.log(rows - 1.0) + np.euler_gamma) - 2.0 * (rows - 1.0) / rows


def grow_tree(
    tree: int, rows: pd.DataFrame, columns: list[str], seed: int
) -> pd.DataFrame:
    """Grow one tree from the rows drawn for it: nodes as parallel arrays, leaves loop to themselves."""
    data = rows.sort_values("_key")[columns].to_numpy(dtype=float)
    rng = np.random.default_rng([seed, tree])
    limit = int(np.ceil(np.log2(max(len(data), 2))))
    nodes: dict[str, list] = {"feature": [], "cut": [], "left": [], "right": [], "path": []}
    pending = [(np.arange(len(data)), 0, -1, "left")]
    while pending:
        members, depth, parent, side = pending.pop()
        node = len(nodes["feature"])
        if parent >= 0:
            nodes[side][parent] = node
        part = data[members]
        low, high = part.min(axis=0), part.max(axis=0)
        splittable = np.flatnonzero(high > low)
        leaf = depth >= limit or len(members) <= 1 or not len(splittable)
        feature = 0 if leaf else int(rng.choice(splittable))
        cut = 0.0 if leaf else float(rng.uniform(low[feature], high[feature]))
        nodes["feature"].append(feature)
        nodes["cut"].append(cut)
        nodes["left"].append(node)
        nodes["right"].append(node)
        nodes["path"].append(depth + average_path(len(members)) if leaf else 0.0)
        if not leaf:
            below = part[:, feature] < cut
            pending.append((members[~below], depth + 1, node, "right"))
            pending.append((members[below], depth + 1, node, "left"))
    return pd.DataFrame([{"tree": tree, "rows": len(data), **nodes}])


def _fraction(*columns: Column | str) -> Column:
    """A hash of the columns as a number in [0, 1)."""
    low_bits = F.xxhash64(*columns).bitwiseAND(F.lit((1 << _FRACTION_BITS) - 1))
    return low_bits / F.lit(float(1 << _FRACTION_BITS))


def draw_rate(sample: int, rows: int) -> float:
    """Share of the rows that each tree draws, so that hardly any tree gets fewer than ``sample``.

    The margin is six deviations of the number drawn, and a little for small samples.
    """
    return min(1.0, (sample + 6.0 * sample**0.5 + 12.0) / max(rows, 1))


def draw(rows: DataFrame, rate: float, trees: int, seed: int) -> DataFrame:
    """Rows with each ``tree`` that draws them, every tree independently at ``rate``.

    One hash of the key decides whether and by which tree a row is drawn first, so
    the later trees are looked at for drawn rows only.
    """
    rate = min(rate, 1.0 - 1e-12)
    first = F.floor(F.log1p(-_fraction("_key", F.lit(seed))) / F.log1p(F.lit(-rate)))
    met = rows.withColumn("_first", first).where(F.col("_first") < trees)
    later = F.filter(
        F.sequence(F.lit(0).cast("bigint"), F.lit(trees - 1).cast("bigint")),
        lambda t: (t == F.col("_first")) | ((t > F.col("_first")) & (_fraction("_key", F.lit(seed), t) < rate)),
    )
    met = met.withColumn("tree", F.explode(later)).drop("_first")
    return met.withColumn("tree", F.col("tree").cast("int"))


def fit_forest(
    complete: DataFrame, columns: Sequence[str], trees: int, sample: int, seed: int
) -> list[dict[str, np.ndarray]]:
    """Grow ``trees`` trees, each from about ``sample`` rows or a little more.

    ``complete`` has a unique ``_key`` and no missing values. A tree notes how
    many rows it grew from; the model is bounded by trees x sample nodes.
    """
    columns = list(columns)
    rows = complete.count()
    if not rows:
        return []
    drawn = draw(complete, draw_rate(sample, rows), trees, seed)

    def grow(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return grow_tree(int(group[0]), rows, columns, seed)

    # Growing is bound by computation: one small task per tree.
    grown = drawn.repartition(trees, "tree").groupBy("tree").applyInPandas(grow, _TREE_SCHEMA)
    forest = [
        {
            "rows": row["rows"],
            "feature": np.asarray(row["feature"], dtype=np.int64),
            "cut": np.asarray(row["cut"], dtype=float),
            "left": np.asarray(row["left"], dtype=np.int64),
            "right": np.asarray(row["right"], dtype=np.int64),
            "path": np.asarray(row["path"], dtype=float),
        }
        for row in sorted(grown.collect(), key=lambda r: r["tree"])
    ]
    if len(forest) < trees:
        raise RuntimeError(f"{trees - len(forest)} of {trees} trees drew no row")
    return forest


def mean_paths(forest: list[dict[str, np.ndarray]], data: np.ndarray) -> np.ndarray:
    """Mean over the trees of each row's path, as a share of the tree's usual path."""
    rows, width = data.shape
    flat, first = data.ravel(), np.arange(rows) * width
    total = np.zeros(rows)
    for tree in forest:
        # Children side by side: 2 x node for the right one, 2 x node + 1 for the left.
        children = np.column_stack([tree["right"], tree["left"]]).ravel()
        node = np.zeros(rows, dtype=np.int64)
        for _ in range(int(np.ceil(np.log2(max(tree["rows"], 2))))):
            value = flat.take(first + tree["feature"].take(node))
            node = children.take(2 * node + (value < tree["cut"].take(node)))
        total += tree["path"].take(node) / (average_path(tree["rows"]) or 1.0)
    return total / max(len(forest), 1)


def isolation_scores(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    trees: int = 100,
    sample: int = 256,
    seed: int = 42,
    contamination: float | None = None,
) -> DataFrame:
    """Add ``anomaly_score`` (lower is stranger) and ``is_anomaly`` to every row.

    ``key`` must be unique per row, as draws hash it. With ``contamination``
    the flagged share follows an exact quantile of the scores; without it the
    cut is -0.5, a row of average depth. A row with a missing value gets no
    score and no flag.
    """
    columns = list(columns)
    narrow = df.dropna(subset=columns).select(F.col(key).alias("_key"), *(F.col(c).cast("double").alias(c) for c in columns))
    grown = fit_forest(stage(narrow, "forest-rows"), columns, trees, sample, seed)
    # Bounded by trees x sample nodes.
    forest = df.sparkSession.sparkContext.broadcast(grown)

    @F.pandas_udf("double")
    def score(features: pd.DataFrame) -> pd.Series:
        data = features.to_numpy(dtype=float)
        scores = -np.power(2.0, -mean_paths(forest.value, data))
        return pd.Series(np.where(np.isnan(data).any(axis=1), np.nan, scores))

    raw = score(F.struct(*(F.col(c).cast("double").alias(c) for c in columns)))
    scored = df.withColumn("anomaly_score", F.nanvl(raw, F.lit(None).cast("double")))
    if contamination is None:
        # Rounded, so that a row of exactly average depth is not flagged.
        return scored.withColumn("is_anomaly", flag(F.round("anomaly_score", 9) < AUTO_CUT))
    scored = stage(scored, "anomaly")
    cut = exact_quantiles(scored, "anomaly_score", [contamination]).agg(F.max("quantile")).scalar()
    return scored.withColumn("is_anomaly", flag(F.col("anomaly_score") < cut))
