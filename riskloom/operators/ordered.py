"""Global order without a one-task sort: row numbers, ranks, exact quantiles.

For numbers, rows are range-partitioned and staged; each partition then needs one
number from the others, the weight before it. Quantiles need no order of all rows:
a sketch brackets each wanted rank, and only what lies inside is looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..session import stage

# monotonically_increasing_id() holds the partition above these bits and the
# row within the partition in them.
_ROW_BITS = 33

_BEFORE = (Window.unboundedPreceding, -1)


def in_global_order(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """Stage ``df`` in order, with ``_part`` rising by range and ``_pos`` from 0 within it.

    ``order_by`` must order the rows fully: rows that tie cannot be split over
    partitions. Callers group equal rows first or add a key.
    """
    placed = stage(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "ordered",
    )
    return (
        placed.withColumn("_part", F.shiftright("_slot", _ROW_BITS))
        .withColumn("_pos", F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_slot")
    )


def row_numbers(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str = "row_number",
    total: str | None = None,
) -> DataFrame:
    """Add gap-free numbers from 1 in ``order_by``, and the row count as ``total``.

    Rows that tie are ordered by a hash of the whole row, so the numbers do not
    depend on the layout. Identical rows are interchangeable; they go by where
    they are read, so most rows may be the same and still spread over partitions.
    """
    tied = df.withColumn("_tie", F.xxhash64(*df.columns)).withColumn("_at", F.monotonically_increasing_id())
    placed = in_global_order(tied, [*order_by, "_tie", "_at"])
    counts = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    offsets = counts.select(
        "_part",
        F.coalesce(
            F.sum("_rows").over(Window.orderBy("_part").rowsBetween(*_BEFORE)), F.lit(0)
        ).alias("_start"),
        F.sum("_rows").over(Window.partitionBy()).alias("_total"),
    )
    # One row per range partition: small whatever the data size.
    numbered = placed.join(F.broadcast(offsets), "_part")
    columns = [*df.columns, (F.col("_start") + F.col("_pos") + 1).alias(name)]
    if total:
        columns.append(F.col("_total").alias(total))
    return numbered.select(*columns)


# Accuracy of the sketch, and how far around a wanted rank its bracket reaches, as
# a share of the rows. Bins of a bracket, of about as many rows each.
_ACCURACY = 10_000
_SLACK = 2.0 / _ACCURACY
_BINS = 4


def bin_of(value: Column, edges: Sequence[Column | float]) -> Column:
    """How many of the ascending ``edges`` lie below ``value``, by a search tree of comparisons."""

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        edge = edges[middle] if isinstance(edges[middle], Column) else F.lit(edges[middle])
        return F.when(value > edge, among(middle + 1, high)).otherwise(among(low, middle))

    return among(0, len(edges))


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """All of ``names`` equal, NULL with NULL."""
    return reduce(Column.__and__, (left[n].eqNullSafe(right[n]) for n in names), F.lit(True))


def _bracketed(rows: DataFrame, groups: list[str], probs: Sequence[float], slack: float) -> DataFrame:
    """Rows counted by value inside the brackets and by bin outside: (groups, _bin, _value, _n).

    The brackets' edges are ranks of one sketch, evenly spaced, so a region of many
    rows with close values is cut as any other. A bin is the number of edges below;
    what lies between two brackets is a bin whose rows have no value here.
    """
    steps = _BINS if slack < 1 else 1
    at = [min(1.0, max(0.0, p + slack * (2 * n / steps - 1))) for p in probs for n in range(steps + 1)]
    at, wanted = sorted(set(at)), set(at)
    edges = rows.groupBy(*groups).agg(F.percentile_approx("_value", at, _ACCURACY).alias("_edges"))
    if groups:
        edges = stage(edges, "brackets")
        right = edges.select(*(F.col(g).alias(f"{g}_") for g in groups), "_edges")
        match = reduce(Column.__and__, (rows[g].eqNullSafe(right[f"{g}_"]) for g in groups))
        placed = rows.join(right, match)
    else:
        kind = rows.schema["_value"].dataType
        # One row of a few edges.
        found = F.lit(edges.first()["_edges"] or []).cast(ArrayType(kind))
        placed = rows.withColumn("_edges", found)
    # An edge itself opens the bin that it ends.
    value, edge = F.col("_value"), [F.get("_edges", F.lit(n)) for n in range(len(at))]
    number = bin_of(value, edge)
    spans = [(p - slack, p + slack) for p in probs]
    inner = [n for n in range(1, len(at)) if any(low <= at[n - 1] and at[n] <= high for low, high in spans)]
    # Equal edges make bins that stay empty; a value on a bracket's first edge belongs to it.
    starts = [n for n in range(len(at)) if n not in inner]
    inside = number.isin(*inner) if inner else F.lit(False)
    for n in starts:
        inside = inside | (value == edge[n])
    return placed.groupBy(*groups, number.alias("_bin"), F.when(inside, value).alias("_value")).agg(F.count("*").alias("_n"))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    interpolate: bool = True,
    slack: float = _SLACK,
) -> DataFrame:
    """Exact quantiles of ``value`` per group, NULL values left out: (by…, prob, quantile).

    ``interpolate`` blends the two neighbours linearly; without it the result
    is the smallest value with at least ``prob`` of the rows at or below it.
    NULL is a group of its own.

    A first pass brackets every wanted rank by a sketch, a second counts the
    rows around the brackets and the values inside, both combined in the map
    tasks. Only the counted values, a few thousandths of the rows, are stored, in
    bins of as many rows each; a bin that holds a wanted rank is put in order. A rank
    outside its bracket is looked for again with a wider one, so the result is exact.
    """
    by, probs = list(by), sorted({float(p) for p in probs})
    groups = [f"_g{n}" for n in range(len(by))]
    rows = df.where(F.col(value).isNotNull()).select(
        *(F.col(c).alias(g) for c, g in zip(by, groups)), F.col(value).alias("_value")
    )
    bins = [*groups, "_bin", "_inside"]
    while True:
        counted = stage(_bracketed(rows, groups, probs, slack), "bracketed")
        # Of a bin between brackets, what equals the edge it ends at comes last.
        counted = counted.withColumn("_inside", F.col("_value").isNotNull().cast("int"))
        wanted = _wanted(counted.groupBy(*bins).agg(F.sum("_n").alias("_rows")), groups, probs, interpolate)
        upto = Window.partitionBy(*bins).orderBy("_value").rowsBetween(*_BEFORE)
        near = counted.join(wanted, _same(counted, wanted, bins), "left_semi")
        near = near.withColumn("_below", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
        ranks = wanted.select(*(F.col(c).alias(f"{c}_") for c in bins), "prob", "_weight", "_local")
        match = reduce(Column.__and__, (near[c].eqNullSafe(ranks[f"{c}_"]) for c in bins))
        found = near.join(ranks, match).where(
            (F.col("_local") >= F.col("_below")) & (F.col("_local") < F.col("_below") + F.col("_n"))
        )
        low, high = F.min("_value"), F.max("_value")
        picked = low + F.max("_weight") * (high - low) if interpolate else low
        missed = F.count_if(F.col("_inside") == 0).alias("_missed")
        named = stage(found.groupBy(*groups, "prob").agg(picked.alias("quantile"), missed), "quantiles")
        if slack >= 1 or not named.where("_missed > 0").limit(1).count():
            return named.select(*(F.col(g).alias(c) for c, g in zip(by, groups)), "prob", "quantile")
        slack = min(1.0, 16 * max(slack, 1.0 / _ACCURACY))


def _wanted(sums: DataFrame, groups: list[str], probs: Sequence[float], interpolate: bool) -> DataFrame:
    """The bins that hold a wanted rank, and which row of the bin it is."""
    position = F.col("prob") * (F.col("_total") - 1)
    ceiling = F.greatest(F.ceil(F.col("prob") * F.col("_total")) - 1, F.lit(0))
    ranks = F.array_distinct(F.array(F.floor(position), F.ceil(position)))
    earlier = Window.partitionBy(*groups).orderBy("_bin", "_inside").rowsBetween(*_BEFORE)
    return (
        sums.withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("_total", F.sum("_rows").over(Window.partitionBy(*groups)))
        .withColumn("prob", F.explode(F.array(*(F.lit(p) for p in probs))))
        .withColumn("_weight", position - F.floor(position) if interpolate else F.lit(0.0))
        .withColumn("_rank", F.explode(ranks) if interpolate else ceiling)
        .where((F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_rows")))
        .select(*groups, "_bin", "_inside", "prob", "_weight", (F.col("_rank") - F.col("_start")).alias("_local"))
    )
