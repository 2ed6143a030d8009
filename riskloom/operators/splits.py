"""Reproducible splits and scalers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ordered import exact_quantiles, row_numbers

# Share held out, seed, and the range of rescaled scores.
TEST_SHARE = 0.2
SEED = 42
SCORE_RANGE = (0.25, 0.99)
# End of fixed values.

_HASH_RANGE = 2.0**32


def key_hash(key: Sequence[str], seed: int) -> Column:
    """A number below 2^32 from the key and seed, the same on every engine and layout."""
    text = F.concat_ws("|", *(F.col(k).cast("string") for k in key), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def train_test_split(
    df: DataFrame, key: Sequence[str], test: float = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """Add ``split``: "test" for a share of the keys, "train" for the rest."""
    drawn = key_hash(key, seed) / F.lit(_HASH_RANGE) < test
    return df.withColumn("split", F.when(drawn, "test").otherwise("train"))


def stratified_split(
    df: DataFrame, key: Sequence[str], label: str, test: float = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """As ``train_test_split``, with the share met within each label.

    Each label, NULL included, has its own cut on the key hash, found exactly.
    """
    hashed = df.withColumn("_hash", key_hash(key, seed))
    cuts = exact_quantiles(hashed.select(label, "_hash"), "_hash", [test], [label], interpolate=False)
    cuts = cuts.select(F.col(label).alias("_label"), F.col("quantile").alias("_cut"))
    joined = hashed.join(cuts, hashed[label].eqNullSafe(cuts["_label"]), "left")
    drawn = F.when(F.col("_hash") <= F.col("_cut"), "test").otherwise("train")
    return joined.select(*df.columns, drawn.alias("split"))


def validation_holdout(
    df: DataFrame, order_by: Sequence[str | Column], frac: float = TEST_SHARE
) -> DataFrame:
    """Add ``split``: the last ``frac`` of the rows in order is "validation"."""
    numbered = row_numbers(df, order_by, "_number", "_rows")
    kept = F.floor(F.col("_rows") * F.lit(1 - frac))
    return numbered.select(
        *df.columns,
        F.when(F.col("_number") <= kept, "train").otherwise("validation").alias("split"),
    )


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per column."""

    mean: dict[str, float]
    std: dict[str, float]

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(name, self.mean[name], self.std[name]) for name in self.mean]
        frame = spark.createDataFrame(rows, "name string, mean double, std double")
        frame.coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Scaler:
        # One row per column.
        rows = spark.read.parquet(path).collect()
        return Scaler({r["name"]: r["mean"] for r in rows}, {r["name"]: r["std"] for r in rows})


def fit_standard(df: DataFrame, columns: list[str]) -> Scaler:
    """Mean and population deviation of each column, in one pass and one row."""
    row = df.agg(
        *(F.avg(c).alias(f"mean_{c}") for c in columns),
        *(F.stddev_pop(c).alias(f"std_{c}") for c in columns),
    ).first()
    return Scaler(
        {c: row[f"mean_{c}"] for c in columns},
        {c: row[f"std_{c}"] for c in columns},
    )


def apply_standard(df: DataFrame, scaler: Scaler) -> DataFrame:
    """Standardise the scaler's columns in place; a constant column becomes 0."""
    # A constant column may show a deviation of rounding noise only.
    scaled = {}
    for name, mean in scaler.mean.items():
        if mean is None:
            scaled[name] = F.lit(None).cast("double")
            continue
        std = scaler.std[name]
        divisor = std if std > abs(mean) * 1e-13 else 1.0
        scaled[name] = (F.col(name).cast("double") - F.lit(mean)) / F.lit(divisor)
    return df.withColumns(scaled)


def minmax_scale(
    df: DataFrame,
    column: str,
    low: float = SCORE_RANGE[0],
    high: float = SCORE_RANGE[1],
    output: str | None = None,
) -> DataFrame:
    """Rescale a column to [low, high]; a constant column becomes ``low``."""
    value = F.col(column).cast("double")
    least, most = df.agg(F.min(value), F.max(value)).first()
    if least is None:
        return df.withColumn(output or column, F.lit(None).cast("double"))
    width = most - least or 1.0
    scaled = (value - F.lit(least)) / F.lit(width) * (high - low) + F.lit(low)
    return df.withColumn(output or column, scaled)
