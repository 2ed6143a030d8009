"""Counts, previews, validation and data profiles."""

from __future__ import annotations

from math import pi, sqrt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import dataset
from .ordered import exact_quantiles

# Box length for whiskers, quartiles, default bins and grid.
WHISKER = 1.5
QUARTILES = [0.25, 0.5, 0.75]
BINS = 30
GRID = 200
# End of fixed values.

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def label_distribution(df: DataFrame, column: str = "fraud_label") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("row_count"))


def source_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per source table, in one result."""
    counts = [
        row_count(df).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def top_customers(df: DataFrame, n: int = 10, desc: bool = False) -> DataFrame:
    """First or last ids in text order: AA1000 comes before AA101."""
    key = F.col("customer_id")
    return df.orderBy(key.desc() if desc else key.asc()).limit(n)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows picked by hash, the same for any partitioning."""
    text = F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))
    return df.orderBy(F.md5(text), key).limit(n)


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)


def validate_dataset(spark: SparkSession, key: str, prefix: str = "") -> DataFrame:
    """Check a registered table: status, reason, row count and columns, as one row."""
    schema = (
        "query_key string, validation_status string, reason string, "
        "row_count bigint, columns array<string>"
    )
    try:
        df = dataset(spark, key, prefix)
        columns = df.columns
    except KeyError:
        row = (key, "error", "Invalid query_key", None, None)
        return spark.createDataFrame([row], schema)
    except AnalysisException as error:
        row = (key, "error", error.getCondition(), None, None)
        return spark.createDataFrame([row], schema)
    filled = F.col("row_count") > 0
    return row_count(df).select(
        F.lit(key).alias("query_key"),
        F.when(filled, "success").otherwise("failed").alias("validation_status"),
        F.when(~filled, "empty table").alias("reason"),
        F.when(filled, F.col("row_count")).alias("row_count"),
        F.when(filled, F.array(*(F.lit(c) for c in columns))).alias("columns"),
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind.split("(")[0] in _NUMERIC]


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per numeric column.

    Moments of all columns come from one row of aggregates, the quartiles from
    ranks bracketed for all columns together.
    """
    columns = columns or numeric_columns(df)
    value = {c: F.col(c).cast("double") for c in columns}
    moments = df.agg(
        *(
            F.struct(
                F.lit(c).alias("column"),
                F.count(v).alias("count"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"),
                F.min(v).alias("min"),
                F.max(v).alias("max"),
            ).alias(f"_{n}")
            for n, (c, v) in enumerate(value.items())
        )
    )
    moments = moments.select(F.explode(F.array(*moments.columns)).alias("row")).select("row.*")
    # Only what lies in a bracket is shuffled, so a row per column costs no more.
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in value.items()))
    long = df.select(F.explode(pairs).alias("pair")).select("pair.*")
    found = exact_quantiles(long, "value", QUARTILES, by=["column"])
    named = (
        F.max(F.when(F.col("prob") == q, F.col("quantile"))).alias(f"q{round(q * 100)}") for q in QUARTILES
    )
    return moments.join(found.groupBy("column").agg(*named), "column", "left")


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column, from one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    return counts.select(
        F.explode(
            F.array(
                *(F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns)
            )
        ).alias("pair")
    ).select("pair.*")


def schema_info(df: DataFrame) -> DataFrame:
    """Column, type and non-NULL count, in column order."""
    counts = df.agg(*(F.count(c).alias(c) for c in df.columns))
    entries = (
        F.struct(
            F.lit(place).alias("position"),
            F.lit(name).alias("column"),
            F.lit(kind).alias("dtype"),
            F.col(name).alias("non_null"),
        )
        for place, (name, kind) in enumerate(df.dtypes)
    )
    return counts.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")


def histogram(df: DataFrame, column: str, bins: int = BINS) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed, empty ones included."""
    value = F.col(column).cast("double")
    low, high = df.agg(F.min(value), F.max(value)).first()
    if low is None:
        low, high = 0.0, 1.0
    if low == high:
        # A column with one value gets a span of width 1 around it.
        low, high = low - 0.5, high + 0.5
    place = F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins))
    counted = (
        df.where(value.isNotNull())
        .groupBy(F.least(place, F.lit(bins)).alias("bin"))
        .agg(F.count("*").alias("rows"))
    )
    edges = df.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin"))
    step = (high - low) / bins
    return edges.join(counted, "bin", "left").select(
        "bin",
        (F.lit(low) + (F.col("bin") - 1) * step).alias("low"),
        (F.lit(low) + F.col("bin") * step).alias("high"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def kde(df: DataFrame, column: str, points: int = GRID) -> DataFrame:
    """Gaussian density on an even grid from minimum to maximum, Scott's bandwidth.

    Every value meets every grid point within its task, where the terms are summed;
    a task shuffles one row per point. NULL densities for a column without spread;
    no rows for one without values.
    """
    value = F.col(column).cast("double")
    low, high, n, std = df.agg(
        F.min(value), F.max(value), F.count(value), F.stddev_samp(value)
    ).first()
    point = F.col("point")
    if not n:
        low = high = 0.0
    x = F.lit(low) + point * (high - low) / (points - 1)
    if not std:
        every = df.sparkSession.range(points if n else 0).select(F.col("id").cast("int").alias("point"))
        return every.select("point", x.alias("x"), F.lit(None).cast("double").alias("density"))
    width = std * n**-0.2
    distance = (x - F.col("v")) / width
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    mass = df.where(value.isNotNull()).select(value.alias("v"), grid).groupBy("point").agg(
        F.sum(F.exp(-0.5 * distance * distance)).alias("mass")
    )
    return mass.select("point", x.alias("x"), (F.col("mass") / (n * width * sqrt(2 * pi))).alias("density"))


def boxplot_stats(df: DataFrame, column: str) -> DataFrame:
    """Quartiles, whiskers and the number of outliers, as one row."""
    # Three rows.
    found = {r["prob"]: r["quantile"] for r in exact_quantiles(df, column, QUARTILES).collect()}
    q1, median, q3 = (
        F.lit(None if q not in found else float(found[q])).cast("double") for q in QUARTILES
    )
    value = F.col(column).cast("double")
    reach = (q3 - q1) * WHISKER
    low, high = q1 - reach, q3 + reach
    return df.agg(
        q1.alias("q1"),
        median.alias("median"),
        q3.alias("q3"),
        F.min(F.when(value >= low, value)).alias("whisker_low"),
        F.max(F.when(value <= high, value)).alias("whisker_high"),
        F.count_if((value < low) | (value > high)).alias("outliers"),
    )
