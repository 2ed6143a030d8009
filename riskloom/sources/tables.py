"""Catalog tables, database tables and the dataset registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import NAMESPACES, REGISTRY, qualified

# How a query is materialised under a name that may be taken.
MATERIALIZE_MODES = {"replace": "overwrite", "if_absent": "ignore", "strict": "errorifexists"}


def ensure_namespaces(spark: SparkSession, location: str | None = None, prefix: str = "") -> None:
    """Create the four namespaces where absent, below ``location`` if given."""
    for name in NAMESPACES:
        place = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {qualified(name, prefix)}{place}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def dataset(spark: SparkSession, key: str, prefix: str = "") -> DataFrame:
    """The table behind an allow-listed key; other keys raise ``KeyError``."""
    if key not in REGISTRY:
        raise KeyError(f"Invalid query_key: {key}")
    return spark.table(qualified(REGISTRY[key], prefix))


def materialize(df: DataFrame, name: str, mode: str = "replace") -> DataFrame:
    """Save a query as a table: replace it, keep an old one, or refuse."""
    if mode not in MATERIALIZE_MODES:
        raise ValueError(f"mode must be one of {sorted(MATERIALIZE_MODES)}")
    df.write.mode(MATERIALIZE_MODES[mode]).saveAsTable(name)
    return df.sparkSession.table(name)


def append(df: DataFrame, table: str) -> None:
    """Add rows to a table; each task writes its own files, so no chunking."""
    df.write.mode("append").saveAsTable(table)


def jdbc_options(
    url: str, user: str, password: str, driver: str | None = None, connections: int = 16
) -> dict[str, str]:
    """Connection options; ``connections`` bounds parallel sessions on the database."""
    options = {"url": url, "user": user, "password": password, "numPartitions": str(connections)}
    if driver:
        options["driver"] = driver
    return options


def write_jdbc(
    df: DataFrame,
    options: dict[str, str],
    table: str,
    mode: str = "overwrite",
    batch: int = 1000,
    fmt: str = "jdbc",
) -> None:
    """Write to a database table in batches of ``batch`` rows.

    ``fmt`` swaps the transport, for tests and other stores.
    """
    (
        df.write.format(fmt)
        .options(**options)
        .option("dbtable", table)
        .option("batchsize", str(batch))
        .mode(mode)
        .save()
    )


def read_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    split_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    fmt: str = "jdbc",
) -> DataFrame:
    """Read a database table, in parallel slices of ``split_column`` if given, with its bounds.

    Without a split column one task reads the whole table, which suits small ones.
    """
    if (split_column is None) != (bounds is None):
        raise ValueError("a split column and its bounds go together")
    reader = spark.read.format(fmt).options(**options).option("dbtable", table)
    if split_column is not None:
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
        )
    return reader.load()
