"""CSV and parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession, path: str, sep: str = ",", schema: StructType | None = None
) -> DataFrame:
    """CSV with a header; all strings unless a schema says otherwise.

    No type inference, which would read the files twice.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
