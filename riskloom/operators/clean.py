"""Cleaning, projection and simple targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules


def silver_clean(df: DataFrame) -> DataFrame:
    """Amount as a number, a failed flag, and no row with a NULL in any column.

    A text that is no number counts as NULL. The flag is set before the drop.
    """
    return (
        df.withColumn("transaction_amount", F.col("transaction_amount").try_cast("double"))
        .withColumn("failed_tx", rules.failed_flag(F.col("event_type")))
        .dropna()
    )


def rename_select(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep the mapped columns only, under their new names."""
    return df.select(*(F.col(f"`{old}`").alias(new) for old, new in mapping.items()))


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def ctr_proxy_target(df: DataFrame, cut: float = rules.CTR_TARGET_MIN) -> DataFrame:
    return df.withColumn("target", rules.flag(F.col("ctr") > cut))


def decision_threshold(
    df: DataFrame,
    probability: str = "fraud_probability",
    cut: float = rules.PROBABILITY_MIN,
    output: str = "fraud_prediction",
) -> DataFrame:
    return df.withColumn(output, rules.flag(F.col(probability) >= cut))


def day_of_month(df: DataFrame, column: str = "event_date") -> DataFrame:
    """Replace a date by its day of the month, as ``Day``."""
    return df.withColumn("Day", F.dayofmonth(F.to_date(column))).drop(column)
