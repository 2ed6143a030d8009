"""Hourly, daily, customer-day and customer features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, times
from ..schema import FEATURES

# The model features that describe the transactions of an hour or day.
FINANCE_FEATURES = FEATURES[: FEATURES.index("total_clicks")]


def _finance_aggregates() -> list[Column]:
    amount = F.col("transaction_amount")
    return [
        F.count("*").alias("tx_count"),
        F.sum(amount).alias("total_tx_amount"),
        F.avg(amount).alias("avg_tx_amount"),
        F.max(amount).alias("max_tx_amount"),
        F.stddev_samp(amount).alias("std_tx_amount"),
        F.avg("account_balance").alias("avg_account_balance"),
    ]


def finance_features(tx: DataFrame, grain: str) -> DataFrame:
    """Transaction totals and spread per hour or day."""
    key, bucket = times.GRAINS[grain]
    risky = rules.risky_flag(F.col("transaction_amount"), F.col("account_balance"))
    return tx.groupBy(bucket(F.col("created_at")).alias(key)).agg(
        *_finance_aggregates(), F.sum(risky).alias("risky_tx_count")
    )


def finance_day_basic(tx: DataFrame) -> DataFrame:
    """Daily transaction features without the risky count, keyed by event_date."""
    day = times.day_start(F.col("created_at")).alias("event_date")
    return tx.groupBy(day).agg(*_finance_aggregates())


def marketing_features(mkt: DataFrame, grain: str) -> DataFrame:
    """Marketing activity per hour or day.

    Spark counts the distinct ids after a shuffle on bucket and id, so a bucket
    with most of the rows is spread by id.
    """
    key, bucket = times.GRAINS[grain]
    return mkt.groupBy(bucket(F.col("created_at")).alias(key)).agg(
        F.countDistinct("customer_id").alias("active_users"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("impressions").alias("total_impressions"),
        F.avg("conversion").alias("conversion_rate"),
        F.avg("clicks").alias("avg_clicks_per_user"),
    )


def join_features(
    fin: DataFrame, mkt: DataFrame, key: str, ctr_mode: str = "fractional"
) -> DataFrame:
    """Transaction features with the marketing features of the same hour or day."""
    return (
        fin.join(mkt, key, "left")
        .withColumn("avg_tx_per_event", rules.ratio(F.col("total_tx_amount"), F.col("tx_count")))
        .withColumn(
            "ctr",
            rules.click_rate(F.col("total_clicks"), F.col("total_impressions"), ctr_mode),
        )
    )


def marketing_customer_day(mkt: DataFrame) -> DataFrame:
    """Clicks, impressions and conversions per customer and day; ctr 0 without impressions."""
    day = times.day_start(F.col("created_at")).alias("event_date")
    return with_customer_ctr(
        mkt.groupBy("customer_id", day).agg(
            F.sum("clicks").alias("total_clicks"),
            F.sum("impressions").alias("total_impressions"),
            F.sum("conversion").alias("total_conversion"),
        )
    )


def with_customer_ctr(df: DataFrame) -> DataFrame:
    shown = F.col("total_impressions")
    return df.withColumn(
        "ctr",
        F.when(shown > 0, rules.ratio(F.col("total_clicks"), shown)).otherwise(F.lit(0.0)),
    )


def customer_features(clean: DataFrame) -> DataFrame:
    return clean.groupBy("customer_id").agg(
        F.avg("transaction_amount").alias("avg_tx_amount"),
        F.sum("failed_tx").alias("failed_tx_count"),
        F.count("*").alias("tx_count"),
    )


def calendar_parts(df: DataFrame, column: str = "event_date") -> DataFrame:
    day = F.col(column)
    return (
        df.withColumn("weekday", times.weekday(day))
        .withColumn("month", F.month(day))
        .withColumn("year", F.year(day))
    )


def customer_day_join(customer_day: DataFrame, finance_day: DataFrame) -> DataFrame:
    """Customer days with the transaction features of their date.

    A staged ``finance_day`` has a known size, so the optimizer broadcasts it
    while it is small; beyond that the join sorts and splits a hot date.
    """
    return customer_day.join(finance_day, "event_date").select(
        F.col("customer_id").alias("user_id"),
        "event_date",
        *FINANCE_FEATURES,
        "total_clicks",
        "total_impressions",
        "total_conversion",
        "ctr",
    )
