"""Several grains from one scan: partial aggregates and what follows from them.

Counts, sums, maxima and squared deviations merge, so the hourly partials of a
transaction table give its hourly and daily features. Distinct ids do not merge
from hours to days, so marketing days come from customer days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, times
from .features import FINANCE_FEATURES, with_customer_ctr


def finance_partials(tx: DataFrame) -> DataFrame:
    """One row per hour, from one scan of the transactions."""
    amount, balance = F.col("transaction_amount"), F.col("account_balance")
    return tx.groupBy(times.hour_start(F.col("created_at")).alias("event_hour")).agg(
        F.count("*").alias("rows"),
        F.sum(amount).alias("amount_sum"),
        F.max(amount).alias("amount_max"),
        F.struct(
            F.count(amount).cast("double").alias("n"),
            F.avg(amount).alias("mean"),
            (F.var_pop(amount) * F.count(amount)).alias("m2"),
        ).alias("moments"),
        F.sum(balance).alias("balance_sum"),
        F.count(balance).alias("balance_rows"),
        F.sum(rules.risky_flag(amount, balance)).alias("risky"),
    )


def _merge_moments(left: Column, right: Column) -> Column:
    """Count, mean and squared deviation of two groups together, without cancellation."""
    n = left["n"] + right["n"]
    gap = right["mean"] - left["mean"]
    share = right["n"] / n
    merged = F.struct(
        n.alias("n"),
        (left["mean"] + gap * share).alias("mean"),
        (left["m2"] + right["m2"] + gap * gap * left["n"] * share).alias("m2"),
    )
    return F.when(right["n"] > 0, merged).otherwise(left)


def finance_rollup(partials: DataFrame, grain: str) -> DataFrame:
    """``finance_features`` from hourly partials.

    A day gathers the moments of its hours, 24 at most.
    """
    key, bucket = times.GRAINS[grain]
    empty = F.struct(*(F.lit(0.0).alias(part) for part in ("n", "mean", "m2")))
    day = partials.groupBy(bucket(F.col("event_hour")).alias(key)).agg(
        F.sum("rows").alias("tx_count"),
        F.sum("amount_sum").alias("total_tx_amount"),
        F.max("amount_max").alias("max_tx_amount"),
        F.aggregate(F.collect_list("moments"), empty, _merge_moments).alias("m"),
        F.try_divide(F.sum("balance_sum"), F.sum("balance_rows")).alias("avg_account_balance"),
        F.sum("risky").alias("risky_tx_count"),
    )
    n = F.col("m")["n"]
    return (
        day.withColumn("avg_tx_amount", F.try_divide(F.col("total_tx_amount"), n))
        .withColumn("std_tx_amount", F.when(n > 1, F.sqrt(F.col("m")["m2"] / (n - 1))))
        .select(key, *FINANCE_FEATURES, "risky_tx_count")
    )


_MARKETING_SUMS = ("total_clicks", "total_impressions", "total_conversion", "click_rows", "conversion_rows")


def marketing_hour_partials(mkt: DataFrame) -> DataFrame:
    """One row per customer and hour, with the counts that averages need.

    Rows are shuffled by hour and id together, so a hot hour is spread by id.
    """
    hour = times.hour_start(F.col("created_at")).alias("event_hour")
    return mkt.groupBy("customer_id", hour).agg(
        F.sum("clicks").alias("total_clicks"),
        F.sum("impressions").alias("total_impressions"),
        F.sum("conversion").alias("total_conversion"),
        F.count("clicks").alias("click_rows"),
        F.count("conversion").alias("conversion_rows"),
    )


def marketing_partials(mkt: DataFrame) -> DataFrame:
    """One row per customer and day, as ``customer_days`` makes from hours."""
    return customer_days(marketing_hour_partials(mkt))


def customer_days(hours: DataFrame) -> DataFrame:
    """Customer days from customer hours."""
    day = times.day_start(F.col("event_hour")).alias("event_date")
    return hours.groupBy("customer_id", day).agg(*(F.sum(c).alias(c) for c in _MARKETING_SUMS))


def customer_day_rollup(partials: DataFrame) -> DataFrame:
    """``marketing_customer_day`` from its partials."""
    return with_customer_ctr(partials.drop("click_rows", "conversion_rows"))


def marketing_day_rollup(partials: DataFrame) -> DataFrame:
    """Daily ``marketing_features`` from customer-day partials."""
    return _marketing_rollup(partials, F.col("event_date").alias("event_day"))


def marketing_hour_rollup(partials: DataFrame) -> DataFrame:
    """Hourly ``marketing_features`` from customer-hour partials."""
    return _marketing_rollup(partials, F.col("event_hour"))


def _marketing_rollup(partials: DataFrame, bucket: Column) -> DataFrame:
    """Each id is one row of its bucket, so counting rows replaces a distinct count."""
    return partials.groupBy(bucket).agg(
        F.count("customer_id").alias("active_users"),
        F.sum("total_clicks").alias("total_clicks"),
        F.sum("total_impressions").alias("total_impressions"),
        F.try_divide(F.sum("total_conversion"), F.sum("conversion_rows")).alias("conversion_rate"),
        F.try_divide(F.sum("total_clicks"), F.sum("click_rows")).alias("avg_clicks_per_user"),
    )
