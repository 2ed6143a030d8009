"""The risk rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits, weights and texts of the rules.
RISKY_RATIO = 0.8
SYNTHETIC_RATIO = 0.95
RISKY_MIN = 3
HOURLY_TX_MIN = 10
HOURLY_CTR_MIN = 0.02
DAILY_CTR_MIN = 0.01
SPIKE_FACTOR = 2
SCORE_WEIGHTS = {"risky": 0.4, "balance": 0.3, "spread": 0.2, "ctr": 0.1}
SCORE_CAP = 1.0
SCORE_LABEL_MIN = 0.7
ALERT_LEVELS = {"HIGH RISK": 0.8, "MEDIUM RISK": 0.5}
ALERT_REST = "LOW RISK"
ALERT_ACTIONS = {"HIGH": "Freeze high-value tx", "MEDIUM": "Monitor", "LOW": "Ignore"}
CTR_TARGET_MIN = 0.1
PROBABILITY_MIN = 0.5
FAILED_EVENT = "fail_tx"
# End of fixed values.


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, NULL on a zero divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def one_is_null(column: Column) -> Column:
    """The value 1 becomes NULL; every other value stays, zero included."""
    return F.nullif(column.cast("double"), F.lit(1.0))


def risky_flag(amount: Column, balance: Column) -> Column:
    return flag(amount > balance * RISKY_RATIO)


def synthetic_flag(amount: Column, balance: Column, share: float = SYNTHETIC_RATIO) -> Column:
    return flag(amount > balance * share)


def failed_flag(event_type: Column) -> Column:
    return flag(event_type == FAILED_EVENT)


def click_rate(clicks: Column, impressions: Column, mode: str = "fractional") -> Column:
    """Click-through rate, NULL without impressions.

    ``integer`` truncates like a division of whole numbers; the limits of the
    rules only make sense for ``fractional``.
    """
    if mode == "fractional":
        return ratio(clicks, impressions)
    if mode == "integer":
        shown = F.when(impressions != 0, impressions)
        return F.call_function("div", clicks, shown).cast("double")
    raise ValueError(f"unknown ctr mode: {mode}")


def hourly_label() -> Column:
    return flag(
        (F.col("risky_tx_count") >= RISKY_MIN)
        & (F.col("tx_count") >= HOURLY_TX_MIN)
        & (F.col("ctr") < HOURLY_CTR_MIN)
    )


def hourly_reason() -> Column:
    return (
        F.when(F.col("risky_tx_count") >= RISKY_MIN, "HIGH_TX_VS_BALANCE")
        .when(F.col("ctr") < HOURLY_CTR_MIN, "LOW_MARKETING_QUALITY")
        .otherwise("NORMAL")
    )


def fraud_score_raw() -> Column:
    """Weighted day score before the cap.

    NULL where a divisor is 1 or 0 or the day has no deviation.
    """
    w = SCORE_WEIGHTS
    risky = ratio(F.col("risky_tx_count"), one_is_null(F.col("tx_count")))
    balance = ratio(F.col("avg_tx_amount"), one_is_null(F.col("avg_account_balance")))
    spread = ratio(F.col("std_tx_amount"), one_is_null(F.col("avg_tx_amount")))
    missed = 1 - F.coalesce(F.col("ctr"), F.lit(0.0))
    return risky * w["risky"] + balance * w["balance"] + spread * w["spread"] + missed * w["ctr"]


def fraud_score(raw: Column) -> Column:
    """Capped above only; the cap skips a NULL score, which so becomes 1.0."""
    return F.least(F.lit(SCORE_CAP), raw)


def daily_reason() -> Column:
    return (
        F.when(F.col("risky_tx_count") >= RISKY_MIN, "HIGH_TX_VS_BALANCE")
        .when(F.col("ctr") < DAILY_CTR_MIN, "LOW_CTR")
        .when(F.col("std_tx_amount") > F.col("avg_tx_amount") * SPIKE_FACTOR, "TX_VARIANCE_SPIKE")
        .otherwise("NORMAL")
    )


def alert_level(score: Column) -> Column:
    (high, high_min), (medium, medium_min) = ALERT_LEVELS.items()
    return (
        F.when(score >= high_min, high).when(score >= medium_min, medium).otherwise(ALERT_REST)
    )


def customer_day_score() -> Column:
    return ratio(F.col("max_tx_amount"), one_is_null(F.col("avg_tx_amount"))) + F.col("ctr")


def customer_id_text(number: Column) -> Column:
    """AA001 … AA999, AA1000: at least three digits, never cut."""
    digits = number.cast("string")
    return F.concat(F.lit("AA"), F.lpad(digits, F.greatest(F.lit(3), F.length(digits)), F.lit("0")))
