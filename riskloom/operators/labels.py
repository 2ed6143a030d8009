"""Labels, scores, alerts and reports over hourly and daily features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules

# Message colours per level; other levels take the first.
LEVEL_COLORS = {
    "INFO": "#439FE0",
    "SUCCESS": "#36a64f",
    "WARNING": "#ffae42",
    "ERROR": "#ff0000",
}
# End of fixed values.

ALERT_MESSAGE_LEVELS = {"HIGH RISK": "ERROR", "MEDIUM RISK": "WARNING", "LOW RISK": "INFO"}


def _lookup(column: Column, table: dict[str, str], default: Column) -> Column:
    result = default
    for key, value in table.items():
        result = F.when(column == key, value).otherwise(result)
    return result


def label_hourly(features: DataFrame) -> DataFrame:
    """Label and reason per hour; a reason does not imply the label."""
    return features.select(
        "event_hour",
        rules.hourly_label().alias("fraud_label"),
        rules.hourly_reason().alias("fraud_reason"),
    )


def fraud_score_daily(features: DataFrame) -> DataFrame:
    """Raw and capped score per day."""
    raw = rules.fraud_score_raw()
    return features.select(
        "event_day", raw.alias("raw_score"), rules.fraud_score(raw).alias("fraud_score")
    )


def label_daily(features: DataFrame) -> DataFrame:
    """Score, label and reason per day. The label follows the uncapped score."""
    raw = rules.fraud_score_raw()
    return features.select(
        "event_day",
        rules.fraud_score(raw).alias("fraud_score"),
        rules.flag(raw >= rules.SCORE_LABEL_MIN).alias("fraud_label"),
        rules.daily_reason().alias("fraud_reason"),
    )


def daily_fraud_alert(labels: DataFrame) -> DataFrame:
    return labels.select(
        "event_day",
        "fraud_score",
        "fraud_label",
        rules.alert_level(F.col("fraud_score")).alias("alert_level"),
    )


def alert_actions(alerts: DataFrame) -> DataFrame:
    """The management view: short level and what to do."""
    level = F.regexp_replace("alert_level", " RISK$", "")
    return alerts.select(
        "event_day",
        "fraud_score",
        level.alias("alert_level"),
        _lookup(level, rules.ALERT_ACTIONS, F.lit(None)).alias("action"),
    )


def message_payload(
    level: Column, title: Column, text: Column, component: Column, run_ts: Column
) -> Column:
    """A chat attachment as JSON text; nothing is sent."""
    attachment = F.struct(
        _lookup(level, LEVEL_COLORS, F.lit(LEVEL_COLORS["INFO"])).alias("color"),
        F.concat(F.lit("["), level, F.lit("] "), title).alias("title"),
        text.alias("text"),
        F.concat(component, F.lit(" | "), run_ts, F.lit(" UTC")).alias("footer"),
    )
    return F.to_json(F.struct(F.array(attachment).alias("attachments")))


def alert_payload(alerts: DataFrame, component: str, run_ts: str) -> DataFrame:
    """One message per alert row."""
    level = _lookup(F.col("alert_level"), ALERT_MESSAGE_LEVELS, F.lit("INFO"))
    title = F.concat(F.lit("Daily fraud alert "), F.col("event_day").cast("string"))
    text = F.concat(F.col("alert_level"), F.lit(", label "), F.col("fraud_label").cast("string"))
    return alerts.select(
        "event_day",
        level.alias("level"),
        _lookup(level, LEVEL_COLORS, F.lit(LEVEL_COLORS["INFO"])).alias("color"),
        message_payload(level, title, text, F.lit(component), F.lit(run_ts)).alias("payload"),
    )


def risky_flag(tx: DataFrame) -> DataFrame:
    return tx.withColumn(
        "risky", rules.risky_flag(F.col("transaction_amount"), F.col("account_balance"))
    )


def synthetic_fraud(tx: DataFrame, ratio: float = rules.SYNTHETIC_RATIO) -> DataFrame:
    """The demonstration label: amount above a share of the balance."""
    return tx.withColumn(
        "fraud",
        rules.synthetic_flag(F.col("transaction_amount"), F.col("account_balance"), ratio),
    )


def daily_risk_report(training: DataFrame) -> DataFrame:
    return training.select(
        "event_day", "tx_count", "ctr", "fraud_label", "fraud_score"
    ).orderBy("event_day")


def daily_risk_summary(training: DataFrame) -> DataFrame:
    return training.select(
        "event_day",
        "tx_count",
        "avg_tx_amount",
        "risky_tx_count",
        "ctr",
        "fraud_score",
        "fraud_label",
        "fraud_reason",
    )
