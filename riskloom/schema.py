"""Input schemas, table names and the dataset registry."""

from __future__ import annotations

from pyspark.sql import types as T

TRANSACTIONS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("transaction_amount", T.DoubleType()),
        T.StructField("account_balance", T.DoubleType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

MARKETING = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("clicks", T.IntegerType()),
        T.StructField("impressions", T.IntegerType()),
        T.StructField("conversion", T.IntegerType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

USER_EVENT = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("transaction_amount", T.DoubleType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("timestamp", T.DoubleType()),
    ]
)

# Messages that are no events, as they came.
REJECTS = T.StructType([T.StructField("value", T.StringType())])

# Namespaces, table names, registry keys and model features.
NAMESPACES = ("raw", "feature", "label", "alert")

# The hourly training table bears this name.
HOURLY_TRAINING = "feature.training_fradu_dataset"

REGISTRY = {
    "finance": "feature.finance",
    "marketing": "feature.marketing",
    "feature_marketing": "feature.marketing",
    "feature_finance": "feature.finance",
    "marketing_score": "feature.marketing_scores",
    "feature_finance_fraud": "feature.finance_fraud_features",
    "feature_marketing_fraud": "feature.marketing_fraud_features",
    "feature_fraud": "feature.feature_fraud",
    "label_fraud": "label.fraud_label",
    "feature_fraud_dataset": "feature.training_fraud_dataset",
    "finance_fraud_daily": "feature.finance_fraud_daily",
    "marketing_fraud_daily": "feature.marketing_fraud_daily",
    "feature_fraud_daily": "feature.feature_fraud_daily",
    "fraud_label_daily": "label.fraud_label_daily",
    "training_fraud_daily": "feature.training_fraud_daily",
    "daily_fraud_alert": "alert.daily_fraud_alert",
}

FEATURES = [
    "tx_count",
    "total_tx_amount",
    "avg_tx_amount",
    "max_tx_amount",
    "std_tx_amount",
    "avg_account_balance",
    "total_clicks",
    "total_impressions",
    "total_conversion",
    "ctr",
    "weekday",
    "month",
    "year",
    "fraud_score",
    "Day",
]
# End of fixed values.


def qualified(name: str, prefix: str = "") -> str:
    """``name`` with ``prefix`` before its namespace."""
    return prefix + name
