"""Training sets."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..schema import FEATURES
from ..session import stage
from .features import (
    calendar_parts,
    customer_day_join,
    finance_day_basic,
    marketing_customer_day,
)
from .ordered import exact_quantiles

# Fixed value: the share of rows below the label threshold.
THRESHOLD_QUANTILE = 0.8


def training_set(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    return features.join(labels, key)


def fraud_threshold(
    df: DataFrame, column: str = "fraud_score", q: float = THRESHOLD_QUANTILE
) -> DataFrame:
    """The exact interpolated quantile, as one row."""
    found = exact_quantiles(df, column, [q]).select(F.col("quantile").alias("fraud_threshold"))
    # An aggregate always gives one row: NULL for a table without scores.
    return found.agg(F.max("fraud_threshold").alias("fraud_threshold"))


def apply_threshold(scored: DataFrame, threshold: DataFrame) -> DataFrame:
    """Label scores at or above a one-row threshold, read as a scalar subquery."""
    return scored.withColumn("fraud_label", rules.flag(F.col("fraud_score") >= threshold.scalar()))


def score_customer_days(customer_day: DataFrame, finance_day: DataFrame) -> DataFrame:
    joined = calendar_parts(customer_day_join(customer_day, finance_day))
    return joined.withColumn("fraud_score", rules.customer_day_score())


def label_customer_days(scored: DataFrame) -> DataFrame:
    """Add the label of the top share of scores.

    ``scored`` must be a stored table: the threshold and the comparison have to
    see the same floating-point values.
    """
    return apply_threshold(scored, fraud_threshold(scored))


def training_customer_day(mkt: DataFrame, tx: DataFrame) -> DataFrame:
    """Scored and labelled customer days, from one scan of each input."""
    finance_day = stage(finance_day_basic(tx), "finance-day")
    scored = score_customer_days(marketing_customer_day(mkt), finance_day)
    return label_customer_days(stage(scored, "scored"))


def feature_columns(df: DataFrame, features: list[str] = FEATURES, keep: tuple[str, ...] = ()):
    """The model's columns in order, as doubles; a missing value becomes 0.

    On standardised columns 0 is the mean, so no row is dropped.
    """
    filled = (F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name) for name in features)
    return df.select(*keep, *filled)


def feature_matrix(
    df: DataFrame, features: list[str] = FEATURES, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``keep`` columns and the vector ``features``, a row for every input row."""
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    return assembler.transform(feature_columns(df, features, keep)).select(*keep, "features")
