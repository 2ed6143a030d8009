"""The fraud network: training, early stopping, storage and scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..schema import FEATURES
from ..session import stage
from .clean import decision_threshold
from .descent import Descent, loss_and_gradient, pack, probabilities
from .metrics import roc_auc_binned
from .splits import SEED, Scaler, apply_standard
from .training import feature_columns, feature_matrix

# Hidden layers and limits of training.
HIDDEN = (64, 32)
MAX_ROUNDS = 50
PATIENCE = 5
TOLERANCE = 1e-6
# End of fixed values.

# Parquet's settings for rows of many bytes, packed before: parts of some MB, not of a hundred rows at least.
PACKED_FILES = {
    "compression": "none",
    "parquet.block.size": 8 << 20,
    "parquet.block.size.row.check.min": 1,
    "parquet.page.size.row.check.min": 1,
}

TRANSACTION_FEATURES = ["transaction_amount", "account_balance", "failed_tx"]


def train_mlp(
    df: DataFrame,
    features: list[str] = FEATURES,
    label: str = "fraud_label",
    hidden: tuple[int, ...] = HIDDEN,
    max_iter: int = MAX_ROUNDS,
    seed: int = SEED,
    initial_weights=None,
    spread: bool = True,
) -> MultilayerPerceptronClassificationModel:
    """Fit the network on standardised columns.

    The rows are packed and staged once. Gradients are summed over the partitions in each step;
    only the weights, whose number the layers fix, reach the driver. ``spread`` first evens out
    the packed rows, as every step is as slow as its largest partition.
    """
    rows = packed_rows(df, features, label, "train", spread)
    if initial_weights is None:
        initial_weights = _network(df.sparkSession, features, label, hidden, seed).weights
    sizes = [len(features), *hidden, 2]
    descent = Descent(lambda weights: loss_and_gradient(rows, sizes, weights), initial_weights.toArray())
    descent.run(max_iter, TOLERANCE)
    return _network(df.sparkSession, features, label, hidden, seed, descent.weights, max_iter)


def _network(
    spark: SparkSession,
    features: list[str],
    label: str,
    hidden: tuple[int, ...],
    seed: int,
    weights: np.ndarray | None = None,
    max_iter: int = 0,
) -> MultilayerPerceptronClassificationModel:
    """MLlib's model with these weights, else with those it draws first, by a fit without a step."""
    blank = spark.range(0, 1, 1, 1).select(*(F.lit(0.0).alias(name) for name in (label, *features)))
    classifier = MultilayerPerceptronClassifier(
        layers=[len(features), *hidden, 2], featuresCol="features", labelCol=label, maxIter=0, seed=seed
    )
    if weights is not None:
        classifier = classifier.setInitialWeights(Vectors.dense(weights))
    model = classifier.fit(feature_matrix(blank, features, keep=(label,)))
    # The steps were taken before.
    return model._set(maxIter=max_iter)


def packed_rows(
    df: DataFrame, features: list[str], label: str, name: str, spread: bool = True, checked: bool = True
) -> DataFrame:
    """Label and inputs of every row, packed and staged for the many passes over them.

    Files are written in parts of a few blocks, which tasks of a bounded size can read.
    """
    rows = feature_columns(df.withColumn(label, F.col(label).cast("double")), features, (label,))
    packed = pack(rows, checked)
    return stage(spread_rows(packed) if spread else packed, name, **PACKED_FILES)


def spread_rows(df: DataFrame) -> DataFrame:
    """Even partitions, one per core, or per shuffle partition if those are more."""
    spark = df.sparkSession
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(spark.sparkContext.defaultParallelism, shuffles))


@dataclass(frozen=True)
class TrainingHistory:
    """The best model and the validation AUC after each round."""

    model: MultilayerPerceptronClassificationModel
    best_round: int
    auc: list[float | None]


def train_early_stopping(
    train: DataFrame,
    validation: DataFrame,
    features: list[str] = FEATURES,
    label: str = "fraud_label",
    patience: int = PATIENCE,
    max_rounds: int = MAX_ROUNDS,
    steps_per_round: int = 2,
    hidden: tuple[int, ...] = HIDDEN,
    seed: int = SEED,
) -> TrainingHistory:
    """Train in short rounds, each from the last weights, until the AUC stops rising.

    The optimizer keeps its curvature from round to round, so that a step takes little
    more than one pass over the training rows. Inputs are packed, spread and staged once:
    every pass reads them again.
    """
    rows = packed_rows(train, features, label, "train")
    held = packed_rows(validation, features, label, "validation", checked=False)
    best, best_auc, best_round = None, float("-inf"), 0
    history: list[float | None] = []
    # MLlib draws the first weights and makes the model of the best ones.
    start = _network(train.sparkSession, features, label, hidden, seed).weights.toArray()
    sizes = [len(features), *hidden, 2]
    descent = Descent(lambda weights: loss_and_gradient(rows, sizes, weights), start)
    for number in range(1, max_rounds + 1):
        for _ in range(steps_per_round):
            descent.step()
        scored = probabilities(held, sizes, descent.weights, "fraud_probability", label)
        auc = roc_auc_binned(scored, label, "fraud_probability").first()["auc"]
        history.append(auc)
        if best is None or (auc is not None and auc > best_auc):
            best, best_round = descent.weights, number
            best_auc = auc if auc is not None else best_auc
        elif number - best_round >= patience:
            break
    model = _network(train.sparkSession, features, label, hidden, seed, best)
    return TrainingHistory(model, best_round, history)


def with_probability(
    model: MultilayerPerceptronClassificationModel | PipelineModel,
    df: DataFrame,
    features: list[str] = FEATURES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``keep`` columns and the probability of class 1, from standardised columns."""
    scored = model.transform(feature_matrix(df, features, keep))
    probability = vector_to_array(F.col("probability"))[1]
    return scored.select(*keep, probability.alias("fraud_probability"))


def score_model(
    model: MultilayerPerceptronClassificationModel | None,
    scaler: Scaler | None,
    df: DataFrame,
    features: list[str] = FEATURES,
) -> DataFrame:
    """Scale, score and decide for every row; the input columns stay as they were."""
    if model is None or scaler is None:
        raise RuntimeError("Model or scaler not loaded")
    original = F.struct(*df.columns).alias("_row")
    scaled = apply_standard(df.select(original, *features), scaler)
    scored = with_probability(model, scaled, features, keep=("_row",))
    return decision_threshold(scored.select("_row.*", "fraud_probability"))


def save_model(
    spark: SparkSession,
    model: MultilayerPerceptronClassificationModel,
    scaler: Scaler,
    path: str,
) -> None:
    """Store the network and its scaler below one path."""
    model.write().overwrite().save(f"{path}/model")
    scaler.save(spark, f"{path}/scaler")


def load_model(
    spark: SparkSession, path: str
) -> tuple[MultilayerPerceptronClassificationModel, Scaler]:
    model = MultilayerPerceptronClassificationModel.load(f"{path}/model")
    return model, Scaler.load(spark, f"{path}/scaler")


def transaction_features(tx: DataFrame) -> DataFrame:
    return tx.withColumn("failed_tx", rules.failed_flag(F.col("event_type")))


def score_transactions(
    model: MultilayerPerceptronClassificationModel | None,
    scaler: Scaler | None,
    tx: DataFrame,
    key: str = "tx_id",
) -> DataFrame:
    """Probability and label per transaction."""
    scored = score_model(model, scaler, transaction_features(tx), TRANSACTION_FEATURES)
    return scored.select(
        F.col(key).alias("transaction_id"),
        "fraud_probability",
        F.col("fraud_prediction").alias("fraud_label"),
    )
