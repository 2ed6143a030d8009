"""The batch jobs: medallion, features, training and scoring."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import rules
from ..operators import features, labels, metrics, models, rollup, splits, training
from ..operators.clean import ctr_proxy_target, day_of_month, silver_clean
from ..operators.prompts import risk_prompt
from ..schema import FEATURES, HOURLY_TRAINING, qualified
from ..session import scratch_scope, stage
from ..sources import raw
from ..sources.files import read_csv, read_parquet, write_parquet
from ..sources.tables import ensure_namespaces, materialize, write_jdbc
from ..streaming.events import ingest_events


@dataclass(frozen=True)
class MedallionConfig:
    """Paths of the lake layers, named by content, and an optional database sink."""

    finance_csv: str
    marketing_csv: str
    lake: str
    jdbc: dict[str, str] | None = None
    jdbc_table: str = "fraud_features"
    jdbc_format: str = "jdbc"


def run_medallion(spark: SparkSession, cfg: MedallionConfig) -> DataFrame:
    """Raw CSV to columnar, cleaned and per-customer tables; a failure stops the chain."""
    raw, raw_mkt = f"{cfg.lake}/raw/finance", f"{cfg.lake}/raw/marketing"
    clean, gold = f"{cfg.lake}/clean/finance", f"{cfg.lake}/features/customer"
    write_parquet(read_csv(spark, cfg.finance_csv), raw)
    write_parquet(read_csv(spark, cfg.marketing_csv), raw_mkt)
    write_parquet(silver_clean(read_parquet(spark, raw)), clean)
    write_parquet(features.customer_features(read_parquet(spark, clean)), gold)
    result = read_parquet(spark, gold)
    if cfg.jdbc is not None:
        write_jdbc(result, cfg.jdbc, cfg.jdbc_table, fmt=cfg.jdbc_format)
    return result


@dataclass(frozen=True)
class FeatureConfig:
    """Where the feature tables go; ``prefix`` keeps runs apart in one catalog."""

    prefix: str = ""
    location: str | None = None
    ctr_mode: str = "fractional"


def run_features(
    spark: SparkSession, tx: DataFrame, mkt: DataFrame, cfg: FeatureConfig = FeatureConfig()
) -> dict[str, DataFrame]:
    """All feature, label, training and alert tables, in dependency order.

    Both inputs are read once: hourly partials of the transactions serve both
    grains and the customer days, customer-hour partials of the marketing rows
    its hours, customer days and days. The hourly tables are made beside the daily
    ones. Every table is replaced, so a run that is repeated leaves the same tables.
    """
    ensure_namespaces(spark, cfg.location, cfg.prefix)
    tables: dict[str, DataFrame] = {}

    def save(name: str, df: DataFrame) -> DataFrame:
        tables[name] = materialize(df, qualified(name, cfg.prefix), "replace")
        return tables[name]

    with scratch_scope(spark):
        tx_hours = stage(rollup.finance_partials(tx), "finance-partials")
        mkt_hours = stage(rollup.marketing_hour_partials(mkt), "marketing-partials")

        def hourly() -> None:
            finance = save("feature.finance_fraud_features", rollup.finance_rollup(tx_hours, "hour"))
            marketing = save("feature.marketing_fraud_features", rollup.marketing_hour_rollup(mkt_hours))
            joined = save(
                "feature.feature_fraud",
                features.join_features(finance, marketing, "event_hour", cfg.ctr_mode),
            )
            label = save("label.fraud_label", labels.label_hourly(joined))
            save(HOURLY_TRAINING, training.training_set(joined, label, "event_hour"))

        def daily() -> None:
            mkt_days = stage(rollup.customer_days(mkt_hours), "customer-days")
            finance = save("feature.finance_fraud_daily", rollup.finance_rollup(tx_hours, "day"))
            marketing = save("feature.marketing_fraud_daily", rollup.marketing_day_rollup(mkt_days))
            joined = save(
                "feature.feature_fraud_daily",
                features.join_features(finance, marketing, "event_day", cfg.ctr_mode),
            )
            label = save("label.fraud_label_daily", labels.label_daily(joined))
            save("feature.training_fraud_daily", training.training_set(joined, label, "event_day"))
            save("alert.daily_fraud_alert", labels.daily_fraud_alert(label))

            finance_day = save(
                "feature.finance",
                finance.select(F.col("event_day").alias("event_date"), *features.FINANCE_FEATURES),
            )
            customer_day = save("feature.marketing", rollup.customer_day_rollup(mkt_days))
            save("feature.marketing_scores", ctr_proxy_target(customer_day))
            scored = stage(training.score_customer_days(customer_day, finance_day), "scored")
            save("feature.training_fraud_dataset", training.label_customer_days(scored))

        with ThreadPoolExecutor(2) as pool:
            # Each thread works in the scratch folder of this run.
            for branch in [pool.submit(copy_context().run, work) for work in (hourly, daily)]:
                branch.result()
    return tables


@dataclass(frozen=True)
class IngestConfig:
    """Tables a stream of user events fills, and where it notes its progress."""

    checkpoint: str
    prefix: str = ""
    location: str | None = None
    transactions: str = "raw.finance"
    rejects: str = "raw.user_event_rejects"
    interval: str = "1 minute"
    writer: str = "events"


def run_ingest(spark: SparkSession, messages: DataFrame, cfg: IngestConfig, once: bool = False) -> StreamingQuery:
    """Stream messages into the raw transaction table, which ``run_features`` reads, and the rejects.

    Finance loads may fill the same table before, after and meanwhile.
    """
    ensure_namespaces(spark, cfg.location, cfg.prefix)
    good, bad = (qualified(name, cfg.prefix) for name in (cfg.transactions, cfg.rejects))
    return ingest_events(messages, good, bad, cfg.checkpoint, once, cfg.interval, cfg.writer)


def run_compaction(spark: SparkSession, cfg: IngestConfig) -> dict[str, int]:
    """Merge the small partitions that ingest left, while no reader runs; returns how many went, by table."""
    tables = (qualified(name, cfg.prefix) for name in (cfg.transactions, cfg.rejects))
    return {name: raw.compact(spark, name) for name in tables}


@dataclass(frozen=True)
class TrainingConfig:
    """Model location and effort."""

    model_path: str
    key: tuple[str, ...] = ("user_id", "event_date")
    label: str = "fraud_label"
    features: list[str] = field(default_factory=lambda: list(FEATURES))
    patience: int = models.PATIENCE
    max_rounds: int = models.MAX_ROUNDS
    steps_per_round: int = 2


def model_rows(dataset: DataFrame) -> DataFrame:
    """The training table with the day of the month, its date kept as a key."""
    dated = dataset.withColumn("_date", F.col("event_date"))
    return day_of_month(dated, "event_date").withColumnRenamed("_date", "event_date")


def run_training(
    spark: SparkSession, dataset: DataFrame, cfg: TrainingConfig
) -> tuple[models.TrainingHistory, DataFrame]:
    """Split, scale, train with early stopping, store, and measure on the held-out rows.

    Returns the history and one row of metrics.
    """
    with scratch_scope(spark):
        rows = stage(
            splits.stratified_split(model_rows(dataset), cfg.key, cfg.label), "model-rows"
        )
        train, test = (rows.where(F.col("split") == part) for part in ("train", "test"))
        scaler = splits.fit_standard(train, cfg.features)
        # Rounds stop on a part of the training rows, so the test rows only measure.
        parts = splits.stratified_split(train.drop("split"), cfg.key, cfg.label, seed=splits.SEED + 1)
        fitted, stopping = (parts.where(F.col("split") == part) for part in ("train", "test"))
        history = models.train_early_stopping(
            splits.apply_standard(fitted, scaler),
            splits.apply_standard(stopping, scaler),
            cfg.features,
            cfg.label,
            cfg.patience,
            cfg.max_rounds,
            cfg.steps_per_round,
        )
        models.save_model(spark, history.model, scaler, cfg.model_path)
        scored = stage(models.score_model(history.model, scaler, test, cfg.features), "test-scores")
        return history, evaluate(scored, cfg.label)


def evaluate(scored: DataFrame, label: str = "fraud_label") -> DataFrame:
    """AUC, loss, accuracy and the fraud class's precision and recall, as a local row."""
    spark = scored.sparkSession
    auc = metrics.roc_auc(scored, label, "fraud_probability").first()
    loss = metrics.log_loss(scored, label, "fraud_probability").first()
    report = {
        r["class"]: r for r in metrics.classification_report(scored, label, "fraud_prediction").collect()
    }
    row = (
        auc["positives"] + auc["negatives"],
        auc["auc"],
        loss["log_loss"],
        report["accuracy"]["f1"],
        report["1"]["precision"],
        report["1"]["recall"],
    )
    return spark.createDataFrame(
        [row],
        "rows bigint, auc double, log_loss double, accuracy double, precision double, recall double",
    )


def run_scoring(spark: SparkSession, dataset: DataFrame, model_path: str) -> DataFrame:
    """Stored model to probability, decision, rescaled score and prompt for every row.

    The model's probability and the rescaled rule score are separate columns.
    """
    model, scaler = models.load_model(spark, model_path)
    scored = models.score_model(model, scaler, model_rows(dataset))
    rescaled = splits.minmax_scale(scored, "fraud_score", output="scaled_score")
    return risk_prompt(rescaled)


def run_marketing_training(
    spark: SparkSession, marketing: DataFrame, model_path: str, rounds: int = 10
) -> DataFrame:
    """The click-rate network: proxy target, scaling, split, hold-out, metrics.

    The target is a function of the one feature and the scaler sees all rows, so
    the metrics say how well the rule is learnt, not how well fraud is found.
    ``rounds`` is the number of optimizer steps.
    """
    with scratch_scope(spark):
        keys = ["customer_id", "event_date"]
        target = ctr_proxy_target(marketing.select(*keys, "ctr"))
        scaler = splits.fit_standard(target, ["ctr"])
        rows = splits.train_test_split(splits.apply_standard(target, scaler), keys)
        rows = stage(rows, "marketing-rows")
        fitted = splits.validation_holdout(rows.where(F.col("split") == "train").drop("split"), keys)
        train = fitted.where(F.col("split") == "train")
        model = models.train_mlp(train, ["ctr"], "target", max_iter=rounds)
        models.save_model(spark, model, scaler, model_path)
        results = []
        for part, df in (
            ("validation", fitted.where(F.col("split") == "validation")),
            ("test", rows.where(F.col("split") == "test")),
        ):
            scored = models.with_probability(model, df, ["ctr"], keep=("target",))
            scored = scored.withColumn(
                "fraud_prediction", rules.flag(F.col("fraud_probability") >= rules.PROBABILITY_MIN)
            )
            scored = stage(scored.select("target", "fraud_probability", "fraud_prediction"), f"{part}-scores")
            results.append(evaluate(scored, "target").withColumn("part", F.lit(part)))
        return results[0].unionByName(results[1])
