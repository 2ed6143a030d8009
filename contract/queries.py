"""One query per operator, over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import rules, times
from riskloom.operators import (
    anomaly,
    clean,
    features,
    ids,
    labels,
    metrics,
    models,
    prompts,
    quality,
    rollup,
    splits,
    training,
)
from riskloom.plans import jobs
from riskloom.schema import FEATURES, HOURLY_TRAINING, qualified
from riskloom.session import scratch_path, stage
from riskloom.sources import files, loads, tables
from riskloom.streaming import events

from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LOAD_TS = "2024-06-01 00:00:00"
RUN_TS = "2024-06-02 03:04:05.678901"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles to a fixed number of digits, so that summation order does not show.

    The small shift keeps values that end in a 5 off the rounding edge.
    """
    shift, scale = F.lit(float(f"3.7e-{digits + 2}")), F.lit(10.0**digits)
    return df.select(
        *(
            (F.rint((F.col(name) + shift) * scale) / scale + F.lit(0.0)).alias(name)
            if kind == "double"
            else F.col(name)
            for name, kind in df.dtypes
        )
    )


def _prefix() -> str:
    return f"q{uuid.uuid4().hex[:12]}_"


def _namespaces(spark: SparkSession) -> str:
    """Fresh namespaces in the shared folder; returns their prefix."""
    prefix = _prefix()
    tables.ensure_namespaces(spark, scratch_path(spark, "namespaces"), prefix)
    return prefix


# Shared inputs


def _feature_hourly(spark: SparkSession, d: str, ctr_mode: str = "fractional") -> DataFrame:
    return features.join_features(
        features.finance_features(fx.tx_hourly(spark, d), "hour"),
        features.marketing_features(fx.mkt_hourly(spark, d), "hour"),
        "event_hour",
        ctr_mode,
    )


def _feature_daily(spark: SparkSession, d: str, ctr_mode: str = "fractional") -> DataFrame:
    return features.join_features(
        features.finance_features(fx.tx_daily(spark, d), "day"),
        features.marketing_features(fx.mkt_daily(spark, d), "day"),
        "event_day",
        ctr_mode,
    )


def _training_daily(spark: SparkSession, d: str) -> DataFrame:
    days = stage(_feature_daily(spark, d), "feature-daily")
    return training.training_set(days, labels.label_daily(days), "event_day")


def _customer_days(spark: SparkSession, d: str) -> DataFrame:
    return training.training_customer_day(fx.mkt_daily(spark, d), fx.tx_daily(spark, d))


def _scored_days(spark: SparkSession, d: str) -> DataFrame:
    """Customer days scored, before the threshold."""
    finance_day = stage(features.finance_day_basic(fx.tx_daily(spark, d)), "finance-day")
    customer_day = features.marketing_customer_day(fx.mkt_daily(spark, d))
    return stage(training.score_customer_days(customer_day, finance_day), "scored")


def _judged(spark: SparkSession, d: str) -> DataFrame:
    """Customer days with a stand-in probability and its decision."""
    days = _customer_days(spark, d)
    probability = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("ctr") * 10))
    return clean.decision_threshold(days.withColumn("fraud_probability", probability))


def _model_rows(spark: SparkSession, d: str) -> tuple[DataFrame, splits.Scaler]:
    """Split customer days and the scaler of their training part."""
    rows = splits.stratified_split(
        jobs.model_rows(_customer_days(spark, d)), ["user_id", "event_date"], "fraud_label"
    )
    rows = stage(rows, "model-rows")
    return rows, splits.fit_standard(rows.where(F.col("split") == "train"), FEATURES)


def _trained_model(spark: SparkSession, d: str):
    rows, scaler = _model_rows(spark, d)
    train = splits.apply_standard(rows.where(F.col("split") == "train"), scaler)
    return rows, scaler, models.train_mlp(train)


def _score_facts(scored: DataFrame, *columns: str) -> DataFrame:
    """Per row: whether the probability is one, and the decision follows it."""
    p = F.col("fraud_probability")
    return scored.select(
        *columns,
        p.between(0, 1).alias("is_probability"),
        (F.col("fraud_prediction") == F.when(p >= 0.5, 1).otherwise(0)).alias("decision_agrees"),
    )


# A network that learned ranks held-out rows at least this well.
LEARNED_AUC = 0.9


# Sources and sinks


@query
def src_csv_header(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    fx.tx_daily(spark, d).write.option("header", True).csv(path)
    text = files.read_csv(spark, path)
    return rounded(
        text.select(
            F.col("tx_id").try_cast("bigint").alias("tx_id"),
            "customer_id",
            F.col("transaction_amount").try_cast("double").alias("transaction_amount"),
            F.col("account_balance").try_cast("double").alias("account_balance"),
            "event_type",
            F.col("created_at").try_cast("timestamp_ntz").alias("created_at"),
        )
    )


@query
def src_csv_semicolon(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    source = fx.table(spark, d, "lineitem").select(*fx.LINE_KEY, "l_quantity", "l_returnflag")
    source.write.option("header", True).option("sep", ";").csv(path)
    return files.read_csv(spark, path, sep=";", schema=source.schema)


@query
def load_finance(spark: SparkSession, d: str) -> DataFrame:
    path, table = scratch_path(spark, "csv"), f"{_namespaces(spark)}raw.finance"
    fx.tx_daily(spark, d).select(
        F.col("transaction_amount").alias("Total Loan"),
        F.col("account_balance").alias("LCY Deposit"),
        F.col("customer_id").alias("Public Deposit"),
    ).write.option("header", True).csv(path)
    return rounded(loads.load_finance(spark, path, table, LOAD_TS))


@query
def load_marketing(spark: SparkSession, d: str) -> DataFrame:
    path, table = scratch_path(spark, "csv"), f"{_namespaces(spark)}raw.marketing"
    # Sorted files, so that file order is the line key's order.
    fx.mkt_lines(spark, d).orderBy(*fx.LINE_KEY).select(
        F.col("clicks").alias("duration"),
        F.col("impressions").alias("campaign"),
        F.col("conversion").alias("previous"),
    ).write.option("header", True).option("sep", ";").csv(path)
    return loads.load_marketing(spark, path, table, LOAD_TS)


@query
def load_finance_own_times(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose file gives a time keep it; those without one, or with no time in it, get the load time."""
    path, table = scratch_path(spark, "csv"), f"{_namespaces(spark)}raw.finance"
    kind = F.col("event_type")
    fx.tx_daily(spark, d).select(
        F.col("transaction_amount").alias("Total Loan"),
        F.col("account_balance").alias("LCY Deposit"),
        F.when(kind == "purchase", F.col("created_at").cast("string")).when(
            F.col("tx_id") % 2 == 0, "no time"
        ).alias("created_at"),
    ).write.option("header", True).csv(path)
    return rounded(loads.load_finance(spark, path, table, LOAD_TS))


@query
def src_parquet(spark: SparkSession, d: str) -> DataFrame:
    return files.read_parquet(spark, f"{d}/orders.parquet")


@query
def sink_parquet_overwrite(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "overwrite")
    tx = fx.tx_hourly(spark, d)
    files.write_parquet(tx.where(F.col("event_type") == "click"), path)
    files.write_parquet(tx, path)
    return rounded(files.read_parquet(spark, path))


@query
def sink_append_chunked(spark: SparkSession, d: str) -> DataFrame:
    name = f"{_namespaces(spark)}raw.finance"
    tx = fx.tx_daily(spark, d)
    for part in ("fail_tx", "purchase"):
        tables.append(tx.where(F.col("event_type") == part), name)
    return rounded(tables.read_table(spark, name))


@query
def src_table(spark: SparkSession, d: str) -> DataFrame:
    name = f"{_namespaces(spark)}feature.finance_fraud_daily"
    tables.materialize(features.finance_features(fx.tx_daily(spark, d), "day"), name)
    return rounded(tables.read_table(spark, name))


@query
def ctas_replace(spark: SparkSession, d: str) -> DataFrame:
    name = f"{_namespaces(spark)}feature.finance_fraud_daily"
    tables.materialize(features.finance_day_basic(fx.tx_daily(spark, d)), name)
    days = features.finance_features(fx.tx_daily(spark, d), "day")
    return rounded(tables.materialize(days, name, "replace"))


@query
def ctas_if_absent(spark: SparkSession, d: str) -> DataFrame:
    name = f"{_namespaces(spark)}feature.finance_fraud_features"
    hours = features.finance_features(fx.tx_hourly(spark, d), "hour")
    tables.materialize(hours, name, "if_absent")
    return rounded(tables.materialize(fx.tx_hourly(spark, d), name, "if_absent"))


@query
def ctas_strict(spark: SparkSession, d: str) -> DataFrame:
    name = f"{_namespaces(spark)}alert.daily_fraud_alert"
    alerts = labels.daily_fraud_alert(labels.label_daily(_feature_daily(spark, d)))
    kept = tables.materialize(alerts, name, "strict")
    try:
        tables.materialize(alerts, name, "strict")
        refused = False
    except AnalysisException:
        refused = True
    return rounded(kept.withColumn("refused", F.lit(refused)))


@query
def namespaces(spark: SparkSession, d: str) -> DataFrame:
    """One stored table per namespace, with its rows."""
    prefix = _namespaces(spark)
    hours = features.finance_features(fx.tx_hourly(spark, d), "hour")
    stored = {
        "raw.finance": fx.tx_hourly(spark, d),
        "feature.finance_fraud_features": hours,
        "label.fraud_label": labels.label_hourly(_feature_hourly(spark, d)),
        "alert.daily_fraud_alert": _alerts(spark, d),
    }
    return quality.source_row_counts(
        {name: tables.materialize(df, qualified(name, prefix)) for name, df in stored.items()}
    )


@query
def query_registry(spark: SparkSession, d: str) -> DataFrame:
    prefix = _namespaces(spark)
    hours = features.marketing_features(fx.mkt_hourly(spark, d), "hour")
    tables.materialize(hours, qualified("feature.marketing_fraud_features", prefix))
    return rounded(tables.dataset(spark, "feature_marketing_fraud", prefix))


# Projections


@query
def silver_clean(spark: SparkSession, d: str) -> DataFrame:
    raw = fx.table(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderkey").alias("tx_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "abc")
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("transaction_amount"),
        F.when(F.col("o_orderstatus") == "F", "fail_tx")
        .when(F.col("o_orderstatus") == "O", "purchase")
        .alias("event_type"),
    )
    return rounded(clean.silver_clean(raw))


@query
def rename_select(spark: SparkSession, d: str) -> DataFrame:
    mapping = {"o_totalprice": "transaction_amount", "o_orderkey": "tx_id"}
    return rounded(clean.rename_select(fx.table(spark, d, "orders"), mapping))


@query
def drop_columns(spark: SparkSession, d: str) -> DataFrame:
    days = _customer_days(spark, d)
    return rounded(clean.drop_columns(days, ["user_id", "event_date", "fraud_label"]))


@query
def ctr_proxy_target(spark: SparkSession, d: str) -> DataFrame:
    days = features.marketing_customer_day(fx.mkt_daily(spark, d))
    return rounded(clean.ctr_proxy_target(days))


@query
def decision_threshold(spark: SparkSession, d: str) -> DataFrame:
    scaled = splits.minmax_scale(_scored_days(spark, d), "fraud_score", output="fraud_probability")
    return rounded(
        clean.decision_threshold(scaled).select(
            "user_id", "event_date", "fraud_probability", "fraud_prediction"
        )
    )


@query
def feature_matrix(spark: SparkSession, d: str) -> DataFrame:
    rows = jobs.model_rows(_scored_days(spark, d))
    matrix = training.feature_matrix(rows, keep=("user_id", "event_date"))
    values = vector_to_array("features")
    return rounded(
        matrix.select(
            "user_id", "event_date", *(values[i].alias(name) for i, name in enumerate(FEATURES))
        )
    )


@query
def day_of_month(spark: SparkSession, d: str) -> DataFrame:
    tx = fx.tx_daily(spark, d).select("tx_id", F.to_date("created_at").alias("event_date"))
    return clean.day_of_month(tx)


# Aggregations and joins


@query
def finance_hourly(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.finance_features(fx.tx_hourly(spark, d), "hour"))


@query
def finance_daily(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.finance_features(fx.tx_daily(spark, d), "day"))


@query
def marketing_hourly(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.marketing_features(fx.mkt_hourly(spark, d), "hour"))


@query
def marketing_daily(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.marketing_features(fx.mkt_daily(spark, d), "day"))


@query
def finance_hourly_rollup(spark: SparkSession, d: str) -> DataFrame:
    return rounded(rollup.finance_rollup(rollup.finance_partials(fx.tx_hourly(spark, d)), "hour"))


@query
def finance_daily_rollup(spark: SparkSession, d: str) -> DataFrame:
    return rounded(rollup.finance_rollup(rollup.finance_partials(fx.tx_hourly(spark, d)), "day"))


@query
def marketing_daily_rollup(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        rollup.marketing_day_rollup(rollup.marketing_partials(fx.mkt_daily(spark, d)))
    )


@query
def marketing_customer_day(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.marketing_customer_day(fx.mkt_daily(spark, d)))


@query
def finance_day_basic(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.finance_day_basic(fx.tx_daily(spark, d)))


@query
def customer_features(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.customer_features(clean.silver_clean(fx.tx_daily(spark, d))))


@query
def feature_hourly(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_feature_hourly(spark, d))


@query
def feature_daily(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_feature_daily(spark, d))


@query
def feature_daily_integer_ctr(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_feature_daily(spark, d, "integer"))


@query
def training_hourly(spark: SparkSession, d: str) -> DataFrame:
    hours = stage(_feature_hourly(spark, d), "feature-hourly")
    return rounded(training.training_set(hours, labels.label_hourly(hours), "event_hour"))


@query
def training_daily(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_training_daily(spark, d))


@query
def customer_day_join(spark: SparkSession, d: str) -> DataFrame:
    finance_day = stage(features.finance_day_basic(fx.tx_daily(spark, d)), "finance-day")
    customer_day = features.marketing_customer_day(fx.mkt_daily(spark, d))
    return rounded(features.customer_day_join(customer_day, finance_day))


@query
def threshold_cross(spark: SparkSession, d: str) -> DataFrame:
    scored = _scored_days(spark, d)
    threshold = training.fraud_threshold(scored)
    return rounded(
        training.apply_threshold(scored, threshold).select(
            "user_id", "event_date", "fraud_score", "fraud_label"
        )
    )


@query
def fraud_threshold(spark: SparkSession, d: str) -> DataFrame:
    return rounded(training.fraud_threshold(_scored_days(spark, d)))


@query
def row_count(spark: SparkSession, d: str) -> DataFrame:
    return quality.row_count(fx.table(spark, d, "lineitem"))


@query
def label_distribution(spark: SparkSession, d: str) -> DataFrame:
    return quality.label_distribution(_customer_days(spark, d))


# Ids


@query
def assign_customer_ids(spark: SparkSession, d: str) -> DataFrame:
    kept = F.when(F.col("impressions") == 50, F.concat(F.lit("C"), F.col("customer_id")))
    rows = fx.mkt_lines(spark, d).withColumn("customer_id", kept).select("customer_id", *fx.LINE_KEY)
    return rounded(ids.assign_customer_ids(rows, fx.LINE_KEY))


@query
def customer_id_valid(spark: SparkSession, d: str) -> DataFrame:
    shaped = (
        F.when(F.col("o_orderstatus") == "P", None)
        .when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("CUSTOMER-"), F.col("o_custkey")))
        .otherwise(F.col("o_custkey").cast("string"))
    )
    return ids.customer_id_violations(
        fx.table(spark, d, "orders").select(shaped.alias("customer_id"))
    )


# Order, limit, sample, union


def _customers(spark: SparkSession, d: str) -> DataFrame:
    return fx.table(spark, d, "customer").select(
        rules.customer_id_text(F.col("c_custkey") + 1).alias("customer_id"),
        F.col("c_acctbal").alias("account_balance"),
    )


@query
def first_customers(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.top_customers(_customers(spark, d)))


@query
def last_customers(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.top_customers(_customers(spark, d), desc=True))


@query
def daily_risk_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(labels.daily_risk_report(_training_daily(spark, d)))


@query
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.seeded_sample(fx.tx_daily(spark, d), "tx_id", 100, 42))


@query
def head(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.head(fx.tx_daily(spark, d), "tx_id"))


@query
def source_row_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.source_row_counts(
        {
            "finance_fraud_features": features.finance_features(fx.tx_hourly(spark, d), "hour"),
            "marketing_fraud_features": features.marketing_features(fx.mkt_hourly(spark, d), "hour"),
        }
    )


# Scalar functions


@query
def calendar_parts(spark: SparkSession, d: str) -> DataFrame:
    tx = fx.tx_daily(spark, d).select("tx_id", F.to_date("created_at").alias("event_date"))
    return features.calendar_parts(tx)


@query
def epoch_to_ts(spark: SparkSession, d: str) -> DataFrame:
    seconds = fx.epoch_seconds(F.col("ts"))
    return fx.table(spark, d, "events").select("event_id", times.epoch_to_ts(seconds).alias("ts"))


# Rules


@query
def risky_flag(spark: SparkSession, d: str) -> DataFrame:
    return labels.risky_flag(fx.tx_hourly(spark, d)).select("tx_id", "risky")


@query
def label_hourly(spark: SparkSession, d: str) -> DataFrame:
    return labels.label_hourly(_feature_hourly(spark, d))


@query
def fraud_score_daily(spark: SparkSession, d: str) -> DataFrame:
    return rounded(labels.fraud_score_daily(_feature_daily(spark, d)))


@query
def label_daily(spark: SparkSession, d: str) -> DataFrame:
    return rounded(labels.label_daily(_feature_daily(spark, d)))


def _alerts(spark: SparkSession, d: str) -> DataFrame:
    return labels.daily_fraud_alert(labels.label_daily(_feature_daily(spark, d)))


@query
def daily_fraud_alert(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_alerts(spark, d))


@query
def alert_actions(spark: SparkSession, d: str) -> DataFrame:
    return rounded(labels.alert_actions(_alerts(spark, d)))


@query
def alert_payload(spark: SparkSession, d: str) -> DataFrame:
    return labels.alert_payload(_alerts(spark, d), "RISK", RUN_TS)


@query
def training_customer_day(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_customer_days(spark, d))


@query
def synthetic_fraud(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        labels.synthetic_fraud(fx.tx_daily(spark, d)).select(
            "tx_id", "transaction_amount", "account_balance", "fraud"
        )
    )


@query
def daily_risk_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(labels.daily_risk_summary(_training_daily(spark, d)))


# Data quality


@query
def validate_dataset(spark: SparkSession, d: str) -> DataFrame:
    prefix = _namespaces(spark)
    tables.materialize(_alerts(spark, d), qualified("alert.daily_fraud_alert", prefix))
    hours = labels.label_hourly(_feature_hourly(spark, d))
    empty = hours.where(F.col("fraud_label") > 1)
    tables.materialize(empty, qualified("label.fraud_label", prefix))
    keys = ["daily_fraud_alert", "label_fraud", "no_such_key"]
    result = quality.validate_dataset(spark, keys[0], prefix)
    for key in keys[1:]:
        result = result.unionByName(quality.validate_dataset(spark, key, prefix))
    return result.withColumn("columns", F.array_join("columns", ","))


@query
def describe(spark: SparkSession, d: str) -> DataFrame:
    lines = fx.table(spark, d, "lineitem")
    return rounded(quality.describe(lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@query
def null_counts(spark: SparkSession, d: str) -> DataFrame:
    return quality.null_counts(_feature_daily(spark, d))


@query
def schema_info(spark: SparkSession, d: str) -> DataFrame:
    return quality.schema_info(_feature_daily(spark, d))


@query
def histogram(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.histogram(fx.table(spark, d, "lineitem"), "l_extendedprice"))


@query
def kde(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.kde(fx.table(spark, d, "events"), "value"), 8)


@query
def boxplot_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.boxplot_stats(fx.table(spark, d, "events"), "value"))


# Model preparation, metrics and models


@query
def train_test_split(spark: SparkSession, d: str) -> DataFrame:
    return splits.train_test_split(fx.tx_daily(spark, d).select("tx_id"), ["tx_id"])


@query
def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    rows = clean.silver_clean(fx.tx_daily(spark, d)).select("tx_id", "failed_tx")
    return splits.stratified_split(rows, ["tx_id"], "failed_tx")


@query
def validation_holdout(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.tx_daily(spark, d).select("tx_id", "created_at")
    return splits.validation_holdout(rows, ["created_at", "tx_id"])


@query
def standard_scale(spark: SparkSession, d: str) -> DataFrame:
    columns = ["transaction_amount", "account_balance", "constant"]
    rows = fx.tx_daily(spark, d).withColumn("constant", F.lit(7.5)).select("tx_id", *columns)
    rows = splits.train_test_split(rows, ["tx_id"])
    scaler = splits.fit_standard(rows.where(F.col("split") == "train"), columns)
    return rounded(splits.apply_standard(rows, scaler))


@query
def minmax_scale(spark: SparkSession, d: str) -> DataFrame:
    scored = _scored_days(spark, d).select("user_id", "event_date", "fraud_score")
    return rounded(splits.minmax_scale(scored, "fraud_score"))


@query
def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return metrics.confusion_matrix(_judged(spark, d), "fraud_label", "fraud_prediction")


@query
def classification_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(
        metrics.classification_report(_judged(spark, d), "fraud_label", "fraud_prediction")
    )


@query
def roc_auc(spark: SparkSession, d: str) -> DataFrame:
    judged = stage(_judged(spark, d).select("fraud_label", "fraud_probability"), "judged")
    return rounded(metrics.roc_auc(judged, "fraud_label", "fraud_probability"))


@query
def roc_auc_binned(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.roc_auc_binned(_judged(spark, d), "fraud_label", "fraud_probability"))


@query
def log_loss(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.log_loss(_judged(spark, d), "fraud_label", "fraud_probability"))


@query
def prediction_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.prediction_summary(_judged(spark, d)))


@query
def risk_prompt(spark: SparkSession, d: str) -> DataFrame:
    text = prompts.risk_prompt(rounded(_judged(spark, d)))
    return text.select(
        "user_id",
        "event_date",
        F.md5("prompt").alias("prompt_md5"),
        F.length("prompt").alias("prompt_length"),
    )


@query
def train_mlp(spark: SparkSession, d: str) -> DataFrame:
    """Facts of every row scored by a network fitted with the default effort."""
    rows, scaler, model = _trained_model(spark, d)
    scored = stage(models.score_model(model, scaler, rows), "scores")
    auc = metrics.roc_auc(scored.where(F.col("split") == "test"), "fraud_label", "fraud_probability")
    learned = auc.select((F.col("auc") >= LEARNED_AUC).alias("learned")).first()["learned"]
    return _score_facts(scored, "user_id", "event_date").withColumn("learned", F.lit(learned))


def _history_facts(spark: SparkSession, history: models.TrainingHistory) -> DataFrame:
    """Whether the rounds ended as early stopping says, and the network learned."""
    rounds, best = len(history.auc), history.best_round
    stopped = rounds == min(best + models.PATIENCE, models.MAX_ROUNDS)
    first_best = best == 1 + history.auc.index(max(history.auc))
    row = (first_best, stopped, max(history.auc) >= LEARNED_AUC)
    return spark.createDataFrame([row], "best_is_first_maximum boolean, stopped_in_time boolean, learned boolean")


@query
def early_stopping(spark: SparkSession, d: str) -> DataFrame:
    rows, scaler = _model_rows(spark, d)
    train, test = (
        splits.apply_standard(rows.where(F.col("split") == part), scaler)
        for part in ("train", "test")
    )
    return _history_facts(spark, models.train_early_stopping(train, test))


@query
def score_model(spark: SparkSession, d: str) -> DataFrame:
    """Every probability of a network with given weights."""
    rows = stage(jobs.model_rows(_customer_days(spark, d)), "model-rows")
    scaler = splits.fit_standard(rows, FEATURES)
    scored = models.score_model(fx.fixed_model(spark, len(FEATURES)), scaler, rows)
    return rounded(
        scored.select("user_id", "event_date", "fraud_label", "fraud_probability", "fraud_prediction")
    )


@query
def model_store(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose probability changes over a save and reload."""
    rows, scaler, model = _trained_model(spark, d)
    path = scratch_path(spark, "model")
    models.save_model(spark, model, scaler, path)
    again, scaler_again = models.load_model(spark, path)
    first = models.score_model(model, scaler, rows)
    second = models.score_model(
        again, scaler_again, first.withColumnRenamed("fraud_probability", "before")
    )
    return second.agg(
        F.count("*").alias("rows"),
        F.count_if(~F.col("before").eqNullSafe(F.col("fraud_probability"))).alias("changed"),
    )


@query
def marketing_model(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each part, and whether the network learned the proxy rule there."""
    days = features.marketing_customer_day(fx.mkt_daily(spark, d))
    report = jobs.run_marketing_training(spark, days, scratch_path(spark, "model"))
    return report.select("part", "rows", (F.col("auc") >= LEARNED_AUC).alias("learned"))


@query
def transaction_inference(spark: SparkSession, d: str) -> DataFrame:
    """Every probability of a network with given weights."""
    tx = fx.tx_daily(spark, d)
    scaler = splits.fit_standard(models.transaction_features(tx), models.TRANSACTION_FEATURES)
    model = fx.fixed_model(spark, len(models.TRANSACTION_FEATURES))
    return rounded(models.score_transactions(model, scaler, tx))


@query
def anomaly_isolation(spark: SparkSession, d: str) -> DataFrame:
    """Per row: a score in range, a flag that follows the exact quantile; planted rows are flagged."""
    columns = ["transaction_amount", "account_balance"]
    planted = spark.createDataFrame(
        [(-n, 1e9 * n, -1e9 * n) for n in (1, 2, 3)], "tx_id bigint, transaction_amount double, account_balance double"
    )
    tx = fx.tx_daily(spark, d).select("tx_id", *columns).unionByName(planted)
    scored = stage(anomaly.isolation_scores(tx, "tx_id", columns, contamination=0.05), "anomalies")
    cut = scored.agg(F.percentile("anomaly_score", F.lit(0.05))).first()[0]
    score = F.col("anomaly_score")
    # The quantile is interpolated by two ways of rounding; rows at the cut itself may differ.
    agrees = (F.col("is_anomaly") == F.when(score < cut, 1).otherwise(0)) | (F.abs(score - cut) < 1e-12)
    return scored.select(
        "tx_id",
        score.between(-1, 0).alias("in_range"),
        agrees.alias("flag_agrees"),
        F.when(F.col("tx_id") < 0, F.col("is_anomaly") == 1).alias("planted_flagged"),
    )


# Streaming


def _messages(spark: SparkSession, d: str) -> DataFrame:
    tx = fx.tx_hourly(spark, d)
    broken = F.when(F.col("event_type") == "fail_tx", F.concat(F.lit("{bad "), F.col("tx_id")))
    return tx.select(F.coalesce(broken, fx.event_json(tx)).cast("binary").alias("value"))


# Epoch values of messages whose time is damaged or in another unit, and of good ones.
STRANGE_TIMES = ["1e15", "1e30", "1704067200000", '"NaN"', "-86400", "4102444800", "null"]
GOOD_TIMES = ["0", "1704067200.25", "4102444799"]


def _strange_messages(spark: SparkSession, d: str) -> DataFrame:
    """Each user's message with every strange and good time in turn."""
    users = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    times = F.explode(F.array(*map(F.lit, STRANGE_TIMES + GOOD_TIMES))).alias("at")
    message = F.format_string(
        '{"customer_id": %d, "transaction_amount": 1.5, "event_type": "click", "timestamp": %s}', "id", "at"
    )
    return users.select("id", times).select(message.alias("value"))


@query
def parse_events_strange_times(spark: SparkSession, d: str) -> DataFrame:
    good, bad = events.parse_events(_strange_messages(spark, d))
    seconds = F.unix_micros(F.col("created_at").cast("timestamp")) / 1e6
    kept = good.select("customer_id", F.lit("good").alias("end"), seconds.alias("seconds"))
    lost = bad.select(
        F.get_json_object("value", "$.customer_id").alias("customer_id"),
        F.lit("reject").alias("end"),
        F.lit(None).cast("double").alias("seconds"),
    )
    return kept.unionByName(lost)


@query
def parse_events(spark: SparkSession, d: str) -> DataFrame:
    return rounded(events.parse_events(_messages(spark, d))[0])


@query
def parse_event_rejects(spark: SparkSession, d: str) -> DataFrame:
    return events.parse_events(_messages(spark, d))[1]


@query
def stream_source(spark: SparkSession, d: str) -> DataFrame:
    """Raw messages through a file stream."""
    inbox, out, state = (scratch_path(spark, name) for name in ("inbox", "stream", "state"))
    rows = fx.table(spark, d, "events")
    rows.select(F.concat_ws("|", "event_id", "event_type", "props")).write.text(inbox)
    source = events.stream_source(spark, "text", path=inbox)
    events.stream_append(source, out, state, once=True).awaitTermination()
    return files.read_parquet(spark, out)


@query
def stream_append(spark: SparkSession, d: str) -> DataFrame:
    inbox, out, state = (scratch_path(spark, name) for name in ("inbox", "stream", "state"))
    tx = fx.tx_hourly(spark, d)
    tx.select(fx.event_json(tx).alias("value")).write.text(inbox)
    good, _ = events.parse_events(events.stream_source(spark, "text", path=inbox))
    events.stream_append(good, out, state, once=True).awaitTermination()
    return rounded(files.read_parquet(spark, out))


def _ingested(spark: SparkSession, messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables of the ingest job, stopped and started again on the way."""
    inbox, state = scratch_path(spark, "inbox"), scratch_path(spark, "state")
    cfg = jobs.IngestConfig(state, _prefix(), scratch_path(spark, "namespaces"))
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    for part in (0, 1):
        messages.where(half == part).write.mode("append").text(inbox)
        jobs.run_ingest(spark, events.stream_source(spark, "text", path=inbox), cfg, once=True).awaitTermination()
    good, bad = (spark.table(qualified(name, cfg.prefix)) for name in (cfg.transactions, cfg.rejects))
    return good, bad


@query
def ingest_run(spark: SparkSession, d: str) -> DataFrame:
    """Transactions and rejects as the ingest job stores them."""
    strange = _strange_messages(spark, d)
    good, bad = _ingested(spark, _messages(spark, d).select(F.col("value").cast("string").alias("value")).union(strange))
    amounts = good.groupBy("customer_id", "event_type", F.to_date("created_at").alias("day")).agg(
        F.count("*").alias("rows"), F.sum("transaction_amount").alias("amount")
    )
    dated = good.where(F.col("event_month") != F.trunc("created_at", "month")).count()
    rejects = bad.agg(
        F.lit(None).cast("string").alias("customer_id"),
        F.lit("reject").alias("event_type"),
        F.lit(None).cast("date").alias("day"),
        F.count("*").alias("rows"),
        F.lit(float(dated)).alias("amount"),
    )
    return rounded(amounts.unionByName(rejects))


@query
def ingest_features(spark: SparkSession, d: str) -> DataFrame:
    """Hourly features of the streamed transactions."""
    tx = fx.tx_hourly(spark, d)
    good, _ = _ingested(spark, tx.select(fx.event_json(tx).alias("value")))
    cfg = jobs.FeatureConfig(_prefix(), scratch_path(spark, "namespaces"))
    made = jobs.run_features(spark, good, fx.mkt_hourly(spark, d), cfg)
    return rounded(
        made["feature.feature_fraud"].select(
            "event_hour", "tx_count", "total_tx_amount", "max_tx_amount", "active_users", "total_clicks"
        )
    )


def _finance_csv(spark: SparkSession, d: str) -> str:
    path = scratch_path(spark, "csv")
    fx.tx_daily(spark, d).select(
        F.col("transaction_amount").alias("Total Loan"),
        F.col("account_balance").alias("LCY Deposit"),
        F.col("created_at").cast("string").alias("created_at"),
    ).write.option("header", True).csv(path)
    return path


def _by_day(rows: DataFrame) -> DataFrame:
    """Rows and sums per writer, kind and day, with the month of the partitions they lie in."""
    return rows.groupBy("writer", "event_type", F.to_date("created_at").alias("day"), "event_month").agg(
        F.count("*").alias("rows"), F.sum("transaction_amount").alias("amount"), F.max("created_at").alias("latest")
    )


@query
def ingest_beside_loads(spark: SparkSession, d: str) -> DataFrame:
    """One raw table filled by a finance load and the stream, in either order."""
    csv = _finance_csv(spark, d)
    tx = fx.tx_hourly(spark, d)
    found = []
    for first in ("load", "stream"):
        cfg = jobs.IngestConfig(scratch_path(spark, "state"), _prefix(), scratch_path(spark, "namespaces"))
        tables.ensure_namespaces(spark, cfg.location, cfg.prefix)
        name, inbox = qualified(cfg.transactions, cfg.prefix), scratch_path(spark, "inbox")
        tx.select(fx.event_json(tx).alias("value")).write.text(inbox)
        steps = [
            lambda name=name: loads.load_finance(spark, csv, name, LOAD_TS),
            lambda cfg=cfg, inbox=inbox: jobs.run_ingest(
                spark, events.stream_source(spark, "text", path=inbox), cfg, once=True
            ).awaitTermination(),
        ]
        for step in steps if first == "load" else reversed(steps):
            step()
        spark.catalog.refreshTable(name)
        found.append(_by_day(spark.table(name)).withColumn("first", F.lit(first)))
    return rounded(found[0].unionByName(found[1]))


@query
def ingest_compacted(spark: SparkSession, d: str) -> DataFrame:
    """The raw table after five batches, compaction and a sixth, with its closed partitions per month."""
    tx = fx.tx_hourly(spark, d)
    messages = stage(tx.select(fx.event_json(tx).alias("value")), "messages")
    cfg = jobs.IngestConfig(scratch_path(spark, "state"), _prefix(), scratch_path(spark, "namespaces"))
    name, inbox = qualified(cfg.transactions, cfg.prefix), scratch_path(spark, "inbox")
    part = F.pmod(F.xxhash64("value"), F.lit(6))
    for number in range(6):
        messages.where(part == number).write.mode("append").text(inbox)
        jobs.run_ingest(spark, events.stream_source(spark, "text", path=inbox), cfg, once=True).awaitTermination()
        if number == 4:
            jobs.run_compaction(spark, cfg)
    spark.catalog.refreshTable(name)
    rows = spark.table(name)
    # Batches 0 to 3 of a month lie in one partition; 4 and 5 are as they came.
    closed = rows.where("batch_id < 4").groupBy("event_month").agg(F.countDistinct("batch_id").alias("places"))
    worst = closed.agg(F.max("places").alias("places_a_month"))
    return rounded(_by_day(rows).join(F.broadcast(worst)))


# Jobs


@query
def medallion_run(spark: SparkSession, d: str) -> DataFrame:
    finance_csv, marketing_csv = scratch_path(spark, "csv"), scratch_path(spark, "csv")
    fx.tx_daily(spark, d).write.option("header", True).csv(finance_csv)
    fx.mkt_daily(spark, d).write.option("header", True).csv(marketing_csv)
    cfg = jobs.MedallionConfig(finance_csv, marketing_csv, scratch_path(spark, "lake"))
    return rounded(jobs.run_medallion(spark, cfg))


@query
def feature_run(spark: SparkSession, d: str) -> DataFrame:
    """Row counts of all tables of the feature job."""
    cfg = jobs.FeatureConfig(_prefix(), scratch_path(spark, "namespaces"))
    made = jobs.run_features(spark, fx.tx_daily(spark, d), fx.mkt_daily(spark, d), cfg)
    return quality.source_row_counts(made)


# Tables of the feature job over one input, made once for all queries that look at one of them.
_made: dict[tuple[str, str], dict[str, str]] = {}


def _feature_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    key = spark.sparkContext.applicationId, d
    if key not in _made:
        cfg = jobs.FeatureConfig(_prefix(), scratch_path(spark, "namespaces"))
        made = jobs.run_features(spark, fx.tx_daily(spark, d), fx.mkt_daily(spark, d), cfg)
        _made[key] = {table: qualified(table, cfg.prefix) for table in made}
    return rounded(spark.table(_made[key][name]))


@query
def feature_run_training(spark: SparkSession, d: str) -> DataFrame:
    """The customer-day training set as the feature job stores it."""
    return _feature_table(spark, d, "feature.training_fraud_dataset")


# The other stored tables, each a query of its own.
STORED = {
    "stored_finance_hourly": "feature.finance_fraud_features",
    "stored_marketing_hourly": "feature.marketing_fraud_features",
    "stored_feature_hourly": "feature.feature_fraud",
    "stored_label_hourly": "label.fraud_label",
    "stored_training_hourly": HOURLY_TRAINING,
    "stored_finance_daily": "feature.finance_fraud_daily",
    "stored_marketing_daily": "feature.marketing_fraud_daily",
    "stored_feature_daily": "feature.feature_fraud_daily",
    "stored_label_daily": "label.fraud_label_daily",
    "stored_training_daily": "feature.training_fraud_daily",
    "stored_alert": "alert.daily_fraud_alert",
    "stored_finance_day": "feature.finance",
    "stored_customer_day": "feature.marketing",
    "stored_marketing_scores": "feature.marketing_scores",
}
for _name, _table in STORED.items():
    QUERIES[_name] = partial(_feature_table, name=_table)


@query
def training_run(spark: SparkSession, d: str) -> DataFrame:
    """Facts of a training run with the default effort."""
    cfg = jobs.TrainingConfig(scratch_path(spark, "model"))
    history, report = jobs.run_training(spark, _customer_days(spark, d), cfg)
    held_out = report.select("rows", (F.col("auc") >= LEARNED_AUC).alias("holds_on_test_rows")).first()
    facts = _history_facts(spark, history)
    return facts.withColumns({"test_rows": F.lit(held_out["rows"]), "holds_on_test_rows": F.lit(held_out[1])})


@query
def scoring_run(spark: SparkSession, d: str) -> DataFrame:
    """Every score and prompt of the stored network with given weights."""
    # Rounded days, so that the texts of both engines' numbers agree.
    days = stage(rounded(_customer_days(spark, d)), "days")
    scaler = splits.fit_standard(jobs.model_rows(days), FEATURES)
    path = scratch_path(spark, "model")
    models.save_model(spark, fx.fixed_model(spark, len(FEATURES)), scaler, path)
    scored = jobs.run_scoring(spark, days, path)
    return rounded(
        scored.select(
            "user_id", "event_date", "fraud_probability", "fraud_prediction", "scaled_score", F.md5("prompt").alias("prompt_md5")
        )
    )
