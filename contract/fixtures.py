"""The test tables seen as transactions and marketing rows."""

from __future__ import annotations

from pyspark.ml.classification import MultilayerPerceptronClassificationModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tx_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transactions, a month at hourly density."""
    kind = F.col("event_type")
    return (
        table(spark, sf_dir, "events")
        .join(table(spark, sf_dir, "customer"), F.col("user_id") == F.col("c_custkey"))
        .select(
            F.col("event_id").alias("tx_id"),
            F.col("user_id").cast("string").alias("customer_id"),
            F.col("value").alias("transaction_amount"),
            (F.col("c_acctbal") * 0.05).alias("account_balance"),
            F.when(kind == "error", "fail_tx")
            .when(kind == "purchase", "purchase")
            .otherwise("click")
            .alias("event_type"),
            F.col("ts").alias("created_at"),
        )
    )


def mkt_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    def is_one_of(*kinds: str) -> Column:
        return F.when(F.col("event_type").isin(*kinds), 1).otherwise(0)

    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("customer_id"),
        is_one_of("click").alias("clicks"),
        is_one_of("click", "view").alias("impressions"),
        is_one_of("signup").alias("conversion"),
        F.col("ts").alias("created_at"),
    )


def tx_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transactions, several years at daily density."""
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("tx_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("o_totalprice").alias("transaction_amount"),
            (F.col("c_acctbal") * 50).alias("account_balance"),
            F.when(F.col("o_orderstatus") == "F", "fail_tx")
            .otherwise("purchase")
            .alias("event_type"),
            F.col("o_orderdate").alias("created_at"),
        )
    )


# The columns that order the marketing rows of lineitem fully.
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def mkt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as marketing rows, with their line key."""
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.when(F.col("l_discount") >= 0.1, 1).otherwise(0).alias("clicks"),
            F.col("l_quantity").cast("int").alias("impressions"),
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("conversion"),
            F.col("l_shipdate").alias("created_at"),
            *LINE_KEY,
        )
    )


def mkt_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mkt_lines(spark, sf_dir).drop(*LINE_KEY)


def epoch_seconds(ts: Column) -> Column:
    """UTC epoch seconds of a ``timestamp_ntz``, whatever the session zone."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date"))
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts).cast("double")
    return days.cast("bigint") * 86400 + clock


def event_json(tx: DataFrame) -> Column:
    """A transaction as a user event message."""
    return F.to_json(
        F.struct(
            F.col("customer_id").cast("bigint").alias("customer_id"),
            "transaction_amount",
            "event_type",
            epoch_seconds(F.col("created_at")).alias("timestamp"),
        )
    )


FIXED_HIDDEN = (4, 3)


def fixed_weight(place: int) -> float:
    """Weight number ``place`` of the network that only scores."""
    return ((place * 37) % 101 - 50) / 40


def fixed_layers(inputs: int) -> list[tuple[int, int, int]]:
    """(inputs, outputs, first weight) of each layer; a layer's matrix is stored by column."""
    sizes, first, out = [inputs, *FIXED_HIDDEN, 2], 0, []
    for a, b in zip(sizes, sizes[1:]):
        out.append((a, b, first))
        first += a * b + b
    return out


def fixed_model(spark: SparkSession, inputs: int) -> MultilayerPerceptronClassificationModel:
    """A network with given weights, so that SQL can repeat its forward pass."""
    a, b, first = fixed_layers(inputs)[-1]
    weights = Vectors.dense([fixed_weight(n) for n in range(first + a * b + b)])
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    layers = gateway.new_array(jvm.int, len(FIXED_HIDDEN) + 2)
    for n, size in enumerate([inputs, *FIXED_HIDDEN, 2]):
        layers[n] = size
    values = gateway.new_array(jvm.double, len(weights))
    for n, value in enumerate(weights):
        values[n] = float(value)
    made = jvm.org.apache.spark.ml.classification.MultilayerPerceptronClassificationModel(
        "fixed", jvm.org.apache.spark.ml.linalg.DenseVector(values)
    )
    made.set(made.layers(), layers)
    return MultilayerPerceptronClassificationModel(made)
