"""User events from a stream into the transaction table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import epoch_to_ts
from ..schema import REJECTS, TRANSACTIONS, USER_EVENT
from ..session import scratch_scope, stage
from ..sources.raw import ensure_raw, replace_batch

# Epoch seconds an event may bear: from 1970 up to, not including, 2100. Other
# numbers are another unit or damage.
EARLIEST, LATEST = 0.0, 4_102_444_800.0

# The topic and where a new subscriber starts.
TOPIC = "user_events"
STARTING_OFFSETS = "latest"
# End of fixed values.


def stream_source(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """A stream of raw messages in ``value``.

    Kafka needs its connector on the class path and ``kafka.bootstrap.servers``;
    ``fmt="text"`` with a ``path`` reads files of one JSON message per line.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("subscribe", TOPIC).option("startingOffsets", STARTING_OFFSETS)
    return reader.options(**options).load()


def _complete(event: Column) -> Column:
    present = [event[name].isNotNull() for name in USER_EVENT.names]
    seconds = event["timestamp"]
    return reduce(Column.__and__, present) & (seconds >= EARLIEST) & (seconds < LATEST)


def _transaction_columns() -> list[Column]:
    return [
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("transaction_amount"),
        F.lit(None).cast("double").alias("account_balance"),
        F.col("event_type"),
        epoch_to_ts(F.col("timestamp")).alias("created_at"),
    ]


def parse_events(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split messages into transactions and rejects, for a stream or a batch.

    A message that is no JSON object of the event fields, or whose time lies
    outside the years 1970 to 2099, is rejected with its text, and
    never stops the stream. The parsed message sits in an array of
    one, so that the many uses of its fields parse it once.
    """
    text = F.col("value").cast("string")
    one = F.array(F.from_json(text, USER_EVENT))
    good = raw.select(F.inline(F.filter(one, _complete))).select(*_transaction_columns())
    return good.to(TRANSACTIONS), raw.where(~F.exists(one, _complete)).select(text.alias("value"))


def ingest_events(
    raw: DataFrame,
    good_table: str,
    reject_table: str,
    checkpoint: str,
    once: bool = False,
    interval: str = "1 minute",
    writer: str = "events",
) -> StreamingQuery:
    """Stream messages into the transaction table and the table of rejects, each exactly once.

    Every micro-batch is parsed once and staged, then becomes one batch of
    ``writer`` in both raw tables: one that is repeated after a failure leaves what
    it left before. Streams into one table need names of their own. A session that has
    read a table already refreshes it to see what came later.
    """
    spark = raw.sparkSession
    ensure_raw(spark, good_table, TRANSACTIONS)
    ensure_raw(spark, reject_table, REJECTS)

    def load(batch: DataFrame, number: int) -> None:
        with scratch_scope(batch.sparkSession):
            one = F.array(F.from_json(F.col("value").cast("string"), USER_EVENT))
            parsed = batch.select(F.col("value").cast("string").alias("value"), F.filter(one, _complete).alias("_good"))
            parsed = stage(parsed, "batch")
            good = parsed.select(F.inline("_good")).select(*_transaction_columns()).to(TRANSACTIONS)
            bad = parsed.where(F.size("_good") == 0).select("value")
            replace_batch(good, F.col("created_at"), good_table, writer, number)
            replace_batch(bad, F.current_date(), reject_table, writer, number)

    stream = raw.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    stream = stream.trigger(availableNow=True) if once else stream.trigger(processingTime=interval)
    return stream.start()


def stream_append(
    df: DataFrame, path: str, checkpoint: str, once: bool = False, interval: str = "1 minute"
) -> StreamingQuery:
    """Append a stream to parquet files, each record exactly once across restarts.

    ``once`` stops after what is there; otherwise a micro-batch runs per interval.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()
