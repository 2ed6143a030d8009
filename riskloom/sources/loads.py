"""Raw CSV loads into the transaction and marketing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.rules import customer_id_text
from ..operators.clean import rename_select
from ..schema import MARKETING, TRANSACTIONS
from .files import read_csv
from .raw import append_rows, ensure_raw, raw_rows
from .tables import materialize

# Source column to table column.
FINANCE_COLUMNS = {"Total Loan": "transaction_amount", "LCY Deposit": "account_balance"}
MARKETING_COLUMNS = {"duration": "clicks", "campaign": "impressions", "previous": "conversion"}
# End of fixed values.


def _event_time(raw: DataFrame, load_ts: str | Column) -> Column:
    """The row's own ``created_at`` where the file has one that is a time, else the load time."""
    loaded = (F.lit(load_ts) if isinstance(load_ts, str) else load_ts).cast("timestamp_ntz")
    if "created_at" not in raw.columns:
        return loaded
    return F.coalesce(F.col("created_at").try_cast("timestamp_ntz"), loaded)


def finance_rows(raw: DataFrame, load_ts: str | Column) -> DataFrame:
    """Raw finance rows in the transaction schema; absent columns are NULL."""
    own = {"created_at": "created_at"} if "created_at" in raw.columns else {}
    kept = rename_select(raw, FINANCE_COLUMNS | own)
    return kept.select(
        F.lit(None).cast("string").alias("customer_id"),
        F.col("transaction_amount").try_cast("double").alias("transaction_amount"),
        F.col("account_balance").try_cast("double").alias("account_balance"),
        F.lit(None).cast("string").alias("event_type"),
        _event_time(raw, load_ts).alias("created_at"),
    ).to(TRANSACTIONS)


def marketing_rows(raw: DataFrame, load_ts: str | Column) -> DataFrame:
    """Raw marketing rows with ids numbered in file order.

    A first scan counts the rows of every block of every file; a row's number is what
    comes before its block plus its place in it. Rows are neither moved nor copied.
    Should the second scan cut the files otherwise than the first, it fails.
    """
    placed = raw.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    # One row per block: as many as read tasks, however many rows they hold.
    blocks = placed.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    place = F.col("_row") - F.col("_first")
    number = F.when(place.between(0, F.col("_rows") - 1), F.col("_start") + place + 1).otherwise(
        F.raise_error(F.lit("the files were cut otherwise when read again")).cast("bigint")
    )
    return placed.join(F.broadcast(starts), ["_file", "_block"]).select(
        customer_id_text(number).alias("customer_id"),
        *(F.col(f"`{old}`").try_cast("int").alias(new) for old, new in MARKETING_COLUMNS.items()),
        _event_time(raw, load_ts).alias("created_at"),
    ).select(*MARKETING.names)


def load_finance(spark: SparkSession, path: str, table: str, load_ts: str | Column) -> DataFrame:
    """Append a finance CSV to the raw table ``table``, which streams may fill too; returns all its rows."""
    ensure_raw(spark, table, TRANSACTIONS)
    append_rows(finance_rows(read_csv(spark, path), load_ts), F.col("created_at"), table)
    return raw_rows(spark, table)


def load_marketing(spark: SparkSession, path: str, table: str, load_ts: str | Column) -> DataFrame:
    """Replace ``table`` by a ``;`` separated CSV, ids starting again at AA001."""
    return materialize(marketing_rows(read_csv(spark, path, sep=";"), load_ts), table, "replace")
