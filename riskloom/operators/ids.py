"""Customer ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import customer_id_text
from .ordered import row_numbers

# Fixed value: the widest id the marketing table takes.
MAX_ID_LENGTH = 10


def assign_customer_ids(
    df: DataFrame, order_by: Sequence[str | Column], start: int = 1
) -> DataFrame:
    """Number rows without an id in ``order_by``; given ids stay and use no number."""
    given = df.where(F.col("customer_id").isNotNull())
    missing = row_numbers(df.where(F.col("customer_id").isNull()), order_by, "_number")
    filled = missing.withColumn(
        "customer_id", customer_id_text(F.col("_number") + (start - 1))
    ).select(*df.columns)
    return given.unionByName(filled)


def customer_id_violations(df: DataFrame) -> DataFrame:
    """Ids that break the key: (customer_id, violation, rows)."""
    key = F.col("customer_id")
    per_id = df.groupBy(key).agg(F.count("*").alias("rows"))
    broken = F.array_compact(
        F.array(
            F.when(key.isNull(), "null"),
            F.when(key.isNotNull() & (F.col("rows") > 1), "duplicate"),
            F.when(F.length(key) > MAX_ID_LENGTH, "too_long"),
        )
    )
    return per_id.select("customer_id", F.explode(broken).alias("violation"), "rows")
