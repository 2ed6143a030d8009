"""One prompt text per scored row."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.prompts import PROMPT, fill


def risk_prompt(df: DataFrame, output: str = "prompt") -> DataFrame:
    """Add the analyst prompt for each row; sending it is left to the caller."""
    return df.withColumn(output, fill(PROMPT, dict(df.dtypes)))
