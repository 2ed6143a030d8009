"""The analyst prompt, as one text column."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# The prompt text, its places for values and their formats.
PROMPT = """
You are a senior fraud risk analyst.

Analyze the following user profile and explain the Fraud Risk based on the features provided.

MODEL OUTPUT:
- Fraud Probability: {fraud_probability:.4f}

USER BEHAVIOR FEATURES:
- Transaction Count: {tx_count}
- Total Transaction Amount: {total_tx_amount}
- Averaege Transaction Amount: {avg_tx_amount}
- Maximum Transaction Amount: {max_tx_amount}
- Standard Deviation of Transaction Amount: {std_tx_amount}
- Average Account Balance: {avg_account_balance}
- Total Clicks: {total_clicks}
- Total Impressions: {total_impressions}
- Total Conversions: {total_conversion}
- Click-Through Rate (CTR): {ctr:.4f}

TASK:
1. Explain why this probability is high or low based on the features above.
2. Highlight key risk drivers.
3. Recommend an action (ALLOW / REVIEW / BLOCK) based on the analysis.
4. Keep the explanation concise and to the point.
5. Explain if fraud prediction was related to the features or not.
6. Limit the response to 1000 words.

DO NOT make up data or features not provided in the profile.
Base reasoning strictly on inputs above.
"""
# End of fixed values.


def plain_number(column: Column) -> Column:
    """Shortest decimal text without an exponent; whole doubles end in ``.0``."""
    text = column.cast("string")
    digits = F.rtrim(column.try_cast("decimal(38,18)").cast("string"), F.lit("0"))
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    # Numbers beyond the decimal range keep their exponent.
    return (
        F.when(text.contains("E"), F.coalesce(plain, F.lower(text)))
        .when(F.isnan(column), "nan")
        .otherwise(text)
    )


def fill(template: str, types: dict[str, str]) -> Column:
    """A ``str.format`` template filled from columns; a missing value reads ``nan``."""
    pieces = []
    for text, name, spec, _ in Formatter().parse(template):
        pieces.append(F.lit(text))
        if name is None:
            continue
        column = F.col(name)
        if spec:
            shown = F.format_string("%" + spec, column.cast("double"))
        elif types[name] in ("double", "float"):
            shown = plain_number(column)
        else:
            shown = column.cast("string")
        pieces.append(F.when(column.isNull(), "nan").otherwise(shown))
    return F.concat(*pieces)
