"""Model metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import bin_of

# Distance kept from 0 and 1 in the log loss; thresholds while training.
CLIP = 1e-7
THRESHOLDS = 200
# End of fixed values.

# Bins that scores are cut into.
BINS = 128

_BEFORE = (Window.unboundedPreceding, -1)


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows per (actual, predicted) class 0 or 1, zero cells included."""
    a, p = F.col(actual), F.col(predicted)
    cells = [(i, j) for i in (0, 1) for j in (0, 1)]
    counts = df.agg(*(F.count_if((a == i) & (p == j)).alias(f"n{i}{j}") for i, j in cells))
    entries = (
        F.struct(F.lit(i).alias("actual"), F.lit(j).alias("predicted"), F.col(f"n{i}{j}").alias("rows"))
        for i, j in cells
    )
    return counts.select(F.explode(F.array(*entries)).alias("cell")).select("cell.*")


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, f1 and support: classes 0 and 1, accuracy, macro and weighted mean.

    Undefined ratios are 0. The accuracy row carries its value in ``f1``.
    """
    a, p = F.col(actual), F.col(predicted)

    def zero_safe(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    counts = df.where(a.isNotNull() & p.isNotNull()).agg(
        F.count("*").alias("n"),
        *(F.count_if(a == c).alias(f"actual_{c}") for c in (0, 1)),
        *(F.count_if(p == c).alias(f"predicted_{c}") for c in (0, 1)),
        *(F.count_if((a == c) & (p == c)).alias(f"hit_{c}") for c in (0, 1)),
    )
    per_class = counts
    for c in (0, 1):
        hit = F.col(f"hit_{c}")
        per_class = per_class.withColumns(
            {
                f"precision_{c}": zero_safe(hit, F.col(f"predicted_{c}")),
                f"recall_{c}": zero_safe(hit, F.col(f"actual_{c}")),
                f"f1_{c}": zero_safe(2 * hit, F.col(f"predicted_{c}") + F.col(f"actual_{c}")),
            }
        )

    def entry(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("support"),
        )

    def macro(metric: str) -> Column:
        return (F.col(f"{metric}_0") + F.col(f"{metric}_1")) / 2

    def weighted(metric: str) -> Column:
        total = sum(F.col(f"{metric}_{c}") * F.col(f"actual_{c}") for c in (0, 1))
        return zero_safe(total, F.col("n"))

    names = ("precision", "recall", "f1")
    none = F.lit(None).cast("double")
    accuracy = zero_safe(F.col("hit_0") + F.col("hit_1"), F.col("n"))
    rows = [
        *(
            entry(str(c), *(F.col(f"{m}_{c}") for m in names), F.col(f"actual_{c}"))
            for c in (0, 1)
        ),
        entry("accuracy", none, none, accuracy, F.col("n")),
        entry("macro avg", *(macro(m) for m in names), F.col("n")),
        entry("weighted avg", *(weighted(m) for m in names), F.col("n")),
    ]
    return per_class.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def _scored(df: DataFrame, actual: str, score: Column, *by: str) -> DataFrame:
    """Positives and negatives per score."""
    y = F.col(actual)
    return (
        df.where(y.isNotNull() & score.isNotNull())
        .groupBy(*by, score.alias("_score"))
        .agg(F.count_if(y == 1).alias("_positive"), F.count_if(y == 0).alias("_negative"))
    )


def _area(below: Column) -> Column:
    """Pairs a score wins: negatives below it, and half of those that tie."""
    return F.col("_positive") * (below + F.col("_negative") / 2)


def _auc_row(df: DataFrame, area: Column) -> DataFrame:
    positives, negatives = (
        F.coalesce(F.sum(c), F.lit(0)) for c in ("_positive", "_negative")
    )
    return df.withColumn("_area", area).agg(
        F.try_divide(F.sum("_area"), positives.cast("double") * negatives).alias("auc"),
        positives.alias("positives"),
        negatives.alias("negatives"),
    )


def roc_auc(df: DataFrame, actual: str, probability: str, bins: int = BINS) -> DataFrame:
    """Exact area under the ROC curve, ties counted half, with the class sizes.

    NULL when one class is missing. A sketch cuts the scores into bins of as many
    rows each, whose class sums give every pair across bins; only bins that hold both
    classes are put in order, each by itself. ``df`` is read three times, so stage
    one that is dear to make.
    """
    y, score = F.col(actual), F.col(probability)
    rows = df.where(y.isNotNull() & score.isNotNull()).select(y.alias("_y"), score.alias("_score"))
    ranks = [n / bins for n in range(1, bins)]
    # As many numbers as there are bins.
    found = rows.agg(F.percentile_approx("_score", ranks, 10_000)).first()[0] or []
    edges = sorted({float(edge) for edge in found if edge == edge})
    binned = rows.withColumn("_bin", bin_of(F.col("_score"), edges))
    positive, negative = F.count_if(F.col("_y") == 1), F.count_if(F.col("_y") == 0)
    sums = binned.groupBy("_bin").agg(positive.alias("p"), negative.alias("n")).orderBy("_bin").collect()
    across = below = 0
    for row in sums:
        across += row["p"] * below
        below += row["n"]
    positives = sum(row["p"] for row in sums)
    mixed = [row["_bin"] for row in sums if row["p"] and row["n"]]
    within = _scored(binned.where(F.col("_bin").isin(mixed)), "_y", F.col("_score"), "_bin")
    earlier = Window.partitionBy("_bin").orderBy("_score").rowsBetween(*_BEFORE)
    area = within.withColumn("_area", _area(F.coalesce(F.sum("_negative").over(earlier), F.lit(0))))
    pairs = F.lit(float(across)) + F.coalesce(F.sum("_area"), F.lit(0.0))
    return area.agg(
        F.try_divide(pairs, F.lit(float(positives) * below)).alias("auc"),
        F.lit(positives).cast("bigint").alias("positives"),
        F.lit(below).cast("bigint").alias("negatives"),
    )


def roc_auc_binned(
    df: DataFrame, actual: str, probability: str, thresholds: int = THRESHOLDS
) -> DataFrame:
    """The area over evenly spaced probability thresholds, as ``roc_auc`` otherwise.

    Scores between two thresholds tie, so the data are summed into fewer than
    ``thresholds`` rows within the tasks: cheap enough for every training round.
    """
    step = F.ceil(F.col(probability) * (thresholds - 1))
    score = F.greatest(F.lit(1), F.least(F.lit(thresholds - 1), step))
    score = F.when(F.col(probability).isNotNull(), score)
    earlier = Window.orderBy("_score").rowsBetween(*_BEFORE)
    below = F.coalesce(F.sum("_negative").over(earlier), F.lit(0))
    return _auc_row(_scored(df, actual, score), _area(below))


def log_loss(df: DataFrame, actual: str, probability: str, eps: float = CLIP) -> DataFrame:
    """Mean binary cross-entropy, as one row."""
    p = F.greatest(F.lit(eps), F.least(F.lit(1 - eps), F.col(probability)))
    p = F.when(F.col(probability).isNotNull(), p)
    y = F.col(actual)
    return df.agg(F.avg(-(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("log_loss"))


def prediction_summary(
    df: DataFrame, probability: str = "fraud_probability", predicted: str = "fraud_prediction"
) -> DataFrame:
    p = F.col(probability)
    return df.agg(
        F.count("*").alias("rows"),
        F.min(p).alias("min_probability"),
        F.max(p).alias("max_probability"),
        F.avg(p).alias("mean_probability"),
        F.sum(predicted).alias("predicted_frauds"),
    )
