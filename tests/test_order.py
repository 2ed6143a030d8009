"""Ids, ranks and quantiles under different partitionings."""

import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.operators import ids, metrics, ordered, quality, splits


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_ids_widen_and_leave_no_gap(spark, partitions):
    rows = spark.range(1, 1002, 1, partitions).select("id", F.lit(None).cast("string").alias("customer_id"))
    got = [r["customer_id"] for r in ids.assign_customer_ids(rows, ["id"]).orderBy("id").collect()]
    assert got[:2] == ["AA001", "AA002"] and got[998:] == ["AA999", "AA1000", "AA1001"]
    assert len(set(got)) == 1001


def test_numbers_of_tied_rows(spark):
    """A third of the rows share their order key."""
    rows = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"))

    def numbers(partitions):
        df = ordered.row_numbers(rows.repartition(partitions), ["k"], "n", "total")
        return {r["id"]: r["n"] for r in df.collect()}

    one = numbers(1)
    assert sorted(one.values()) == list(range(1, 9001)) and numbers(12) == one


def test_given_ids_use_no_number(make):
    rows = make([(1, None), (2, "X"), (3, None)], "id int, customer_id string")
    got = {r["id"]: r["customer_id"] for r in ids.assign_customer_ids(rows, ["id"], start=7).collect()}
    assert got == {1: "AA007", 2: "X", 3: "AA008"}


def test_ids_of_no_rows(make):
    assert ids.assign_customer_ids(make([], "id int, customer_id string"), ["id"]).count() == 0


def test_id_violations(make):
    rows = make([("a",), ("a",), (None,), ("12345678901",), ("ok",)], "customer_id string")
    got = sorted((r["customer_id"] or "", r["violation"], r["rows"]) for r in ids.customer_id_violations(rows).collect())
    assert got == [("", "null", 1), ("12345678901", "too_long", 1), ("a", "duplicate", 2)]


def test_text_order_of_ids(make):
    rows = make([("AA1000",), ("AA101",), ("AA099",)], "customer_id string")
    assert [r[0] for r in quality.top_customers(rows, 2).collect()] == ["AA099", "AA1000"]
    assert [r[0] for r in quality.top_customers(rows, 1, desc=True).collect()] == ["AA101"]


def plain_quantile(values, q):
    values = sorted(values)
    place = q * (len(values) - 1)
    low = int(place)
    high = min(low + 1, len(values) - 1)
    return values[low] + (place - low) * (values[high] - values[low])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60), st.sampled_from([0.0, 0.2, 0.5, 0.8, 1.0]))
def test_quantile_equals_brute_force(spark, values, q):
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    got = ordered.exact_quantiles(df, "v", [q]).first()["quantile"]
    assert got == pytest.approx(plain_quantile([float(v) for v in values], q))


def test_quantiles_with_a_hot_value_and_groups(spark):
    rng = random.Random(1)
    rows = [(g, 5.0 if rng.random() < 0.4 else rng.uniform(0, 10)) for g in "ab" for _ in range(3000)]
    rows += [("a", None)] * 50
    df = spark.createDataFrame(rows, "g string, v double").repartition(12)
    got = {(r["g"], r["prob"]): r["quantile"] for r in ordered.exact_quantiles(df, "v", [0.25, 0.5, 0.9], ["g"]).collect()}
    for g in "ab":
        values = [v for k, v in rows if k == g and v is not None]
        for q in (0.25, 0.5, 0.9):
            assert got[g, q] == pytest.approx(plain_quantile(values, q))


def test_threshold_of_no_scores(make):
    from riskloom.operators.training import fraud_threshold

    assert fraud_threshold(make([], "fraud_score double")).collect()[0][0] is None


def test_splits_do_not_depend_on_layout(spark):
    rows = spark.range(2000).withColumn("label", (F.col("id") % 5 == 0).cast("int"))
    def picked(df):
        return {r["id"] for r in df.where("split = 'test'").collect()}

    for split in (
        lambda df: splits.train_test_split(df, ["id"]),
        lambda df: splits.stratified_split(df, ["id"], "label"),
    ):
        assert picked(split(rows.repartition(1))) == picked(split(rows.repartition(13)))
    parts = splits.stratified_split(rows, ["id"], "label").where("split = 'test'").groupBy("label").count()
    assert {r["label"]: r["count"] for r in parts.collect()} == {0: 320, 1: 80}


def test_holdout_is_the_end(spark):
    rows = splits.validation_holdout(spark.range(103).repartition(7), ["id"])
    assert sorted(r["id"] for r in rows.where("split = 'validation'").collect()) == list(range(82, 103))


def test_sample_does_not_depend_on_layout(spark):
    rows = spark.range(500)
    a = quality.seeded_sample(rows.repartition(1), "id", 10, 42).collect()
    assert a == quality.seeded_sample(rows.repartition(9), "id", 10, 42).collect()
    assert a != quality.seeded_sample(rows, "id", 10, 43).collect()


def brute_auc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_auc(spark):
    rng = random.Random(2)
    rows = [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(800)]
    df = spark.createDataFrame(rows, "y int, p double").repartition(6)
    auc = metrics.roc_auc(df, "y", "p").first()["auc"]
    assert auc == pytest.approx(brute_auc(rows))
    turned = metrics.roc_auc(df.withColumn("p", -F.col("p")), "y", "p").first()["auc"]
    assert turned == pytest.approx(1 - auc)


def test_auc_orders_mixed_bins_only(spark):
    """Distinct scores, some bins of one class; no order of all rows."""
    rng = random.Random(5)
    rows = [(int(rng.random() < (0.0 if n < 600 else n / 2000)), n + rng.random()) for n in range(2000)]
    rows += [(1, None), (None, 0.5)]
    df = spark.createDataFrame(rows, "y int, p double").repartition(6)
    got = metrics.roc_auc(df, "y", "p", bins=16)
    assert "rangepartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    row = got.first()
    assert row["auc"] == pytest.approx(brute_auc([r for r in rows if None not in r]))
    assert row["positives"] + row["negatives"] == 2000
    none = metrics.roc_auc(df.where("p < 0"), "y", "p").first()
    assert (none["auc"], none["positives"], none["negatives"]) == (None, 0, 0)


def test_binned_auc(spark):
    rng = random.Random(3)
    rows = [(int(rng.random() < 0.3), rng.choice([0.0, 1.0, rng.random()])) for _ in range(500)]
    rows += [(0, None), (1, None)]
    df = spark.createDataFrame(rows, "y int, p double").repartition(6)
    steps = [-1e-7] + [i / 199 for i in range(1, 199)] + [1 + 1e-7]
    binned = [(y, sum(p > t for t in steps)) for y, p in rows if p is not None]
    got = metrics.roc_auc_binned(df, "y", "p").first()
    assert got["auc"] == pytest.approx(brute_auc(binned))
    assert got["positives"] + got["negatives"] == 500


def test_auc_of_one_class(make):
    row = metrics.roc_auc(make([(1, 0.5), (1, 0.6)], "y int, p double"), "y", "p").first()
    assert (row["auc"], row["positives"], row["negatives"]) == (None, 2, 0)


def test_scalers(spark, make):
    df = make([(1.0, 3.0), (2.0, 3.0), (4.0, 3.0), (None, 3.0)], "a double, b double")
    scaled = splits.apply_standard(df, splits.fit_standard(df, ["a", "b"]))
    a = [r["a"] for r in scaled.collect() if r["a"] is not None]
    assert statistics.fmean(a) == pytest.approx(0) and statistics.pstdev(a) == pytest.approx(1)
    assert {r["b"] for r in scaled.collect()} == {0.0}
    assert {r["b"] for r in splits.minmax_scale(df, "b").collect()} == {0.25}
    ends = sorted(r["a"] for r in splits.minmax_scale(df, "a").collect() if r["a"] is not None)
    assert (ends[0], ends[-1]) == (0.25, pytest.approx(0.99))


def test_undefined_metrics_are_zero(make):
    df = make([(0, 0), (0, 0), (1, 0)], "y int, z int")
    got = {r["class"]: r for r in metrics.classification_report(df, "y", "z").collect()}
    assert got["1"]["precision"] == 0.0 and got["1"]["f1"] == 0.0 and got["1"]["support"] == 1
    cells = {(r["actual"], r["predicted"]): r["rows"] for r in metrics.confusion_matrix(df, "y", "z").collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_histogram_of_one_value(make):
    rows = quality.histogram(make([(3.0,), (3.0,)], "v double"), "v", 4).collect()
    assert sum(r["rows"] for r in rows) == 2 and len(rows) == 4


def test_kde_integrates_to_nearly_one(spark):
    df = spark.range(1000).select(((F.col("id") % 97) / 10).alias("v"))
    rows = quality.kde(df, "v").orderBy("point").collect()
    step = rows[1]["x"] - rows[0]["x"]
    assert 0.85 < sum(r["density"] for r in rows) * step < 1.0


def test_profiles_of_no_rows(make):
    empty = make([], "v double")
    assert quality.histogram(empty, "v", 3).count() == 3
    assert quality.kde(empty, "v").count() == 0
    assert quality.boxplot_stats(empty, "v").first()["outliers"] == 0
    assert splits.minmax_scale(empty, "v").count() == 0
    assert quality.kde(make([(2.0,), (2.0,)], "v double"), "v").where("density IS NOT NULL").count() == 0


def test_boxplot(make):
    rows = make([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]] + [(None,)], "v double")
    box = quality.boxplot_stats(rows, "v").first()
    assert (box["q1"], box["median"], box["q3"]) == (3.0, 5.0, 7.0)
    assert (box["whisker_low"], box["whisker_high"], box["outliers"]) == (1.0, 8.0, 1)


def test_identical_rows_spread_over_partitions(spark):
    """Nine rows in ten are the same row."""
    rows = spark.range(0, 20_000, 1, 8).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(7).alias("k"))
    tied = rows.withColumn("_tie", F.xxhash64("k")).withColumn("_at", F.monotonically_increasing_id())
    # Partitions this small would be merged again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ordered.in_global_order(tied, ["k", "_tie", "_at"])
        sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 6 and max(sizes) < 2 * 20_000 / len(sizes)
    numbers = sorted(r["n"] for r in ordered.row_numbers(rows, ["k"], "n").collect())
    assert numbers == list(range(1, 20_001))


@pytest.mark.parametrize("slack", [0.0, 1e-9, 2e-4, 1.0])
def test_quantiles_when_a_bracket_misses(spark, slack):
    """Brackets of no width miss ranks between two values, and are widened."""
    rng = random.Random(3)
    rows = [(rng.choice(["a", None]), rng.choice([1.0, rng.random()])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    found = ordered.exact_quantiles(df, "v", [0.1, 0.5, 0.55], ["g"], slack=slack).collect()
    got = {(r["g"], r["prob"]): r["quantile"] for r in found}
    assert len(got) == 6
    for (g, q), v in got.items():
        assert v == pytest.approx(plain_quantile([x for k, x in rows if k == g], q))


def test_quantiles_of_few_rows_and_null_groups(make):
    df = make([("a", 1.0), (None, 5.0), (None, 7.0), ("b", None)], "g string, v double")
    got = {r["g"]: r["quantile"] for r in ordered.exact_quantiles(df, "v", [0.5], ["g"]).collect()}
    assert got == {"a": 1.0, None: 6.0}
    assert ordered.exact_quantiles(df.where("v > 9"), "v", [0.5], ["g"]).collect() == []


def test_no_bracket_misses_and_no_bin_is_hot(spark):
    """Half of all rows within a millionth of the value range, next to the wanted rank."""
    rng = random.Random(4)
    values = [0.5 + rng.random() * 1e-6 if rng.random() < 0.5 else rng.random() for _ in range(30_000)]
    df = spark.createDataFrame([(v,) for v in values], "_value double").repartition(5)
    counted = ordered._bracketed(df, [], [0.5], 0.01).withColumn("inside", F.col("_value").isNotNull())
    bins = [r["n"] for r in counted.where("inside").groupBy("_bin").agg(F.sum("_n").alias("n")).collect()]
    assert 400 < sum(bins) < 800 and max(bins) < sum(bins) / 2
    got = ordered.exact_quantiles(df, "_value", [0.5]).first()["quantile"]
    assert got == pytest.approx(plain_quantile(values, 0.5), abs=1e-15)


def test_quantiles_do_not_sort_the_table(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    for step in (ordered.exact_quantiles(df, "v", [0.5]), ordered._bracketed(df.withColumnRenamed("v", "_value"), [], [0.5], 0.01)):
        assert "rangepartitioning" not in step._jdf.queryExecution().executedPlan().toString()
    kept = ordered._bracketed(df.withColumnRenamed("v", "_value"), [], [0.5], 0.01)
    assert kept.where("_value IS NOT NULL").count() < 50


def test_rows_without_a_label_are_held_out_too(spark):
    rows = spark.range(1000).withColumn("label", F.when(F.col("id") % 2 == 0, 1))
    test = splits.stratified_split(rows, ["id"], "label").where("split = 'test'")
    assert {r["label"]: r["count"] for r in test.groupBy("label").count().collect()} == {None: 100, 1: 100}
