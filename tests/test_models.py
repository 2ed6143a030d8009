"""Training, storage, scoring, anomalies and the jobs."""

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from contract import fixtures as fx
from riskloom import session
from riskloom.operators import anomaly, descent, models, splits, training
from riskloom.plans import jobs
from riskloom.schema import FEATURES


@pytest.fixture(scope="module")
def days(spark, sf_dir):
    return session.stage(
        training.training_customer_day(fx.mkt_daily(spark, sf_dir), fx.tx_daily(spark, sf_dir)), "days"
    )


@pytest.fixture(scope="module")
def trained(spark, days):
    path = session.scratch_path(spark, "model")
    cfg = jobs.TrainingConfig(path, patience=2, max_rounds=8, steps_per_round=3)
    history, metrics = jobs.run_training(spark, days, cfg)
    return path, history, metrics.first()


def test_training_learns(trained):
    _, history, metrics = trained
    assert metrics["auc"] > 0.8 and 0 < metrics["log_loss"] < 0.7
    assert history.auc[history.best_round - 1] == max(history.auc)
    assert len(history.auc) - history.best_round <= 2


def test_stored_model_scores_the_same(spark, days, trained):
    path, history, _ = trained
    model, scaler = models.load_model(spark, path)
    a = models.score_model(history.model, scaler, jobs.model_rows(days))
    b = models.score_model(model, scaler, jobs.model_rows(days))
    assert a.exceptAll(b).count() == 0


def test_scoring_keeps_every_row(spark, days, trained):
    scored = jobs.run_scoring(spark, days, trained[0])
    assert scored.count() == days.count()
    bad = scored.where(
        ~F.col("fraud_probability").between(0, 1)
        | ((F.col("fraud_probability") >= 0.5) != (F.col("fraud_prediction") == 1))
        | ~F.col("scaled_score").between(0.25 - 1e-9, 0.99 + 1e-9)
    )
    assert bad.count() == 0
    # Days with one transaction have no deviation and are scored all the same.
    assert scored.where("std_tx_amount IS NULL AND fraud_probability IS NOT NULL").count() > 0


def test_missing_model(days):
    with pytest.raises(RuntimeError):
        models.score_model(None, None, days)


def test_feature_order(days):
    matrix = training.feature_matrix(jobs.model_rows(days), keep=("user_id",))
    assert len(FEATURES) == 15 and len(matrix.first()["features"]) == 15
    assert matrix.count() == days.count()


def test_early_stopping_stops(make):
    rows = make([(float(i % 7), i % 2) for i in range(200)], "ctr double, target int")
    history = models.train_early_stopping(rows, rows, ["ctr"], "target", patience=1, max_rounds=6, hidden=(3,))
    assert len(history.auc) <= 6 and history.model is not None


NET = ["a", "b", "c"]


@pytest.fixture
def net_rows(make):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    return make([(int(r[0] * r[1] > 0), *map(float, r)) for r in x], "y int, a double, b double, c double")


def test_rounds_go_on_from_the_optimizer(net_rows):
    """Five rounds of two steps end where one round of ten does."""
    runs = [
        models.train_early_stopping(net_rows, net_rows, NET, "y", 99, rounds, steps, (4, 3))
        for rounds, steps in ((5, 2), (1, 10))
    ]
    assert runs[0].auc[-1] == pytest.approx(runs[1].auc[-1], abs=1e-6)
    assert runs[0].auc[-1] > runs[0].auc[0]


def test_gradient_and_scores_are_those_of_the_network(net_rows):
    model = models.train_mlp(net_rows, NET, "y", (4, 3), 3)
    weights, sizes = model.weights.toArray(), [3, 4, 3, 2]
    rows = net_rows.withColumn("y", F.col("y").cast("double"))
    loss, gradient = descent.loss_and_gradient(rows, sizes, weights)
    wanted = models.with_probability(model, net_rows, NET, ("y",))
    found = descent.probabilities(rows, sizes, weights, "p").toPandas().sort_values("p")["p"].to_numpy()
    assert np.allclose(found, np.sort([r["fraud_probability"] for r in wanted.collect()]), atol=1e-12)
    p = F.col("fraud_probability")
    assert loss == pytest.approx(wanted.agg(-F.avg(F.ln(F.when(F.col("y") == 1, p).otherwise(1 - p)))).first()[0])
    for place in (0, 11, 13, 30, len(weights) - 1):
        step = 1e-5 * np.eye(len(weights))[place]
        up, down = (descent.loss_and_gradient(rows, sizes, w)[0] for w in (weights + step, weights - step))
        assert (up - down) / 2e-5 == pytest.approx(gradient[place], abs=1e-8)


@pytest.mark.parametrize("column, bad", [("y", None), ("y", 2), ("a", float("nan"))])
def test_early_stopping_refuses_what_the_network_refuses(net_rows, column, bad):
    kind = dict(net_rows.dtypes)[column]
    rows = net_rows.withColumn(column, F.when(F.col("c") > 0, F.col(column)).otherwise(F.lit(bad).cast(kind)))
    with pytest.raises(Exception, match="labels must be|inputs must be"):
        models.train_early_stopping(rows, net_rows, NET, "y", 1, 1, 1, (3,))


def test_packed_rows_are_all_there(spark):
    """Rows of several batches and blocks, some of them equal, with an odd number left over."""
    rows = spark.range(0, 45_001, 1, 2).selectExpr("id % 2 * 1D y", "id * 1D a", "id % 7 / 7D b")
    packed = session.stage(descent.pack(rows), "packed", **models.PACKED_FILES)
    tables = [pq.read_table(pa.BufferReader(bytes(row[0]))) for row in packed.collect()]
    assert max(t.num_rows for t in tables) == descent.PACKED_ROWS and len(tables) == 4
    found = pa.concat_tables(tables).to_pandas().sort_values("a").reset_index(drop=True)
    assert found.equals(rows.toPandas())
    sizes, weights = [2, 3, 2], np.random.default_rng(2).normal(size=17) / 10_000
    for x, y in zip(descent.loss_and_gradient(packed, sizes, weights), descent.loss_and_gradient(rows, sizes, weights)):
        assert np.allclose(x, y, rtol=1e-9, atol=1e-12)
    scored = descent.probabilities(packed, sizes, weights, "p", "y")
    assert scored.columns == ["y", "p"] and scored.agg(F.count("p"), F.sum("y")).first()[:] == (45_001, 22_500.0)


def test_validation_rows_without_label_are_left_out(net_rows):
    """They may have odd inputs as well."""
    odd = net_rows.limit(20).select(F.lit(None).cast("int").alias("y"), "a", "b", F.lit(float("nan")).alias("c"))
    runs = [
        models.train_early_stopping(net_rows, held, NET, "y", 99, 2, 2, (4, 3)) for held in (net_rows, net_rows.union(odd))
    ]
    assert runs[0].auc == pytest.approx(runs[1].auc, abs=1e-9)


def passes(monkeypatch):
    """The columns of the rows that each pass reads, as they are noted."""
    seen, real = [], models.loss_and_gradient

    def noted(rows, sizes, weights):
        seen.append(rows.columns)
        return real(rows, sizes, weights)

    monkeypatch.setattr(models, "loss_and_gradient", noted)
    return seen


def test_rounds_read_packed_rows(net_rows, monkeypatch):
    seen = passes(monkeypatch)
    models.train_early_stopping(net_rows, net_rows, NET, "y", 99, 4, 2, (4, 3))
    assert all(columns == [descent.PACKED] for columns in seen) and 9 <= len(seen) <= 16


def test_fit_reads_packed_rows(net_rows, monkeypatch):
    """About a pass a step, and a fit no worse than MLlib's own from the same first weights."""
    seen = passes(monkeypatch)
    model = models.train_mlp(net_rows, NET, "y", (4, 3), 20)
    assert all(columns == [descent.PACKED] for columns in seen) and 21 <= len(seen) <= 32
    assert model.getMaxIter() == 20 and model.getLayers() == [3, 4, 3, 2]
    theirs = MultilayerPerceptronClassifier(layers=[3, 4, 3, 2], labelCol="y", maxIter=20, seed=splits.SEED).fit(
        training.feature_matrix(net_rows, NET, ("y",))
    )
    rows = net_rows.withColumn("y", F.col("y").cast("double"))
    ours, loss = (descent.loss_and_gradient(rows, [3, 4, 3, 2], m.weights.toArray())[0] for m in (model, theirs))
    assert ours <= loss * 1.05


def test_fit_without_steps_keeps_its_weights(net_rows):
    given = Vectors.dense(np.linspace(-1, 1, 39))
    model = models.train_mlp(net_rows, NET, "y", (4, 3), 0, initial_weights=given)
    assert model.weights == given
    drawn, other = (models.train_mlp(rows, NET, "y", (4, 3), 0) for rows in (net_rows, net_rows.limit(9)))
    assert drawn.weights == other.weights and drawn.weights != given


@pytest.mark.parametrize("column, bad", [("y", None), ("y", 2), ("a", float("inf"))])
def test_fit_refuses_what_the_network_refuses(net_rows, column, bad):
    kind = dict(net_rows.dtypes)[column]
    rows = net_rows.withColumn(column, F.when(F.col("c") > 0, F.col(column)).otherwise(F.lit(bad).cast(kind)))
    with pytest.raises(Exception, match="labels must be|inputs must be"):
        models.train_mlp(rows, NET, "y", (3,), 1)


@pytest.mark.parametrize("scale, most", [(np.array([1.0, 1.0]), 3), (np.array([0.0, 0.0]), 1), (np.array([1e-9, 1e-9]), 1)])
def test_descent_ends_where_nothing_is_left(scale, most):
    calls = []

    def bowl(w):
        calls.append(1)
        return float((scale * w * w).sum() / 2 + 1), scale * w

    descent.Descent(bowl, np.array([1.0, 2.0])).run(50, 1e-6)
    assert len(calls) <= most + 1


def test_descent_takes_few_passes():
    """A narrow valley: one or two evaluations a step, and none once the end is reached."""
    calls = []

    def valley(w):
        calls.append(1)
        scale = np.array([1.0, 30.0, 900.0])
        return float((scale * w * w).sum() / 2), scale * w

    walk = descent.Descent(valley, np.array([3.0, -2.0, 1.0]))
    for _ in range(25):
        walk.step()
    assert np.abs(walk.weights).max() < 1e-4 and len(calls) <= 60
    rest = descent.Descent(lambda w: (0.0, 0 * w), np.ones(2))
    rest.step()
    assert rest.weights.tolist() == [1, 1]


def test_marketing_job(spark, sf_dir):
    from riskloom.operators.features import marketing_customer_day

    days = marketing_customer_day(fx.mkt_daily(spark, sf_dir))
    got = {r["part"]: r for r in jobs.run_marketing_training(spark, days, session.scratch_path(spark, "m")).collect()}
    assert set(got) == {"validation", "test"} and got["test"]["auc"] > 0.9


def test_transactions_are_all_scored(spark, sf_dir):
    tx = fx.tx_daily(spark, sf_dir)
    rows = models.transaction_features(tx).withColumn("fraud", (F.col("transaction_amount") > F.col("account_balance")).cast("int"))
    scaler = splits.fit_standard(rows, models.TRANSACTION_FEATURES)
    model = models.train_mlp(splits.apply_standard(rows, scaler), models.TRANSACTION_FEATURES, "fraud", hidden=(4,), max_iter=20)
    scored = models.score_transactions(model, scaler, tx)
    assert scored.columns == ["transaction_id", "fraud_probability", "fraud_label"]
    assert scored.count() == tx.count()
    agree = scored.join(rows, scored.transaction_id == rows.tx_id).where("fraud_label = fraud").count()
    assert agree / tx.count() > 0.9


def test_forest_finds_outliers(spark):
    rng = np.random.default_rng(0)
    normal = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(100, 5, (2000, 2)))]
    odd = [(5000 + i, 500.0 + i, 900.0) for i in range(5)]
    missing = [(9000, None, 1.0)]
    df = spark.createDataFrame(normal + odd + missing, "id long, amount double, balance double")
    scored = anomaly.isolation_scores(df, "id", ["amount", "balance"], contamination=0.01)
    rows = {r["id"]: r for r in scored.collect()}
    assert len(rows) == 2006
    assert all(rows[5000 + i]["is_anomaly"] == 1 for i in range(5))
    assert rows[9000]["anomaly_score"] is None and rows[9000]["is_anomaly"] == 0
    assert sum(r["is_anomaly"] for r in rows.values()) <= 0.011 * 2005
    assert all(-1 <= r["anomaly_score"] < 0 for r in rows.values() if r["anomaly_score"] is not None)
    again = anomaly.isolation_scores(df.repartition(11), "id", ["amount", "balance"], contamination=0.01)
    assert {r["id"]: r["anomaly_score"] for r in again.collect()} == {k: r["anomaly_score"] for k, r in rows.items()}


def test_forest_of_few_and_equal_rows(spark):
    same = spark.range(50).select("id", F.lit(1.0).alias("a"))
    assert anomaly.isolation_scores(same, "id", ["a"], trees=5).where("is_anomaly = 1").count() == 0
    assert anomaly.isolation_scores(same.limit(0), "id", ["a"], trees=5).count() == 0


@pytest.mark.parametrize("sample, trees, rows", [(4, 40, 20_000), (256, 100, 20_000), (256, 20, 100)])
def test_every_tree_draws_enough_rows(spark, sample, trees, rows):
    df = spark.range(rows).select(F.col("id").alias("_key"), F.rand(3).alias("v"))
    forest = anomaly.fit_forest(session.stage(df, "rows"), ["v"], trees, sample, 42)
    sizes = [tree["rows"] for tree in forest]
    rate = anomaly.draw_rate(sample, rows)
    assert len(sizes) == trees and min(sizes) >= min(sample, rows)
    assert abs(np.mean(sizes) - rate * rows) < 5 * (rate * rows / trees) ** 0.5 + 1e-9


def test_draws_are_independent(spark):
    """Rows drawn by two trees are as many as chance says."""
    df = spark.range(40_000).select(F.col("id").alias("_key"))
    drawn = anomaly.draw(df, 0.1, 12, 1).groupBy("_key").agg(F.count("*").alias("n"), F.countDistinct("tree").alias("d"))
    assert drawn.where("n <> d").count() == 0
    pairs = drawn.agg(F.sum(F.expr("n * (n - 1) / 2"))).first()[0]
    assert abs(pairs / (40_000 * 66 * 0.01) - 1) < 0.05


def test_a_missing_tree_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(anomaly, "draw_rate", lambda sample, rows: 1e-9)
    df = spark.range(50).select(F.col("id").alias("_key"), F.rand(3).alias("v"))
    with pytest.raises(RuntimeError, match="trees"):
        anomaly.fit_forest(df, ["v"], 5, 4, 42)


def test_isolation_depth():
    assert anomaly.average_path(1) == 0 and anomaly.average_path(2) == 1
    assert anomaly.average_path(256) == pytest.approx(10.24, abs=0.01)


def test_feature_job_tables(spark, sf_dir):
    prefix = f"t{uuid.uuid4().hex[:10]}_"
    cfg = jobs.FeatureConfig(prefix, session.scratch_path(spark, "ns"), "integer")
    made = jobs.run_features(spark, fx.tx_daily(spark, sf_dir), fx.mkt_daily(spark, sf_dir), cfg)
    assert len(made) == 15
    daily = made["feature.feature_fraud_daily"]
    assert daily.where(F.col("ctr") != F.floor("ctr")).count() == 0
    # A second run replaces the tables.
    again = jobs.run_features(spark, fx.tx_daily(spark, sf_dir), fx.mkt_daily(spark, sf_dir), cfg)
    assert again["alert.daily_fraud_alert"].count() == 1094


def test_medallion_stops_on_failure(spark, tmp_path):
    cfg = jobs.MedallionConfig(str(tmp_path / "none"), str(tmp_path / "none"), str(tmp_path / "lake"))
    with pytest.raises(Exception):
        jobs.run_medallion(spark, cfg)
    assert not (tmp_path / "lake").exists()
