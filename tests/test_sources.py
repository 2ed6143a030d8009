"""Files, tables, loads, cleaning and validation."""

import hashlib
import uuid
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from riskloom import session
from riskloom.functions.prompts import PROMPT, plain_number
from riskloom.operators import clean, quality
from riskloom.operators.prompts import risk_prompt
from riskloom.schema import NAMESPACES, REGISTRY
from riskloom.sources import files, loads, tables


@pytest.fixture
def prefix(spark):
    name = f"t{uuid.uuid4().hex[:10]}_"
    tables.ensure_namespaces(spark, session.scratch_path(spark, "ns"), name)
    return name


def test_namespaces_twice(spark, prefix):
    tables.ensure_namespaces(spark, None, prefix)
    found = {r[0] for r in spark.sql(f"SHOW DATABASES LIKE '{prefix}*'").collect()}
    assert found == {prefix + n for n in NAMESPACES}


def test_materialize_modes(spark, make, prefix):
    name = prefix + "label.t"
    one, two = make([(1,)], "a int"), make([(2,)], "a int")
    assert tables.materialize(one, name, "strict").first()[0] == 1
    with pytest.raises(AnalysisException):
        tables.materialize(two, name, "strict")
    assert tables.materialize(two, name, "if_absent").first()[0] == 1
    assert tables.materialize(two, name, "replace").first()[0] == 2
    tables.append(one, name)
    assert sorted(r[0] for r in tables.read_table(spark, name).collect()) == [1, 2]
    with pytest.raises(ValueError):
        tables.materialize(one, name, "other")


def test_registry(spark, make, prefix):
    assert len(REGISTRY) == 16
    tables.materialize(make([(1, 0)], "a int, b int"), prefix + "label.fraud_label")
    assert tables.dataset(spark, "label_fraud", prefix).columns == ["a", "b"]
    with pytest.raises(KeyError):
        tables.dataset(spark, "label.fraud_label", prefix)


def test_validation(spark, make, prefix):
    tables.materialize(make([(1, 0)], "a int, b int"), prefix + "label.fraud_label")
    tables.materialize(make([], "a int"), prefix + "alert.daily_fraud_alert")
    def check(key):
        return quality.validate_dataset(spark, key, prefix).first()

    good = check("label_fraud")
    assert (good["validation_status"], good["row_count"], good["columns"]) == ("success", 1, ["a", "b"])
    empty = check("daily_fraud_alert")
    assert (empty["validation_status"], empty["reason"]) == ("failed", "empty table")
    assert check("nope")["reason"] == "Invalid query_key"
    assert check("feature_fraud")["validation_status"] == "error"


def test_jdbc_options_through_another_transport(spark, make):
    options = tables.jdbc_options("jdbc:postgresql://h/db", "u", "p", connections=4)
    assert options == {"url": "jdbc:postgresql://h/db", "user": "u", "password": "p", "numPartitions": "4"}
    path = session.scratch_path(spark, "jdbc")
    for value in (1, 2):
        tables.write_jdbc(make([(value,)], "a int"), {"path": path}, "t", fmt="parquet")
    assert [r[0] for r in tables.read_jdbc(spark, {"path": path}, "t", fmt="parquet").collect()] == [2]


def test_csv_is_text_without_a_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;2.5\n;abc\n")
    df = files.read_csv(spark, str(tmp_path), sep=";")
    assert df.dtypes == [("x", "string"), ("y", "string")]
    assert [tuple(r) for r in df.collect()] == [("1", "2.5"), (None, "abc")]


def test_load_finance_appends(spark, tmp_path, prefix):
    (tmp_path / "f.csv").write_text("Total Loan,LCY Deposit,Public Deposit\n10.5,100,7\nbad,200,8\n")
    for _ in range(2):
        df = loads.load_finance(spark, str(tmp_path), prefix + "raw.finance", "2024-01-01 00:00:00")
    rows = sorted((r["account_balance"], r["transaction_amount"]) for r in df.collect())
    assert rows == [(100.0, 10.5), (100.0, 10.5), (200.0, None), (200.0, None)]
    assert df.first()["created_at"] == datetime(2024, 1, 1)


def test_load_marketing_restarts_ids_in_file_order(spark, tmp_path, prefix):
    for part in range(3):
        lines = [f"{part * 400 + i};1;0;93.2" for i in range(400)]
        (tmp_path / f"m{part}.csv").write_text("duration;campaign;previous;cons.price.idx\n" + "\n".join(lines) + "\n")
    for _ in range(2):
        df = loads.load_marketing(spark, str(tmp_path), prefix + "raw.marketing", "2024-01-01 00:00:00")
    assert df.count() == 1200
    for row in df.collect():
        assert int(row["customer_id"][2:]) == row["clicks"] + 1


def test_cleaning_drops_bad_rows(make):
    rows = [("a", "1.5", "fail_tx"), ("b", "abc", "x"), ("c", "2", None), (None, "2", "x"), ("d", "3", "x")]
    df = clean.silver_clean(make(rows, "customer_id string, transaction_amount string, event_type string"))
    assert sorted((r["customer_id"], r["transaction_amount"], r["failed_tx"]) for r in df.collect()) == [
        ("a", 1.5, 1),
        ("d", 3.0, 0),
    ]


def test_plain_numbers(spark):
    values = [0.0, 1.0, 12345678.5, 1234567890123.25, 0.1, 0.00015, -2.5, 123456.789012345]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(plain_number(F.col("v"))).collect()]
    assert got == [repr(v) if v != 0.00015 else "0.00015" for v in values]


def test_prompt(make):
    schema = (
        "fraud_probability double, tx_count bigint, total_tx_amount double, avg_tx_amount double, "
        "max_tx_amount double, std_tx_amount double, avg_account_balance double, total_clicks bigint, "
        "total_impressions bigint, total_conversion bigint, ctr double"
    )
    text = risk_prompt(make([(0.25, 3, 10.5, 3.5, 5.0, None, 2e8, 1, 2, 3, 0.5)], schema)).first()["prompt"]
    assert text.startswith("\nYou are a senior fraud risk analyst.\n")
    assert "- Fraud Probability: 0.2500\n" in text
    assert "- Standard Deviation of Transaction Amount: nan\n" in text
    assert "- Average Account Balance: 200000000.0\n" in text
    assert "- Click-Through Rate (CTR): 0.5000\n" in text
    assert text.endswith("Base reasoning strictly on inputs above.\n")


def test_scratch_scope_removes_its_folder(spark, make):
    with session.scratch_scope(spark) as folder:
        staged = session.stage(make([(1,)], "a int"), "x")
        assert staged.first()[0] == 1 and staged.inputFiles()[0].find("scope") > 0
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        assert fs.exists(path)
    assert not fs.exists(path)


def test_stage_of_no_rows(spark, make):
    empty = session.stage(make([], "a int, t timestamp_ntz"), "empty")
    assert empty.count() == 0 and empty.dtypes == [("a", "int"), ("t", "timestamp_ntz")]


def test_prompt_text_is_the_given_one():
    assert hashlib.md5(PROMPT.encode()).hexdigest() == "f3fe9da4939b1dfcba7c30c8c19caac7"


def test_own_times_are_kept(make):
    raw = make([("1", "2", "2024-01-02 03:04:05"), ("3", "4", "soon"), ("5", "6", None)], "`Total Loan` string, `LCY Deposit` string, created_at string")
    got = [str(r["created_at"]) for r in loads.finance_rows(raw, "2020-01-01 00:00:00").collect()]
    assert got == ["2024-01-02 03:04:05", "2020-01-01 00:00:00", "2020-01-01 00:00:00"]


def test_marketing_load_moves_no_rows(spark, tmp_path):
    (tmp_path / "m.csv").write_text("duration;campaign;previous\n" + "1;1;0\n" * 50)
    raw = spark.read.option("header", True).option("sep", ";").csv(str(tmp_path))
    plan = loads.marketing_rows(raw, "2024-01-01 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan


def test_split_column_needs_bounds(spark):
    with pytest.raises(ValueError, match="bounds"):
        tables.read_jdbc(spark, {}, "t", split_column="id")


class _Cluster:
    """A session whose master is no local one."""

    def __init__(self, spark, folder):
        self._jvm, self._jsc = spark._jvm, spark._jsc
        self.sparkContext = type("C", (), {"master": "yarn", "applicationId": "a"})()
        self._conf = {"spark.checkpoint.dir": folder}
        self.conf = type("F", (), {"get": lambda _, key, default=None: self._conf.get(key, default)})()


def test_a_folder_of_one_machine_is_refused_on_a_cluster(spark):
    for folder in ("file:/tmp/x", "/tmp/x"):
        with pytest.raises(RuntimeError, match="one machine"):
            session.shared_folder(_Cluster(spark, folder))
    mounted = _Cluster(spark, "file:/mnt/x/")
    mounted._conf["spark.riskloom.sharedMount"] = "true"
    assert session.shared_folder(mounted) == "file:/mnt/x"


class _Elsewhere:
    """The test session as if its tasks ran on other machines, with the settings given."""

    def __init__(self, spark, conf):
        self._spark = spark
        self.conf = type("F", (), {"get": lambda _, key, default=None: conf.get(key, default)})()
        self.sparkContext = type(
            "C", (), {"master": "spark://a:7077", "applicationId": uuid.uuid4().hex, "defaultParallelism": 4}
        )()

    def __getattr__(self, name):
        return getattr(self._spark, name)


def test_a_folder_that_executors_reach_is_taken_on_a_cluster(spark, tmp_path, monkeypatch):
    for folder in (f"file:{tmp_path}/x", f"{tmp_path}/y"):
        cluster = _Elsewhere(spark, {"spark.checkpoint.dir": folder})
        assert session.shared_folder(cluster) == folder
        assert session.scratch_path(cluster, "a").startswith(f"{folder}/riskloom/")
        assert not list(tmp_path.rglob("probe-*"))
    monkeypatch.setattr(session, "_reaches_all", lambda *_: False)
    with pytest.raises(RuntimeError, match="one machine"):
        session.shared_folder(_Elsewhere(spark, {"spark.checkpoint.dir": f"file:{tmp_path}/z"}))


def test_without_a_checkpoint_folder_a_cluster_stages_in_the_warehouse(spark, tmp_path, monkeypatch):
    conf = {"spark.sql.warehouse.dir": f"file:{tmp_path}/tables/"}
    set_ = spark._jsc.sc().getCheckpointDir()
    if set_.isDefined():  # by the machine's defaults
        assert session.shared_folder(_Elsewhere(spark, conf)) == set_.get()
        none = type("O", (), {"isDefined": lambda _: False})()
        context = type("S", (), {"getCheckpointDir": lambda _: none})()
        held = type("J", (), {"sc": lambda _: context, "hadoopConfiguration": lambda _: spark._jsc.hadoopConfiguration()})()
        monkeypatch.setattr(_Elsewhere, "_jsc", held, raising=False)
    assert session.shared_folder(_Elsewhere(spark, conf)) == f"file:{tmp_path}/tables/riskloom-scratch"
    monkeypatch.setattr(session, "_reaches_all", lambda *_: False)
    with pytest.raises(RuntimeError, match="set spark.checkpoint.dir"):
        session.shared_folder(_Elsewhere(spark, conf))
