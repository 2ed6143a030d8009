"""Event ingest from files of JSON lines."""

import json
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riskloom import session
from riskloom.plans import jobs
from riskloom.schema import TRANSACTIONS, qualified
from riskloom.sources import loads, raw
from riskloom.sources.tables import ensure_namespaces
from riskloom.streaming import events


def message(i, **changes):
    event = {"customer_id": i, "transaction_amount": i + 0.5, "event_type": "click", "timestamp": 1704067200.25 + i}
    event.update(changes)
    return json.dumps(event)


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        events.stream_source(spark, **{"kafka.bootstrap.servers": "localhost:1"})


def test_good_and_rejected(make):
    lines = [message(1), "{bad", "[]", "", '{"customer_id": 2}', message(3, customer_id="x"), None]
    raw = make([(None if t is None else t.encode(),) for t in lines], "value binary")
    good, rejects = events.parse_events(raw)
    rows = good.collect()
    assert len(rows) == 1
    assert rows[0]["customer_id"] == "1" and rows[0]["account_balance"] is None
    assert rows[0]["created_at"] == datetime(2024, 1, 1, 0, 0, 1, 250000)
    assert rejects.count() == len(lines) - 1


def test_restart_adds_only_what_is_new(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    out, bad, state, bad_state = (session.scratch_path(spark, n) for n in ("out", "bad", "state", "bad-state"))

    def run():
        good, rejects = events.parse_events(events.stream_source(spark, "text", path=str(inbox)))
        for df, path, checkpoint in ((good, out, state), (rejects, bad, bad_state)):
            events.stream_append(df, path, checkpoint, once=True).awaitTermination()
        return spark.read.parquet(out)

    (inbox / "a.json").write_text("\n".join(message(i) for i in range(10)) + "\n{bad\n")
    assert run().count() == 10
    assert run().count() == 10
    (inbox / "b.json").write_text("\n".join(message(i) for i in range(10, 15)) + "\n")
    stored = run()
    assert sorted(int(r["customer_id"]) for r in stored.collect()) == list(range(15))
    assert [r["value"] for r in spark.read.parquet(bad).collect()] == ["{bad"]
    batch, _ = events.parse_events(spark.read.text(str(inbox)))
    assert batch.exceptAll(stored).count() == 0 and stored.exceptAll(batch).count() == 0


STRANGE = [1e15, 1e30, 1704067200000, "NaN", -86400, 4102444800]


def test_strange_times_are_rejected(make):
    lines = [message(n, timestamp=t) for n, t in enumerate(STRANGE)]
    good, rejects = events.parse_events(make([(t,) for t in [*lines, message(9, timestamp=0)]], "value string"))
    assert [r["created_at"] for r in good.collect()] == [datetime(1970, 1, 1)]
    assert sorted(r["value"] for r in rejects.collect()) == sorted(lines)


def test_ingest_takes_every_message_once(spark, tmp_path):
    """Good, broken and strange messages over two runs; the second batch is then run again."""
    inbox, state = tmp_path / "inbox", str(tmp_path / "state")
    inbox.mkdir()
    cfg = jobs.IngestConfig(state, f"i{uuid.uuid4().hex[:8]}_", str(tmp_path / "tables"))

    def run():
        source = events.stream_source(spark, "text", path=str(inbox))
        jobs.run_ingest(spark, source, cfg, once=True).awaitTermination()

    def stored():
        names = [qualified(t, cfg.prefix) for t in (cfg.transactions, cfg.rejects)]
        for name in names:
            spark.catalog.refreshTable(name)
        good, bad = map(spark.table, names)
        return sorted(int(r["customer_id"]) for r in good.collect()), sorted(r["value"] for r in bad.collect())

    odd = [message(n, timestamp=t) for n, t in enumerate(STRANGE)]
    (inbox / "a.json").write_text("\n".join([message(1), "{bad", *odd[:3]]) + "\n")
    run()
    (inbox / "b.json").write_text("\n".join([message(2), message(3, timestamp=90000), *odd[3:]]) + "\n")
    run()
    want = [1, 2, 3], sorted(["{bad", *odd])
    assert stored() == want
    # Without its commit the last batch counts as not done.
    [(tmp_path / "state" / "commits" / name).unlink() for name in ("1", ".1.crc")]
    run()
    assert stored() == want
    months = spark.table(qualified(cfg.transactions, cfg.prefix)).select("event_month").distinct().count()
    assert months == 2


def test_loads_and_stream_fill_one_table(spark, tmp_path):
    """In either order, then a broken-off batch, compaction and a restart."""
    (tmp_path / "f.csv").write_text("Total Loan,LCY Deposit,created_at\n10.5,100,2024-01-01 05:00:00\n7,1,\n")
    for first in ("load", "stream"):
        inbox, state = tmp_path / f"inbox-{first}", tmp_path / f"state-{first}"
        inbox.mkdir()
        cfg = jobs.IngestConfig(str(state), f"i{uuid.uuid4().hex[:8]}_", str(tmp_path / f"tables-{first}"))
        name = qualified(cfg.transactions, cfg.prefix)
        ensure_namespaces(spark, cfg.location, cfg.prefix)

        def load():
            return loads.load_finance(spark, str(tmp_path / "f.csv"), name, "2024-02-01 00:00:00")

        def run():
            source = events.stream_source(spark, "text", path=str(inbox))
            jobs.run_ingest(spark, source, cfg, once=True).awaitTermination()

        def stored():
            spark.catalog.refreshTable(name)
            rows = spark.table(name).collect()
            return sorted((r["transaction_amount"], str(r["event_month"]), r["writer"]) for r in rows)

        def places():
            return sorted(set(raw._partitions(spark, name)))

        want = []
        if first == "load":
            load()
            want += [(7.0, "2024-02-01", "load"), (10.5, "2024-01-01", "load")]
        for n in range(4):
            (inbox / f"{n}.json").write_text("\n".join([message(n), message(n, timestamp=1706745600 + n), "{bad"]) + "\n")
            run()
            want += [(n + 0.5, "2024-01-01", "events"), (n + 0.5, "2024-02-01", "events")]
        load()
        want += [(7.0, "2024-02-01", "load"), (10.5, "2024-01-01", "load")]
        assert stored() == sorted(want)
        assert len([p for p in places() if p[1] == "events"]) == 8
        merged = jobs.run_compaction(spark, cfg)
        # Batches 0 to 2 of two months became one each; of the rejects those of one month.
        assert list(merged.values()) == [4, 2]
        assert stored() == sorted(want)
        assert [p[2] for p in places() if p[1] == "events"] == [2, 3, 2, 3]
        # Without its commit the last batch counts as not done, and is run again.
        [(state / "commits" / done).unlink() for done in ("3", ".3.crc")]
        run()
        assert stored() == sorted(want) and jobs.run_compaction(spark, cfg) == dict.fromkeys(merged, 0)
        bad = spark.table(qualified(cfg.rejects, cfg.prefix))
        assert bad.count() == 4


def test_compaction_broken_off_is_finished(spark, make, tmp_path, monkeypatch):
    name = f"i{uuid.uuid4().hex[:8]}_raw.finance"
    ensure_namespaces(spark, str(tmp_path / "tables"), name.split("raw")[0])
    raw.ensure_raw(spark, name, TRANSACTIONS)
    for batch in range(4):
        rows = make([("c", float(batch), 1.0, "click", datetime(2024, 1 + batch % 2, 1))] * 3, TRANSACTIONS)
        raw.replace_batch(rows, F.col("created_at"), name, "s", batch)
    for broken in ("_drop", "_delete"):
        # The first stops before the table is touched, the second after all is done but the clean-up.
        rows = make([("c", 9.0, 1.0, "click", datetime(2024, 1, 1))], TRANSACTIONS)
        raw.replace_batch(rows, F.col("created_at"), name, "s", 4 if broken == "_drop" else 6)
        raw.replace_batch(rows, F.col("created_at"), name, "s", 5 if broken == "_drop" else 7)
        before = sorted(r["transaction_amount"] for r in spark.table(name).collect())
        with monkeypatch.context() as patch:
            patch.setattr(raw, broken, lambda *a, **k: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                raw.compact(spark, name)
        raw.recover(spark, name)
        spark.catalog.refreshTable(name)
        assert sorted(r["transaction_amount"] for r in spark.table(name).collect()) == before
        assert raw.compact(spark, name) == 0
    assert raw.recover(spark, name) is None


def test_hot_month_is_written_by_several_tasks(spark, make, tmp_path):
    name = f"i{uuid.uuid4().hex[:8]}_raw.finance"
    ensure_namespaces(spark, str(tmp_path / "tables"), name.split("raw")[0])
    raw.ensure_raw(spark, name, TRANSACTIONS)
    rows = spark.range(0, 40_000, 1, 8).select(
        F.uuid().alias("customer_id"), F.rand().alias("transaction_amount"), F.rand().alias("account_balance"),
        F.lit("click").alias("event_type"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("created_at"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        raw.replace_batch(rows, F.col("created_at"), name, "s", 0)
    finally:
        spark.conf.set(key, before)
    table = spark.table(name)
    assert table.count() == 40_000 and table.select(F.input_file_name()).distinct().count() >= 4


def test_other_layouts_are_refused(spark, make, tmp_path):
    name = f"i{uuid.uuid4().hex[:8]}_raw.finance"
    ensure_namespaces(spark, str(tmp_path / "tables"), name.split("raw")[0])
    make([], TRANSACTIONS).write.saveAsTable(name)
    with pytest.raises(ValueError, match="no raw table"):
        raw.ensure_raw(spark, name, TRANSACTIONS)
