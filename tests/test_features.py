"""Features, rules and labels on hand-made rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from riskloom.functions import rules, times
from riskloom.operators import features, labels, rollup, training

TX = "customer_id string, transaction_amount double, account_balance double, event_type string, created_at timestamp_ntz"
MKT = "customer_id string, clicks int, impressions int, conversion int, created_at timestamp_ntz"
DAY = datetime(2024, 3, 10, 2, 30)


def tx_rows(pairs, at=DAY):
    return [("c", float(a), None if b is None else float(b), "purchase", at) for a, b in pairs]


def daily(make, tx, mkt=(("c", 5, 100, 1, DAY),)):
    return features.join_features(
        features.finance_features(make(tx, TX), "day"),
        features.marketing_features(make(list(mkt), MKT), "day"),
        "event_day",
    )


def label_of(make, tx, **kw):
    return labels.label_daily(daily(make, tx, **kw)).first()


def test_spike_day(make):
    row = label_of(make, tx_rows([(1, 1e6)] * 9 + [(1000, 1e6)]))
    assert round(row["fraud_score"], 4) == 0.7212
    assert (row["fraud_label"], row["fraud_reason"]) == (1, "TX_VARIANCE_SPIKE")


@pytest.mark.parametrize(
    "pairs",
    [
        [(50, 100), (60, -100)],  # the mean balance is 0
        [(1, 10), (1, 10)],  # the mean amount is 1
        [(3, 1), (5, 1)],  # the mean balance is 1
        [(40, 100)],  # one row: count 1 and no deviation
    ],
)
def test_missing_score_is_capped_but_not_labelled(make, pairs):
    features_day = daily(make, tx_rows(pairs))
    raw = labels.fraud_score_daily(features_day).first()
    assert raw["raw_score"] is None and raw["fraud_score"] == 1.0
    labelled = labels.label_daily(features_day)
    assert labelled.first()["fraud_label"] == 0
    assert labels.daily_fraud_alert(labelled).first()["alert_level"] == "HIGH RISK"


def test_score_has_no_lower_bound(make):
    row = label_of(make, tx_rows([(100, -10), (200, -10)]))
    assert row["fraud_score"] < 0


@pytest.mark.parametrize(
    "score, level",
    [(0.8, "HIGH RISK"), (0.79, "MEDIUM RISK"), (0.5, "MEDIUM RISK"), (0.49, "LOW RISK"), (None, "LOW RISK")],
)
def test_alert_levels(make, score, level):
    rows = make([(DAY.date(), score, 0)], "event_day date, fraud_score double, fraud_label int")
    assert labels.daily_fraud_alert(rows).first()["alert_level"] == level


def test_hourly_label_needs_all_three(make):
    schema = "event_hour timestamp_ntz, risky_tx_count bigint, tx_count bigint, ctr double"
    rows = [(DAY, 3, 10, 0.01), (DAY, 3, 9, 0.01), (DAY, 2, 10, 0.01), (DAY, 3, 10, None), (DAY, 0, 1, 0.5)]
    got = [(r["fraud_label"], r["fraud_reason"]) for r in labels.label_hourly(make(rows, schema)).collect()]
    assert got == [
        (1, "HIGH_TX_VS_BALANCE"),
        (0, "HIGH_TX_VS_BALANCE"),
        (0, "LOW_MARKETING_QUALITY"),
        (0, "HIGH_TX_VS_BALANCE"),
        (0, "NORMAL"),
    ]


def test_ctr_modes_and_zero_impressions(make):
    pairs = make([(7, 2), (7, 0), (None, 2)], "c bigint, i bigint")
    both = pairs.select(
        rules.click_rate(F.col("c"), F.col("i")).alias("f"),
        rules.click_rate(F.col("c"), F.col("i"), "integer").alias("i"),
    )
    assert [tuple(r) for r in both.collect()] == [(3.5, 3.0), (None, None), (None, None)]
    with pytest.raises(ValueError):
        rules.click_rate(F.col("c"), F.col("i"), "other")


def test_customer_day_ctr_is_zero_without_impressions(make):
    row = features.marketing_customer_day(make([("c", 3, 0, 0, DAY)], MKT)).first()
    assert row["ctr"] == 0.0


def test_day_without_marketing_keeps_nulls(make):
    other = [("c", 1, 10, 0, datetime(2024, 3, 11))]
    row = daily(make, tx_rows([(10, 100), (20, 100)]), mkt=other).first()
    assert row["ctr"] is None and row["active_users"] is None and row["avg_tx_per_event"] == 15.0


def test_unknown_balance_is_not_risky(make):
    row = features.finance_features(make(tx_rows([(10, None), (90, 100)]), TX), "day").first()
    assert row["risky_tx_count"] == 1


def test_synthetic_boundary(make):
    rows = make([(475000.0, 500000.0), (480000.0, 500000.0)], "transaction_amount double, account_balance double")
    assert [r["fraud"] for r in labels.synthetic_fraud(rows).collect()] == [0, 1]


def test_alert_payload_colours(make):
    import json

    rows = [(date(2024, 1, d + 1), 0.1, 0, level) for d, level in enumerate(["HIGH RISK", "MEDIUM RISK", "LOW RISK"])]
    alerts = make(rows, "event_day date, fraud_score double, fraud_label int, alert_level string")
    sent = [json.loads(r["payload"])["attachments"][0] for r in labels.alert_payload(alerts, "X", "now").collect()]
    assert [a["color"] for a in sent] == ["#ff0000", "#ffae42", "#439FE0"]
    assert sent[0]["title"] == "[ERROR] Daily fraud alert 2024-01-01"
    assert sent[0]["footer"] == "X | now UTC"
    odd = make([("FATAL",)], "level string").select(
        labels.message_payload(F.col("level"), F.lit("t"), F.lit("m"), F.lit("c"), F.lit("n"))
    )
    assert "#439FE0" in odd.first()[0]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_ignore_the_session_zone(spark, make, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist on this day in New York.
        row = make([(DAY, 1710037800.25)], "ts timestamp_ntz, epoch double").select(
            times.hour_start(F.col("ts")).alias("hour"),
            times.epoch_to_ts(F.col("epoch")).alias("at"),
            times.weekday(F.to_date("ts")).alias("weekday"),
            times.epoch_to_ts(F.lit(-0.5)).alias("early"),
            times.epoch_to_ts(F.lit(-1e9)).alias("long_ago"),
            times.epoch_to_ts(F.lit(2.5e11)).alias("far"),
            *(times.epoch_to_ts(F.lit(x)).alias(f"none{n}") for n, x in enumerate((9.3e12, -1e30, float("nan")))),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row["hour"] == datetime(2024, 3, 10, 2)
    assert row["at"] == datetime(2024, 3, 10, 2, 30, 0, 250000)
    assert row["weekday"] == 0
    assert row["early"] == datetime(1969, 12, 31, 23, 59, 59, 500000)
    assert row["long_ago"] == datetime(1938, 4, 24, 22, 13, 20) and row["far"] == datetime(9892, 3, 8, 12, 26, 40)
    assert row["none0"] is row["none1"] is row["none2"] is None


def test_rollup_equals_direct(spark, sf_dir):
    from contract import fixtures as fx

    tx, mkt = fx.tx_hourly(spark, sf_dir), fx.mkt_hourly(spark, sf_dir)
    for grain in ("hour", "day"):
        key = times.GRAINS[grain][0]
        a = features.finance_features(tx, grain).toPandas().sort_values(key, ignore_index=True)
        b = rollup.finance_rollup(rollup.finance_partials(tx), grain).toPandas()
        b = b.sort_values(key, ignore_index=True)[a.columns]
        assert a[key].equals(b[key])
        assert abs(a.drop(columns=key).fillna(-1) - b.drop(columns=key).fillna(-1)).max().max() < 1e-6
    a = features.marketing_features(mkt, "day").toPandas().sort_values("event_day", ignore_index=True)
    b = rollup.marketing_day_rollup(rollup.marketing_partials(mkt)).toPandas()
    b = b.sort_values("event_day", ignore_index=True)[a.columns]
    assert abs(a.drop(columns="event_day") - b.drop(columns="event_day")).max().max() < 1e-9


def test_rollup_with_missing_amounts_and_ids(make):
    rows = tx_rows([(10, 5), (20, None)]) + [("c", None, 7.0, "purchase", DAY), ("c", 40.0, 1.0, "x", datetime(2024, 3, 10, 9))]
    tx = make(rows, TX)
    direct = features.finance_features(tx, "day").first()
    rolled = rollup.finance_rollup(rollup.finance_partials(tx), "day").first()
    for name in direct.asDict():
        assert rolled[name] == pytest.approx(direct[name]) if name != "event_day" else True
    nothing = make([("c", None, None, "x", DAY)], TX)
    assert rollup.finance_rollup(rollup.finance_partials(nothing), "day").first()["std_tx_amount"] is None
    mkt = make([(None, 1, 2, 0, DAY), ("a", None, 2, 1, DAY), ("a", 3, 2, None, DAY)], MKT)
    one = features.marketing_features(mkt, "day").first().asDict()
    assert rollup.marketing_day_rollup(rollup.marketing_partials(mkt)).first().asDict() == one


def test_one_hot_day(spark):
    """A day with most of the rows, and an id with a third of them."""
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("customer_id"),
        F.lit(1).alias("clicks"),
        F.lit(2).alias("impressions"),
        F.lit(0).alias("conversion"),
        F.when(F.col("id") < 29000, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).cast("timestamp_ntz").alias("created_at"),
    )
    got = {r["event_day"]: r for r in features.marketing_features(rows, "day").collect()}
    hot = got[date(2024, 1, 1)]
    assert hot["total_clicks"] == 29000
    assert hot["active_users"] == 1 + sum(1 for i in range(29000) if i % 3)


def test_labelled_share(spark, sf_dir):
    from contract import fixtures as fx

    days = training.training_customer_day(fx.mkt_daily(spark, sf_dir), fx.tx_daily(spark, sf_dir))
    assert {r["fraud_label"]: r["count"] for r in days.groupBy("fraud_label").count().collect()} == {0: 2082, 1: 523}
