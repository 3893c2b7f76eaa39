from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerlark.operators import models as T
from ledgerlark.operators import scoring as N
from ledgerlark.operators.ranking import in_ranges


def test_ladder_boundaries_use_the_exact_score(spark):
    s = spark.createDataFrame([(0.95,), (0.94999,), (0.7,), (0.4,), (0.39999,)], "fraud_score double")
    got = sorted(tuple(r) for r in N.decide(s).select("fraud_score", "risk_level", "decision").collect())
    assert got == [(0.4, "low", "approve"), (0.4, "medium", "monitor"), (0.7, "high", "review"), (0.95, "critical", "decline"),
                   (0.95, "high", "review")]
    assert N.decide(s, ladder=N.TWO_CUT_LADDER).filter("decision = 'decline'").count() == 2


def test_reasons_keep_the_first_five_or_fall_back(spark):
    names = ["transaction_count_1h", "card_country_mismatch", "ip_country_mismatch", "velocity_km_per_hour",
             "device_fingerprint_new", "email_domain_disposable", "first_transaction_customer", "customer_dispute_history",
             "high_value_flag", "amount_zscore", "high_risk_country"]
    df = spark.createDataFrame([(11, 1, 1, 501, 1, 1, 1, 1, 1, 4, 1), (10, 0, 0, 500, 0, 0, 0, 0, 0, 3, 0)],
                               ", ".join(f"{n} int" for n in names))
    all_, none = [r[0] for r in df.select(N.reasons()).collect()]
    assert all_ == [text for _, text in N.REASONS[:5]] and none == [N.NO_REASON]


@pytest.fixture(scope="module")
def scores(spark):
    rng = random.Random(3)
    data = [(i, round(rng.random(), 2), int(rng.random() < 0.2)) for i in range(300)]
    return data, spark.createDataFrame(data, "id bigint, fraud_score double, is_fraud int")


def test_auc_against_all_pairs(scores):
    data, df = scores
    good, bad = [s for _, s, y in data if not y], [s for _, s, y in data if y]
    wins = sum((b > g) + 0.5 * (b == g) for b in bad for g in good)
    assert N.evaluate(df, 0.7).first()["auc_roc"] == pytest.approx(wins / len(good) / len(bad))


def test_confusion_without_positives(spark):
    df = spark.createDataFrame([(0.1, 0), (0.9, 0)], "fraud_score double, is_fraud int")
    r = N.confusion(df, 0.7).first()
    assert (r["precision"], r["recall"], r["false_positive_rate"], r["true_negatives"]) == (0.0, 0.0, 0.5, 1)


def test_tradeoff_matches_confusion(scores):
    _, df = scores
    for r in N.threshold_tradeoff(df).collect():
        c = N.confusion(df, r["threshold"]).first()
        assert (r["caught"], r["stopped"]) == (c["true_positives"], c["false_positives"])


def test_split_is_stable_and_stratified(spark):
    df = spark.range(6000).withColumn("is_fraud", (F.col("id") % 10 == 0).cast("int"))
    a = T.stratified_split(df, "id", "is_fraud")
    assert a.exceptAll(T.stratified_split(df.repartition(7), "id", "is_fraud")).isEmpty()
    for label, split, n in rows(a.groupBy("is_fraud", "split").count()):
        want = {"train": 0.6}.get(split, 0.2) * (600 if label else 5400)
        assert abs(n - want) < 0.15 * want


def test_promote_needs_all_four(spark):
    m = spark.createDataFrame([("prod", 0.90, 0.80, 0.70, 0.05), ("good", 0.91, 0.795, 0.69, 0.04), ("worse", 0.91, 0.78, 0.75, 0.04)],
                              "model string, auc_roc double, recall double, precision double, false_positive_rate double")
    assert rows(N.compare_models(m, "prod").select("model", "promote"), "model") == [("good", True), ("worse", False)]


def test_external_scorer(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id bigint, a double, b double")
    got = T.score_external(df, ["a", "b"], lambda batch: batch["a"] + batch["b"] / 10, ["id"]).first()
    assert got["fraud_score"] == pytest.approx(2.3)


def test_training_needs_fraud(spark):
    df = spark.createDataFrame([(1, 0, "train")], "a bigint, is_fraud int, split string")
    with pytest.raises(ValueError):
        T.train(df, ["a"])


def test_many_disputes_need_one_instant_a_customer(spark):
    """Only disputes opened before the payment count, however many a customer has; no array of them is made."""
    start = "timestamp '2024-01-01'"
    disputes = spark.range(5000).selectExpr(
        "CASE WHEN id < 4995 THEN 1 WHEN id < 4997 THEN 2 ELSE 3 END AS customer_id", f"{start} + make_dt_interval(0, 0, id) AS opened_at")
    disputes = disputes.unionByName(spark.sql("SELECT 2 AS customer_id, CAST(NULL AS timestamp) AS opened_at"))
    known = N.many_disputed(disputes)
    assert known.dtypes == [("customer_id", "int"), ("many_disputed_at", "timestamp")]
    asked = spark.sql(f"""SELECT c AS customer_id, {start} + make_dt_interval(0, 0, m) AS ts, 'a' AS card_country, 'a' AS ip_country,
        'a' AS billing_country, 'x@example.org' AS email FROM VALUES (1, 2), (1, 3), (2, 5000), (3, 4999), (3, 5000), (4, 9) AS t(c, m)""")
    out = asked.join(known, "customer_id", "left").withColumn("score", N.rule_score())
    got = rows(out.selectExpr("customer_id", "minute(ts)", "score > 0.4"), "customer_id", "ts")
    assert [g[2] for g in got] == [False, True, False, False, True, False]


def test_crowded_scores_spread_over_ranges(spark):
    """98 % of the scores below 0.02: same area, no range with most of the scores."""
    rnd = random.Random(2)
    data = [(rnd.random() * (0.02 if rnd.random() < 0.98 else 1), int(rnd.random() < 0.1)) for _ in range(4000)]
    df = spark.createDataFrame(data, "fraud_score double, is_fraud int")
    area = N.evaluate(df, 0.5, ranges=8).first()["auc_roc"]
    pairs = sorted(data)
    good, won = 0, 0.0
    for s, y in pairs:
        won += good if y else 0
        good += 1 - y
    assert area == pytest.approx(won / (good * (len(data) - good)))
    sizes = [r["count"] for r in in_ranges(df, "fraud_score", ranges=8).groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1200
