"""Scores, decisions, reasons and model monitoring as plain columns and aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions import expr as X
from ledgerlark.operators.features import DISPOSABLE_DOMAINS
from ledgerlark.operators.ranking import exact_percentiles, in_ranges

# (threshold, risk level, decision) from the highest down; the last entry is the default.
LADDER = ((0.95, "critical", "decline"), (0.70, "high", "review"), (0.40, "medium", "monitor"), (0.0, "low", "approve"))
TWO_CUT_LADDER = ((0.90, "high", "decline"), (0.70, "medium", "review"), (0.0, "low", "approve"))

# Reason texts in the order they are tested.
REASONS = (
    ("transaction_count_1h > 10", "High transaction velocity (>10 in 1 hour)"),
    ("card_country_mismatch = 1", "Card country doesn't match IP country"),
    ("ip_country_mismatch = 1", "IP country doesn't match billing country"),
    ("velocity_km_per_hour > 500", "Impossible travel velocity detected"),
    ("device_fingerprint_new = 1", "New device fingerprint"),
    ("email_domain_disposable = 1", "Disposable email domain"),
    ("first_transaction_customer = 1", "First transaction for customer"),
    ("customer_dispute_history > 0", "Customer has dispute history"),
    ("high_value_flag = 1", "High transaction amount (>$10,000)"),
    ("amount_zscore > 3", "Transaction amount significantly above customer average"),
    ("high_risk_country = 1", "Transaction from high-risk country"),
)
NO_REASON = "Pattern analysis indicates elevated risk"

# Weights of the additive fraud probability.
BASE_RISK = 0.01
RISK_WEIGHTS = (
    ("card_country_mismatch", 0.15),
    ("ip_country_mismatch", 0.20),
    ("device_fingerprint_new", 0.10),
    ("email_domain_disposable", 0.15),
    ("high_risk_country", 0.10),
)
FAST_TRAVEL = (500, 0.05)


def risk_probability() -> Column:
    """Summed in whole hundredths, so that equal sums are equal numbers and tie in rankings."""
    def hundredths(weight: float) -> int:
        return round(weight * 100)

    p = F.lit(hundredths(BASE_RISK))
    for feature, weight in RISK_WEIGHTS:
        p = p + F.col(feature) * hundredths(weight)
    p = p + F.when(F.col("velocity_km_per_hour") > FAST_TRAVEL[0], hundredths(FAST_TRAVEL[1])).otherwise(0)
    return F.least(F.greatest(p.cast("double") / 100, F.lit(0.0)), F.lit(1.0))


def many_disputed(disputes: DataFrame, many_disputes: int = 2) -> DataFrame:
    """Per customer the instant (``many_disputed_at``) after which more than ``many_disputes`` disputes are known, from rows of
    (customer_id, opened_at). Ranks beyond that one are dropped before the shuffle, however many a customer has."""
    by_time = Window.partitionBy("customer_id").orderBy("opened_at")
    ranked = disputes.filter(F.col("opened_at").isNotNull()).withColumn("rank", F.row_number().over(by_time))
    return ranked.filter(F.col("rank") <= many_disputes + 1).groupBy("customer_id").agg(
        F.max(F.when(F.col("rank") == many_disputes + 1, F.col("opened_at"))).alias("many_disputed_at"))


def rule_score() -> Column:
    """Score of a payment from rules that need the payment and its customer's ``many_disputed_at`` only.

    Disputes opened at the payment's instant or later are not known yet."""
    def flag(p: Column) -> Column:
        return F.coalesce(p.cast("int"), F.lit(0))

    return (
        F.lit(0.01) + F.lit(0.15) * flag(F.col("card_country") != F.col("ip_country"))
        + F.lit(0.20) * flag(F.col("ip_country") != F.col("billing_country"))
        + F.lit(0.15) * flag(X.email_domain("email").isin(*DISPOSABLE_DOMAINS))
        + F.lit(0.40) * flag(F.col("many_disputed_at") < F.col("ts")))


def synthetic_labels(vector: DataFrame, row_id: str = "payment_id", seed: int = 42) -> DataFrame:
    """Bernoulli labels from the probability and a hash of the id: the same on every run."""
    labelled = vector.withColumn("fraud_probability", risk_probability())
    return labelled.withColumn("is_fraud", (X.uniform(seed, row_id) < F.col("fraud_probability")).cast("int"))


def decide(scores: DataFrame, score: str = "fraud_score", ladder: Sequence[tuple[float, str, str]] = LADDER) -> DataFrame:
    """Risk level and decision from the exact score, which is then rounded to four digits."""
    s = F.col(score)
    level, action = F.lit(ladder[-1][1]), F.lit(ladder[-1][2])
    for cut, name, decision in reversed(ladder[:-1]):
        level = F.when(s >= cut, name).otherwise(level)
        action = F.when(s >= cut, decision).otherwise(action)
    return scores.withColumns({"risk_level": level, "decision": action}).withColumn(score, F.round(s, 4))


def reasons(limit: int = 5) -> Column:
    """The first reasons that apply, or a general one."""
    found = F.slice(F.array_compact(F.array(*[F.when(F.expr(rule), text) for rule, text in REASONS])), 1, limit)
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(NO_REASON)))


# -- evaluation -------------------------------------------------------------------
def _outcomes(threshold: float) -> list[Column]:
    hit, fraud = F.col("fraud_score") >= threshold, F.col("is_fraud") == 1
    return [
        F.count_if(hit & fraud).alias("true_positives"),
        F.count_if(hit & ~fraud).alias("false_positives"),
        F.count_if(~hit & fraud).alias("false_negatives"),
        F.count_if(~hit & ~fraud).alias("true_negatives"),
    ]


def _with_rates(counted: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives", "true_negatives"))
    precision, recall = F.coalesce(X.ratio(tp, tp + fp), F.lit(0.0)), F.coalesce(X.ratio(tp, tp + fn), F.lit(0.0))
    return counted.withColumns({
        "precision": precision,
        "recall": recall,
        "f1_score": F.coalesce(X.ratio(2 * tp, 2 * tp + fp + fn), F.lit(0.0)),
        "false_positive_rate": F.coalesce(X.ratio(fp, fp + tn), F.lit(0.0)),
        "false_negative_rate": 1 - recall,
        "accuracy": X.ratio(tp + tn, tp + fp + fn + tn),
    })


def confusion(scores: DataFrame, threshold: float, keys: Sequence[str] = ()) -> DataFrame:
    """Confusion counts and rates in one pass. Columns ``fraud_score`` and ``is_fraud`` (0/1)."""
    return _with_rates(scores.groupBy(*keys).agg(*_outcomes(threshold)))


def evaluate(scores: DataFrame, threshold: float, keys: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """``confusion`` and ``auc_roc`` from one pass over the scores. Both are exact.

    Outcomes are counted per score first. For the area scores are dealt to ranges that hold about equally many of them, ranked inside,
    and each range is shifted by the outcomes of those below; so scores that crowd in a small part of 0 to 1 still spread over tasks.
    """
    counted = scores.groupBy(*keys, F.col("fraud_score").alias("_s")).agg(*_outcomes(threshold))
    per_score = in_ranges(counted, *keys, "_s", ranges=ranges)
    p, n = F.col("true_positives") + F.col("false_negatives"), F.col("false_positives") + F.col("true_negatives")
    earlier = (Window.unboundedPreceding, -1)
    lower = Window.partitionBy(*keys).orderBy("_part").rowsBetween(*earlier)  # one row per range
    offsets = per_score.groupBy(*keys, "_part").agg(F.sum(n).alias("_n")).withColumn(
        "_offset", F.coalesce(F.sum("_n").over(lower), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*keys, "_part").orderBy("_s").rowsBetween(*earlier)
    won = p * (F.col("_offset") + F.coalesce(F.sum(n).over(inside), F.lit(0)) + n / 2)
    counts = ("true_positives", "false_positives", "false_negatives", "true_negatives")
    summed = per_score.join(offsets, [*keys, "_part"]).withColumn("_won", won).groupBy(*keys).agg(
        X.ratio(F.sum("_won"), F.sum(p) * F.sum(n)).alias("auc_roc"), *[F.sum(c).alias(c) for c in counts])
    return _with_rates(summed)


def threshold_tradeoff(scores: DataFrame, thresholds: Sequence[float] = (0.5, 0.7, 0.9)) -> DataFrame:
    """Share of fraud caught and of good payments stopped per threshold, in one pass."""
    hit = lambda cut: F.col("fraud_score") >= cut
    fraud = F.col("is_fraud") == 1
    one_row = scores.agg(
        F.count_if(fraud).alias("fraud"), F.count_if(~fraud).alias("good"),
        F.array(*[
            F.struct(F.lit(cut).alias("threshold"), F.count_if(hit(cut) & fraud).alias("caught"),
                     F.count_if(hit(cut) & ~fraud).alias("stopped"))
            for cut in thresholds]).alias("per_cut"),
    )
    return one_row.select("fraud", "good", F.inline("per_cut")).select(
        "threshold", "caught", "stopped", X.pct("caught", "fraud").alias("fraud_caught_pct"),
        X.pct("stopped", "good").alias("false_positive_pct"))


def class_weight(labels: DataFrame) -> DataFrame:
    fraud = F.col("is_fraud") == 1
    return labels.agg(F.count_if(~fraud).alias("negatives"), F.count_if(fraud).alias("positives")).withColumn(
        "scale_pos_weight", X.ratio("negatives", "positives"))


def compare_models(metrics: DataFrame, production: str, recall_slack: float = 0.01, precision_slack: float = 0.02) -> DataFrame:
    """Every other model of ``metrics`` against the production model; promote only when all four tests pass."""
    names = ("auc_roc", "recall", "precision", "false_positive_rate")
    base = metrics.filter(F.col("model") == production).select(*[F.col(c).alias(f"p_{c}") for c in names])
    current = {c: base.select(f"p_{c}").scalar() for c in names}
    return metrics.filter(F.col("model") != production).select(
        "model",
        (F.col("auc_roc") > current["auc_roc"]).alias("auc_better"),
        (F.col("recall") > current["recall"] - recall_slack).alias("recall_kept"),
        (F.col("precision") > current["precision"] - precision_slack).alias("precision_kept"),
        (F.col("false_positive_rate") < current["false_positive_rate"]).alias("fpr_better"),
    ).withColumn("promote", F.col("auc_better") & F.col("recall_kept") & F.col("precision_kept") & F.col("fpr_better"))


def feature_drift(vector: DataFrame, names: Sequence[str], split, days: int = 7, warn: float = 10, critical: float = 20) -> DataFrame:
    """Percent change of each feature's mean between the ``days`` before ``split`` and the ``days`` from it.

    One pass computes all features; the population stability index compares fixed buckets
    (zero, up to one, up to ten, up to a hundred, more).
    """
    at = X.ts(split)
    old = (F.col("ts") >= at - F.expr(f"INTERVAL {days} DAY")) & (F.col("ts") < at)
    new = (F.col("ts") >= at) & (F.col("ts") < at + F.expr(f"INTERVAL {days} DAY"))

    def bucket(c):
        return (F.when(c <= 0, 0).when(c <= 1, 1).when(c <= 10, 2).when(c <= 100, 3).otherwise(4))

    def share(part, c, b):
        return F.count_if(part & (bucket(c) == b)).cast("double") / F.greatest(F.count_if(part), F.lit(1)).cast("double")

    def summary(name):
        c = F.col(name).cast("double")
        terms = []
        for b in range(5):
            o, n = F.greatest(share(old, c, b), F.lit(0.0001)), F.greatest(share(new, c, b), F.lit(0.0001))
            terms.append((n - o) * F.log(n / o))
        return F.struct(F.lit(name).alias("feature"), F.avg(F.when(old, c)).alias("baseline_mean"),
                        F.avg(F.when(new, c)).alias("current_mean"), sum(terms[1:], terms[0]).alias("psi"))

    one_row = vector.agg(F.array(*[summary(n) for n in names]).alias("all"))
    change = F.abs(X.growth_pct("current_mean", "baseline_mean"))
    return one_row.select(F.inline("all")).withColumn("drift_pct", change).withColumn(
        "status", F.when(F.col("drift_pct") > critical, "CRITICAL").when(F.col("drift_pct") > warn, "WARNING").otherwise("OK"))


def feedback_labels(payments: DataFrame, disputes: DataFrame, reason: str = "fraudulent") -> DataFrame:
    """A payment disputed later for ``reason`` is fraud. Disputes are reduced to one row per payment."""
    bad = disputes.filter(F.col("reason") == reason).groupBy("payment_id").agg(F.min("opened_at").alias("labelled_at"))
    return payments.join(bad, "payment_id", "left").withColumn("is_fraud", F.col("labelled_at").isNotNull().cast("int"))


def monitor(scores: DataFrame, threshold: float = 0.7, drop_pct: float = 5) -> DataFrame:
    """Daily accuracy and area under the curve; ``alert`` when either falls by more than ``drop_pct`` percent."""
    days = scores.withColumn("day", F.to_date("ts"))
    daily = evaluate(days, threshold, ["day"])
    by_day = Window.orderBy("day")  # one row per day

    def fell(c):
        # A day without scores is no day to compare with.
        yesterday = F.when(F.lag("day").over(by_day) == F.date_sub("day", 1), F.lag(c).over(by_day))
        return F.coalesce(X.growth_pct(c, yesterday) < -drop_pct, F.lit(False))

    return daily.withColumn("alert", fell("auc_roc") | fell("accuracy"))


def latency_percentiles(logs: DataFrame, keys: Sequence[str], latency: str, points: Mapping[str, float] | None = None,
                        exact: bool = True) -> DataFrame:
    """P50, P95 and P99. ``exact`` counts inside the bounds of a sketch; otherwise a sketch alone is used."""
    points = points or {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    if exact:
        return exact_percentiles(logs, keys, latency, points).withColumnRenamed("n", "requests")
    values = F.percentile_approx(F.col(latency), F.array(*[F.lit(p) for p in points.values()]))
    return logs.groupBy(*keys).agg(F.count(latency).alias("requests"), values.alias("_p")).select(
        *keys, "requests", *[F.col("_p")[i].alias(name) for i, name in enumerate(points)])
