"""Scores, evaluation and model jobs, and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.operators import features as M
from ledgerlark.operators import models as T
from ledgerlark.operators import scoring as N
from ledgerlark.registry import query
from ledgerlark.registry.features import vector
from ledgerlark.registry.fixture_sql import part
from ledgerlark.session import materialise

# Thresholds for the additive risk, which seldom passes one half.
CUTS = ((0.55, "critical", "decline"), (0.40, "high", "review"), (0.20, "medium", "monitor"), (0.0, "low", "approve"))


def uniform(seed: int, text: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || {text}), 1, 8) AS BIGINT) / 4294967296.0"


part("x_labelled", f"""SELECT *, risk AS fraud_probability, CAST({uniform(42, 'payment_id')} < risk AS INT) AS is_fraud FROM x_risk""")
part("x_truth", """SELECT r.*, r.risk AS fraud_score, CAST(d.payment_id IS NOT NULL AS INT) AS disputed
  FROM x_risk r LEFT JOIN (SELECT DISTINCT payment_id FROM x_disputes WHERE reason = 'fraudulent') d USING (payment_id)""")


def risk(t):
    return vector(t).withColumn("fraud_score", N.risk_probability())


def labelled(t):
    """Risk as score, synthetic labels as truth."""
    return N.synthetic_labels(vector(t)).withColumn("fraud_score", F.col("fraud_probability"))


@query("score_decision", "payment_id:i fraud_score:r risk_level:s decision:s",
       """SELECT payment_id, risk AS fraud_score,
            CASE WHEN risk >= 0.55 THEN 'critical' WHEN risk >= 0.4 THEN 'high' WHEN risk >= 0.2 THEN 'medium' ELSE 'low' END
              AS risk_level,
            CASE WHEN risk >= 0.55 THEN 'decline' WHEN risk >= 0.4 THEN 'review' WHEN risk >= 0.2 THEN 'monitor' ELSE 'approve' END
              AS decision FROM x_risk""")
def score_decision(t):
    return N.decide(risk(t), ladder=CUTS)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query("explain_reasons", "payment_id:i reasons:s",
       """SELECT payment_id, array_to_string(CASE WHEN len(r) = 0 THEN ['""" + N.NO_REASON + """'] ELSE r[1:5] END, '; ') AS reasons
          FROM (SELECT payment_id, [x FOR x IN [""" + ", ".join(
              f"CASE WHEN {rule} THEN {quoted(text)} END" for rule, text in N.REASONS)
       + "] IF x IS NOT NULL] AS r FROM x_vector)")
def explain_reasons(t):
    return vector(t).select("payment_id", F.array_join(N.reasons(), "; ").alias("reasons"))


@query("synthetic_fraud_labels", "payment_id:i fraud_probability:r is_fraud:i", "SELECT * FROM x_labelled")
def synthetic_fraud_labels(t):
    return labelled(t)


@query("class_weight", "negatives:i positives:i scale_pos_weight:r",
       """SELECT count(*) FILTER (is_fraud = 0) AS negatives, count(*) FILTER (is_fraud = 1) AS positives,
            CAST(count(*) FILTER (is_fraud = 0) AS DOUBLE) / count(*) FILTER (is_fraud = 1) AS scale_pos_weight FROM x_labelled""")
def class_weight(t):
    return N.class_weight(labelled(t))


@query("stratified_split", "payment_id:i is_fraud:i split:s",
       f"""SELECT payment_id, is_fraud, CASE WHEN u < 0.6 THEN 'train' WHEN u < 0.8 THEN 'validation' ELSE 'test' END AS split
          FROM (SELECT *, {uniform(42, "is_fraud || ':' || payment_id")} AS u FROM x_labelled)""")
def stratified_split(t):
    return T.stratified_split(labelled(t), "payment_id", "is_fraud")


RATES = "precision:r recall:r f1_score:r false_positive_rate:r false_negative_rate:r accuracy:r"
COUNTS = "true_positives:i false_positives:i false_negatives:i true_negatives:i"


def confusion(source: str, cut: float, keys: str = "") -> str:
    by = f"{keys}, " if keys else ""
    return f"""SELECT *, tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives,
        CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END AS precision,
        CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END AS recall,
        CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0 END AS f1_score,
        CASE WHEN fp + tn > 0 THEN CAST(fp AS DOUBLE) / (fp + tn) ELSE 0 END AS false_positive_rate,
        1 - CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END AS false_negative_rate,
        CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy
      FROM (SELECT {by}count(*) FILTER (s >= {cut} AND y = 1) AS tp, count(*) FILTER (s >= {cut} AND y = 0) AS fp,
        count(*) FILTER (s < {cut} AND y = 1) AS fn, count(*) FILTER (s < {cut} AND y = 0) AS tn
        FROM ({source}) {'GROUP BY ' + keys if keys else ''})"""


def area(source: str, keys: str) -> str:
    """Pairs won: for every fraud row the good rows scored below it, ties half."""
    return f"""SELECT {keys}, sum(p * (below + n / 2.0)) / nullif(CAST(sum(p) * sum(n) AS DOUBLE), 0) AS auc_roc
      FROM (SELECT *, coalesce(sum(n) OVER (PARTITION BY {keys} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM (SELECT {keys}, s, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n FROM ({source}) GROUP BY ALL))
      GROUP BY {keys}"""


SCORED = "SELECT risk AS s, is_fraud AS y, 'risk' AS model, CAST(ts AS DATE) AS day FROM x_labelled"


@query("evaluate_at_threshold", f"auc_roc:r {COUNTS} {RATES}",
       f"SELECT c.*, a.auc_roc FROM ({confusion(SCORED, 0.4, 'model')}) c JOIN ({area(SCORED, 'model')}) a USING (model)")
def evaluate_at_threshold(t):
    return N.evaluate(labelled(t), 0.4)


@query("threshold_tradeoff", "threshold:r caught:i stopped:i fraud_caught_pct:r false_positive_pct:r",
       """SELECT threshold, count(*) FILTER (risk >= threshold AND is_fraud = 1) AS caught,
            count(*) FILTER (risk >= threshold AND is_fraud = 0) AS stopped,
            CAST(count(*) FILTER (risk >= threshold AND is_fraud = 1) AS DOUBLE) / count(*) FILTER (is_fraud = 1) * 100
              AS fraud_caught_pct,
            CAST(count(*) FILTER (risk >= threshold AND is_fraud = 0) AS DOUBLE) / count(*) FILTER (is_fraud = 0) * 100
              AS false_positive_pct
          FROM x_labelled, (VALUES (CAST(0.1 AS DOUBLE)), (0.3), (0.5)) AS v(threshold) GROUP BY 1""")
def threshold_tradeoff(t):
    return N.threshold_tradeoff(labelled(t), (0.1, 0.3, 0.5))


TWO = f"""{SCORED} UNION ALL SELECT CASE WHEN amount_ratio_to_avg > 1 THEN 0.5 ELSE 0.1 END, is_fraud, 'amount', NULL FROM x_labelled
  UNION ALL SELECT least(risk + 0.001 * is_fraud, 1.0), is_fraud, 'sharper', NULL FROM x_labelled"""


@query("compare_models", "model:s auc_better:b recall_kept:b precision_kept:b fpr_better:b promote:b",
       f"""WITH m AS (SELECT c.*, a.auc_roc FROM ({confusion(TWO, 0.4, 'model')}) c JOIN ({area(TWO, 'model')}) a USING (model)),
            p AS (SELECT * FROM m WHERE model = 'risk')
          SELECT m.model, m.auc_roc > p.auc_roc AS auc_better, m.recall > p.recall - 0.01 AS recall_kept,
            m.precision > p.precision - 0.02 AS precision_kept, m.false_positive_rate < p.false_positive_rate AS fpr_better,
            m.auc_roc > p.auc_roc AND m.recall > p.recall - 0.01 AND m.precision > p.precision - 0.02
              AND m.false_positive_rate < p.false_positive_rate AS promote
          FROM m, p WHERE m.model <> 'risk'""")
def compare_models(t):
    """Two candidates against the risk score: one by amount, one that knows a little of the truth."""
    candidates = F.array(
        F.struct(F.lit("risk").alias("model"), F.col("fraud_score").alias("s")),
        F.struct(F.lit("amount").alias("model"), F.when(F.col("amount_ratio_to_avg") > 1, 0.5).otherwise(0.1).alias("s")),
        F.struct(F.lit("sharper").alias("model"),
                 F.least(F.col("fraud_score") + 0.001 * F.col("is_fraud"), F.lit(1.0)).alias("s")))
    scores = labelled(t).select("is_fraud", F.inline(candidates)).withColumnRenamed("s", "fraud_score")
    metrics = materialise(N.evaluate(scores, 0.4, ["model"]), "metrics")
    return N.compare_models(metrics, "risk")


DRIFT = ("transaction_count_24h", "avg_amount_7d", "distance_km", "customer_success_rate", "email_domain_age_days")
BUCKET = "CASE WHEN v <= 0 THEN 0 WHEN v <= 1 THEN 1 WHEN v <= 10 THEN 2 WHEN v <= 100 THEN 3 ELSE 4 END"


@query("feature_drift", "feature:s baseline_mean:r current_mean:r psi:r drift_pct:r status:s",
       f"""WITH long AS (SELECT CAST(ts >= TIMESTAMP '2024-01-16 00:00:00' AS INT) AS now, f AS feature, CAST(v AS DOUBLE) AS v FROM ("""
       + " UNION ALL ".join(f"SELECT ts, '{f}' AS f, {f} AS v FROM x_vector" for f in DRIFT)
       + f""") WHERE ts >= TIMESTAMP '2024-01-09 00:00:00' AND ts < TIMESTAMP '2024-01-23 00:00:00'),
          shares AS (SELECT feature, b, greatest(CAST(count(*) FILTER (now = 0 AND {BUCKET} = b) AS DOUBLE) / count(*) FILTER (now = 0), 0.0001) AS o,
              greatest(CAST(count(*) FILTER (now = 1 AND {BUCKET} = b) AS DOUBLE) / count(*) FILTER (now = 1), 0.0001) AS n
            FROM long, range(5) AS r(b) GROUP BY 1, 2),
          means AS (SELECT feature, avg(v) FILTER (now = 0) AS baseline_mean, avg(v) FILTER (now = 1) AS current_mean FROM long GROUP BY 1)
          SELECT *, CASE WHEN drift_pct > 20 THEN 'CRITICAL' WHEN drift_pct > 10 THEN 'WARNING' ELSE 'OK' END AS status
          FROM (SELECT m.*, s.psi, abs((current_mean - baseline_mean) / nullif(baseline_mean, 0) * 100) AS drift_pct
            FROM means m JOIN (SELECT feature, sum((n - o) * ln(n / o)) AS psi FROM shares GROUP BY 1) s USING (feature))""")
def feature_drift(t):
    return N.feature_drift(vector(t), DRIFT, "2024-01-16 00:00:00")


@query("label_feedback", "payment_id:i is_fraud:i labelled_at:t",
       """SELECT p.payment_id, CAST(d.at IS NOT NULL AS INT) AS is_fraud, d.at AS labelled_at FROM x_payments p
          LEFT JOIN (SELECT payment_id, min(opened_at) AS at FROM x_disputes WHERE reason = 'fraudulent' GROUP BY 1) d
          USING (payment_id)""")
def label_feedback(t):
    return N.feedback_labels(t.payments(), t.disputes())


@query("model_monitor", "day:s accuracy:r auc_roc:r alert:b",
       f"""SELECT *, coalesce(lag(day) OVER d = day - 1 AND (auc_roc - lag(auc_roc) OVER d) / nullif(lag(auc_roc) OVER d, 0) * 100 < -5, FALSE)
            OR coalesce(lag(day) OVER d = day - 1 AND (accuracy - lag(accuracy) OVER d) / nullif(lag(accuracy) OVER d, 0) * 100 < -5, FALSE)
            AS alert
          FROM (SELECT c.day, c.accuracy, a.auc_roc FROM ({confusion(SCORED, 0.4, 'day')}) c JOIN ({area(SCORED, 'day')}) a USING (day))
          WINDOW d AS (ORDER BY day)""")
def model_monitor(t):
    return N.monitor(labelled(t), threshold=0.4)


@query("latency_percentiles", "endpoint:s requests:i p50:r p95:r p99:r",
       """SELECT endpoint, count(*) AS requests, quantile_cont(latency_ms, 0.5) AS p50, quantile_cont(latency_ms, 0.95) AS p95,
            quantile_cont(latency_ms, 0.99) AS p99 FROM x_logs GROUP BY 1""")
def latency_percentiles(t):
    return N.latency_percentiles(t.api_logs(), ["endpoint"], "latency_ms")


# -- trained models -------------------------------------------------------------------
SMALL = {"maxIter": 5, "maxDepth": 4, "stepSize": 0.3, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}


def training_rows(t):
    return materialise(T.stratified_split(labelled(t), "payment_id", "is_fraud"), "training")


@query("train_classifier", f"auc_roc:r {COUNTS} {RATES}")
def train_classifier(t):
    """Metrics of a small model on the test split."""
    rows = training_rows(t)
    model = T.train(rows, M.FEATURES, params=SMALL)
    return N.evaluate(T.score(model, rows.filter("split = 'test'"), M.FEATURES, ["payment_id", "is_fraud"]), 0.7)


@query("batch_score", "payment_id:i fraud_score:r risk_level:s decision:s")
def batch_score(t):
    rows = training_rows(t)
    model = T.train(rows, M.FEATURES, params=SMALL)
    return N.decide(T.score(model, rows, M.FEATURES, ["payment_id"]))


@query("feature_importance", "feature:s importance:r")
def feature_importance(t):
    rows = training_rows(t)
    return T.importances(T.train(rows, M.FEATURES, params=SMALL), rows, M.FEATURES)


@query("tune", "trial:i params:s auc_roc:r")
def tune(t):
    space = {**{k: (v,) for k, v in SMALL.items()}, "maxIter": (2, 4), "maxDepth": (2, 3, 4)}
    return T.tune(training_rows(t), M.FEATURES, trials=3, space=space)


# -- what can be told of fitted models in SQL ------------------------------------------------------
@query("model_facts", "scored:i scores_between_0_and_1:i trees_allowed:b features:i importance_sum:r sorted_by_importance:b trials:i sorted_by_area:b "
       "same_twice:b",
       """SELECT count(*) AS scored, count(*) AS scores_between_0_and_1, TRUE AS trees_allowed, 45 AS features, 1.0 AS importance_sum,
            TRUE AS sorted_by_importance, 3 AS trials, TRUE AS sorted_by_area, TRUE AS same_twice FROM x_payments""")
def model_facts(t):
    """Counts, sums and orders of one fit, its scores and importances, and a search; the same candidate twice has one area."""
    rows = training_rows(t)
    model = T.train(rows, M.FEATURES, params=SMALL)
    scores = T.score(model, rows, M.FEATURES, ["payment_id"]).agg(
        F.count("*").alias("scored"), F.count_if(F.col("fraud_score").between(0, 1)).alias("scores_between_0_and_1"))
    weights = [r["importance"] for r in T.importances(model, rows, M.FEATURES).collect()]  # one per feature
    space = {**{k: (v,) for k, v in SMALL.items()}, "maxIter": (2,), "maxDepth": (2, 3)}
    found = [(r["params"], r["auc_roc"]) for r in T.tune(rows, M.FEATURES, trials=3, space=space).collect()]  # one per trial
    facts = {"trees_allowed": 1 <= model.stages[-1].getNumTrees <= SMALL["maxIter"], "features": len(weights), "importance_sum": float(sum(weights)), "trials": len(found),
             "sorted_by_importance": weights == sorted(weights, reverse=True), "same_twice": len(set(found)) == len({p for p, _ in found}),
             "sorted_by_area": [a for _, a in found] == sorted((a for _, a in found), reverse=True)}
    return scores.withColumns({k: F.lit(v) for k, v in facts.items()})
