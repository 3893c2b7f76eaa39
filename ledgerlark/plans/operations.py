"""Reports over the operational tables, set-based: one run answers for all merchants or customers.

``as_of`` stands for the current time everywhere. Optional identifiers only add a predicate,
which is pushed to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions import expr as X
from ledgerlark.operators.ranking import top_n, top_n_per_group
from ledgerlark.operators.timeslice import previous_within
from ledgerlark.plans.aggregates import with_two_distincts


def live(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_deleted"))


def since(df: DataFrame, as_of, n: int, unit: str, column: str = "created_at") -> DataFrame:
    return df.filter(F.col(column) >= X.ago(as_of, n, unit))


def only(df: DataFrame, **ids) -> DataFrame:
    """Equality predicates for the identifiers that were given."""
    for name, value in ids.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def _customer(customers, *columns) -> DataFrame:
    return customers.select("customer_id", F.col("email").alias("customer_email"), *columns)


def _merchant(merchants, *columns) -> DataFrame:
    return merchants.select("merchant_id", F.col("business_name").alias("merchant_name"), *columns)


def succeeded():
    return F.col("status") == "SUCCEEDED"


# -- payments ------------------------------------------------------------------
def transaction_details(transactions, customers, merchants, methods, checks, intent_id=None) -> DataFrame:
    return (
        only(live(transactions), payment_intent_id=intent_id)
        .join(_merchant(merchants), "merchant_id")
        .join(methods.select("payment_method_id", "card_brand", "last4"), "payment_method_id")
        .join(_customer(customers), "customer_id")
        .join(checks.select("transaction_id", "risk_level"), "transaction_id", "left")
        .select("transaction_id", "payment_intent_id", "amount", "currency", "status", "created_at", "customer_email",
                "merchant_name", "card_brand", "last4", "risk_level")
    )


def active_payment_methods(methods, customer_id=None) -> DataFrame:
    """Default first, then newest; the order applies to one customer's list."""
    df = only(methods.filter("is_active"), customer_id=customer_id).select(
        "customer_id", "payment_method_id", "type", "card_brand", "last4", "is_default", "created_at")
    return df if customer_id is None else df.orderBy(F.desc("is_default"), F.desc("created_at"))


def duplicate_transactions(transactions, minutes: int = 5) -> DataFrame:
    """Payments that repeat customer, merchant and amount of one at most ``minutes`` earlier."""
    candidates = live(transactions).filter(F.col("status").isin("PENDING", "SUCCEEDED"))
    return previous_within(
        candidates, ["customer_id", "merchant_id", "amount"], "created_at", "transaction_id", minutes * 60
    ).select("transaction_id", "payment_intent_id", "customer_id", "merchant_id", "amount", "created_at", "previous_at")


# -- merchant dashboard ----------------------------------------------------------
def merchant_daily_revenue(transactions, as_of, days: int = 30, merchant_id=None) -> DataFrame:
    return (
        only(since(live(transactions), as_of, days, "DAY"), merchant_id=merchant_id)
        .groupBy("merchant_id", F.to_date("created_at").alias("transaction_date"), "currency")
        .agg(
            F.count("*").alias("total_transactions"),
            F.count_if(succeeded()).alias("successful_count"),
            X.sum_if(succeeded(), "amount").alias("gross_revenue"),
            X.sum_if(succeeded(), "processing_fee").alias("fees"),
            X.sum_if(succeeded(), "net_amount").alias("net_revenue"),
        )
        .orderBy("merchant_id", F.desc("transaction_date"))
    )


def top_customers(transactions, customers, as_of, days: int = 90, n: int = 10, per_merchant: bool = False) -> DataFrame:
    """Top ``n`` spenders overall or of every merchant; only the winners meet the customer table's attributes."""
    keys = ["merchant_id", "customer_id"] if per_merchant else ["customer_id"]
    spend = (
        since(live(transactions), as_of, days, "DAY")
        .join(live(customers).select("customer_id"), "customer_id")
        .groupBy(*keys)
        .agg(
            F.count("*").alias("transaction_count"),
            X.sum_if(succeeded(), "amount").alias("total_spent"),
            F.max("created_at").alias("last_transaction_date"),
        )
    )
    order = (F.desc("total_spent"), F.asc("customer_id"))
    best = top_n_per_group(spend, ["merchant_id"], n, *order) if per_merchant else top_n(spend, n, *order)
    return best.join(customers.select("customer_id", "email", F.col("full_name").alias("customer_name")), "customer_id")


def failed_analysis(transactions, as_of, days: int = 7, merchant_id=None) -> DataFrame:
    return (
        only(since(live(transactions), as_of, days, "DAY").filter(F.col("status") == "FAILED"), merchant_id=merchant_id)
        .groupBy("merchant_id", "failure_code", "failure_message")
        .agg(
            F.count("*").alias("failure_count"),
            F.sum("amount").alias("lost_revenue"),
            X.mean("amount").alias("avg_failed_amount"),
        )
        .orderBy("merchant_id", F.desc("failure_count"))
    )


# -- fraud ------------------------------------------------------------------------
def high_risk_review(transactions, customers, merchants, checks, as_of, hours: int = 24) -> DataFrame:
    waiting = checks.filter(
        F.col("risk_level").isin("HIGH", "CRITICAL") & (F.col("action_taken") == "REVIEW") & F.col("reviewed_at").isNull()
    ).select("transaction_id", F.col("risk_score").alias("transaction_risk_score"), "risk_level")
    return (
        since(transactions, as_of, hours, "HOUR")
        .join(waiting, "transaction_id")
        .join(_merchant(merchants), "merchant_id")
        .join(_customer(customers, F.col("risk_score").alias("customer_risk_score"),
                        F.col("nationkey").alias("customer_country")), "customer_id")
        .select("transaction_id", "payment_intent_id", "amount", "currency", "created_at", "customer_email",
                "customer_risk_score", "merchant_name", "transaction_risk_score", "risk_level",
                F.col("nationkey").alias("country"), "customer_country")
        .orderBy(F.desc("transaction_risk_score"), F.desc("created_at"))
    )


def card_testing(transactions, customers, as_of, hours: int = 1, at_least: int = 3) -> DataFrame:
    return (
        since(live(transactions), as_of, hours, "HOUR")
        .filter(F.col("status") == "FAILED")
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("failed_attempts"),
            F.countDistinct("payment_method_id").alias("different_cards_used"),
            F.min("created_at").alias("first_attempt"),
            F.max("created_at").alias("last_attempt"),
        )
        .filter(F.col("failed_attempts") >= at_least)
        .join(customers.select("customer_id", "email"), "customer_id")
        .orderBy(F.desc("failed_attempts"))
    )


def cross_border(transactions, customers, checks, as_of, days: int = 1, above: int = 500) -> DataFrame:
    return (
        since(live(transactions), as_of, days, "DAY")
        .filter(F.col("amount") > above)
        .join(customers.select("customer_id", "email", F.col("nationkey").alias("customer_country")), "customer_id")
        .filter(F.col("customer_country") != F.col("nationkey"))
        .join(checks.select("transaction_id", "risk_score"), "transaction_id")
        .select("transaction_id", "amount", "created_at", "email", "customer_country",
                F.col("nationkey").alias("transaction_country"), "risk_score")
        .orderBy(F.desc("risk_score"))
    )


# -- subscriptions -------------------------------------------------------------------
def subscriptions_expiring(subscriptions, customers, merchants, as_of, days: int = 7) -> DataFrame:
    until = X.ts(as_of) + F.expr(f"INTERVAL {int(days)} DAY")
    return (
        subscriptions.filter(
            (F.col("status") == "ACTIVE") & F.col("current_period_end").between(X.ts(as_of), until)
            & ~F.col("cancel_at_period_end")
        )
        .join(_merchant(merchants), "merchant_id")
        .join(_customer(customers, "full_name"), "customer_id")
        .select("subscription_id", "plan_name", "amount", "current_period_end", "customer_email", "full_name", "merchant_name")
        .orderBy("current_period_end")
    )


def dunning_queue(subscription_payments, subscriptions, customers, merchants, as_of, max_attempts: int = 4) -> DataFrame:
    due = subscription_payments.filter(
        (F.col("status") == "FAILED") & (F.col("next_retry_at") <= X.ts(as_of)) & (F.col("attempt_count") < max_attempts)
    ).select("subscription_payment_id", "subscription_id", "attempt_count", "next_retry_at")
    active = subscriptions.filter("status = 'ACTIVE'").select(
        "subscription_id", "plan_name", "amount", "merchant_id", "customer_id")
    return (
        due.join(active, "subscription_id")
        .join(_merchant(merchants), "merchant_id")
        .join(_customer(customers), "customer_id")
        .orderBy("next_retry_at")
    )


def subscription_churn(subscriptions, as_of, months: int = 12) -> DataFrame:
    at = F.col("canceled_at")
    return (
        since(subscriptions.filter("status = 'CANCELED'"), as_of, months, "MONTH", "canceled_at")
        .groupBy(F.year(at).alias("cancel_year"), F.month(at).alias("cancel_month"))
        .agg(
            F.count("*").alias("canceled_count"),
            X.mean(X.days_between("created_at", "canceled_at")).alias("avg_lifetime_days"),
            F.sum("amount").alias("lost_mrr"),
        )
        .orderBy(F.desc("cancel_year"), F.desc("cancel_month"))
    )


# -- compliance -----------------------------------------------------------------------
def card_audit(methods, customers, transactions, as_of, months: int = 6) -> DataFrame:
    stored = since(methods, as_of, months, "MONTH")
    usage = transactions.groupBy("payment_method_id").agg(F.count("*").alias("times_used"))
    return (
        stored.join(usage, "payment_method_id", "left")
        .join(_customer(customers), "customer_id")
        .select("payment_method_id", "last4", "card_brand", "customer_email", F.col("created_at").alias("card_stored_date"),
                F.coalesce("times_used", F.lit(0)).alias("times_used"))
        .orderBy(F.desc("card_stored_date"))
    )


def customer_export(customers, methods, transactions, merchants, email: str | None = None) -> DataFrame:
    """Everything stored about customers as tagged rows; all detail columns are text."""
    who = customers if email is None else customers.filter(F.col("email") == email)
    text = lambda c: F.col(c).cast("string")
    none = F.lit(None).cast("string")

    def branch(df, tag, record_id, details, at):
        columns = [c.alias(f"detail_{i}") for i, c in enumerate(details, 1)]
        return df.select(F.lit(tag).alias("data_type"), "customer_id", F.col(record_id).cast("bigint").alias("record_id"),
                         *columns, F.col(at).alias("created_at"))

    ids = who.select("customer_id")
    info = branch(who, "Customer Info", "customer_id", [
        text("email"), text("first_name"), text("last_name"), text("phone"), text("nationkey")], "created_at")
    cards = branch(methods.join(ids, "customer_id"), "Payment Methods", "payment_method_id", [
        text("type"), text("card_brand"), text("last4"), text("exp_month"), text("exp_year")], "created_at")
    paid = branch(transactions.join(ids, "customer_id").join(_merchant(merchants), "merchant_id"), "Transactions",
                  "transaction_id", [text("amount"), text("currency"), text("status"), text("merchant_name"), none], "created_at")
    return info.unionByName(cards).unionByName(paid)


def aml_large(transactions, customers, merchants, checks, as_of, days: int = 30, at_least: int = 10000) -> DataFrame:
    return (
        since(live(transactions), as_of, days, "DAY")
        .filter((F.col("amount") >= at_least) & succeeded())
        .join(_merchant(merchants, "industry"), "merchant_id")
        .join(checks.select("transaction_id", "risk_score", "risk_level"), "transaction_id")
        .join(_customer(customers, F.col("nationkey").alias("customer_country")), "customer_id")
        .select("transaction_id", "payment_intent_id", "amount", "currency", "created_at", "customer_email",
                "customer_country", "merchant_name", "industry", "risk_score", "risk_level")
        .orderBy(F.desc("amount"))
    )


# -- refunds and chargebacks ---------------------------------------------------------------
def pending_refunds(refunds, transactions, customers, merchants, as_of) -> DataFrame:
    return (
        refunds.filter("status = 'PENDING'")
        .select("refund_id", "transaction_id", F.col("amount").alias("refund_amount"), "reason",
                F.col("created_at").alias("requested_at"))
        .join(transactions, "transaction_id")
        .join(_merchant(merchants), "merchant_id")
        .join(_customer(customers), "customer_id")
        .select("refund_id", "refund_amount", "currency", "reason", "requested_at",
                X.hour_boundaries("requested_at", X.ts(as_of)).alias("hours_pending"), "transaction_id",
                "payment_intent_id", "customer_email", "merchant_name")
        .orderBy("requested_at")
    )


def chargeback_rate(transactions, merchants, chargebacks, as_of, months: int = 3) -> DataFrame:
    """Chargebacks are counted per payment before the join, so a payment is one row and plain counts are distinct."""
    per_payment = chargebacks.groupBy("transaction_id").agg(
        F.countDistinct("chargeback_id").alias("n"), F.sum("amount").alias("disputed"))
    return (
        since(live(transactions), as_of, months, "MONTH")
        .join(per_payment, "transaction_id", "left")
        .groupBy("merchant_id")
        .agg(
            F.count("*").alias("total_transactions"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("chargeback_count"),
            F.sum("disputed").alias("total_disputed_amount"),
        )
        .filter(F.col("chargeback_count") > 0)
        .withColumn("chargeback_rate", X.pct("chargeback_count", "total_transactions"))
        .join(live(merchants).select("merchant_id", "business_name", "industry"), "merchant_id")
        .orderBy(F.desc("chargeback_rate"))
    )


def open_chargebacks(chargebacks, transactions, customers, merchants, as_of) -> DataFrame:
    return (
        chargebacks.filter((F.col("status") == "OPEN") & F.col("evidence_due_date").isNotNull())
        .select("chargeback_id", "transaction_id", F.col("amount").alias("disputed_amount"), "reason_code",
                "evidence_due_date", X.days_between(X.ts(as_of), "evidence_due_date").alias("days_remaining"))
        .join(transactions.select("transaction_id", "payment_intent_id", "customer_id", "merchant_id",
                                  F.col("created_at").alias("transaction_date")), "transaction_id")
        .join(_merchant(merchants, F.col("email").alias("merchant_email")), "merchant_id")
        .join(_customer(customers), "customer_id")
        .drop("customer_id", "merchant_id")
        .orderBy("evidence_due_date")
    )


# -- performance ----------------------------------------------------------------------------
def hourly_volume(transactions, checks, as_of, hours: int = 24) -> DataFrame:
    return (
        since(live(transactions), as_of, hours, "HOUR")
        .join(checks.select("transaction_id", "risk_score"), "transaction_id", "left")
        .groupBy(F.hour("created_at").alias("transaction_hour"))
        .agg(
            F.count("*").alias("transaction_count"),
            F.count_if(succeeded()).alias("successful_count"),
            X.mean(F.when(succeeded(), F.col("amount"))).alias("avg_transaction_amount"),
            X.mean("risk_score").alias("avg_risk_score"),
        )
        .orderBy("transaction_hour")
    )


def method_performance(methods, transactions, as_of, months: int = 1) -> DataFrame:
    per_method = (
        since(live(transactions), as_of, months, "MONTH")
        .groupBy("payment_method_id")
        .agg(
            F.count("*").alias("n"),
            F.count_if(succeeded()).alias("n_ok"),
            F.count_if(F.col("status") == "FAILED").alias("n_failed"),
            F.sum(F.when(succeeded(), F.col("amount"))).alias("ok_amount"),
        )
    )
    return (
        per_method.join(methods.select("payment_method_id", "type", "card_brand"), "payment_method_id")
        .groupBy("type", "card_brand")
        .agg(
            F.sum("n").alias("transaction_count"),
            F.sum("n_ok").alias("successful_count"),
            F.sum("n_failed").alias("failed_count"),
            F.sum("ok_amount").alias("ok_amount"),
        )
        .withColumn("success_rate", X.pct("successful_count", "transaction_count"))
        .withColumn("avg_successful_amount", X.ratio("ok_amount", "successful_count"))
        .drop("ok_amount")
        .orderBy(F.desc("transaction_count"))
    )


def geo_distribution(transactions, checks, as_of, months: int = 1) -> DataFrame:
    rows = (
        since(live(transactions), as_of, months, "MONTH")
        .filter(F.col("nationkey").isNotNull())
        .join(checks.select("transaction_id", "risk_score"), "transaction_id", "left")
        .withColumnRenamed("nationkey", "country")
    )
    counted = with_two_distincts(
        rows, ["country"], {"unique_customers": "customer_id", "unique_merchants": "merchant_id"},
        {"total_volume": F.when(succeeded(), F.col("amount")).otherwise(F.lit(0).cast("decimal(18,2)")),
         "_amount": F.col("amount"), "_n_amount": F.col("amount").isNotNull().cast("bigint"),
         "_risk": F.col("risk_score"), "_n_risk": F.col("risk_score").isNotNull().cast("bigint")})
    return (
        counted.withColumnRenamed("n", "transaction_count")
        .withColumn("avg_transaction_amount", X.ratio("_amount", "_n_amount"))
        .withColumn("avg_risk_score", X.ratio("_risk", "_n_risk"))
        .drop("_amount", "_n_amount", "_risk", "_n_risk")
        .orderBy(F.desc("total_volume"))
    )


def processing_latency(transactions, as_of, hours: int = 24) -> DataFrame:
    ms = F.unix_millis("updated_at") - F.unix_millis("created_at")
    return (
        since(live(transactions), as_of, hours, "HOUR")
        .filter(F.col("status").isin("SUCCEEDED", "FAILED"))
        .groupBy(F.hour("created_at").alias("hour_of_day"))
        .agg(
            F.count("*").alias("transaction_count"),
            X.mean(ms).alias("avg_processing_ms"),
            F.max(ms).alias("max_processing_ms"),
            F.min(ms).alias("min_processing_ms"),
        )
        .orderBy("hour_of_day")
    )


def health_check(transactions, checks, as_of, hours: int = 1, label: str = "Last Hour") -> DataFrame:
    status = F.col("status")
    return (
        since(live(transactions), as_of, hours, "HOUR")
        .join(checks.select("transaction_id", "risk_score"), "transaction_id", "left")
        .agg(
            F.lit(label).alias("time_period"),
            F.count("*").alias("total_transactions"),
            F.count_if(succeeded()).alias("succeeded"),
            F.count_if(status == "FAILED").alias("failed"),
            F.count_if(status == "PENDING").alias("pending"),
            X.pct(F.count_if(succeeded()), F.count("*")).alias("success_rate"),
            X.sum_if(succeeded(), "amount").alias("total_volume"),
            X.mean("risk_score").alias("avg_risk_score"),
        )
    )


# -- customer behaviour -------------------------------------------------------------------------
def customer_lifetime_value(transactions, customers, as_of) -> DataFrame:
    per_customer = live(transactions).groupBy("customer_id").agg(
        F.count("*").alias("total_transactions"),
        X.sum_if(succeeded(), "amount").alias("total_spent"),
        X.mean(F.when(succeeded(), F.col("amount"))).alias("avg_transaction_value"),
        F.max("created_at").alias("last_transaction_date"),
    )
    return (
        live(customers)
        .select("customer_id", "email", F.col("nationkey").alias("country"), F.col("created_at").alias("customer_since"))
        .join(per_customer, "customer_id")  # customers without payments are dropped by the report
        .withColumn("customer_age_days", X.days_between("customer_since", X.ts(as_of)))
        .withColumn("days_since_last_transaction", X.days_between("last_transaction_date", X.ts(as_of)))
        .orderBy(F.desc("total_spent"))
    )


def method_diversity(customers, methods, more_than: int = 1) -> DataFrame:
    """The list of types is ordered, so it is the same on every run. Types and brands are short closed lists."""
    return (
        methods.groupBy("customer_id")
        .agg(
            F.countDistinct("payment_method_id").alias("total_payment_methods"),
            F.size(F.collect_set("card_brand")).alias("different_brands"),
            F.array_join(F.sort_array(F.collect_set("type")), ", ").alias("payment_types_used"),
            F.max("created_at").alias("last_method_added"),
        )
        .filter(F.col("total_payment_methods") > more_than)
        .join(live(customers).select("customer_id", "email"), "customer_id")
        .orderBy(F.desc("total_payment_methods"))
    )


def repeat_rate(transactions, as_of, months: int = 6) -> DataFrame:
    n = F.col("transaction_count")
    counts = (
        since(live(transactions).filter(succeeded()), as_of, months, "MONTH")
        .groupBy("customer_id")
        .agg(F.count("*").alias("transaction_count"))
    )
    segments = (
        counts.groupBy(
            F.when(n == 1, "One-time").when(n <= 5, "Occasional").when(n <= 20, "Regular").otherwise("Power User")
            .alias("customer_segment")
        )
        .agg(F.count("*").alias("customer_count"))
    )
    everyone = F.sum("customer_count").over(Window.partitionBy())  # four segments
    return segments.withColumn("percentage", X.pct("customer_count", everyone)).orderBy(F.desc("customer_count"))


# -- views and procedures ---------------------------------------------------------------------------
def active_transactions(transactions, customers, merchants, methods, checks) -> DataFrame:
    return (
        live(transactions)
        .join(_merchant(merchants, F.col("nationkey").alias("merchant_country")), "merchant_id")
        .join(methods.select("payment_method_id", F.col("type").alias("payment_type"), "card_brand", "last4"),
              "payment_method_id")
        .join(_customer(customers, F.col("full_name").alias("customer_name")), "customer_id")
        .join(checks.select("transaction_id", "risk_level", "risk_score"), "transaction_id", "left")
        .select("transaction_id", "payment_intent_id", "amount", "currency", "status", "created_at", "customer_id",
                "customer_email", "customer_name", "merchant_id", "merchant_name", "merchant_country", "payment_type",
                "card_brand", "last4", "risk_level", "risk_score")
    )


def merchant_revenue(transactions, merchants) -> DataFrame:
    """Merchants without payments stay in, with zero counts."""
    per_merchant = live(transactions).groupBy("merchant_id").agg(
        F.count("*").alias("total_transactions"),
        X.sum_if(succeeded(), "amount").alias("total_revenue"),
        X.sum_if(succeeded(), "processing_fee").alias("total_fees"),
        X.sum_if(succeeded(), "net_amount").alias("total_net"),
        F.count_if(F.col("status") == "REFUNDED").alias("refund_count"),
        F.count_if(F.col("status") == "FAILED").alias("failed_count"),
    )
    return (
        live(merchants)
        .select("merchant_id", "business_name", F.col("nationkey").alias("country"))
        .join(per_merchant, "merchant_id", "left")
        .fillna(0)
    )


def high_risk_transactions(transactions, customers, merchants, checks) -> DataFrame:
    flagged = checks.filter(F.col("risk_level").isin("HIGH", "CRITICAL") & F.col("is_flagged"))
    return (
        live(transactions)
        .join(flagged.select("transaction_id", "risk_score", "risk_level", "is_flagged", "action_taken"), "transaction_id")
        .join(_merchant(merchants), "merchant_id")
        .join(_customer(customers), "customer_id")
        .select("transaction_id", "payment_intent_id", "amount", "currency", "status", "created_at", "customer_email",
                "merchant_name", "risk_score", "risk_level", "is_flagged", "action_taken")
    )


def customer_history(transactions, merchants, methods, customer_id=None, start=None, end=None, status=None) -> DataFrame:
    df = only(live(transactions), customer_id=customer_id, status=status)
    if start is not None:
        df = df.filter(F.col("created_at") >= X.ts(start))
    if end is not None:
        df = df.filter(F.col("created_at") <= X.ts(end))
    history = (
        df.join(_merchant(merchants), "merchant_id")
        .join(methods.select("payment_method_id", F.col("type").alias("payment_type"), "last4"), "payment_method_id")
        .select("customer_id", "transaction_id", "payment_intent_id", "amount", "currency", "status", "created_at",
                "merchant_name", "payment_type", "last4")
    )
    return history if customer_id is None else history.orderBy(F.desc("created_at"))


def merchant_metrics(transactions, start, end, merchant_id=None) -> DataFrame:
    status = F.col("status")
    in_range = F.col("created_at").between(X.ts(start), X.ts(end))
    return only(live(transactions).filter(in_range), merchant_id=merchant_id).groupBy("merchant_id").agg(
        F.count("*").alias("total_transactions"),
        F.count_if(succeeded()).alias("successful_transactions"),
        F.count_if(status == "FAILED").alias("failed_transactions"),
        F.count_if(status == "REFUNDED").alias("refunded_transactions"),
        X.sum_if(succeeded(), "amount").alias("total_revenue"),
        X.mean(F.when(succeeded(), F.col("amount"))).alias("average_transaction_value"),
        X.sum_if(succeeded(), "processing_fee").alias("total_processing_fees"),
        X.sum_if(succeeded(), "net_amount").alias("total_net_revenue"),
        X.pct(F.count_if(succeeded()), F.count("*")).alias("success_rate"),
    )
