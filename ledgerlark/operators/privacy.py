"""Export, erasure, retention, masking and access monitoring for personal data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerlark.functions import expr as X
from ledgerlark.operators.timeslice import previous_within

FORMAT_VERSION = "1.0"
RETENTION_YEARS = 7

# Protection per classification level.
PROTECTION = {"P0": "tokenise", "P1": "encrypt and mask", "P2": "restrict", "P3": "internal", "P4": "none"}
# Detectors over text values: (kind, level, pattern).
DETECTORS = (
    ("card number", "P0", r"\b\d(?:[ -]?\d){12,18}\b"),
    ("iban", "P0", r"\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b"),
    ("email", "P1", r"[\w.+-]+@[\w-]+\.[\w.]+"),
)


# -- access and portability -------------------------------------------------------
def subject_export(requests, customers, payments, subscriptions) -> DataFrame:
    """Tagged rows about every requested customer; detail columns are text."""
    ids = requests.select("customer_id").distinct()

    def branch(df, tag, record, details):
        chosen = df.join(ids, "customer_id")
        return chosen.select(F.lit(tag).alias("data_type"), "customer_id", F.col(record).cast("bigint").alias("record_id"),
                             *[F.col(c).cast("string").alias(f"detail_{i}") for i, c in enumerate(details, 1)],
                             "created_at")

    return (
        branch(customers, "Customer", "customer_id", ["email", "nationkey", "customer_segment"])
        .unionByName(branch(payments, "Payments", "transaction_id", ["amount", "currency", "status"]))
        .unionByName(branch(subscriptions, "Subscriptions", "subscription_id", ["plan_name", "status", "current_period_end"]))
    )


def request_log(requests: DataFrame, kind: str, status: str, as_of) -> DataFrame:
    return requests.select("customer_id", F.lit(kind).alias("request_type"), F.lit(status).alias("status"),
                           X.ts(as_of).alias("processed_at"))


def portability_json(requests, customers, payments, subscriptions, as_of, controller: str,
                     records_per_part: int = 10_000) -> DataFrame:
    """JSON documents per customer: one, or ``parts`` of about ``records_per_part`` records for a large customer.

    Records are dealt to parts by their id, so no customer fills a single task and every record
    is in exactly one part.
    """
    ids = requests.select("customer_id").distinct()
    stamp = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    paid = payments.join(ids, "customer_id")
    subs = subscriptions.join(ids, "customer_id")
    sizes = (
        paid.groupBy("customer_id").agg(F.count("*").alias("n"))
        .unionByName(subs.groupBy("customer_id").agg(F.count("*").alias("n")))
        .groupBy("customer_id").agg(F.ceil(F.sum("n") / records_per_part).alias("parts"))
    )
    people = customers.join(ids, "customer_id").join(sizes, "customer_id", "left").withColumn(
        "parts", F.coalesce("parts", F.lit(1)).cast("bigint"))

    def children(df, name, record, **fields):
        item = F.struct(*[c.alias(n) for n, c in fields.items()])
        dealt = df.join(sizes, "customer_id").withColumn("part", F.pmod(F.hash(record), F.col("parts")))
        return dealt.groupBy("customer_id", "part").agg(F.sort_array(F.collect_list(item)).alias(name))

    paid = children(paid, "payments", "transaction_id", id=F.col("transaction_id"), amount=F.col("amount"),
                    currency=F.col("currency"), status=F.lower("status"), created_at=F.date_format("created_at", stamp))
    subs = children(subs, "subscriptions", "subscription_id", id=F.col("subscription_id"), plan=F.col("plan_name"),
                    status=F.lower("status"), start_date=F.date_format("created_at", "yyyy-MM-dd"))
    who = F.struct(F.col("customer_id").alias("id"), "email", F.col("nationkey").alias("country"),
                   F.date_format("created_at", stamp).alias("created_at"))
    meta = F.struct(F.date_format(X.ts(as_of), stamp).alias("exported_at"), F.lit(FORMAT_VERSION).alias("format_version"),
                    F.lit(controller).alias("data_controller"), (F.col("part") + 1).alias("part"), "parts")
    parts = people.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    joined = parts.join(paid, ["customer_id", "part"], "left").join(subs, ["customer_id", "part"], "left")
    paid_list, sub_list = F.coalesce("payments", F.array()), F.coalesce("subscriptions", F.array())
    return joined.select(
        "customer_id", (F.col("part") + 1).alias("part"), "parts", F.size(paid_list).alias("payment_count"),
        F.size(sub_list).alias("subscription_count"),
        F.to_json(F.struct(who.alias("customer"), paid_list.alias("payments"), sub_list.alias("subscriptions"),
                           meta.alias("export_metadata"))).alias("document"))


# -- erasure and retention ------------------------------------------------------------
def erasure_decisions(requests: DataFrame, payments: DataFrame, as_of, years: int = RETENTION_YEARS) -> DataFrame:
    """Rejected while a payment is younger than the legal retention, otherwise completed."""
    recent = payments.filter(F.col("created_at") > X.ago(as_of, years, "YEAR")).select("customer_id").distinct()
    asked = requests.select("customer_id").distinct()
    kept = asked.join(recent.withColumn("_kept", F.lit(True)), "customer_id", "left")
    blocked = F.col("_kept").isNotNull()
    return kept.select("customer_id", F.when(blocked, "Rejected").otherwise("Completed").alias("status"),
                       F.when(blocked, f"Legal obligation: tax retention {years} years").alias("reason"),
                       X.ts(as_of).alias("processed_at"))


def erase(decisions: DataFrame, tables: Mapping[str, tuple[DataFrame, str]], payments: str = "transactions",
          payment_key: str = "transaction_id", by_payment: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Every table without the erased customers' rows.

    ``tables`` maps a name to (frame, customer column). Tables in ``by_payment`` have no customer
    and follow the erased payments, whose keys are taken before the payments themselves go.
    """
    gone = decisions.filter(F.col("status") == "Completed").select("customer_id")
    paid, owner = tables[payments]
    gone_payments = paid.join(gone.withColumnRenamed("customer_id", owner), owner, "left_semi").select(payment_key)
    out = {}
    for name, (df, column) in tables.items():
        if name in by_payment:
            out[name] = df.join(gone_payments, payment_key, "left_anti")
        else:
            out[name] = df.join(gone.withColumnRenamed("customer_id", column), column, "left_anti")
    return out


def purge_payments(payments: DataFrame, as_of, years: int = RETENTION_YEARS + 1) -> DataFrame:
    """Payments young enough to keep. With anonymisation they go a year after the retention ends."""
    return payments.filter(F.col("created_at") >= X.ago(as_of, years, "YEAR"))


def anonymise_old(payments: DataFrame, as_of, from_years: int = RETENTION_YEARS, to_years: int = RETENTION_YEARS + 1) -> DataFrame:
    """Payments between the two ages lose the person: no customer, no card digits, no address."""
    at = F.col("created_at")
    old = (at < X.ago(as_of, from_years, "YEAR")) & (at >= X.ago(as_of, to_years, "YEAR"))
    return payments.withColumns({
        "customer_id": F.when(~old, F.col("customer_id")),
        "last4": F.when(old, "XXXX").otherwise(F.col("last4")),
        "billing_address": F.when(old, "REDACTED").otherwise(F.col("billing_address")),
    })


def purge_customers(customers: DataFrame, as_of, years: int = 3, notice_days: int = 30) -> DataFrame:
    """Customers to keep: an inactive one goes after ``years`` and a notice sent long enough ago."""
    go = (
        ~F.col("is_active") & (F.col("last_login_at") < X.ago(as_of, years, "YEAR"))
        & (F.col("notified_at") < X.ago(as_of, notice_days, "DAY")))
    return customers.filter(~F.coalesce(go, F.lit(False)))


def mark_inactive(customers: DataFrame, as_of, years: int = 2) -> DataFrame:
    stale = F.coalesce(F.col("last_login_at") < X.ago(as_of, years, "YEAR"), F.lit(False))
    return customers.withColumn("is_active", F.col("is_active") & ~stale)


def stale_notifications(customers: DataFrame, as_of, months: int = 6) -> DataFrame:
    return customers.filter(F.col("updated_at") < X.ago(as_of, months, "MONTH")).select(
        "customer_id", F.lit("DataUpdate").alias("type"), F.lit("Please verify your account information").alias("message"))


# -- masking -----------------------------------------------------------------------------
def mask_columns(df: DataFrame, masks: Mapping[str, str]) -> DataFrame:
    """``masks`` maps a column to email, redact, last4 or drop."""
    how = {
        "email": lambda c: X.mask_email(c),
        "redact": lambda c: F.when(F.col(c).isNotNull(), F.lit("REDACTED")),
        "last4": lambda c: F.concat(F.lit("****"), F.right(F.col(c).cast("string"), F.lit(4))),
    }
    changed = df.withColumns({c: how[m](c) for c, m in masks.items() if m != "drop"})
    return changed.drop(*[c for c, m in masks.items() if m == "drop"])


def pseudonymise(df: DataFrame, columns: Sequence[str], salt: str) -> DataFrame:
    return df.withColumns({c: X.pseudonym(c, salt) for c in columns})


def classify_columns(df: DataFrame, name: str) -> DataFrame:
    """Scan every text column with the detectors in one pass: hits per kind, level, protection."""
    text = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    found = df.agg(F.count("*").alias("total"), F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("kind"), F.lit(level).alias("level"),
                 F.count_if(F.coalesce(F.regexp_like(c, F.lit(pattern)), F.lit(False))).alias("hits"))
        for c in text for kind, level, pattern in DETECTORS]).alias("all"))
    protection = F.lit(None).cast("string")
    for level, action in PROTECTION.items():
        protection = F.when(F.col("level") == level, action).otherwise(protection)
    return found.select(F.lit(name).alias("table_name"), "total", F.inline("all")).filter("hits > 0").withColumn(
        "protection", protection)


# -- incidents, requests and access -------------------------------------------------------------
def breach_severity(incidents: DataFrame) -> DataFrame:
    """``incidents``: incident_id, records, has_pii, has_payment_data."""
    n = F.col("records")
    return incidents.withColumn(
        "severity",
        F.when((n > 10_000) | F.col("has_payment_data"), "High").when((n >= 100) | F.col("has_pii"), "Medium").otherwise("Low"))


def affected_subjects(incident_records: DataFrame, customers: DataFrame) -> DataFrame:
    return customers.join(incident_records.select("customer_id"), "customer_id", "left_semi")


def request_sla(requests: DataFrame, as_of, limit_days: int = 30) -> DataFrame:
    """Answer time per request type; open requests count up to ``as_of``."""
    days = X.days_between("requested_at", F.coalesce(F.col("processed_at"), X.ts(as_of)))
    return requests.withColumn("days", days).groupBy("request_type").agg(
        F.count("*").alias("requests"), X.mean("days").alias("avg_days"), F.max("days").alias("max_days"),
        F.count_if(F.col("days") > limit_days).alias("late"))


def bulk_access(access: DataFrame, export_rows: int = 10_000, pii_rows: int = 1_000, start_hour: int = 8,
                end_hour: int = 18) -> DataFrame:
    """Accesses that are too large or outside office hours. ``access``: principal, ts, action, row_count, has_pii."""
    n = F.col("row_count")
    finding = F.array_compact(F.array(
        F.when((F.col("action") == "export") & (n > export_rows), "bulk export"),
        F.when(F.col("has_pii") & (n > pii_rows), "bulk personal data"),
        F.when(~F.hour("ts").between(start_hour, end_hour - 1), "after hours"),
    ))
    return access.withColumn("findings", F.array_join(finding, ", ")).filter(F.col("findings") != "")


def geo_jump(access: DataFrame, principal: str, ts: str, country: str, row_id: str, seconds: int = 3600) -> DataFrame:
    """Accesses whose country differs from the principal's previous access (by time, then id) at most ``seconds`` earlier.

    Two countries at the same instant are such a jump."""
    rows = access.select(row_id, principal, F.col(ts).alias("seen_at"), F.col(country).alias("country"))
    before = previous_within(rows, [principal], "seen_at", row_id, seconds, ["country"])
    return before.filter(F.col("country") != F.col("previous_country")).withColumnRenamed("previous_at", "previous_seen_at")


def consented(customers: DataFrame) -> DataFrame:
    return customers.filter(F.col("marketing_consent") == 1)

