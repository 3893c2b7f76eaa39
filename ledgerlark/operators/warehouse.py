"""Loading and maintaining the warehouse: keys, versions, facts, change capture."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import expr as X
from ledgerlark.operators.ranking import dense_keys

UNKNOWN_KEY = -1


# -- keys and versions ------------------------------------------------------------
def lookup_key(rows: DataFrame, dim: DataFrame, business_id: str, key: str, current: str | None = "is_current") -> DataFrame:
    """Add the surrogate key of the current version; rows without one get -1."""
    if current:
        dim = dim.filter(F.col(current))
    found = dim.select(business_id, F.col(key).alias("_key"))
    return rows.join(found, business_id, "left").withColumn(
        key, F.coalesce("_key", F.lit(UNKNOWN_KEY)).cast("bigint")).drop("_key")


def unresolved(rows: DataFrame, key: str) -> DataFrame:
    return rows.filter(F.col(key) == UNKNOWN_KEY)


def scd2_merge(dim: DataFrame, updates: DataFrame, business_id: str, key: str, tracked: Sequence[str], as_of) -> DataFrame:
    """The dimension after ``updates``: changed current rows are closed and get a new version.

    ``dim`` has (key, business id, tracked..., effective_date, expiration_date, is_current, version);
    ``updates`` has the business id, once each, and the tracked columns. Ids missing in ``updates`` stay.
    Old versions are passed through without taking part in the join.
    """
    today = F.to_date(X.ts(as_of))
    old = dim.filter(~F.col("is_current"))
    current = dim.filter("is_current").withColumn("_known", F.lit(True))
    new = updates.select(business_id, *[F.col(c).alias(f"_new_{c}") for c in tracked], F.lit(True).alias("_given"))
    both = current.join(new, business_id, "full")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in tracked])
    given, known = F.coalesce("_given", F.lit(False)), F.coalesce("_known", F.lit(False))
    replaced = given & (~known | ~same)

    fields = [business_id, *tracked]
    kept = both.filter(known).select(
        key, *fields, "effective_date",
        F.when(replaced, today).otherwise(F.col("expiration_date")).alias("expiration_date"),
        (~replaced).alias("is_current"), "version",
    )
    added = both.filter(replaced).select(
        business_id, *[F.col(f"_new_{c}").alias(c) for c in tracked], today.alias("effective_date"),
        F.lit(None).cast("date").alias("expiration_date"), F.lit(True).alias("is_current"),
        (F.coalesce("version", F.lit(0)) + 1).cast("int").alias("version"),
    )
    last = F.coalesce(dim.agg(F.max(key).alias("k")).scalar(), F.lit(0))
    columns = [key, *fields, "effective_date", "expiration_date", "is_current", "version"]
    return (
        old.select(columns)
        .unionByName(kept.select(columns))
        .unionByName(dense_keys(added, business_id, key, last).select(columns))
    )


def version_at(rows: DataFrame, dim: DataFrame, business_id: str, date: Column, columns: Sequence[str],
               key: str | None = None) -> DataFrame:
    """Join the dimension version that was valid on ``date`` (hash or sort-merge on the id, dates as residual).

    Rows without a valid version stay; their ``key`` column is -1 and their other columns are null.
    """
    versions = dim.select(F.col(business_id).alias("_id"), F.col("effective_date").alias("_from"),
                          F.col("expiration_date").alias("_to"), *columns)
    valid = (F.col("_from") <= F.col("_on")) & (F.col("_to").isNull() | (F.col("_on") < F.col("_to")))
    found = rows.withColumn("_on", date).join(versions, (F.col(business_id) == F.col("_id")) & valid, "left")
    if key:
        found = found.withColumn(key, F.coalesce(key, F.lit(UNKNOWN_KEY)).cast("bigint"))
    return found.drop("_on", "_from", "_to", "_id")


# -- fact ------------------------------------------------------------------------------
def key_at(rows: DataFrame, dim: DataFrame, business_id: str, key: str, date: Column) -> DataFrame:
    """Add the surrogate key of the version valid on ``date``; a dimension without versions gives its current row. -1 if there is none."""
    if "effective_date" in dim.columns:
        return version_at(rows, dim, business_id, date, [key], key)
    return lookup_key(rows, dim, business_id, key, "is_current" if "is_current" in dim.columns else None)


def load_fact(transactions, customers, merchants, methods, refunds, chargebacks, geography, loaded_at, products=None,
              last_key: int | None = None) -> DataFrame:
    """Transactions as fact rows, stamped ``loaded_at``. Refunds and chargebacks are summed per transaction before the join.

    Keys are those of the dimension versions valid at the payment's time, so a reload of old payments gives the keys they had.
    Every dimension key that cannot be resolved is -1; without ``products`` (product_id, product_key) there is no product key.
    With ``last_key`` rows get consecutive ``transaction_key`` after it, in order of their id.
    """
    day = F.to_date("created_at")
    back = refunds.filter("status = 'SUCCEEDED'").groupBy("transaction_id").agg(F.sum("amount").alias("refund_amount"))
    disputed = chargebacks.groupBy("transaction_id").agg(
        F.sum("amount").alias("chargeback_amount"), F.max(F.col("reason_code") == "fraudulent").alias("_fraud"))
    rows = key_at(transactions, merchants, "merchant_id", "merchant_key", day)
    rows = lookup_key(rows, methods, "payment_method_id", "payment_method_key", None)
    rows = key_at(rows, customers, "customer_id", "customer_key", day)
    rows = lookup_key(rows, geography, "nationkey", "geography_key", None)
    if products is not None:
        rows = lookup_key(rows, products, "product_id", "product_key", None)
    rows = rows.join(back, "transaction_id", "left").join(disputed, "transaction_id", "left")
    none = F.lit(0).cast("decimal(18,2)")
    loaded = rows.select(
        "transaction_id",
        X.date_key("created_at").alias("time_key"),
        "customer_key", "merchant_key", "payment_method_key",
        "geography_key",
        *([] if products is None else ["product_key"]),
        "amount", "processing_fee", "net_amount",
        F.coalesce("refund_amount", none).alias("refund_amount"),
        F.coalesce("chargeback_amount", none).alias("chargeback_amount"),
        F.col("status").isin("SUCCEEDED", "REFUNDED").alias("is_successful"),
        F.col("refund_amount").isNotNull().alias("is_refunded"),
        F.col("chargeback_amount").isNotNull().alias("is_disputed"),
        F.coalesce("_fraud", F.lit(False)).alias("is_fraudulent"),
        F.lit(1).alias("transaction_count"),
        F.col("created_at").alias("transaction_datetime"),
        X.ts(loaded_at).alias("inserted_at"),
        "updated_at",
    )
    return loaded if last_key is None else dense_keys(loaded, "transaction_id", "transaction_key", last_key)


def convert_currency(rows: DataFrame, rates: DataFrame, date: Column, target: str = "USD") -> DataFrame:
    """Amount in ``target`` at the rate valid on the day, rounded half up to cents.

    ``rates`` (currency, valid_from, valid_to exclusive, rate) is spread to one row per currency
    and day, a table bounded by the calendar, so that the big side meets it on equality. A rate whose
    end is open is valid up to the last day of ``rows``.
    """
    last = rows.agg(F.date_add(F.max(date), 1).alias("d")).scalar()
    ends = F.coalesce("valid_to", F.greatest(last, F.date_add("valid_from", 1)))
    daily = rates.filter(F.col("valid_from") < ends).select(
        "currency", "rate", F.explode(F.sequence("valid_from", F.date_sub(ends, 1), F.expr("INTERVAL 1 DAY"))).alias("_day"))
    converted = F.when(F.col("currency") == target, F.col("amount")).otherwise(
        F.round(F.col("amount") * F.col("rate"), 2).cast("decimal(18,2)"))
    return rows.withColumn("_day", date).join(daily, ["currency", "_day"], "left").withColumn(
        "converted_amount", converted).drop("_day", "rate")


# -- change capture -------------------------------------------------------------------------
OPERATIONS = {1: "DELETE", 2: "INSERT", 3: "UPDATE_BEFORE", 4: "UPDATE_AFTER"}


def changes(log: DataFrame, from_lsn=None, to_lsn=None) -> DataFrame:
    """All changes in the inclusive range; a missing bound is open."""
    if from_lsn is not None:
        log = log.filter(F.col("lsn") >= from_lsn)
    if to_lsn is not None:
        log = log.filter(F.col("lsn") <= to_lsn)
    name = F.lit(None).cast("string")
    for op, label in OPERATIONS.items():
        name = F.when(F.col("op") == op, label).otherwise(name)
    return log.withColumn("operation", name)


def log_order(log: DataFrame) -> list[str]:
    """Changes of one transaction share an LSN; ``seqval`` orders them where the log has it."""
    return [c for c in ("lsn", "seqval") if c in log.columns]


def net_changes(log: DataFrame, key: str, from_lsn=None, to_lsn=None, order: Sequence[str] | None = None) -> DataFrame:
    """One row per key with its last image. A key inserted and deleted in the range does not appear.

    First and last change come from one aggregation with map-side combine.
    """
    order = order or log_order(log)
    inside = changes(log, from_lsn, to_lsn).filter(F.col("op") != 3)
    image = [c for c in log.columns if c not in (key, "op", *order)]
    at = F.struct(*order)
    per_key = inside.groupBy(key).agg(
        F.min_by("op", at).alias("_first"), F.max_by("op", at).alias("_last"),
        F.max_by(F.struct(*order, *image), at).alias("_image"))
    kind = F.when(F.col("_last") == 1, "DELETE").when(F.col("_first") == 2, "INSERT").otherwise("UPDATE")
    return per_key.filter(~((F.col("_first") == 2) & (F.col("_last") == 1))).select(
        key, "_image.*", kind.alias("change_type"))


def apply_changes(target: DataFrame, net: DataFrame, key: str) -> DataFrame:
    """The target after upserts and deletes. Applying the same changes again changes nothing.

    Net changes are one row per key; the unchanged part of the target is an anti join.
    """
    columns = target.columns
    stay = target.join(net.select(key), key, "left_anti")
    return stay.select(columns).unionByName(net.filter("change_type <> 'DELETE'").select(columns))


def change_report(target: DataFrame, net: DataFrame, key: str) -> DataFrame:
    """How many net changes update, insert, delete or miss a row of the target."""
    known = target.select(key, F.lit(True).alias("_known"))
    action = (
        F.when((F.col("change_type") == "DELETE") & F.col("_known"), "deleted")
        .when(F.col("change_type") == "DELETE", "missing").when(F.col("_known"), "updated").otherwise("inserted"))
    return net.join(known, key, "left").groupBy(action.alias("action")).agg(F.count("*").alias("rows"))


def status_events(net: DataFrame, key: str) -> DataFrame:
    """Net changes of a payment's status as outgoing events."""
    names = {"SUCCEEDED": "charge.succeeded", "FAILED": "charge.failed", "REFUNDED": "charge.refunded",
             "PENDING": "charge.pending"}
    kind = F.lit(None).cast("string")
    for status, name in names.items():
        kind = F.when(F.col("status") == status, name).otherwise(kind)
    return net.filter("change_type <> 'DELETE'").select(
        F.concat(F.lit("evt_"), F.col("lsn").cast("string")).alias("event_id"), key, kind.alias("event_type"),
        F.lit("pending").alias("status"), F.lit(0).alias("retry_count"))


# -- keys under load ---------------------------------------------------------------------------
def salted_totals(rows: DataFrame, key: str, distinct: str, amount: str, shards: int = 10) -> DataFrame:
    """Count, sum and distinct count per key in two steps, so that a dominant key fills ``shards`` tasks.

    The shard comes from the counted column, so distinct counts of the shards add up.
    """
    shard = F.pmod(F.hash(distinct), F.lit(shards))
    partial = (
        rows.withColumn("_shard", shard)
        .groupBy(key, "_shard", distinct)
        .agg(F.count("*").alias("n"), F.sum(amount).alias("total"))
        .groupBy(key, "_shard")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.count("*").alias("values"))
    )
    return partial.groupBy(key).agg(
        F.sum("n").alias("row_count"), F.sum("total").alias("total_amount"), F.sum("values").alias("distinct_values"))


def hot_keys(rows: DataFrame, key: str, rule: float = 20.0, watch: float = 10.0) -> DataFrame:
    """Share of rows per key, marked above the rule and the earlier watch level."""
    total = rows.agg(F.count("*").alias("n")).scalar()
    return rows.groupBy(key).agg(F.count("*").alias("row_count")).withColumn(
        "share_pct", X.pct("row_count", total)).withColumn("over_rule", F.col("share_pct") > rule).withColumn(
        "over_watch", F.col("share_pct") > watch)


# -- attributes -----------------------------------------------------------------------------------
def classify_risk(customers: DataFrame, low_below: int = 33, high_from: int = 66) -> DataFrame:
    """Risk category from the 0-100 score; the cut points are ours, the levels are given."""
    s = F.col("risk_score")
    return customers.withColumn(
        "risk_category", F.when(s >= high_from, "HIGH").when(s >= low_below, "MEDIUM").otherwise("LOW"))


def segment_customers(transactions: DataFrame, as_of, vip_from: int = 2_000_000, new_days: int = 180) -> DataFrame:
    """VIP by lifetime value, New by first payment, otherwise Regular. Thresholds are parameters."""
    good = F.col("status") == "SUCCEEDED"
    return (
        transactions.filter(~F.col("is_deleted"))
        .groupBy("customer_id")
        .agg(X.sum_if(good, "amount").alias("lifetime_value"), F.min("created_at").alias("first_payment_at"))
        .withColumn(
            "customer_segment",
            F.when(F.col("lifetime_value") >= vip_from, "VIP")
            .when(F.col("first_payment_at") >= X.ago(as_of, new_days, "DAY"), "New").otherwise("Regular"))
    )


def soft_delete(table: DataFrame, keys: DataFrame, key: str, as_of) -> DataFrame:
    """Mark the rows whose key is listed; rows already deleted keep their time."""
    marked = table.join(keys.select(key).distinct().withColumn("_gone", F.lit(True)), key, "left")
    gone = F.coalesce("_gone", F.lit(False))
    return (
        marked.withColumn("deleted_at", F.when(gone & ~F.col("is_deleted"), X.ts(as_of)))
        .withColumn("is_deleted", F.col("is_deleted") | gone).drop("_gone")
    )
