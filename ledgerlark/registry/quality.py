"""Quality rules and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlark.operators import quality as Q
from ledgerlark.registry import query
from ledgerlark.registry.fixture_sql import part
from ledgerlark.registry.warehouse import loaded_fact
from ledgerlark.session import scratch
from ledgerlark.sources import tables as T
from ledgerlark.sources.driver_tables import AS_OF_ORDERS as NOW

RULE = "rule:s table_name:s failed:i total:i passed:b"


def counted(*rules: tuple[str, str, str, str]) -> str:
    """(rule, table name, failed-row predicate, source) as one result row each."""
    rows = " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{table}' AS table_name, count(*) FILTER ({bad}) AS failed, count(*) AS total FROM {source}"
        for rule, table, bad, source in rules)
    return f"SELECT *, failed = 0 AS passed FROM ({rows})"


part("x_target", "SELECT * FROM x_loaded WHERE transaction_id IN (SELECT transaction_id FROM x_transactions WHERE NOT is_deleted)")
part("x_pairs", """SELECT coalesce(s.time_key, w.time_key) AS time_key, coalesce(sr, 0) AS source_rows, coalesce(wr, 0) AS target_rows,
    coalesce(sv, 0) AS source_sum, coalesce(wv, 0) AS target_sum
  FROM (SELECT time_key, count(*) AS sr, sum(amount) AS sv FROM x_loaded GROUP BY 1) s
  FULL JOIN (SELECT time_key, count(*) AS wr, sum(amount) AS wv FROM x_target GROUP BY 1) w USING (time_key)""")


def pairs(t):
    """All payments against a warehouse that took only the live ones."""
    fact = loaded_fact(t).select("transaction_id", "time_key", "amount")
    live = t.transactions().filter("NOT is_deleted").select("transaction_id")
    return Q.reconcile(fact, fact.join(live, "transaction_id", "left_semi"), "time_key", "amount")


@query("dq_row_count_reconcile", "time_key:i source_rows:i target_rows:i rows_match:b",
       "SELECT *, source_rows = target_rows AS rows_match FROM x_pairs")
def row_count_reconcile(t):
    return pairs(t)


@query("dq_sum_reconcile", "time_key:i source_sum:d target_sum:d sums_match:b",
       "SELECT *, source_sum = target_sum AS sums_match FROM x_pairs")
def sum_reconcile(t):
    return pairs(t)


@query("dq_referential_integrity", RULE,
       counted(("customer_id resolves", "transactions", "customer_id NOT IN (SELECT customer_id FROM x_customers WHERE NOT is_deleted)",
                "x_transactions"),
               ("merchant_id resolves", "transactions", "merchant_id NOT IN (SELECT merchant_id FROM x_merchants)", "x_transactions"),
               ("subscription_id resolves", "subscription_payments",
                "subscription_id NOT IN (SELECT subscription_id FROM x_subscriptions)", "x_subpayments")))
def referential_integrity(t):
    return Q.union_results(
        Q.foreign_key(t.transactions(), "transactions", "customer_id", t.customers().filter("NOT is_deleted"), "customer_id"),
        Q.foreign_key(t.transactions(), "transactions", "merchant_id", t.merchants(), "merchant_id"),
        Q.foreign_key(t.subscription_payments(), "subscription_payments", "subscription_id", t.subscriptions(), "subscription_id"),
    )


TRANSACTION_RULES = {
    "amount positive": "amount > 0",
    "status known": "status IN ('PENDING', 'SUCCEEDED', 'FAILED', 'REFUNDED')",
    "currency has three letters": "length(currency) = 3",
    "fee below amount": "processing_fee < amount",
    "failure has a code": "status <> 'FAILED' OR failure_code IS NOT NULL",
    "not deleted": "NOT is_deleted",
}
CHECK_RULES = {
    "score in range": "risk_score BETWEEN 0 AND 100",
    "level known": "risk_level IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')",
    "action known": "action_taken IN ('APPROVED', 'REVIEW', 'BLOCKED')",
}


@query("dq_business_rules", RULE,
       counted(*[(r, "transactions", f"NOT coalesce({p}, FALSE)", "x_transactions") for r, p in TRANSACTION_RULES.items()],
               *[(r, "fraud_checks", f"NOT coalesce({p}, FALSE)", "x_checks") for r, p in CHECK_RULES.items()]))
def business_rules(t):
    return Q.union_results(Q.check_rules(t.transactions(), "transactions", TRANSACTION_RULES),
                           Q.check_rules(t.fraud_checks(), "fraud_checks", CHECK_RULES))


@query("dq_freshness", RULE,
       f"""SELECT *, failed = 0 AS passed FROM (
          SELECT 'newer than 24 h' AS rule, 'transactions' AS table_name,
            CAST(max(created_at) < TIMESTAMP '{NOW}' - INTERVAL 24 HOUR AS INT) AS failed, count(*) AS total FROM x_transactions
          UNION ALL SELECT 'newer than 24 h', 'chargebacks', CAST(max(created_at) < TIMESTAMP '{NOW}' - INTERVAL 24 HOUR AS INT),
            count(*) FROM x_chargebacks
          UNION ALL SELECT 'newer than 1 h', 'merchants', CAST(max(created_at) < TIMESTAMP '{NOW}' - INTERVAL 1 HOUR AS INT),
            count(*) FROM x_merchants)""")
def freshness(t):
    return Q.union_results(Q.freshness(t.transactions(), "transactions", "created_at", NOW),
                           Q.freshness(t.chargebacks(), "chargebacks", "created_at", NOW),
                           Q.freshness(t.merchants(), "merchants", "created_at", NOW, hours=1))


@query("dq_nulls_duplicates", RULE,
       counted(("failure_code not null", "transactions", "failure_code IS NULL", "x_transactions"),
               ("customer_id not null", "transactions", "customer_id IS NULL", "x_transactions"))
       + """ UNION ALL SELECT 'unique l_orderkey, l_linenumber', 'lineitem', count(*) FILTER (n > 1), count(*),
              count(*) FILTER (n > 1) = 0 FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
            UNION ALL SELECT 'unique transaction_id', 'transactions', count(*) FILTER (n > 1), count(*),
              count(*) FILTER (n > 1) = 0 FROM (SELECT count(*) AS n FROM x_transactions GROUP BY transaction_id)""")
def nulls_duplicates(t):
    return Q.union_results(
        Q.missing_values(t.transactions(), "transactions", ["failure_code", "customer_id"]),
        Q.duplicate_keys(t.raw("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]),
        Q.duplicate_keys(t.transactions(), "transactions", ["transaction_id"]),
    )


@query("dq_refund_cap", RULE,
       """SELECT 'refunds within amount' AS rule, 'refunds' AS table_name, count(*) FILTER (v > amount) AS failed,
            count(*) AS total, count(*) FILTER (v > amount) = 0 AS passed
          FROM (SELECT transaction_id, sum(amount) AS v FROM x_refunds GROUP BY 1) JOIN x_transactions USING (transaction_id)""")
def refund_cap(t):
    return Q.refund_cap(t.refunds(), t.transactions())


@query("dq_email_format", RULE,
       counted(("email format", "customers", "NOT email LIKE '%_@__%.__%'", "x_customers"),
               ("email format", "supplier names", "NOT business_name LIKE '%_@__%.__%'", "x_merchants")))
def email_format(t):
    return Q.union_results(Q.email_format(t.customers(), "customers"),
                           Q.email_format(t.merchants(), "supplier names", "business_name"))


@query("dq_forbidden_columns", RULE,
       counted(("no acctbal", "customer", "c_acctbal IS NOT NULL", "customer"), ("no birth_date", "customer", "FALSE", "customer"),
               ("has c_name", "customer", "c_name IS NULL", "customer"), ("has email", "customer", "TRUE", "customer"),
               ("no date_of_birth", "transactions", "FALSE", "x_transactions"),
               ("no failure_code", "transactions", "failure_code IS NOT NULL", "x_transactions"),
               ("has failure_code", "transactions", "failure_code IS NULL", "x_transactions")))
def forbidden_columns(t):
    """Rows of two tables that hold what they must not, under any spelling of the name, or lack what they must have."""
    customer = t.raw("customer").withColumnRenamed("c_acctbal", "AcctBal")
    return Q.union_results(Q.held_values(customer, "customer", ["acctbal", "birth_date"], ["c_name", "email"]),
                           Q.held_values(t.transactions(), "transactions", ["date_of_birth", "failure_code"], ["failure_code"]))


DECLARED = "c_custkey BIGINT, c_name STRING, c_nationkey BIGINT, c_phone STRING, c_acctbal DOUBLE"


@query("dq_schema_match", RULE,
       counted(("c_custkey is bigint", "customer", "FALSE", "customer"), ("c_name is string", "customer", "FALSE", "customer"),
               ("c_nationkey is bigint", "customer", "typeof(c_nationkey) <> 'BIGINT'", "customer"),
               ("c_phone is string", "customer", "TRUE", "customer"), ("c_acctbal is double", "customer", "FALSE", "customer"),
               ("c_mktsegment is declared", "customer", "TRUE", "customer")))
def schema_match(t):
    """A table against a declaration that has one column more, one less and one of another type."""
    return Q.rows_off_schema(t.raw("customer"), "customer", StructType.fromDDL(DECLARED))


@query("dq_gate", "version:i status:s rows:i amount:d",
       """SELECT 1 AS version, status, count(*) AS rows, sum(amount) AS amount FROM x_transactions
          WHERE NOT is_deleted GROUP BY status""")
def gate(t):
    """The second version holds deleted payments and fails, so readers keep the first."""
    rows = t.transactions().select("transaction_id", "status", "amount", "is_deleted")
    table = T.PublishedTable(t.spark, scratch(t.spark, "gated"))

    def rules(written):
        return Q.union_results(
            Q.check_rules(written, "transactions", {"amount positive": "amount > 0", "not deleted": "NOT is_deleted"}),
            Q.duplicate_keys(written, "transactions", ["transaction_id"]),
            Q.schema_matches(t.spark, written.schema, rows.schema, "transactions"),
            Q.forbidden_columns(t.spark, written.schema, "transactions", required=()),
        )

    table.publish(rows.filter("NOT is_deleted"), gate=rules)
    table.publish(rows, gate=rules)
    return table.read().groupBy("status").agg(F.count("*").alias("rows"), F.sum("amount").alias("amount")).withColumn(
        "version", F.lit(table.version))


SUMMARY = """SELECT 'transactions' AS table_name, count(*) AS row_count, max(created_at) AS latest FROM x_transactions
  UNION ALL SELECT 'customers', count(*), max(created_at) FROM x_customers
  UNION ALL SELECT 'merchants', count(*), max(created_at) FROM x_merchants"""


def tables(t):
    return {"transactions": (t.transactions(), "created_at"), "customers": (t.customers(), "created_at"),
            "merchants": (t.merchants(), "created_at")}


@query("union_reconcile", "table_name:s row_count:i latest:t", SUMMARY)
def union_reconcile(t):
    return Q.table_summary(tables(t))


@query("restore_validate", "table_name:s row_count:i expected_rows:i passed:b",
       """SELECT b.table_name, coalesce(r.n, b.row_count) AS row_count, b.row_count AS expected_rows,
            r.n IS NULL OR r.n = b.row_count AND r.latest = b.latest AS passed
          FROM (""" + SUMMARY + """) b LEFT JOIN (SELECT 'customers' AS table_name, count(*) AS n, max(created_at) AS latest
            FROM x_customers WHERE NOT is_deleted) r USING (table_name)""")
def restore_validate(t):
    """The restored customers lack the deleted ones."""
    restored = {**tables(t), "customers": (t.customers().filter("NOT is_deleted"), "created_at")}
    return Q.validate_restore(restored, Q.table_summary(tables(t)))


@query("set_difference", "merchant_id:i currency:s",
       """SELECT merchant_id, currency FROM x_transactions
          EXCEPT ALL SELECT merchant_id, currency FROM x_transactions WHERE status = 'SUCCEEDED'""")
def set_difference(t):
    rows = t.transactions()
    return Q.missing_rows(rows.select("merchant_id", "currency"),
                          rows.filter("status = 'SUCCEEDED'").select("merchant_id", "currency"))
