"""The payment model over the given parquet tables.

Every payment table is a projection of one or two of the given tables; nothing is
sampled. Row-level properties (deleted, disputed, refunded ...) come from ordinary
attributes of the source row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions import expr as X
from ledgerlark.session import configure

AS_OF_ORDERS = "2001-08-02 00:00:00"
AS_OF_EVENTS = "2024-01-31 00:00:00"
# Inserts come first in the change log, then updates, then deletes.
LSN_STEP = 10**12
SUBSCRIBER_SEGMENTS = ("BUILDING", "MACHINERY", "HOUSEHOLD")


class PaymentTables:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = configure(spark)
        self.path = path

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    # -- dimensions -------------------------------------------------------
    def merchants(self) -> DataFrame:
        return self.raw("supplier").selectExpr(
            "s_suppkey AS merchant_id",
            "s_suppkey AS merchant_key",
            "s_name AS business_name",
            "concat('m', CAST(s_suppkey AS STRING), '@example.com') AS email",
            "s_nationkey AS nationkey",
            "CASE s_suppkey % 5 WHEN 0 THEN 'Electronics' WHEN 1 THEN 'Clothing' "
            "WHEN 2 THEN 'Food & Beverage' WHEN 3 THEN 'travel' ELSE 'gambling' END AS industry",
            "CASE s_suppkey % 10 WHEN 3 THEN 'Leisure' WHEN 4 THEN 'Leisure' ELSE 'Retail' END AS industry_group",
            "CASE WHEN s_acctbal < 3000 THEN 'STARTUP' WHEN s_acctbal < 7000 THEN 'SMB' "
            "ELSE 'ENTERPRISE' END AS merchant_tier",
            "TIMESTAMP '1994-06-01 00:00:00' + (s_suppkey % 200) * INTERVAL '1' DAY AS created_at",
            "s_acctbal < -800 AS is_deleted",
            "true AS is_current",
        )

    def customers(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey AS customer_id",
            "c_custkey AS customer_key",
            "c_name AS full_name",
            "split_part(c_name, '#', 1) AS first_name",
            "split_part(c_name, '#', 2) AS last_name",
            "concat('+44 20 ', lpad(CAST(c_custkey AS STRING), 8, '0')) AS phone",
            "concat('c', CAST(c_custkey AS STRING), CASE c_custkey % 4 WHEN 0 THEN '@gmail.com' "
            "WHEN 1 THEN '@tempmail.com' ELSE '@example.com' END) AS email",
            "c_nationkey AS nationkey",
            "c_mktsegment AS customer_segment",
            "CAST(c_custkey % 101 AS DECIMAL(5,2)) AS risk_score",
            "TIMESTAMP '1994-01-01 00:00:00' + (c_custkey % 365) * INTERVAL '1' DAY AS created_at",
            "c_acctbal < -900 AS is_deleted",
            "true AS is_current",
        )

    def geography(self) -> DataFrame:
        return (
            self.raw("nation")
            .join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr(
                "n_nationkey AS geography_key",
                "n_name AS country_name",
                "r_name AS region",
                "r_name AS continent",
                "CASE n_nationkey % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' ELSE 'GBP' END AS currency_code",
            )
        )

    def payment_methods(self) -> DataFrame:
        """Methods are dealt out to customers in blocks of three."""
        return self.raw("part").selectExpr(
            "p_partkey AS payment_method_id",
            "p_partkey AS payment_method_key",
            "CASE p_size % 3 WHEN 0 THEN 'CARD' WHEN 1 THEN 'SEPA' ELSE 'WALLET' END AS type",
            "CASE WHEN p_size % 3 = 0 THEN p_brand END AS card_brand",
            "p_size % 3 = 2 AS is_digital_wallet",
            "lpad(CAST(p_partkey % 10000 AS STRING), 4, '0') AS last4",
            "CAST(1 + p_partkey % 12 AS INT) AS exp_month",
            "CAST(2002 + p_partkey % 6 AS INT) AS exp_year",
            "p_partkey DIV 3 AS customer_id",
            "p_size > 25 AS is_default",
            "p_retailprice >= 905 AS is_active",
            "TIMESTAMP '2001-01-01 00:00:00' + (p_partkey % 200) * INTERVAL '1' DAY AS created_at",
        )

    def products(self) -> DataFrame:
        """The two fee products; the fact's product key is 1 or 2."""
        return self.spark.createDataFrame(
            [(1, "Card payments", "payments"), (2, "Billing", "subscriptions")],
            "product_key int, product_name string, product_category string",
        )

    # -- operational tables -----------------------------------------------
    def transactions(self) -> DataFrame:
        n_merchants = self.raw("supplier").agg(F.count("*").alias("n")).scalar()
        n_methods = self.raw("part").agg(F.count("*").alias("n")).scalar()
        o = self.raw("orders")
        return (
            o.withColumn("amount", F.col("o_totalprice").cast("decimal(18,2)"))
            .withColumn("merchant_id", F.col("o_orderkey") % n_merchants)
            .withColumn("payment_method_id", (F.col("o_orderkey") * 7 + F.col("o_custkey")) % n_methods)
            .selectExpr(
                "o_orderkey AS transaction_id",
                "o_custkey AS customer_id",
                "merchant_id",
                "payment_method_id",
                "amount",
                "CASE o_custkey % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' ELSE 'GBP' END AS currency",
                "CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'REFUNDED' "
                "WHEN o_orderstatus = 'F' THEN 'SUCCEEDED' WHEN o_orderstatus = 'O' THEN 'FAILED' "
                "ELSE 'PENDING' END AS status",
                "concat('pi_', CAST(o_orderkey AS STRING)) AS payment_intent_id",
                "CAST(o_orderkey % 25 AS INT) AS nationkey",
                "CASE WHEN o_orderstatus = 'O' THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'insufficient_funds' "
                "WHEN '2-HIGH' THEN 'card_declined' ELSE 'processing_error' END END AS failure_code",
                "CASE WHEN o_orderstatus = 'O' THEN concat('refused: ', o_orderpriority) END AS failure_message",
                "CAST(o_orderdate AS TIMESTAMP) + (o_orderkey % 86400) * INTERVAL '1' SECOND AS created_at",
                "CAST(o_orderdate AS TIMESTAMP) + (o_orderkey % 86400) * INTERVAL '1' SECOND "
                "+ (o_orderkey % 997) * INTERVAL '0.001' SECOND AS updated_at",
                "CAST(round(amount * CAST(0.0290 AS DECIMAL(5,4)), 2) AS DECIMAL(18,2)) AS processing_fee",
                "o_totalprice < 5000 AS is_deleted",
            )
            .withColumn("net_amount", (F.col("amount") - F.col("processing_fee")).cast("decimal(18,2)"))
        )

    def fraud_checks(self) -> DataFrame:
        """Orders without a priority were never checked, so left joins matter."""
        score = "o_orderkey * 13 % 101"
        return self.raw("orders").filter("o_orderpriority <> '4-NOT SPECIFIED'").selectExpr(
            "o_orderkey AS transaction_id",
            f"CAST({score} AS DECIMAL(5,2)) AS risk_score",
            f"CASE WHEN {score} >= 95 THEN 'CRITICAL' WHEN {score} >= 70 THEN 'HIGH' "
            f"WHEN {score} >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level",
            f"{score} >= 70 AS is_flagged",
            f"CASE WHEN {score} >= 95 THEN 'BLOCKED' WHEN {score} >= 70 THEN 'REVIEW' ELSE 'APPROVED' END "
            "AS action_taken",
            "CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_orderdate AS TIMESTAMP) END AS reviewed_at",
        )

    def chargebacks(self) -> DataFrame:
        """Urgent, fulfilled orders above 300,000 were disputed."""
        return self.raw("orders").filter(
            "o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice > 300000"
        ).selectExpr(
            "o_orderkey AS chargeback_id",
            "o_orderkey AS transaction_id",
            "CAST(o_totalprice AS DECIMAL(18,2)) AS amount",
            "CASE o_orderkey % 3 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'WON' ELSE 'LOST' END AS status",
            "CASE o_orderkey % 2 WHEN 0 THEN 'fraudulent' ELSE 'product_not_received' END AS reason_code",
            "CAST(o_orderdate AS TIMESTAMP) + INTERVAL 30 DAYS AS evidence_due_date",
            "CAST(o_orderdate AS TIMESTAMP) + INTERVAL 10 DAYS AS created_at",
        )

    def refunds(self) -> DataFrame:
        """Fulfilled low-priority orders were refunded, half or in full."""
        return self.raw("orders").filter("o_orderstatus = 'F' AND o_orderpriority = '5-LOW'").selectExpr(
            "o_orderkey AS refund_id",
            "o_orderkey AS transaction_id",
            "CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1.0 "
            "ELSE 0.5 END AS DECIMAL(3,1)), 2) AS DECIMAL(18,2)) AS amount",
            "CASE o_orderkey % 3 WHEN 0 THEN 'REQUESTED_BY_CUSTOMER' WHEN 1 THEN 'FRAUDULENT' "
            "ELSE 'DUPLICATE' END AS reason",
            "CASE WHEN o_totalprice > 400000 THEN 'PENDING' ELSE 'SUCCEEDED' END AS status",
            "CAST(o_orderdate AS TIMESTAMP) + INTERVAL 5 DAYS + (o_orderkey % 1440) * INTERVAL '1' MINUTE AS created_at",
        )

    def subscriptions(self) -> DataFrame:
        n_merchants = self.raw("supplier").agg(F.count("*").alias("n")).scalar()
        return (
            self.raw("customer")
            .filter(F.col("c_mktsegment").isin(*SUBSCRIBER_SEGMENTS))
            .withColumn("merchant_id", F.col("c_custkey") % n_merchants)
            .selectExpr(
                "c_custkey AS subscription_id",
                "merchant_id",
                "c_custkey AS customer_id",
                "concat('plan_', lower(c_mktsegment)) AS plan_name",
                "CAST(5 + c_custkey % 95 AS DECIMAL(18,2)) AS amount",
                "CASE WHEN c_acctbal < 0 THEN 'CANCELED' WHEN c_acctbal < 1000 THEN 'PAUSED' ELSE 'ACTIVE' END AS status",
                "TIMESTAMP '2000-01-01 00:00:00' + (c_custkey % 365) * INTERVAL '1' DAY AS created_at",
                "TIMESTAMP '2001-08-02 00:00:00' + (c_custkey % 30) * INTERVAL '1' DAY AS current_period_end",
                "CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2001-01-01 00:00:00' + "
                "(c_custkey % 200) * INTERVAL '1' DAY END AS canceled_at",
                "c_acctbal > 9000 AS cancel_at_period_end",
            )
        )

    def subscription_payments(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS subscription_payment_id",
            "o_custkey AS subscription_id",
            "CASE WHEN o_orderstatus = 'O' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status",
            "CAST(1 + o_orderkey % 5 AS INT) AS attempt_count",
            "CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 3 DAYS END AS next_retry_at",
        )

    # -- warehouse ---------------------------------------------------------
    def sales(self) -> DataFrame:
        """The fact without its geography, which alone needs the customer table."""
        return self._lines(self.raw("orders"))

    def fact(self) -> DataFrame:
        """One row per order line. Orders meet their customers before their lines, so that lines are shuffled once."""
        orders = self.raw("orders").join(self.raw("customer"), F.col("o_custkey") == F.col("c_custkey"))
        return self._lines(orders, "c_nationkey AS geography_key")

    def _lines(self, orders: DataFrame, *extra: str) -> DataFrame:
        """Lines are cut to what the fact needs before they are shuffled."""
        lines = self.raw("lineitem").selectExpr(
            "l_orderkey", "l_suppkey", "l_partkey", "CAST(l_linenumber % 2 + 1 AS INT) AS product_key",
            "CAST(l_extendedprice AS DECIMAL(18,2)) AS amount", "l_linestatus = 'F' AS is_successful", "l_returnflag = 'R' AS is_refunded",
            "l_discount >= 0.1 AS is_disputed", "l_tax >= 0.08 AS is_fraudulent")
        return (
            lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .withColumn("time_key", X.date_key("o_orderdate"))
            .selectExpr(
                "l_orderkey AS transaction_id",
                "time_key",
                "o_custkey AS customer_key",
                "l_suppkey AS merchant_key",
                "l_partkey AS payment_method_key",
                *extra,
                "product_key",
                "amount",
                "CAST(round(amount * CAST(0.0290 AS DECIMAL(5,4)), 2) AS DECIMAL(18,2)) AS processing_fee",
                "is_successful",
                "is_refunded",
                "is_disputed",
                "is_fraudulent",
                "CAST(o_orderdate AS TIMESTAMP) + (l_orderkey * 37 % 86400) * INTERVAL '1' SECOND "
                "AS transaction_datetime",
            )
            .withColumn("net_amount", (F.col("amount") - F.col("processing_fee")).cast("decimal(18,2)"))
        )

    def change_log(self) -> DataFrame:
        """Insert per order, update for settled orders, delete for orders below 50,000."""
        o = self.raw("orders")
        settled = o.filter("o_orderstatus = 'F'")

        def part(df, step, op, status):
            return df.selectExpr(
                "o_orderkey AS payment_id",
                f"{step} * {LSN_STEP} + o_orderkey AS lsn",
                f"{op} AS op",
                f"'{status}' AS status",
                "CAST(o_totalprice AS DECIMAL(18,2)) AS amount",
            )

        return (
            part(o, 1, 2, "PENDING")
            .unionByName(part(settled, 2, 3, "PENDING"))
            .unionByName(part(settled, 3, 4, "SUCCEEDED"))
            .unionByName(part(o.filter("o_totalprice < 50000"), 4, 1, "SUCCEEDED"))
        )

    # -- documents and streams ----------------------------------------------
    def events(self) -> DataFrame:
        return self.raw("events").withColumn("ts", F.col("ts").cast("timestamp"))

    def api_logs(self) -> DataFrame:
        """Latency is the event value in whole hundredths, the body carries the event's JSON."""
        return self.events().selectExpr(*API_LOG_COLUMNS)

    def webhooks(self) -> DataFrame:
        return self.events().selectExpr(
            "event_id AS webhook_id",
            "user_id AS merchant_id",
            "concat('charge.', event_type) AS event_type",
            "ts AS created_at",
            "CASE WHEN event_id % 10 < 6 THEN 'sent' WHEN event_id % 10 < 8 THEN 'failed' "
            "WHEN event_id % 10 = 8 THEN 'pending' ELSE 'cancelled' END AS status",
            "CAST(event_id % 6 AS INT) AS retry_count",
            "CAST(round(value * 100) AS BIGINT) AS response_time_ms",
            "CASE WHEN event_id % 10 < 6 THEN ts + (event_id % 120) * INTERVAL '1' SECOND END AS delivered_at",
            "CASE WHEN event_id % 10 IN (6, 7) THEN ts + "
            "CAST(60 * power(2, event_id % 6) AS INT) * INTERVAL '1' SECOND END AS next_retry_at",
        )

    def payments(self) -> DataFrame:
        """Dense payment stream for the fraud features; amounts in minor units."""
        return self.events().selectExpr(*PAYMENT_COLUMNS)

    def disputes(self) -> DataFrame:
        """Signups above 100 were disputed two days later."""
        return self.events().filter("event_type = 'signup' AND value > 100").selectExpr(
            "event_id AS payment_id",
            "ts + INTERVAL 2 DAYS AS opened_at",
            "CASE event_id % 2 WHEN 0 THEN 'fraudulent' ELSE 'product_not_received' END AS reason",
        )

    def snapshots(self) -> DataFrame:
        """Risk profile versions of a customer: one per signup event."""
        return self.events().filter("event_type = 'signup'").selectExpr(
            "user_id AS customer_id", "ts AS computed_at", "CAST(round(value * 100) AS BIGINT) AS profile_score"
        )


# Shared by the batch view and the stream over the same files.
API_LOG_COLUMNS = (
    "event_id AS log_id",
    "user_id AS merchant_id",
    "ts",
    "concat('/v1/', event_type) AS endpoint",
    "CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 402 ELSE 200 END AS status_code",
    "CAST(round(value * 100) AS BIGINT) AS latency_ms",
    "concat('{\"payment\":\"pi_', CAST(event_id AS STRING), '\",\"props\":', props, '}') AS request_body",
)

PAYMENT_COLUMNS = (
    "event_id AS payment_id",
    "user_id AS customer_id",
    "event_id % 20 AS merchant_id",
    "event_type AS payment_method",
    "CAST(round(value * 100) AS BIGINT) AS amount_minor",
    "CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status",
    "ts",
    "CASE CAST(floor(value) AS BIGINT) % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'FR' ELSE 'GB' END AS ip_country",
    "CASE user_id % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'FR' ELSE 'GB' END AS card_country",
    "CASE user_id % 3 WHEN 0 THEN 'US' ELSE 'FR' END AS billing_country",
    "concat('fp_', CAST(user_id AS STRING), '_', CAST(event_id % 4 AS STRING)) AS device_fingerprint",
    "concat('u', CAST(user_id AS STRING), CASE user_id % 4 WHEN 0 THEN '@gmail.com' "
    "WHEN 1 THEN '@tempmail.com' ELSE '@example.com' END) AS email",
    "concat('Mozilla/5.0 Chrome/', CAST(90 + event_id % 60 AS STRING), '.0') AS user_agent",
    "props AS shipping_address",
    "CASE WHEN event_type = 'view' THEN '{}' ELSE props END AS billing_address",
)
