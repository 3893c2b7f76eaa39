"""Declared schemas and the constraints that come with them.

Fixed values: column names and types of the data model. Spark does not enforce constraints, so
keys, required columns and enumerations are lists that ``operators.quality`` checks.
"""

from __future__ import annotations

MONEY, SCORE, RATE = "DECIMAL(18,2)", "DECIMAL(5,2)", "DECIMAL(5,4)"

TABLES = {
    # operational
    "customers": f"customer_id BIGINT, email STRING, first_name STRING, last_name STRING, phone STRING, country_code STRING, "
                 f"is_verified BOOLEAN, risk_score {SCORE}, created_at TIMESTAMP, updated_at TIMESTAMP, is_deleted BOOLEAN",
    "merchants": "merchant_id BIGINT, business_name STRING, legal_name STRING, email STRING, phone STRING, country_code STRING, "
                 "industry STRING, mcc_code STRING, is_active BOOLEAN, kyc_status STRING, created_at TIMESTAMP, "
                 "updated_at TIMESTAMP, is_deleted BOOLEAN",
    "payment_methods": "payment_method_id BIGINT, customer_id BIGINT, type STRING, card_brand STRING, last4 STRING, "
                       "exp_month SMALLINT, exp_year SMALLINT, token STRING, is_default BOOLEAN, is_active BOOLEAN, "
                       "created_at TIMESTAMP, updated_at TIMESTAMP, is_deleted BOOLEAN",
    "transactions": f"transaction_id BIGINT, merchant_id BIGINT, customer_id BIGINT, payment_method_id BIGINT, amount {MONEY}, "
                    f"currency STRING, status STRING, payment_intent_id STRING, description STRING, ip_address STRING, "
                    f"user_agent STRING, device_type STRING, country_code STRING, failure_code STRING, failure_message STRING, "
                    f"processing_fee {MONEY}, net_amount {MONEY}, created_at TIMESTAMP, updated_at TIMESTAMP, is_deleted BOOLEAN",
    "refunds": f"refund_id BIGINT, transaction_id BIGINT, amount {MONEY}, currency STRING, reason STRING, status STRING, "
               f"description STRING, created_at TIMESTAMP, processed_at TIMESTAMP, is_deleted BOOLEAN",
    "chargebacks": f"chargeback_id BIGINT, transaction_id BIGINT, amount {MONEY}, currency STRING, reason_code STRING, "
                   f"reason_description STRING, status STRING, evidence_due_date TIMESTAMP, resolved_at TIMESTAMP, "
                   f"created_at TIMESTAMP, is_deleted BOOLEAN",
    "fraud_checks": f"fraud_check_id BIGINT, transaction_id BIGINT, risk_score {SCORE}, risk_level STRING, is_flagged BOOLEAN, "
                    f"ml_model_version STRING, factors STRING, action_taken STRING, reviewed_by STRING, reviewed_at TIMESTAMP, "
                    f"created_at TIMESTAMP",
    "subscriptions": f"subscription_id BIGINT, merchant_id BIGINT, customer_id BIGINT, payment_method_id BIGINT, plan_name STRING, "
                     f"amount {MONEY}, currency STRING, interval STRING, interval_count INT, status STRING, "
                     f"current_period_start TIMESTAMP, current_period_end TIMESTAMP, cancel_at_period_end BOOLEAN, "
                     f"canceled_at TIMESTAMP, created_at TIMESTAMP, updated_at TIMESTAMP, is_deleted BOOLEAN",
    "subscription_payments": f"subscription_payment_id BIGINT, subscription_id BIGINT, transaction_id BIGINT, amount {MONEY}, "
                             f"currency STRING, status STRING, attempt_count INT, next_retry_at TIMESTAMP, failure_reason STRING, "
                             f"period_start TIMESTAMP, period_end TIMESTAMP, created_at TIMESTAMP, processed_at TIMESTAMP",
    # star schema
    "dim_time": "time_key INT, full_date DATE, year SMALLINT, quarter SMALLINT, month SMALLINT, month_name STRING, "
                "week_of_year SMALLINT, day_of_month SMALLINT, day_of_week SMALLINT, day_name STRING, is_weekend BOOLEAN, "
                "is_holiday BOOLEAN, fiscal_year SMALLINT, fiscal_quarter SMALLINT, fiscal_period SMALLINT",
    "dim_customer": f"customer_key INT, customer_id BIGINT, email STRING, first_name STRING, last_name STRING, full_name STRING, "
                    f"country_code STRING, country_name STRING, risk_score {SCORE}, risk_category STRING, is_verified BOOLEAN, "
                    f"customer_segment STRING, lifetime_value {MONEY}, effective_date DATE, expiration_date DATE, "
                    f"is_current BOOLEAN, version INT",
    "dim_merchant": "merchant_key INT, merchant_id BIGINT, business_name STRING, legal_name STRING, email STRING, "
                    "country_code STRING, country_name STRING, industry STRING, industry_group STRING, mcc_code STRING, "
                    "mcc_description STRING, is_active BOOLEAN, kyc_status STRING, merchant_tier STRING, effective_date DATE, "
                    "expiration_date DATE, is_current BOOLEAN, version INT",
    "dim_payment_method": f"payment_method_key INT, payment_method_id BIGINT, type STRING, type_description STRING, "
                          f"card_brand STRING, card_brand_category STRING, card_type STRING, issuing_bank STRING, "
                          f"issuing_country STRING, is_digital_wallet BOOLEAN, processing_cost_pct {RATE}",
    "dim_geography": f"geography_key INT, country_code STRING, country_name STRING, region STRING, sub_region STRING, "
                     f"continent STRING, currency_code STRING, currency_name STRING, timezone STRING, gdp_per_capita {MONEY}, "
                     f"population BIGINT, internet_penetration {SCORE}, is_gdpr_country BOOLEAN, is_high_risk BOOLEAN",
    "dim_product": f"product_key INT, product_code STRING, product_name STRING, product_category STRING, product_family STRING, "
                   f"pricing_model STRING, base_fee {MONEY}, percentage_fee {RATE}, is_active BOOLEAN",
    "fact_transactions": f"transaction_key BIGINT, transaction_id BIGINT, time_key INT, customer_key INT, merchant_key INT, "
                         f"payment_method_key INT, geography_key INT, product_key INT, amount {MONEY}, processing_fee {MONEY}, "
                         f"net_amount {MONEY}, refund_amount {MONEY}, chargeback_amount {MONEY}, is_successful BOOLEAN, "
                         f"is_refunded BOOLEAN, is_disputed BOOLEAN, is_fraudulent BOOLEAN, transaction_count INT, "
                         f"transaction_datetime TIMESTAMP, inserted_at TIMESTAMP, updated_at TIMESTAMP",
    # control
    "payment_changes": f"lsn BINARY, seqval BINARY, op INT, update_mask BINARY, payment_id BIGINT, customer_id BIGINT, "
                       f"merchant_id BIGINT, amount {MONEY}, currency STRING, status STRING, payment_method STRING, "
                       f"created_at TIMESTAMP, updated_at TIMESTAMP",
}

# A missing field and a JSON null are both NULL.
DOCUMENTS = {
    "api_logs": "log_id STRING, merchant_id STRING, timestamp TIMESTAMP, endpoint STRING, method STRING, status_code INT, "
                "latency_ms INT, request_body VARIANT, response_body VARIANT, user_agent STRING, ip_address STRING, "
                "error_message STRING, ttl INT",
    "user_sessions": "session_id STRING, user_id STRING, session_start TIMESTAMP, session_end TIMESTAMP, last_activity TIMESTAMP, "
                     "duration_seconds INT, device_type STRING, browser STRING, os STRING, country STRING, "
                     "events ARRAY<STRUCT<timestamp: TIMESTAMP, event_type: STRING, page: STRING, details: VARIANT>>, "
                     "page_views ARRAY<STRUCT<page: STRING, count: INT, total_time_seconds: INT>>, actions_count INT, ttl INT",
    "fraud_features": "feature_id STRING, payment_id STRING, merchant_id STRING, customer_id STRING, computed_at TIMESTAMP, "
                      "fraud_score DOUBLE, risk_level STRING, features STRUCT<transaction_velocity_1h: INT, "
                      "transaction_velocity_24h: INT, avg_transaction_amount_30d: DOUBLE, transaction_amount_stddev_30d: DOUBLE, "
                      "card_country_mismatch: BOOLEAN, ip_country_mismatch: BOOLEAN, first_transaction_customer: BOOLEAN, "
                      "merchant_dispute_rate_30d: DOUBLE, customer_dispute_history: INT, "
                      "time_since_last_transaction_seconds: INT, device_fingerprint_new: BOOLEAN, email_domain_age_days: INT>, "
                      "raw_features STRUCT<ip_address: STRING, device_fingerprint: STRING, billing_address_hash: STRING, "
                      "shipping_address_hash: STRING, card_bin: STRING>, model_version STRING, ttl INT",
    "webhook_events": "webhook_id STRING, merchant_id STRING, event_type STRING, event_id STRING, created_at TIMESTAMP, "
                      "status STRING, webhook_url STRING, payload VARIANT, retry_count INT, last_retry_at TIMESTAMP, "
                      "next_retry_at TIMESTAMP, response_status_code INT, response_time_ms INT, error_message STRING, "
                      "delivered_at TIMESTAMP, ttl INT",
}

UNIQUE = {
    "customers": ["email"], "transactions": ["payment_intent_id"], "fraud_checks": ["transaction_id"],
    "dim_time": ["time_key"], "fact_transactions": ["transaction_id"],
}

RULES = {
    "customers": {"score in range": "risk_score BETWEEN 0 AND 100", "country has two letters": "length(country_code) = 2"},
    "payment_methods": {"type known": "type IN ('CARD', 'SEPA', 'WALLET')",
                        "month in year": "exp_month IS NULL OR exp_month BETWEEN 1 AND 12"},
    "transactions": {"amount positive": "amount > 0", "currency has three letters": "length(currency) = 3",
                     "status known": "status IN ('PENDING', 'SUCCEEDED', 'FAILED', 'REFUNDED')"},
    "refunds": {"amount positive": "amount > 0",
                "reason known": "reason IN ('DUPLICATE', 'FRAUDULENT', 'REQUESTED_BY_CUSTOMER')",
                "status known": "status IN ('PENDING', 'SUCCEEDED', 'FAILED')"},
    "merchants": {"kyc status known": "kyc_status IN ('PENDING', 'VERIFIED', 'REJECTED')"},
    "subscriptions": {"amount positive": "amount > 0", "status known": "status IN ('ACTIVE', 'PAUSED', 'CANCELED')"},
    "chargebacks": {"amount positive": "amount > 0", "status known": "status IN ('OPEN', 'WON', 'LOST')"},
    "fraud_checks": {"score in range": "risk_score BETWEEN 0 AND 100",
                     "level known": "risk_level IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')",
                     "action known": "action_taken IS NULL OR action_taken IN ('APPROVED', 'REVIEW', 'BLOCKED')"},
}
