"""The 45 fraud features of a payment, point in time, for whole tables.

Every feature sees only what was known strictly before the payment's instant. The customer's
history is one pass over the payments with their expiries (see ``timeslice``): counts, sums,
distinct counts, disputes and the previous payment come from the same running aggregation.
Amounts enter in minor units and leave in major units.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import expr as X
from ledgerlark.operators.timeslice import (
    HOT_ROWS, distinct_deltas, look_back, micros, no_busy_keys, rolling_max, rolling_rank, running_before, with_expiries,
)

HOUR, DAY = 3600, 86400
WEEK, MONTH = 7 * DAY, 30 * DAY

# The model's vector order.
FEATURES = (
    "transaction_count_1h", "transaction_count_24h", "transaction_count_7d", "transaction_count_30d", "unique_cards_30d",
    "unique_merchants_30d", "avg_amount_7d", "stddev_amount_7d", "max_amount_30d", "amount_ratio_to_avg", "amount_zscore",
    "round_amount", "high_value_flag", "amount_percentile", "card_country_mismatch", "ip_country_mismatch", "distance_km",
    "velocity_km_per_hour", "high_risk_country", "country_change_24h", "timezone_anomaly", "device_fingerprint_age_days",
    "device_fingerprint_new", "email_domain_age_days", "email_domain_free", "email_domain_disposable",
    "browser_version_outdated", "customer_age_days", "first_transaction_customer", "customer_dispute_history",
    "customer_success_rate", "days_since_last_transaction", "customer_lifetime_value", "avg_transaction_per_month",
    "chargeback_rate_30d", "merchant_age_days", "merchant_dispute_rate_30d", "merchant_chargeback_rate",
    "merchant_avg_ticket", "merchant_industry_risk", "time_of_day", "day_of_week", "is_weekend", "is_holiday",
    "shipping_address_mismatch",
)

# E-mail domains and industries the rules name.
FREE_DOMAINS = ("gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com")
DISPOSABLE_DOMAINS = ("tempmail.com", "10minutemail.com", "guerrillamail.com")
HIGH_RISK_INDUSTRIES = ("gambling", "cryptocurrency", "adult_content")
MEDIUM_RISK_INDUSTRIES = ("travel", "electronics", "jewelry")


@dataclass(frozen=True)
class Rules:
    high_value_minor: int = 1_000_000
    high_risk_countries: Sequence[str] = ()
    holidays: Sequence[str] = ()
    rare_hour_share: float = 0.05
    min_browser_version: int = 0
    default_domain_age: int = 365
    domain_ages: dict = field(default_factory=dict)
    # country -> (latitude, longitude)
    places: dict = field(default_factory=dict)


def _flag(p: Column) -> Column:
    return F.coalesce(p.cast("int"), F.lit(0))


def _days(from_us: Column, to_us: Column) -> Column:
    return F.floor((to_us - from_us) / F.lit(DAY * 1_000_000))


def _dispute_steps(payments: DataFrame, disputes: DataFrame, key: str) -> DataFrame:
    """Changes in the number of disputes of ``key``, of its disputed payments, and of those of the last 30 days.

    A payment counts as disputed from its first dispute on, however many follow."""
    opened = micros("opened_at")
    per_payment = disputes.groupBy("payment_id").agg(F.min(opened).alias("_first"), F.collect_list(opened).alias("_opened"))
    d = per_payment.join(payments.select("payment_id", key, micros("ts").alias("_paid")), "payment_id")
    ends = f"_paid + {MONTH * 1_000_000}"
    return d.selectExpr(key, f"""inline(filter(concat(
        transform(_opened, o -> named_struct('_us', o, '_what', 'disputes', '_delta', 1L)), array(
        named_struct('_us', _first, '_what', 'disputed_all', '_delta', 1L),
        CASE WHEN _first < {ends} THEN named_struct('_us', _first, '_what', 'disputed_30d', '_delta', 1L) END,
        CASE WHEN _first < {ends} THEN named_struct('_us', {ends}, '_what', 'disputed_30d', '_delta', -1L) END)),
        step -> step IS NOT NULL))""")


def _position(payments: DataFrame) -> list[str]:
    """The columns of a payment's place, where its address was located."""
    return [c for c in ("latitude", "longitude") if c in payments.columns]


def customer_state(payments: DataFrame, disputes: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Payments with the customer's raw counters just before them, in columns ``s_*``.

    The pass moves ids and numbers only; the rest of the payment is joined back on its id.
    """
    # A payment adds up to five rows (itself and four expiries).
    if hot_rows and no_busy_keys(payments, ["customer_id"], hot_rows // 5):
        hot_rows = None
    p = payments.withColumns({
        "_t": micros("ts"), "_good": F.col("status") == "SUCCEEDED", "_hour": F.hour("ts"),
        "_seen": F.struct(micros("ts").alias("us"), "payment_id", F.col("ip_country").alias("country"), *_position(payments)),
    })
    stream = with_expiries(p, "_t", [HOUR, DAY, WEEK, MONTH], ["customer_id", "amount_minor", "_good"],
                           ["payment_id", "_hour", "_seen"])
    counts = {"cards_30d": ("payment_method", MONTH), "merchants_30d": ("merchant_id", MONTH),
              "countries_24h": ("ip_country", DAY)}
    for name, (value, length) in counts.items():
        deltas = distinct_deltas(p, ["customer_id"], value, "_t", length, hot_rows)
        stream = stream.unionByName(deltas.withColumn("_what", F.lit(name)), allowMissingColumns=True)
    stream = stream.unionByName(_dispute_steps(payments, disputes, "customer_id"), allowMissingColumns=True)
    found = running_before(stream, ["customer_id"], "_us", {f"s_{m}": e for m, e in customer_measures().items()},
                           {"s_last": "_seen"}, hot_rows=hot_rows)
    state = found.filter("_after = 0").select("payment_id", "_us", *[c for c in found.columns if c.startswith("s_")])
    return payments.join(state, "payment_id")


def customer_measures() -> dict[str, str]:
    """Running sums that make up the customer's state."""
    good, square = "CASE WHEN _good THEN 1L END", "CASE WHEN _good THEN CAST(CAST(amount_minor AS DECIMAL(19,0)) * amount_minor AS DECIMAL(38,0)) END"
    paid = "CASE WHEN _good THEN amount_minor END"
    measures = {
        "n_1h": look_back("1L", HOUR), "n_24h": look_back("1L", DAY), "n_7d": look_back("1L", WEEK),
        "n_30d": look_back("1L", MONTH), "n_all": look_back("1L", None), "ok_all": look_back(good, None),
        "sum_all": look_back("amount_minor", None),
    }
    for span, length in (("7d", WEEK), ("30d", MONTH)):
        measures |= {f"ok_{span}": look_back(good, length), f"sum_{span}": look_back(paid, length),
                     f"squares_{span}": look_back(square, length)}
    for k in range(24):
        measures[f"hour_{k}"] = look_back(f"CASE WHEN _hour = {k} THEN 1L END", None)
    for name in ("cards_30d", "merchants_30d", "countries_24h", "disputes", "disputed_30d"):
        measures[name] = f"CASE WHEN _what = '{name}' THEN _delta END"
    return measures


def velocity(s: dict[str, Column]) -> dict[str, Column]:
    return {
        "transaction_count_1h": s["n_1h"], "transaction_count_24h": s["n_24h"], "transaction_count_7d": s["n_7d"],
        "transaction_count_30d": s["n_30d"], "unique_cards_30d": s["cards_30d"],
        "unique_merchants_30d": s["merchants_30d"],
    }


def _mean_and_spread(s: dict[str, Column], span: str) -> tuple[Column, Column]:
    """Mean and sample standard deviation of succeeded amounts from exact sums; the amount itself and 0 by default."""
    n, total, squares = s[f"ok_{span}"], s[f"sum_{span}"], s[f"squares_{span}"]
    avg = F.coalesce(X.ratio(total, n), F.col("amount_minor").cast("double"))
    exact = total.cast("decimal(38,0)")
    spread = F.greatest((n * squares - exact * exact).cast("double"), F.lit(0.0))
    pairs = n.cast("double") * F.greatest(n.cast("double") - 1, F.lit(1.0))
    return avg, F.when(n > 1, F.sqrt(spread / pairs)).otherwise(F.lit(0.0))


def amounts(s: dict[str, Column], rules: Rules) -> dict[str, Column]:
    """Needs columns ``amount_minor``, ``max_minor_30d`` and ``not_above_30d``."""
    minor = F.col("amount_minor").cast("double")
    avg, std = _mean_and_spread(s, "7d")
    return {
        "avg_amount_7d": avg / 100,
        "stddev_amount_7d": std / 100,
        "max_amount_30d": F.coalesce(F.col("max_minor_30d").cast("double"), minor) / 100,
        "amount_ratio_to_avg": F.when(avg > 0, minor / F.nullif(avg, F.lit(0.0))).otherwise(F.lit(1.0)),
        "amount_zscore": F.when(std > 0, (minor - avg) / F.nullif(std, F.lit(0.0))).otherwise(F.lit(0.0)),
        "round_amount": _flag(F.col("amount_minor") % 100 == 0),
        "high_value_flag": _flag(F.col("amount_minor") > rules.high_value_minor),
        "amount_percentile": F.coalesce(X.ratio("not_above_30d", s["n_30d"]), F.lit(0.5)),
    }


def geography(s: dict[str, Column], rules: Rules, located: bool = False) -> dict[str, Column]:
    """Distances are between the places of the addresses where payments are ``located``, else between the countries' ``places``."""
    here, before = F.col("ip_country"), s["last"]["country"]
    hours = (F.col("_us") - s["last"]["us"]) / F.lit(HOUR * 1_000_000.0)
    if located:
        km = F.coalesce(X.haversine_km(s["last"]["latitude"], s["last"]["longitude"], "latitude", "longitude"), F.lit(0.0))
    elif rules.places:
        entries = [F.lit(v) for c in sorted(rules.places) for v in (c,)]
        lat = F.map_from_arrays(F.array(*entries), F.array(*[F.lit(float(rules.places[c][0])) for c in sorted(rules.places)]))
        lon = F.map_from_arrays(F.array(*entries), F.array(*[F.lit(float(rules.places[c][1])) for c in sorted(rules.places)]))
        km = F.coalesce(X.haversine_km(F.try_element_at(lat, before), F.try_element_at(lon, before),
                                       F.try_element_at(lat, here), F.try_element_at(lon, here)), F.lit(0.0))
    else:
        km = F.lit(0.0)
    usual = F.element_at(F.array(*[s[f"hour_{k}"] for k in range(24)]), F.hour("ts") + 1)
    changed = (s["countries_24h"] > 1) | ((s["countries_24h"] == 1) & (before != here))
    return {
        "card_country_mismatch": _flag(F.col("card_country") != here),
        "ip_country_mismatch": _flag(here != F.col("billing_country")),
        "distance_km": km,
        "velocity_km_per_hour": F.when(hours > 0, km / F.nullif(hours, F.lit(0.0))).otherwise(F.lit(0.0)),
        "high_risk_country": _flag(here.isin(list(rules.high_risk_countries))) if rules.high_risk_countries else F.lit(0),
        "country_change_24h": _flag(changed),
        "timezone_anomaly": _flag(X.ratio(usual, s["n_all"]) < rules.rare_hour_share),
    }


def device_and_email(rules: Rules) -> dict[str, Column]:
    """Needs column ``_device_us``: the customer's first use of the device."""
    age = F.greatest(_days(F.col("_device_us"), micros("ts")), F.lit(0))
    domain = X.email_domain("email")
    version = F.try_to_number(F.regexp_extract("user_agent", r"(?:Chrome|Firefox|Safari|Edge)/(\d{1,4})", 1), F.lit("9999"))
    known_age = F.lit(rules.default_domain_age)
    if rules.domain_ages:
        names = sorted(rules.domain_ages)
        ages = F.map_from_arrays(F.lit(names), F.lit([rules.domain_ages[n] for n in names]))
        known_age = F.coalesce(F.try_element_at(ages, domain), known_age)
    return {
        "device_fingerprint_age_days": F.coalesce(age, F.lit(0)),
        "device_fingerprint_new": _flag(F.coalesce(age, F.lit(0)) < 1),
        "email_domain_age_days": known_age,
        "email_domain_free": _flag(domain.isin(*FREE_DOMAINS)),
        "email_domain_disposable": _flag(domain.isin(*DISPOSABLE_DOMAINS)),
        "browser_version_outdated": _flag(version < rules.min_browser_version),
    }


def customer_history(s: dict[str, Column]) -> dict[str, Column]:
    """Needs column ``customer_since``."""
    age = F.greatest(F.coalesce(_days(micros("customer_since"), F.col("_us")), F.lit(0)), F.lit(0))
    return {
        "customer_age_days": age,
        "first_transaction_customer": _flag(s["n_all"] == 0),
        "customer_dispute_history": s["disputes"],
        "customer_success_rate": F.coalesce(X.ratio(s["ok_all"], s["n_all"]), F.lit(0.0)),
        "days_since_last_transaction": F.coalesce(_days(s["last"]["us"], F.col("_us")), F.lit(9999)),
        "customer_lifetime_value": s["sum_all"].cast("double") / 100,
        "avg_transaction_per_month": F.coalesce(X.ratio(s["n_all"], age.cast("double") / 30), F.lit(0.0)),
        "chargeback_rate_30d": F.coalesce(X.ratio(s["disputed_30d"], s["n_30d"]), F.lit(0.0)),
    }


def context(rules: Rules) -> dict[str, Column]:
    holiday = F.to_date("ts").cast("string").isin(list(rules.holidays)) if rules.holidays else F.lit(False)
    return {
        "time_of_day": F.hour("ts"),
        "day_of_week": F.weekday("ts"),
        "is_weekend": _flag(F.weekday("ts") >= 5),
        "is_holiday": _flag(holiday),
        "shipping_address_mismatch": _flag(~F.col("shipping_address").eqNullSafe(F.col("billing_address"))),
    }


def merchant_features(payments: DataFrame, disputes: DataFrame, merchants: DataFrame,
                      hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``payment_id`` with the five merchant features."""
    if hot_rows and no_busy_keys(payments, ["merchant_id"], hot_rows // 5):
        hot_rows = None
    stream = with_expiries(payments.withColumn("_t", micros("ts")), "_t", [MONTH], ["merchant_id", "amount_minor"],
                           ["payment_id"]).unionByName(
        _dispute_steps(payments, disputes, "merchant_id"), allowMissingColumns=True)
    s = running_before(stream, ["merchant_id"], "_us", {
        "m_n_30d": look_back("1L", MONTH), "m_sum_30d": look_back("amount_minor", MONTH), "m_n_all": look_back("1L", None),
        **{f"m_{w}": f"CASE WHEN _what = '{w}' THEN _delta END" for w in ("disputed_all", "disputed_30d")},
    }, hot_rows=hot_rows).filter("_after = 0")
    industry = F.lower("industry")
    risk = F.when(industry.isin(*HIGH_RISK_INDUSTRIES), 2).when(industry.isin(*MEDIUM_RISK_INDUSTRIES), 1).otherwise(0)
    return s.join(merchants.select("merchant_id", F.col("created_at").alias("_since"), "industry"), "merchant_id",
                  "left").select(
        "payment_id",
        F.greatest(F.coalesce(_days(micros("_since"), F.col("_us")), F.lit(0)), F.lit(0)).alias("merchant_age_days"),
        F.coalesce(X.ratio("m_disputed_30d", "m_n_30d"), F.lit(0.0)).alias("merchant_dispute_rate_30d"),
        F.coalesce(X.ratio("m_disputed_all", "m_n_all"), F.lit(0.0)).alias("merchant_chargeback_rate"),
        F.coalesce(X.ratio("m_sum_30d", "m_n_30d") / 100, F.lit(0.0)).alias("merchant_avg_ticket"),
        risk.alias("merchant_industry_risk"),
    )


def first_device_use(payments: DataFrame) -> DataFrame:
    return payments.groupBy("customer_id", "device_fingerprint").agg(F.min(micros("ts")).alias("_device_us"))


def highest_amount(payments: DataFrame) -> DataFrame:
    good = F.when(F.col("status") == "SUCCEEDED", F.col("amount_minor"))
    return rolling_max(payments, ["customer_id"], "ts", "payment_id", good, MONTH, "max_minor_30d")


def amount_rank(payments: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """How many of the customer's payments of the last 30 days were not larger."""
    return rolling_rank(payments, ["customer_id"], "ts", "payment_id", "amount_minor", MONTH, "not_above_30d", hot_rows)


def _state_columns(df: DataFrame) -> dict[str, Column]:
    return {c[2:]: F.col(c) for c in df.columns if c.startswith("s_")}


def feature_vector(payments, disputes, customers, merchants, rules: Rules = Rules(), hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """All features in model order, one row per payment; missing values are zero."""
    base = customer_state(payments, disputes, hot_rows)
    wide = (
        base.join(highest_amount(payments), "payment_id", "left")
        .join(amount_rank(payments, hot_rows), "payment_id", "left")
        .join(merchant_features(payments, disputes, merchants, hot_rows), "payment_id", "left")
        .join(customers.select("customer_id", F.col("created_at").alias("customer_since")), "customer_id", "left")
        .join(first_device_use(payments), ["customer_id", "device_fingerprint"], "left")
    )
    s = _state_columns(base)
    found = {**velocity(s), **amounts(s, rules), **geography(s, rules, len(_position(payments)) == 2), **device_and_email(rules),
             **customer_history(s), **context(rules)}
    keys = ["payment_id", "customer_id", "merchant_id", "ts", "amount_minor"]
    avg, std = _mean_and_spread(s, "30d")
    return wide.select(
        *keys, *[F.coalesce(found.get(f, F.col(f)), F.lit(0)).alias(f) for f in FEATURES],
        (avg / 100).alias("avg_amount_30d"), (std / 100).alias("stddev_amount_30d"),
        F.floor((F.col("_us") - s["last"]["us"]) / 1_000_000).alias("time_since_last_seconds"),
    )


def group(name: str, payments, disputes, customers, merchants, rules: Rules = Rules(), hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """One feature group: velocity, amount, geo, device_email, customer, merchant or context."""
    if name == "merchant":
        return merchant_features(payments, disputes, merchants, hot_rows)
    if name == "context":
        return payments.select("payment_id", *[c.alias(f) for f, c in context(rules).items()])
    if name == "device_email":
        joined = payments.join(first_device_use(payments), ["customer_id", "device_fingerprint"], "left")
        return joined.select("payment_id", *[c.alias(f) for f, c in device_and_email(rules).items()])
    base = customer_state(payments, disputes, hot_rows)
    s = _state_columns(base)
    if name == "velocity":
        found = velocity(s)
    elif name == "amount":
        base, found = base.join(highest_amount(payments), "payment_id", "left"), amounts(s, rules)
        base = base.join(amount_rank(payments, hot_rows), "payment_id", "left")
    elif name == "geo":
        found = geography(s, rules, len(_position(payments)) == 2)
    elif name == "customer":
        base = base.join(customers.select("customer_id", F.col("created_at").alias("customer_since")), "customer_id", "left")
        found = customer_history(s)
    else:
        raise ValueError(f"unknown feature group {name}")
    return base.select("payment_id", *[c.alias(f) for f, c in found.items()])


GROUPS = ("velocity", "amount", "geo", "device_email", "customer", "merchant", "context")


def feature_document(vector: DataFrame, score: Column, model_version: str, ttl_days: int = 180) -> DataFrame:
    """Nested document with the twelve stored features, as the document store keeps it."""
    f = F.col
    nested = F.struct(
        f("transaction_count_1h").alias("transaction_velocity_1h"),
        f("transaction_count_24h").alias("transaction_velocity_24h"),
        f("avg_amount_30d").alias("avg_transaction_amount_30d"),
        f("stddev_amount_30d").alias("transaction_amount_stddev_30d"),
        (f("card_country_mismatch") == 1).alias("card_country_mismatch"),
        (f("ip_country_mismatch") == 1).alias("ip_country_mismatch"),
        (f("first_transaction_customer") == 1).alias("first_transaction_customer"),
        "merchant_dispute_rate_30d",
        "customer_dispute_history",
        f("time_since_last_seconds").alias("time_since_last_transaction_seconds"),
        (f("device_fingerprint_new") == 1).alias("device_fingerprint_new"),
        "email_domain_age_days",
    )
    return vector.select(
        F.concat(F.lit("feat_"), f("payment_id").cast("string")).alias("feature_id"),
        "payment_id", "merchant_id", "customer_id", f("ts").alias("computed_at"),
        F.round(score, 4).alias("fraud_score"), nested.alias("features"), F.lit(model_version).alias("model_version"),
        F.lit(ttl_days * DAY).alias("ttl"),
    ).withColumn("risk_level", F.when(f("fraud_score") >= 0.7, "high").when(f("fraud_score") >= 0.4, "medium").otherwise("low"))


def time_since_last(payments: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Seconds since the customer's previous payment; null for the first."""
    rows = payments.select("payment_id", "customer_id", micros("ts").alias("_us"),
                           F.struct(micros("ts").alias("us")).alias("_seen"))
    s = running_before(rows, ["customer_id"], "_us", {}, {"last": "_seen"}, hot_rows=hot_rows)
    return s.select("payment_id", "customer_id",
                    F.floor((F.col("_us") - F.col("last.us")) / 1_000_000).alias("time_since_last_seconds"))


def locate(rows: DataFrame, ranges: DataFrame, ip: str = "ip_address") -> DataFrame:
    """Join dotted IPv4 addresses to non-overlapping (start_ip, end_ip, country, lat, lon) ranges given as numbers.

    Both sides meet on the upper 16 bits; a range is repeated for the blocks it covers. Anything but
    four octets from 0 to 255 (also an IPv6 address) finds no place.
    """
    parts = F.split(F.btrim(F.col(ip)), r"\.", -1)
    octets = [F.when(F.get(parts, F.lit(i)).rlike("^[0-9]{1,3}$"), F.get(parts, F.lit(i)).try_cast("bigint")) for i in range(4)]
    valid = (F.size(parts) == 4) & F.greatest(*octets).between(0, 255)
    number = F.when(valid, sum((o * 256 ** (3 - i) for i, o in enumerate(octets)), F.lit(0)))
    def block(c):
        return F.floor(c / 65536)

    cut = ranges.withColumn("_block", F.explode(F.sequence(block(F.col("start_ip")), block(F.col("end_ip")))))
    marked = rows.withColumn("_ip", number).withColumn("_block", block(F.col("_ip")))
    hit = (marked["_block"] == cut["_block"]) & F.col("_ip").between(F.col("start_ip"), F.col("end_ip"))
    return marked.join(cut, hit, "left").drop("_ip", "_block", "start_ip", "end_ip")
