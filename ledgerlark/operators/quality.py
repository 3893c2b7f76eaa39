"""Data-quality rules. Each returns ``rule, table_name, failed, total, passed``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlark.functions import expr as X

EMAIL_PATTERN = "%_@__%.__%"
FORBIDDEN_COLUMNS = ("date_of_birth", "gender", "race")
REQUIRED_COLUMNS = ("customer_id", "email", "country_code")


def _result(df: DataFrame, rule: Column | str, table: str, failed: Column, total: Column) -> DataFrame:
    rule = F.lit(rule) if isinstance(rule, str) else rule
    return df.select(rule.alias("rule"), F.lit(table).alias("table_name"), failed.cast("bigint").alias("failed"),
                     total.cast("bigint").alias("total"), (failed == 0).alias("passed"))


def check_rules(table: DataFrame, name: str, rules: Mapping[str, Column | str]) -> DataFrame:
    """All row rules of a table in one pass. A rule that evaluates to null counts as failed."""
    checks = {r: (F.expr(p) if isinstance(p, str) else p) for r, p in rules.items()}
    counted = table.agg(F.count("*").alias("total"), F.array(*[
        F.struct(F.lit(r).alias("rule"), F.count_if(~F.coalesce(p, F.lit(False))).alias("failed"))
        for r, p in checks.items()]).alias("all"))
    rows = counted.select("total", F.inline("all"))
    return _result(rows, F.col("rule"), name, F.col("failed"), F.col("total"))


def missing_values(table: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    return check_rules(table, name, {f"{c} not null": F.col(c).isNotNull() for c in columns})


def duplicate_keys(table: DataFrame, name: str, key: Sequence[str]) -> DataFrame:
    groups = table.groupBy(*key).agg(F.count("*").alias("n"))
    summary = groups.agg(F.count_if(F.col("n") > 1).alias("failed"), F.count("*").alias("total"))
    return _result(summary, f"unique {', '.join(key)}", name, F.col("failed"), F.col("total"))


def foreign_key(child: DataFrame, name: str, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no parent. Distinct keys meet the parent, so a busy key is one row."""
    keys = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).agg(F.count("*").alias("n"))
    parents = parent.select(F.col(key).alias("_key"), F.lit(True).alias("_found")).dropDuplicates(["_key"])
    summary = keys.join(parents, "_key", "left").agg(
        F.coalesce(F.sum(F.when(F.col("_found").isNull(), F.col("n"))), F.lit(0)).alias("failed"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    return _result(summary, f"{column} resolves", name, F.col("failed"), F.col("total"))


def reconcile(source: DataFrame, target: DataFrame, by: str, amount: str) -> DataFrame:
    """Row count and sum per group on both sides; groups of either side are kept."""
    def side(df, tag):
        return df.groupBy(by).agg(F.count("*").alias(f"{tag}_rows"), F.sum(amount).alias(f"{tag}_sum"))

    none = F.lit(0)
    both = side(source, "source").join(side(target, "target"), by, "full")
    return both.select(
        by, *[F.coalesce(c, none).alias(c) for c in ("source_rows", "target_rows", "source_sum", "target_sum")]
    ).withColumn("rows_match", F.col("source_rows") == F.col("target_rows")).withColumn(
        "sums_match", F.col("source_sum") == F.col("target_sum"))


def reconcile_rule(pairs: DataFrame, name: str, column: str, rule: str) -> DataFrame:
    summary = pairs.agg(F.count_if(~F.col(column)).alias("failed"), F.count("*").alias("total"))
    return _result(summary, rule, name, F.col("failed"), F.col("total"))


def freshness(table: DataFrame, name: str, ts: str, as_of, hours: int = 24) -> DataFrame:
    """Fails when nothing arrived within ``hours``."""
    summary = table.agg(F.max(ts).alias("last"), F.count("*").alias("total"))
    stale = (F.col("last").isNull() | (F.col("last") < X.ago(as_of, hours, "HOUR"))).cast("int")
    return _result(summary, f"newer than {hours} h", name, stale, F.col("total"))


def refund_cap(refunds: DataFrame, transactions: DataFrame) -> DataFrame:
    """Refunds of a payment never exceed it."""
    per_payment = refunds.groupBy("transaction_id").agg(F.sum("amount").alias("refunded"))
    summary = per_payment.join(transactions.select("transaction_id", "amount"), "transaction_id").agg(
        F.count_if(F.col("refunded") > F.col("amount")).alias("failed"), F.count("*").alias("total"))
    return _result(summary, "refunds within amount", "refunds", F.col("failed"), F.col("total"))


def email_format(table: DataFrame, name: str, column: str = "email") -> DataFrame:
    return check_rules(table, name, {"email format": F.col(column).like(EMAIL_PATTERN)})


def forbidden_columns(spark: SparkSession, schema: StructType, name: str, forbidden: Sequence[str] = FORBIDDEN_COLUMNS,
                      required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Data minimisation: columns that must not be there, and ones that must."""
    def plain(s):
        return s.lower().replace("_", "")

    have = {plain(n) for n in schema.fieldNames()}
    rows = [(f"no {c}", name, int(plain(c) in have), 1, plain(c) not in have) for c in forbidden]
    rows += [(f"has {c}", name, int(plain(c) not in have), 1, plain(c) in have) for c in required]
    return spark.createDataFrame(rows, "rule string, table_name string, failed bigint, total bigint, passed boolean")


def held_values(table: DataFrame, name: str, forbidden: Sequence[str] = FORBIDDEN_COLUMNS,
                required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """``forbidden_columns`` counted in rows: those that hold a value they must not, and those that lack one they must have.

    One pass over the columns in question. An empty table passes; its columns are for ``forbidden_columns`` to judge."""
    have = {c.lower().replace("_", ""): c for c in table.columns}

    def column(c):
        return have.get(c.lower().replace("_", ""))

    rules = {f"no {c}": F.col(f"`{column(c)}`").isNull() if column(c) else F.lit(True) for c in forbidden}
    rules |= {f"has {c}": F.col(f"`{column(c)}`").isNotNull() if column(c) else F.lit(False) for c in required}
    return check_rules(table, name, rules)


def _schema_verdicts(actual: StructType, expected: StructType) -> dict[str, bool]:
    types = {f.name: f.dataType for f in actual}
    names = set(expected.fieldNames())
    return {**{f"{f.name} is {f.dataType.simpleString()}": types.get(f.name) == f.dataType for f in expected},
            **{f"{c} is declared": False for c in types if c not in names}}


def schema_matches(spark: SparkSession, actual: StructType, expected: StructType, name: str) -> DataFrame:
    """One row per expected column: present with the same type; and a failed one per column that nobody declared."""
    rows = [(rule, name, int(not fine), 1, fine) for rule, fine in _schema_verdicts(actual, expected).items()]
    return spark.createDataFrame(rows, "rule string, table_name string, failed bigint, total bigint, passed boolean")


def rows_off_schema(table: DataFrame, name: str, expected: StructType) -> DataFrame:
    """``schema_matches`` with the rows that a deviation concerns, all of them, from the row count alone."""
    return check_rules(table, name, {rule: F.lit(fine) for rule, fine in _schema_verdicts(table.schema, expected).items()})


def union_results(*results: DataFrame) -> DataFrame:
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def table_summary(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and latest timestamp per table."""
    return union_results(*[
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"), F.max(ts).alias("latest"))
        for name, (df, ts) in tables.items()])


def validate_restore(restored: Mapping[str, tuple[DataFrame, str]], baseline: DataFrame) -> DataFrame:
    """Restored tables against the baseline taken before: same rows, nothing newer."""
    base = baseline.select("table_name", F.col("row_count").alias("expected_rows"), F.col("latest").alias("expected_latest"))
    return table_summary(restored).join(base, "table_name", "full").withColumn(
        "passed", F.col("row_count").eqNullSafe(F.col("expected_rows")) & F.col("latest").eqNullSafe(F.col("expected_latest")))


def missing_rows(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows of ``expected`` that ``actual`` lacks, with multiplicity."""
    return expected.exceptAll(actual)
