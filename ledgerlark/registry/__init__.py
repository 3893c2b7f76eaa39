"""Binds the operators to the given tables, with a SQL check where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.registry.fixture_sql import check
from ledgerlark.sources.driver_tables import PaymentTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

_OUTPUT = {
    "i": lambda c: c.cast("bigint"),
    "d": lambda c: c.cast("double"),
    "r": lambda c: F.floor(c.cast("double") * 10000 + 0.5).cast("double") / 10000,
    "s": lambda c: c.cast("string"),
    "b": lambda c: c.cast("boolean"),
    "t": lambda c: F.date_format(c, TIMESTAMP_TEXT),
}


def present(df: DataFrame, columns: str) -> DataFrame:
    """Select and type the output columns the same way the SQL check does."""
    pairs = [c.split(":") for c in columns.split()]
    return df.select(*[_OUTPUT[kind](F.col(name)).alias(name) for name, kind in pairs])


def query(name: str, columns: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``; ``sql`` is its independent check."""

    def register(fn: Callable[[PaymentTables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, path: present(fn(PaymentTables(spark, path)), columns)
        if sql is not None:
            CHECKS[name] = check(columns, sql)
        return fn

    return register


MODULES = ("analytics", "operations", "features", "documents", "warehouse", "quality", "webhooks",
           "streams", "privacy", "models", "primitives")


def load_all() -> None:
    """Import the binding modules; each registers its queries."""
    for module in MODULES:
        import_module(f"ledgerlark.registry.{module}")
