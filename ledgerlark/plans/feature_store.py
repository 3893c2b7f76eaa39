"""Feature documents kept by payment: written in batches, the latest computation of a payment wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators.ranking import latest_per_key


class FeatureStore:
    """Documents (``key``, ``computed_at``, ...) below ``root``.

    A batch is one folder, split into hash buckets of the key, so that the document of one payment is looked for in one bucket of each
    batch; inside a bucket rows are sorted by ``computed_at``, so that reports over a stretch of time skip row groups. Writing a batch
    again replaces it. The number of buckets is fixed when the store is made; take it so that a bucket of a batch is some hundred MB.
    Rows without a key cannot be looked up and are refused.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "payment_id", at: str = "computed_at", buckets: int = 64):
        self.spark, self.root, self.key, self.at, self.buckets = spark, root.rstrip("/"), key, at, buckets

    def _bucket(self, key):
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def upsert(self, documents: DataFrame, batch: int) -> None:
        """Write ``documents`` as batch number ``batch``. Of rows with one key the latest is kept; so is it between batches, and of equal
        times the one of the later batch."""
        key = F.when(F.col(self.key).isNull(), F.raise_error(F.lit(f"document without {self.key}"))).otherwise(F.col(self.key))
        rest = [c for c in documents.columns if c not in (self.key, self.at)]
        rows = latest_per_key(documents.withColumn(self.key, key), [self.key], self.at, *_ordered(documents, rest))
        rows = rows.select(*documents.columns).withColumn("bucket", self._bucket(F.col(self.key)))
        rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", self.at).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{self.root}/batch={int(batch)}")

    def read(self, since=None) -> DataFrame:
        """The current documents, or those computed at ``since`` or later. A document that is too old has no later computation, so
        the bound goes before the choice of the latest and reaches the scan."""
        rows = self.spark.read.parquet(self.root)
        if since is not None:
            rows = rows.filter(F.col(self.at) >= since)
        return self._current(rows)

    def get(self, key) -> DataFrame:
        """The document of one payment; one bucket of each batch is opened."""
        kind = self.spark.read.parquet(self.root).schema[self.key].dataType
        value = F.lit(key).cast(kind)
        return self._current(self.spark.read.parquet(self.root).filter((F.col("bucket") == self._bucket(value)) & (F.col(self.key) == value)))

    def _current(self, rows: DataFrame) -> DataFrame:
        columns = [c for c in rows.columns if c not in ("batch", "bucket")]
        return latest_per_key(rows, [self.key], self.at, "batch").select(*columns)


def _ordered(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns that can be compared; they settle equal times, so that the choice is the same on every run."""
    return [f.name for f in df.schema.fields if f.name in columns and f.dataType.typeName() not in ("map", "variant")]
