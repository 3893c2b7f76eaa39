"""Reading and writing tables: declared schemas, partitions, staging, versions, exports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlark.functions import expr as X

# Days a document stays in its collection.
TTL_DAYS = {"api_logs": 90, "user_sessions": 30, "fraud_features": 180, "webhook_events": 60}


def scan(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Declared table: the schema is given, never inferred."""
    return spark.read.schema(schema).parquet(path)


def scan_documents(spark: SparkSession, path: str, schema: StructType | str, multiline: bool = True) -> DataFrame:
    """JSON documents, as arrays over several lines or one document per line."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def write_partitions(df: DataFrame, path: str, by: Sequence[str], sort: Sequence[str] = ()) -> None:
    """Replace exactly the partitions that ``df`` contains; running it again gives the same table.

    Rows are sorted inside files so that parquet min/max statistics skip row groups.
    """
    if sort:
        df = df.sortWithinPartitions(*by, *sort)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy(
        *by).parquet(path)


def append_staging(df: DataFrame, path: str, run_date: str) -> None:
    """Land a run's rows under its date. A repeated run replaces its own date."""
    write_partitions(df.withColumn("run_date", F.lit(run_date)), path, ["run_date"])


def replace_staging(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "snappy").parquet(path)


def read_folder(spark: SparkSession, path: str, schema: StructType | str, pattern: str = "*.parquet") -> DataFrame:
    """All matching files below ``path``, whatever folders they are in."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).parquet(path)


def by_month(df: DataFrame, date_key: str = "time_key") -> DataFrame:
    return df.withColumn("year_month", F.floor(F.col(date_key) / 100).cast("int"))


def archive_partitions(spark: SparkSession, path: str, keep: str, archive: str, partition: str, before: int) -> None:
    """Split a partitioned table: partitions below ``before`` go to ``archive``, the others to ``keep``.

    Both reads list only their own partitions; the source stays until the caller drops it.
    """
    table = spark.read.parquet(path)
    write_partitions(table.filter(F.col(partition) < before), archive, [partition])
    write_partitions(table.filter(F.col(partition) >= before), keep, [partition])


def within_ttl(documents: DataFrame, collection: str, ts: str, as_of) -> DataFrame:
    """Documents younger than their collection's limit."""
    return documents.filter(F.col(ts) >= X.ago(as_of, TTL_DAYS[collection], "DAY"))


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


class PublishedTable:
    """Versions of a table in a shared folder, with an append-only list of pointers.

    A version becomes visible when its pointer file is complete. Readers of the older version
    are not disturbed, and a failed check leaves the pointer where it was. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _pointer(self):
        try:
            rows = self.spark.read.schema("version int, path string").option("recursiveFileLookup", True).parquet(
                f"{self.root}/pointers")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return rows.orderBy(F.desc("version")).first()

    @property
    def version(self) -> int:
        pointer = self._pointer()
        return pointer["version"] if pointer else 0

    def read(self) -> DataFrame | None:
        pointer = self._pointer()
        return self.spark.read.parquet(pointer["path"]) if pointer else None

    def publish(self, df: DataFrame, by: Sequence[str] = (), gate: Callable[[DataFrame], DataFrame] | None = None) -> bool:
        """Write a new version; point to it only if every rule of ``gate(written)`` passed."""
        version = self.version + 1
        path = f"{self.root}/v{version}"
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(path)
        if gate is not None and not gate(self.spark.read.parquet(path)).filter(~F.col("passed")).isEmpty():
            return False
        pointer = self.spark.createDataFrame([(version, path)], "version int, path string")
        pointer.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{self.root}/pointers/p{version}")
        return True


def project_for_role(df: DataFrame, role: str, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """Only the columns the role may read, in table order."""
    return df.select(*[c for c in df.columns if c in set(allowed[role])])


def rows_of_tenant(df: DataFrame, column: str, tenant) -> DataFrame:
    """Only the tenant's rows; the predicate reaches the scan."""
    return df.filter(F.col(column) == F.lit(tenant))
