"""Parquet tables in the shared folder.

A streaming table has one folder per micro-batch, so a batch that runs again
replaces its own rows. A snapshot is a new path; nothing reads and overwrites
the same one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyboard.schemas import CATEGORY_PATTERNS


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    """The whole category dictionary. ``ord`` is the document order."""
    return spark.read.schema(CATEGORY_PATTERNS).parquet(path)


def write_batch(df: DataFrame, root: str, batch_id: int, partition_by: str | None = None) -> None:
    """Replace the rows of a batch; ``partition_by`` puts them in folders by that column."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = df.hint("rebalance", F.col(partition_by)).write.mode("overwrite").partitionBy(partition_by)
    writer.parquet(f"{root}/batch_id={batch_id}")


def write_batches(df: DataFrame, root: str, partition_by: str | None = None) -> None:
    """Replace the rows of all batches that ``df`` has, by its column ``batch_id``, in one job. Batches without a row are left as they are."""
    by = ["batch_id", *([partition_by] if partition_by else [])]
    # A batch's rows go to one task if they are few.
    writer = df.hint("rebalance", *map(F.col, by)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(root)


def stored_batches(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the batches that have a folder under ``root``, whole or not."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(path)] if files.exists(path) else []
    return [int(name.removeprefix("batch_id=")) for name in names if name.startswith("batch_id=")]


def read_batches(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All batches under ``root``, with their ``batch_id``; no rows if none was written yet."""
    full = T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())])
    try:
        return spark.read.schema(full).option("basePath", root).parquet(root)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def write_snapshot(df: DataFrame, path: str, partition_by: str | None = None, sort_by: str | None = None) -> str:
    """Write ``df`` to a path that must not exist yet; ``sort_by`` orders the rows of a partition value over its files."""
    if partition_by is None:
        df.write.mode("errorifexists").parquet(path)
        return path
    # One partition value may be most of the table: both ways split it.
    if sort_by is None:
        balanced = df.hint("rebalance", F.col(partition_by))
    else:
        balanced = df.repartitionByRange(partition_by, sort_by).sortWithinPartitions(partition_by, sort_by)
    balanced.write.mode("errorifexists").partitionBy(partition_by).parquet(path)
    return path


@dataclass(frozen=True)
class PatternStore:
    """Versions of the category dictionary under ``root``; a version is there once its folder is whole."""

    root: str

    def publish(self, patterns: DataFrame, version: int) -> None:
        patterns.write.mode("errorifexists").parquet(f"{self.root}/version={version}")

    def version(self, spark: SparkSession) -> int | None:
        """The latest whole version: folders are listed, nothing is read."""
        root = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(root):
            return None
        found = [status.getPath() for status in files.listStatus(root)]
        whole = [path for path in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"))]
        return max((int(path.getName().partition("=")[2]) for path in whole), default=None)

    def read(self, spark: SparkSession, version: int) -> DataFrame:
        return read_patterns(spark, f"{self.root}/version={version}")
