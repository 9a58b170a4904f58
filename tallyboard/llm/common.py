"""What several operators share: inputs, scratch tables, batches, skew-safe lookups."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.session import new_run_dir

#: The characters of [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"

#: A group with at least 1/HOT_SHARE of all rows is hot; so there are at most HOT_SHARE of them.
HOT_SHARE = 4096

#: Characters handled at once inside a task.
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, independent of any executor."""
    path = new_run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text."""
    spaced = F.trim(F.translate(text, WHITE, " " * len(WHITE)))
    return F.when(spaced == "", F.lit(0)).otherwise(F.size(F.split(spaced, " +"))).cast("long")


def attach_groups(
    rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, spread: str
) -> DataFrame:
    """``rows`` left-joined to ``groups`` (one row per ``key``, ``size`` rows of ``rows`` each) in one pass.

    Groups with 1/HOT_SHARE of the ``total`` rows or more are at most HOT_SHARE by
    arithmetic; they are broadcast. Their rows then carry a key of their own into
    the shuffle join, made from ``spread``, so that no partition gets them all.
    """
    added = [name for name in groups.columns if name != key]
    hot = groups.where(F.col(size) * HOT_SHARE >= total).select(
        F.col(key).alias("_hot_key"), *[F.col(name).alias(f"_hot_{name}") for name in added]
    )
    kind = groups.schema[key].dataType
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left").withColumn(
        "_join_key",
        F.when(F.col("_hot_key").isNull(), F.struct(F.lit(None).cast("long").alias("s"), F.col(key).alias("k"))).otherwise(
            F.struct(F.xxhash64(spread).alias("s"), F.lit(None).cast(kind).alias("k"))
        ),
    )
    few = groups.select(
        F.struct(F.lit(None).cast("long").alias("s"), F.col(key).alias("k")).alias("_group_key"),
        *[F.col(name).alias(f"_cold_{name}") for name in added],
    )
    joined = marked.join(few, F.col("_join_key").eqNullSafe(F.col("_group_key")), "left")
    values = [F.coalesce(f"_hot_{name}", f"_cold_{name}").alias(name) for name in added]
    return joined.select(*[F.col(name) for name in rows.columns], *values)


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about SLICE_CHARS bytes of ``column``, at least one row each."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start, held = 0, 0
        for at, size in enumerate(sizes):
            if at > start and held + size > SLICE_CHARS:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def without_ids(documents: DataFrame, dropped: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Documents whose id is not among ``dropped``. Rows without an id cannot be named by a decision and stay."""
    gone = dropped.select(F.col(doc_id).alias("_dropped_id"))
    return documents.join(gone, documents[doc_id] == F.col("_dropped_id"), "left_anti")
