"""Labelled documents to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The most labelled documents that a model is fitted on; those with the smallest hash of their id.
SAMPLE_ROWS = 20_000


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from; a missing id is never held out, and never has a label."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def training_ids(labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, y) of at most ``rows`` labelled documents that are not held out, the same ones every time.

    A document with several labels counts as 1 if any of them is.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    one = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def training_rows(documents: DataFrame, ids: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents of ``training_ids``, one row each, with y. At most SAMPLE_ROWS ids are broadcast."""
    chosen = ids.select(F.col("doc_id").alias("_train_id"), "y")
    return documents.join(F.broadcast(chosen), documents[doc_id] == F.col("_train_id"))
