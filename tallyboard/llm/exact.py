"""Exact de-duplication in three combining steps, each comparing whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import WHITE, attach_groups, stored, text_or_empty

#: Parts into which the rows of one text are dealt before they meet.
SALTS = 32

_STEP = "cast(36893488147419103232 as decimal(20,0))"  # 2**65
_HALF = "cast(9223372036854775808 as decimal(20,0))"  # 2**63


def _standing(points: str, doc_id: str) -> Column:
    """One number that is largest for the most code points, then the smallest id; a missing id comes last."""
    place = f"coalesce({_HALF} - cast({doc_id} as decimal(20,0)), cast(0 as decimal(20,0)))"
    return F.expr(f"cast({points} * {_STEP} + {place} as decimal(38,0))")


def _id_of(standing: str) -> Column:
    place = f"({standing} % {_STEP})"
    return F.expr(f"case when {place} > 0 then cast({_HALF} - {place} as bigint) end")


def normal_text(text: str = "text") -> Column:
    return F.translate(text_or_empty(text), WHITE, "")


def full_digest(content: Column) -> Column:
    return F.sha2(content, 256)


def exact_duplicates(
    documents: DataFrame, text: str = "text", doc_id: str = "doc_id", salts: int = SALTS, digest=full_digest
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without white space. Of equal texts the
    one with the most code points stays, then the one with the smallest id.

    * locally: each task keeps one row per text (map-side part of the first grouping);
    * salted: the winners of the tasks are grouped by digest, whole text and salt, so a
      text that a third of all rows have is dealt over ``salts`` groups;
    * globally: at most ``salts`` winners per text meet, by digest and whole text.

    Every grouping compares the whole text; should two texts share a digest,
    their documents are told apart by the text itself when ids are handed out.

    A null text counts as empty, and empty texts are equal to each other. A row without
    an id wins only against other rows without one of the same length. Rows repeated
    with the id that stays are all ``kept``: the id is the document. No row: no result.
    """
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        normal_text(text).alias("content"),
        F.char_length(text_or_empty(text)).alias("points"),
    ).withColumn("digest", digest(F.col("content")))
    salted = (
        rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
        .groupBy("digest", "content", "salt")
        .agg(F.max(_standing("points", "doc_id")).alias("best"), F.count(F.lit(1)).alias("n"))
    )
    texts = salted.groupBy("digest", "content").agg(F.max("best").alias("best"), F.sum("n").alias("n"))
    # Texts have been compared; where a digest stands for one text only, it is enough from here on.
    classes = stored(texts.select("digest", "best", "n"), "texts")
    total = classes.agg(F.sum("n")).first()[0] or 0
    shared = classes.groupBy("digest").count().where("count > 1").select("digest")
    collide = not shared.isEmpty()
    groups = classes.where("n > 1").select(
        "digest", _id_of("best").alias("keep_id"), F.col("n").alias("group_size")
    )
    if collide:
        groups = groups.join(shared, "digest", "left_anti")
    alone = rows.join(shared, "digest", "left_anti") if collide else rows
    found = attach_groups(
        alone.select("doc_id", "digest", F.sha2("content", 256).alias("text_sha256")),
        groups,
        "digest",
        "group_size",
        total,
        "doc_id",
    )
    if collide:
        by_text = texts.join(shared, "digest", "left_semi").select(
            "content", _id_of("best").alias("keep_id"), F.col("n").alias("group_size")
        )
        rest = rows.join(shared, "digest", "left_semi").join(by_text, "content")
        found = found.unionByName(
            rest.select("doc_id", "digest", F.sha2("content", 256).alias("text_sha256"), "keep_id", "group_size")
        )
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        size.alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )
