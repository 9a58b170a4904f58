"""The category dictionary: explode, de-duplicate, extend and map to ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

APP, URL = "app", "url"


def pattern_dictionary(category_patterns: DataFrame) -> DataFrame:
    """One row per stored pattern, in document order (``ord``) then list order (``pos``)."""
    lists = F.array(
        F.struct(F.lit(APP).alias("kind"), F.col("app_patterns").alias("patterns")),
        F.struct(F.lit(URL).alias("kind"), F.col("domain_patterns").alias("patterns")),
    )
    by_list = category_patterns.select("category_id", "category", "ord", F.inline(lists))
    return by_list.select(
        "category_id", "category", "kind", "ord", F.posexplode("patterns").alias("pos", "pattern")
    )


def effective_patterns(dictionary: DataFrame) -> DataFrame:
    """What each pattern string maps to: the last entry wins, a blank category removes it.

    Empty URL patterns are left out, as they would match every URL. An empty app
    pattern is plain equality with an empty app and stays.
    """
    usable = dictionary.where((F.col("kind") == APP) | (F.col("pattern") != ""))
    # A struct maximum, so that (ord, pos) decides; categories never break ties.
    last = usable.groupBy("kind", "pattern").agg(
        F.max(F.struct("ord", "pos", "category")).alias("last")
    )
    return last.select("kind", "pattern", F.col("last.category").alias("category")).where(
        F.col("category") != ""
    )


def unmatchable_patterns(dictionary: DataFrame) -> DataFrame:
    """Patterns that can never match, with the reason; reported, not repaired."""
    reason = F.when(
        (F.col("kind") == APP) & (F.lower("pattern") != F.col("pattern")), F.lit("upper case app")
    ).when((F.col("kind") == URL) & (F.col("pattern") == ""), F.lit("empty url pattern"))
    return dictionary.withColumn("reason", reason).where(F.col("reason").isNotNull())


def dictionary_counters(category_patterns: DataFrame) -> DataFrame:
    """One row: documents, distinct categories, and stored, effective and unmatchable patterns."""
    documents = category_patterns.agg(
        F.count(F.lit(1)).alias("documents"), F.count_distinct("category").alias("categories")
    )
    dictionary = pattern_dictionary(category_patterns)
    counted = [
        rows.agg(F.count(F.lit(1)).alias(name))
        for name, rows in (
            ("patterns", dictionary),
            ("effective_patterns", effective_patterns(dictionary)),
            ("unmatchable_patterns", unmatchable_patterns(dictionary)),
        )
    ]
    return documents.select("*", *[one.scalar().alias(one.columns[0]) for one in counted])


def add_pattern_rows(category_patterns: DataFrame, additions: DataFrame) -> DataFrame:
    """The dictionary with new patterns at the end of their lists, one row per pattern.

    ``additions`` has (category_id, kind, pattern, seq); patterns already in a list and documents that do not
    exist are skipped. Nothing is gathered: a list of any length stays rows.
    """
    dictionary = pattern_dictionary(category_patterns)
    lengths = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.coalesce(F.size(column), F.lit(0)).alias("length"))
            for kind, column in ((APP, "app_patterns"), (URL, "domain_patterns"))
        ]
    )
    lists = category_patterns.select("category_id", "category", "ord", F.inline(lengths))
    first_seen = additions.groupBy("category_id", "kind", "pattern").agg(F.min("seq").alias("seq"))
    fresh = first_seen.join(
        dictionary.select("category_id", "kind", "pattern").distinct(), ["category_id", "kind", "pattern"], "left_anti"
    ).join(lists, ["category_id", "kind"])
    nth = F.row_number().over(Window.partitionBy("category_id", "kind").orderBy("seq", "pattern"))
    return dictionary.unionByName(
        fresh.select(
            "category_id", "category", "kind", "ord", (F.col("length") + nth - 1).alias("pos"), "pattern"
        )
    )


def add_patterns(category_patterns: DataFrame, additions: DataFrame) -> DataFrame:
    """Append new patterns to a category's lists, skipping those already there.

    ``additions`` has (category_id, kind, pattern, seq). Stored lists keep their
    own duplicates. For a store whose documents hold arrays; ``add_pattern_rows`` keeps rows.
    """
    first_seen = additions.groupBy("category_id", "kind", "pattern").agg(F.min("seq").alias("seq"))
    listed = first_seen.groupBy("category_id").agg(
        *[
            F.transform(
                F.array_sort(
                    F.collect_list(F.when(F.col("kind") == kind, F.struct("seq", "pattern")))
                ),
                lambda entry: entry["pattern"],
            ).alias(f"new_{kind}")
            for kind in (APP, URL)
        ]
    )

    def extended(stored: str, new: str) -> Column:
        old = F.coalesce(stored, F.array().cast("array<string>"))
        fresh = F.array_except(F.coalesce(new, F.array().cast("array<string>")), old)
        return F.concat(old, fresh).alias(stored)

    return category_patterns.join(listed, "category_id", "left").select(
        "category_id",
        "category",
        extended("app_patterns", f"new_{APP}"),
        extended("domain_patterns", f"new_{URL}"),
        "ord",
    )


def list_categories(category_patterns: DataFrame) -> DataFrame:
    """One row per document: a category in two documents is listed twice."""
    return category_patterns.select("category")


def category_to_id(category_patterns: DataFrame) -> DataFrame:
    last = category_patterns.groupBy("category").agg(
        F.max(F.struct("ord", "category_id")).alias("last")
    )
    return last.select("category", F.col("last.category_id").alias("category_id"))


def id_to_category(category_patterns: DataFrame) -> DataFrame:
    return category_patterns.select(F.lower("category_id").alias("category_id"), "category")
