"""Quality classifier: rules over text statistics, compiled to one Spark expression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import WHITE, text_or_empty
from tallyboard.llm.labels import SAMPLE_ROWS, held_out, training_ids, training_rows
from tallyboard.llm.rules import RuleEnsemble, fit_rules

FEATURES = (
    "s_chars",
    "s_words",
    "s_word_length",
    "s_distinct_words",
    "s_repeated_neighbours",
    "s_upper",
    "s_letters",
    "s_digits",
    "s_odd_marks",
    "s_exclamations",
    "s_bars",
    "s_stops",
    "s_distinct_lines",
    "s_words_per_line",
)


def with_statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` plus the columns FEATURES, all computed over whole texts."""
    named = documents.withColumn("s_text", text_or_empty(text))
    spaced = F.trim(F.translate("s_text", WHITE, " " * len(WHITE)))
    parts = named.withColumns(
        {
            "s_list": F.filter(F.split(spaced, " +"), lambda w: w != ""),
            "s_rows": F.split("s_text", "\n"),
            "s_chars": F.char_length("s_text").cast("double"),
        }
    )
    per = F.greatest(F.col("s_chars"), F.lit(1.0))

    def without(pattern: str):
        return F.char_length(F.regexp_replace("s_text", pattern, "")).cast("double") / per

    def share(characters: str):
        return (F.col("s_chars") - F.char_length(F.translate("s_text", characters, ""))) / per

    size = F.size("s_list").cast("double")
    words = F.greatest(size, F.lit(1.0))
    rest = F.size("s_list") - 1
    same = F.when(
        rest > 0,
        F.size(
            F.filter(
                F.zip_with(F.slice("s_list", 1, rest), F.slice("s_list", 2, rest), lambda a, b: a == b),
                lambda x: x,
            )
        ),
    ).otherwise(0)
    return parts.withColumns(
        {
            "s_words": size,
            "s_word_length": F.col("s_chars") / words,
            "s_distinct_words": F.size(F.array_distinct("s_list")) / words,
            "s_repeated_neighbours": same / words,
            "s_upper": without(r"[^\p{Lu}]+"),
            "s_letters": without(r"[^\p{L}]+"),
            "s_digits": share("0123456789"),
            "s_odd_marks": without(r"[\p{L}\p{N}\s.,;:'\"()?!|-]+"),
            "s_exclamations": share("!"),
            "s_bars": share("|"),
            "s_stops": share("."),
            "s_distinct_lines": F.size(F.array_distinct("s_rows")) / F.size("s_rows"),
            "s_words_per_line": words / F.size("s_rows"),
        }
    ).drop("s_text", "s_list", "s_rows")


def fit(
    documents: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", rows: int = SAMPLE_ROWS
) -> RuleEnsemble:
    """A rule ensemble learned from at most ``rows`` labelled documents; held-out ones are never among them."""
    chosen = training_rows(
        documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")),
        training_ids(labels, "quality", rows),
    )
    # Of rows that repeat an id the one with the least statistics teaches, the same one every time.
    one = with_statistics(chosen).groupBy("doc_id").agg(F.min(F.struct("y", *FEATURES)).alias("row"))
    table = one.select("doc_id", "row.*").toPandas()
    table = table.sort_values("doc_id")  # the same sums in the same order every time
    x = table[list(FEATURES)].to_numpy(np.float64)
    return fit_rules(x, table["y"].to_numpy(np.float64), FEATURES)


def score(documents: DataFrame, model: RuleEnsemble, text: str = "text") -> DataFrame:
    """``documents`` plus quality_score (0 to 1). A null text has the statistics of an empty one.

    Columns of the input keep their values, whatever their names but quality_score; repeated rows score alike.
    """
    kept = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("s_row")
    packed = documents.select(kept, F.col(text).alias("s_body"))
    scored = with_statistics(packed, "s_body").withColumn("quality_score", model.column())
    return scored.select("s_row.*", "quality_score")


def quality_scores(
    documents: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = 0.3
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. No label to learn from: every score is 0.5."""
    model = fit(documents, labels, text, doc_id)
    narrow = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return score(narrow, model).select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= threshold).cast("int").alias("predicted"),
    )
