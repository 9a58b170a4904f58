"""The corpus pipeline: from raw documents to token files, one operator per stage.

Every stage gets all rows that its predecessor kept and returns the columns of ``documents``, but the last,
which returns the token rows. Extra columns pass through unchanged, whatever their names.
Decisions are made for rows: a stage numbers its rows first, so rows without an id, and rows that share one, are
judged each by its own text. Empty in, empty out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.llm import decontaminate, mixing, quality, queries, simhash, tokens
from tallyboard.llm.common import stored, table
from tallyboard.session import configure, new_run_dir

QUALITY_THRESHOLD = 0.3


def _named(documents: DataFrame) -> list:
    return [F.col(f"`{name}`") for name in documents.columns]


def _keyed(docs: DataFrame) -> DataFrame:
    """(key, row, doc_id, text, source): the rows with a number of their own.

    That is the doc_id, if every row has one and no two share it; else the rows are numbered and written once, so that the numbers stay.
    """
    row = F.struct(*_named(docs)).alias("row")
    columns = ["key", "row", "row.doc_id", "row.text", "row.source"]
    unclear = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if unclear.isEmpty():
        return docs.select(row, F.col("doc_id").cast("long").alias("key")).select(*columns)
    return stored(docs.select(row, F.monotonically_increasing_id().alias("key")), "keyed").select(*columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject. A null text is judged as an empty one."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select(F.struct(*_named(docs)).alias("row"), F.col("text").alias("body")), model, "body")
    return scored.where(F.col("quality_score") >= QUALITY_THRESHOLD).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id; a row without an id only where no row has one."""
    rows = _keyed(docs)
    found = simhash.near_duplicates(rows.select(F.col("key").alias("doc_id"), "text"))
    groups = stored(found.select(F.col("doc_id").alias("key"), F.col("component_id").alias("group")), "groups")
    sizes = groups.groupBy("group").count().where("count > 1")
    # Only rows of groups with several meet here, as numbers; a group's least row is found before any shuffle.
    crowd = groups.join(sizes, "group", "left_semi").join(rows.select("key", "doc_id"), "key")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    kept = crowd.groupBy("group").agg(F.min(order).alias("least")).select("least.key")
    dropped = stored(crowd.select("key").join(kept, "key", "left_anti"), "dropped")
    return rows.join(dropped, "key", "left_anti").select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage. Items of a word or two are no passages: clean documents hold them too."""
    rows = _keyed(docs)
    bodies = rows.select(F.col("key").alias("doc_id"), "text")
    found = decontaminate.contaminated(bodies, table(spark, sf_dir, "benchmark"), short_items=False)
    dropped = stored(found.select(F.col("doc_id").alias("key")).distinct(), "contaminated")
    return rows.join(dropped, "key", "left_anti").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix draws it (none, once or twice), in the order of the mix's shards."""
    rows = _keyed(docs)
    mixed = mixing.mix(rows, doc_id="key")
    named = mixed.documents.select("place", F.col("doc_id").alias("drawn_key"))
    drawn = mixed.draws.join(named, "place").select("drawn_key", "shard", "order")
    joined = rows.join(drawn, F.col("key") == F.col("drawn_key")).select("row", "shard", "order")
    return joined.repartitionByRange("shard", "order").sortWithinPartitions("shard", "order").select("row.*")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token rows read back from the files: doc_id, start, n_tokens, ids; in a shuffled order, copies side by side."""
    path = new_run_dir(spark, "tokens")
    tokens.write_tokens(docs, path, queries.default_tokenizer(), order=F.xxhash64("doc_id", "text"))
    return tokens.read_tokens(spark, path)


STAGES = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("token_output", write_tokens),
]

#: Fitted rules, Hamming links and tokenizers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
