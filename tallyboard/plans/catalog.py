"""The registered queries: one per operator, over the whole given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.functions import keys
from tallyboard.functions.periods import board_day, board_key, day_period, month_period, week_period
from tallyboard.operators import classify as cl
from tallyboard.operators import leaderboard as lb
from tallyboard.operators import patterns as pt
from tallyboard.operators import records as rec
from tallyboard.operators.labelling import attempt_labels, last_attempts
from tallyboard.operators.lookup import BroadcastBound
from tallyboard.operators.sessions import session_events, session_scores
from tallyboard.plans import inputs
from tallyboard.schemas import DAILY_TOTALS, LABEL_ATTEMPTS, MESSAGES
from tallyboard.session import configure, new_run_dir, stored
from tallyboard.sources.messages import normalize, without_repeats_bounded
from tallyboard.sources.tables import PatternStore, read_batches, write_batch
from tallyboard.sources.versioned import with_id_part
from tallyboard.streaming import live
from tallyboard.streaming import pipeline as pl

Query = Callable[[SparkSession, str], DataFrame]

TOP = 10

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register ``function`` under its own name, with the session settings applied."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    _QUERIES[function.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _classified(spark: SparkSession, sf_dir: str, labels: bool = False) -> DataFrame:
    learned = inputs.learned_labels(spark, sf_dir) if labels else None
    return cl.classify(inputs.messages(spark, sf_dir), inputs.category_patterns(spark), learned)


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lb.leaderboard_entries(_classified(spark, sf_dir))


# ---- Messages ---------------------------------------------------------------


@query
def normalize_messages(spark, sf_dir):
    return normalize(inputs.raw_messages(spark, sf_dir))


@query
def stream_ingest(spark, sf_dir):
    run = new_run_dir(spark, "ingest")
    stream = normalize(inputs.stream_raw_messages(spark, sf_dir))
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{run}/checkpoint")
    writer.trigger(availableNow=True).start(f"{run}/messages").awaitTermination()
    return spark.read.schema(MESSAGES).parquet(f"{run}/messages")


@query
def session_score_events(spark, sf_dir):
    return session_scores(inputs.messages(spark, sf_dir))


@query
def period_keys(spark, sf_dir):
    # Moved back by up to ten years, to meet every kind of year end.
    moved = F.col("ts_epoch") - (F.col("seq") % 3650) * 86400
    days = inputs.messages(spark, sf_dir).select("seq", board_day(moved).alias("day"))
    board = F.lit("Design")
    return days.select(
        "seq",
        board_key(board, day_period(F.col("day"))).alias("day_key"),
        board_key(board, week_period(F.col("day"))).alias("week_key"),
        board_key(board, month_period(F.col("day"))).alias("month_key"),
    )


# ---- Dictionary -------------------------------------------------------------


@query
def pattern_dictionary(spark, sf_dir):
    return pt.pattern_dictionary(inputs.site_patterns(spark, sf_dir))


@query
def pattern_dedup(spark, sf_dir):
    return pt.effective_patterns(pt.pattern_dictionary(inputs.site_patterns(spark, sf_dir)))


@query
def pattern_unmatchable(spark, sf_dir):
    dictionary = pt.pattern_dictionary(inputs.site_patterns(spark, sf_dir))
    return pt.unmatchable_patterns(dictionary).select("category_id", "kind", "pos", "pattern", "reason")


@query
def pattern_add(spark, sf_dir):
    extended = pt.add_patterns(
        inputs.site_patterns(spark, sf_dir), inputs.pattern_additions(spark, sf_dir)
    )
    return extended.select(
        "category_id",
        F.array_join("app_patterns", "|").alias("app_patterns"),
        F.array_join("domain_patterns", "|").alias("domain_patterns"),
    )


@query
def pattern_add_rows(spark, sf_dir):
    extended = pt.add_pattern_rows(
        inputs.site_patterns(spark, sf_dir), inputs.pattern_additions(spark, sf_dir)
    )
    return extended.select("category_id", "kind", "pos", "pattern")


@query
def dictionary_counters(spark, sf_dir):
    return pt.dictionary_counters(inputs.site_patterns(spark, sf_dir))


@query
def list_categories(spark, sf_dir):
    return pt.list_categories(inputs.site_patterns(spark, sf_dir))


@query
def category_to_id(spark, sf_dir):
    return pt.category_to_id(inputs.site_patterns(spark, sf_dir))


@query
def id_to_category(spark, sf_dir):
    return pt.id_to_category(inputs.site_patterns(spark, sf_dir))


# ---- Classification ---------------------------------------------------------


@query
def classify_app(spark, sf_dir):
    messages = inputs.messages(spark, sf_dir)
    return cl.classify_app(messages, inputs.category_patterns(spark)).select("seq", "app", "app_category")


@query
def classify_url(spark, sf_dir):
    messages = inputs.messages(spark, sf_dir)
    return cl.classify_url(messages, inputs.category_patterns(spark)).select("seq", "url", "url_category")


@query
def classify_url_sites(spark, sf_dir):
    """A dictionary too long for one expression."""
    messages = inputs.messages(spark, sf_dir)
    sites = inputs.site_patterns(spark, sf_dir)
    return cl.classify_url(messages, sites).select("seq", "url", "url_category")


@query
def classify_url_sites_join(spark, sf_dir):
    """The same, asking for the equi-join that serves a dictionary of any size."""
    messages = inputs.messages(spark, sf_dir)
    sites = inputs.site_patterns(spark, sf_dir)
    return cl.classify_url(messages, sites, cl.JOIN).select("seq", "url", "url_category")


@query
def classify_label_lookup(spark, sf_dir):
    messages = inputs.messages(spark, sf_dir)
    labelled = cl.with_label_category(messages, inputs.learned_labels(spark, sf_dir))
    return labelled.select("seq", "label_category")


@query
def classification_query_key(spark, sf_dir):
    key = keys.label_query(F.col("app"), F.col("title"), F.col("url"))
    return inputs.messages(spark, sf_dir).select("seq", key.alias("query"))


@query
def label_prompt(spark, sf_dir):
    title = F.when(F.col("seq") % 5 == 0, "").otherwise(F.col("title"))
    url = F.when(F.col("seq") % 7 == 0, "").otherwise(F.col("url"))
    return inputs.messages(spark, sf_dir).select("seq", keys.label_prompt(F.col("app"), title, url).alias("prompt"))


@query
def label_validate(spark, sf_dir):
    answers = inputs.labeller_answers(spark, sf_dir)
    return answers.select("page_id", keys.validated_label(F.col("answer")).alias("label"))


@query
def classify_usage(spark, sf_dir):
    classified = _classified(spark, sf_dir, labels=True)
    return classified.select("seq", "app", "url", "title", "category", "method", "is_llm")


def _classified_sites(spark: SparkSession, sf_dir: str, bound: BroadcastBound | None = None) -> DataFrame:
    sites, labels = inputs.site_patterns(spark, sf_dir), inputs.learned_labels(spark, sf_dir)
    classified = cl.classify(inputs.messages(spark, sf_dir), sites, labels, bound=bound)
    return classified.select("seq", "app", "url", "title", "category", "method", "is_llm")


@query
def classify_usage_sites(spark, sf_dir):
    """The cascade with a dictionary that grows with the pages."""
    return _classified_sites(spark, sf_dir)


@query
def classify_usage_sites_unbounded(spark, sf_dir):
    """The same as if neither dictionary nor labels could be broadcast."""
    return _classified_sites(spark, sf_dir, BroadcastBound(rows=0, text_bytes=0))


@query
def classification_method_counts(spark, sf_dir):
    classified = _classified(spark, sf_dir, labels=True)
    return classified.groupBy("method", "is_llm", "category").agg(F.count(F.lit(1)).alias("messages"))


@query
def unresolved_keys(spark, sf_dir):
    return cl.unresolved_keys(_classified(spark, sf_dir, labels=True))


@query
def attach_category_id(spark, sf_dir):
    classified = _classified(spark, sf_dir, labels=True)
    with_id = cl.attach_category_id(classified, inputs.category_patterns(spark))
    return with_id.select("seq", "category", "category_id")


@query
def work_usage(spark, sf_dir):
    work = _entries(spark, sf_dir).where(lb.is_work(F.col("category")))
    return work.groupBy("category").agg(
        F.count(F.lit(1)).alias("messages"),
        lb.total(F.col("duration")).alias("total_duration"),
    )


# ---- Leaderboards -----------------------------------------------------------


@query
def leaderboard(spark, sf_dir):
    return lb.leaderboard(_entries(spark, sf_dir))


@query
def leaderboard_fanout(spark, sf_dir):
    return lb.fan_out(lb.daily_totals(_entries(spark, sf_dir)))


@query
def leaderboard_delta_rollup(spark, sf_dir):
    root = new_run_dir(spark, "deltas")
    classified = _classified(spark, sf_dir)
    for batch_id in (0, 1, 2, 1):  # batch 1 runs twice
        part = classified.where(F.col("seq") % 3 == batch_id)
        deltas = lb.daily_totals(lb.leaderboard_entries(part))
        write_batch(deltas, root, batch_id)
    return lb.merge_deltas(read_batches(spark, root, DAILY_TOTALS))


@query
def leaderboard_rank(spark, sf_dir):
    return lb.rank_all(lb.leaderboard(_entries(spark, sf_dir)))


@query
def leaderboard_topk(spark, sf_dir):
    return lb.top_k(lb.leaderboard(_entries(spark, sf_dir)), TOP)


@query
def leaderboard_user_rank(spark, sf_dir):
    """The ranks of every hundredth user on each of their boards, among all users."""
    board = stored(lb.leaderboard(_entries(spark, sf_dir)), "board")
    return lb.user_ranks(board, board.where(F.col("user_id").cast("bigint") % 100 == 0))


@query
def usage_by_period(spark, sf_dir):
    return lb.usage_by_period(_entries(spark, sf_dir))


# ---- Stored records ---------------------------------------------------------


@query
def usage_log_insert(spark, sf_dir):
    return rec.usage_log_insert(inputs.logs_to_insert(spark, sf_dir))


@query
def usage_log_construct(spark, sf_dir):
    return rec.usage_log_insert(rec.new_usage_logs(inputs.messages(spark, sf_dir)))


@query
def categorized_insert(spark, sf_dir):
    return rec.new_categorized_data(inputs.messages(spark, sf_dir))


@query
def usage_log_by_session(spark, sf_dir):
    """The first log of every user's session."""
    return rec.first_usage_logs(inputs.usage_logs(spark, sf_dir))


@query
def categorized_by_key(spark, sf_dir):
    return rec.first_categorized(inputs.categorized_data(spark, sf_dir))


@query
def categorized_find_many(spark, sf_dir):
    return rec.find_many(inputs.categorized_data(spark, sf_dir), inputs.messages(spark, sf_dir))


@query
def categorized_new_keys(spark, sf_dir):
    return rec.new_keys(inputs.messages(spark, sf_dir), inputs.categorized_data(spark, sf_dir))


@query
def latest_category_per_id(spark, sf_dir):
    # A different value with every message, so that arrival order shows.
    changing = inputs.messages(spark, sf_dir).withColumn("category_id", inputs.hex_id(F.col("seq") % 9 + 1))
    return rec.latest_per_id(changing, "categorized_data_id", "category_id")


def _category_updates(spark: SparkSession, sf_dir: str, record_id: str) -> DataFrame:
    with_id = cl.attach_category_id(_classified(spark, sf_dir), inputs.category_patterns(spark))
    return rec.latest_per_id(with_id, record_id, "category_id")


@query
def usage_log_set_category(spark, sf_dir):
    logs = inputs.usage_logs(spark, sf_dir)
    return rec.set_usage_log_category(logs, _category_updates(spark, sf_dir, "usage_log_id"))


@query
def categorized_set_category(spark, sf_dir):
    stored = inputs.categorized_data(spark, sf_dir)
    return rec.set_categorized_category(stored, _category_updates(spark, sf_dir, "categorized_data_id"))


@query
def usage_log_set_categorized(spark, sf_dir):
    key = [F.col(c) for c in rec.NATURAL_KEY]
    moved = inputs.messages(spark, sf_dir).withColumn("categorized_data_id", keys.derived_id(*key))
    updates = rec.latest_per_id(moved, "usage_log_id", "categorized_data_id")
    return rec.set_usage_log_categorized(inputs.usage_logs(spark, sf_dir), updates)


@query
def matched_updates(spark, sf_dir):
    logs = inputs.usage_logs(spark, sf_dir)
    hits = rec.matched_updates(logs, "usage_log_id", _category_updates(spark, sf_dir, "usage_log_id"))
    return hits.select("record_id", "category_id")


@query
def update_counters(spark, sf_dir):
    logs = inputs.usage_logs(spark, sf_dir)
    updates = _category_updates(spark, sf_dir, "usage_log_id")
    return rec.update_counts(logs, "usage_log_id", "category_id", updates)


@query
def usage_log_publish(spark, sf_dir):
    """The same, written back: two versions of the stored table, the second with the categories; its batch runs twice."""
    logs = pl.usage_log_table(new_run_dir(spark, "logs"))
    logs.publish(spark, 0, appended=inputs.usage_logs(spark, sf_dir))
    with_id = cl.attach_category_id(_classified(spark, sf_dir), inputs.category_patterns(spark))
    updates = rec.latest_per_id(with_id, "usage_log_id", "category_id", ["session_date"])
    for _ in range(2):
        logs.publish(spark, 1, updates=updates, target="category_id")
    return logs.read(spark)


@query
def usage_log_append(spark, sf_dir):
    """Three appends that overlap, the last one tried again as another batch: every log is stored once."""
    logs = pl.usage_log_table(new_run_dir(spark, "logs"))
    messages = inputs.messages(spark, sf_dir)
    shares = ["seq % 3 <> 0", "seq % 2 = 0", "true", "true"]
    for version, share in enumerate(shares):
        logs.publish(spark, version, appended=rec.usage_log_insert(rec.new_usage_logs(messages.where(share))))
    return logs.read(spark)


@query
def categorized_publish(spark, sf_dir):
    """Stored keys by a hash of their id, with the categories written back."""
    keys_ = pl.categorized_table(new_run_dir(spark, "keys"))
    keys_.publish(spark, 0, appended=with_id_part(inputs.categorized_data(spark, sf_dir), "categorized_data_id"))
    with_id = cl.attach_category_id(_classified(spark, sf_dir), inputs.category_patterns(spark))
    pl.publish_categorized(keys_, 1, with_id)
    return keys_.read(spark).drop("part")


@query
def usage_log_set_category_upper(spark, sf_dir):
    """Stored ids in capitals get the updates of the same ids in small letters."""
    logs = inputs.usage_logs(spark, sf_dir).withColumn("usage_log_id", F.upper("usage_log_id"))
    return rec.set_usage_log_category(logs, _category_updates(spark, sf_dir, "usage_log_id"))


# ---- Streaming --------------------------------------------------------------


def _streamed(spark: SparkSession, sf_dir: str) -> pl.Sinks:
    """Run the whole job once over the events as a stream."""
    sinks = pl.Sinks(new_run_dir(spark, "stream"))
    job = pl.UsageJob(
        sinks,
        load_patterns=lambda: inputs.category_patterns(spark),
        load_labels=lambda: inputs.learned_labels(spark, sf_dir),
    )
    job.run_available(inputs.stream_raw_messages(spark, sf_dir))
    return sinks


@query
def stream_end_to_end(spark, sf_dir):
    return pl.current_leaderboard(spark, _streamed(spark, sf_dir))


@query
def stream_after_fold(spark, sf_dir):
    """Three batches, each folded by the one after it."""
    sinks = pl.Sinks(new_run_dir(spark, "folded"))
    job = pl.UsageJob(
        sinks,
        load_patterns=lambda: inputs.category_patterns(spark),
        load_labels=lambda: inputs.learned_labels(spark, sf_dir),
        fold_every=1,
    )
    raw = inputs.raw_messages(spark, sf_dir)
    for batch_id in range(3):
        job.process(raw.where(F.col("seq") % 3 == batch_id), batch_id)
    return pl.current_leaderboard(spark, sinks)


@query
def leaderboard_closed_days(spark, sf_dir):
    """Four batches; days are closed after the second and the third, and messages for closed days come later."""
    sinks = pl.Sinks(new_run_dir(spark, "closed"))
    job = pl.UsageJob(
        sinks,
        load_patterns=lambda: inputs.category_patterns(spark),
        load_labels=lambda: inputs.learned_labels(spark, sf_dir),
        fold_every=2,
    )
    raw = inputs.raw_messages(spark, sf_dir)
    for batch_id in range(4):
        job.process(raw.where(F.col("seq") % 4 == batch_id), batch_id)
        if batch_id in (1, 2):
            pl.close_days(spark, sinks, dt.date(2024, 1, 8 * batch_id))
    return pl.current_leaderboard(spark, sinks)


@query
def stream_drop_repeats(spark, sf_dir):
    """Two batches in which three messages share an id; those without a valid one all count."""
    sinks = pl.Sinks(new_run_dir(spark, "repeats"))
    job = pl.UsageJob(sinks, load_patterns=lambda: inputs.category_patterns(spark), drop_repeats=True)
    shared = inputs.hex_id(F.floor(F.col("seq") / 3).cast("bigint"))
    messages = normalize(inputs.raw_messages(spark, sf_dir))
    messages = messages.withColumn("usage_log_id", F.when(keys.valid_id(F.col("usage_log_id")), shared).otherwise(""))
    for batch_id in range(2):
        job.process_messages(messages.where(F.col("seq") % 2 == batch_id), batch_id)
    return pl.current_leaderboard(spark, sinks)


@query
def stream_drop_repeats_bounded(spark, sf_dir):
    """The ids left of a stream in which three messages share each, by the state of recent ids alone."""
    run = new_run_dir(spark, "bounded")
    messages = normalize(inputs.stream_raw_messages(spark, sf_dir))
    shared = inputs.hex_id(F.floor(F.col("seq") / 3).cast("bigint"))
    valid = keys.valid_id(F.col("usage_log_id"))
    marked = messages.withColumn("usage_log_id", F.when(valid, shared).otherwise(F.col("usage_log_id")))
    fresh = without_repeats_bounded(marked, "4000 days")
    ids = fresh.select("usage_log_id", F.when(~keys.valid_id(F.col("usage_log_id")), F.col("seq")).alias("unnamed_seq"))
    writer = ids.writeStream.format("parquet").option("checkpointLocation", f"{run}/checkpoint").option("path", f"{run}/ids")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("usage_log_id string, unnamed_seq long").parquet(f"{run}/ids")


@query
def stream_row_bound(spark, sf_dir):
    """One file as batches of at most 5,000 messages."""
    sinks = pl.Sinks(new_run_dir(spark, "rows"))
    job = pl.UsageJob(
        sinks,
        load_patterns=lambda: inputs.category_patterns(spark),
        load_labels=lambda: inputs.learned_labels(spark, sf_dir),
        most_rows=5_000,
    )
    job.run_available(inputs.stream_raw_messages(spark, sf_dir))
    sizes = pl.current_metrics(spark, sinks).groupBy("batch_id").agg(F.sum("messages").alias("n"))
    assert sizes.where("n > 5000").isEmpty()
    return pl.current_leaderboard(spark, sinks)


@query
def stream_usage_by_period(spark, sf_dir):
    """Each day, week and month of a stream, given out as it closes; a message of another source, long after, closes the last."""
    run = new_run_dir(spark, "periods")
    messages = normalize(inputs.stream_raw_messages(spark, sf_dir))
    inputs.closing_message(spark, sf_dir).select(*messages.columns).write.parquet(f"{run}/closing")
    closing = spark.readStream.schema(messages.schema).parquet(f"{run}/closing")
    classified = cl.classify(messages.unionByName(closing), inputs.category_patterns(spark))
    writer = live.live_usage_by_period(classified, "1 day").writeStream.format("parquet")
    writer = writer.option("checkpointLocation", f"{run}/checkpoint").option("path", f"{run}/usage")
    with live.keyed_state(spark):
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(live.PERIOD_USAGE).parquet(f"{run}/usage")


@query
def stream_sessions_sent(spark, sf_dir):
    """The session records handed on after each of three batches, the second of which runs twice."""
    sinks, out = pl.Sinks(new_run_dir(spark, "outbox")), new_run_dir(spark, "sent")
    job = pl.UsageJob(sinks, load_patterns=lambda: inputs.category_patterns(spark))
    raw = inputs.raw_messages(spark, sf_dir)
    for batch_id in (0, 1, 1, 2):
        job.process(raw.where(F.col("seq") % 3 == batch_id), batch_id)
        for _ in range(2):
            pl.send_sessions(spark, sinks, lambda events: session_events(events).write.mode("append").parquet(out))
    return spark.read.parquet(out).select("key", "value")


def _rehearsed(prompts):
    """A labeller by the page number in the title: some raise, some have no answer."""
    pages = [int(prompt.split("Title: Page ")[1].split("\n")[0]) for prompt in prompts]
    if any(page % 7 == 3 for page in pages):
        raise RuntimeError("no connection")
    return [None if page % 5 == 4 else "Game" if page % 2 else " Music " for page in pages]


@query
def label_attempts(spark, sf_dir):
    """The ledger after three runs over the keys that no stage resolves."""
    open_keys = stored(cl.unresolved_keys(_classified(spark, sf_dir, labels=True)), "open")
    root = new_run_dir(spark, "attempts")
    for run in range(3):
        earlier = read_batches(spark, root, LABEL_ATTEMPTS).drop("batch_id")
        write_batch(attempt_labels(open_keys, earlier, _rehearsed, most_tries=2), root, run)
    return last_attempts(read_batches(spark, root, LABEL_ATTEMPTS).drop("batch_id"))


@query
def stream_usage_logs(spark, sf_dir):
    logs = inputs.usage_logs(spark, sf_dir)
    return pl.current_usage_logs(spark, logs, _streamed(spark, sf_dir))


@query
def stream_session_scores(spark, sf_dir):
    return pl.current_session_scores(spark, _streamed(spark, sf_dir)).drop("batch_id")


@query
def stream_open_keys(spark, sf_dir):
    """Keys the stream could not resolve and nobody has answered yet."""
    sinks = _streamed(spark, sf_dir)
    return pl.open_keys(spark, sinks, inputs.learned_labels(spark, sf_dir)).select("query", "prompt")


@query
def batch_metrics(spark, sf_dir):
    return pl.current_metrics(spark, _streamed(spark, sf_dir)).drop("batch_id")


@query
def refresh_mapping(spark, sf_dir):
    """Three batches; before the last every category document gets a new id, which only that one sees."""
    sinks = pl.Sinks(new_run_dir(spark, "refresh"))
    store = PatternStore(f"{sinks.root}/patterns")
    patterns = inputs.category_patterns(spark)
    store.publish(patterns, 1)
    job = pl.UsageJob(sinks, patterns=store)
    messages = inputs.messages(spark, sf_dir)
    job.process_messages(messages.where("seq % 4 = 0"), 0)
    job.process_messages(messages.where("seq % 4 = 2"), 1)
    store.publish(patterns.withColumn("category_id", inputs.hex_id(F.col("ord") + 100)), 2)
    job.process_messages(messages.where("seq % 2 = 1"), 2)
    return pl.current_updates(spark, sinks).select("record_id", "category_id")
