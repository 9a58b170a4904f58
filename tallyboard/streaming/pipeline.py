"""The streaming job: raw messages in, result tables and a metrics table out.

A batch counts once its metrics are there: they are written last, and readers look at
such batches only. Older batches are folded into one snapshot per table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyboard.functions.keys import valid_id
from tallyboard.functions.periods import period_days
from tallyboard.operators.classify import Dictionary, attach_category_id, classify, prepared, unresolved_keys
from tallyboard.operators.labelling import Labeller, answers, attempt_labels
from tallyboard.operators.leaderboard import (
    daily_totals,
    excluded_entry,
    leaderboard_entries,
    merge_deltas,
    merged_days,
)
from tallyboard.operators.records import by_id, latest_per_id, new_usage_logs, set_by_id, update_counts, usage_log_insert
from tallyboard.operators.sessions import session_outbox, write_session_events
from tallyboard.schemas import (
    BATCH_METRICS,
    CATEGORIZED_PARTED,
    CATEGORY_UPDATES,
    DAILY_TOTALS,
    FOLDS,
    LABEL_ATTEMPTS,
    OPEN_KEYS,
    SEEN_IDS,
    SENT,
    SESSION_OUTBOX,
    UPDATE_COUNTS,
    USAGE_LOGS,
)
from tallyboard.session import configure, remove_path, scratch_scope, side_by_side, stored
from tallyboard.sources.messages import normalize, row_ranges, without_repeats
from tallyboard.sources.tables import PatternStore, read_batches, stored_batches, write_batch, write_batches, write_snapshot
from tallyboard.sources.versioned import Published, VersionedTable, with_id_part

#: Tables that lie in folders by a column, so that a reader of some days opens no others.
PARTED = {"leaderboard_deltas": "day"}

#: The tables of a job and their schemas; the metrics come last.
TABLES = {
    "usage_log_updates": CATEGORY_UPDATES,
    "categorized_updates": CATEGORY_UPDATES,
    "leaderboard_deltas": DAILY_TOTALS,
    "session_scores": SESSION_OUTBOX,
    "to_label": OPEN_KEYS,
    "seen_ids": SEEN_IDS,
    "update_counts": UPDATE_COUNTS,
    "metrics": BATCH_METRICS,
}


@dataclass(frozen=True)
class Sinks:
    """Where a job writes. One folder per table, one sub-folder per micro-batch."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def metrics(self) -> str:
        return self.table("metrics")

    @property
    def folds(self) -> str:
        return self.table("folds")

    @property
    def checkpoint(self) -> str:
        return self.table("checkpoint")

    @property
    def closed_days(self) -> VersionedTable:
        """Final sums of days, by day."""
        return VersionedTable(self.table("closed_days"), DAILY_TOTALS, "user_id", "day", sort="user_id")


@dataclass(frozen=True)
class UsageJob:
    """What one micro-batch does.

    The loaders run at the start of every batch, so a changed dictionary or new
    labels apply from the next batch on without a restart. ``drop_repeats`` leaves out messages whose
    usage-log id an earlier message has. With ``load_usage_logs`` each batch also counts what its
    updates change there. ``fold_every`` batches, the ones before are folded.
    ``session_servers`` names brokers that get the session records too.

    ``patterns``, versions of the dictionary, take the place of ``load_patterns``: one that has not changed is not looked at again.
    A batch of more than ``most_rows`` messages is processed in runs of that many, as batches of their own; see ``part_id``. Runs that
    need nothing of each other are written together, up to MOST_AT_ONCE messages at a time: one job for each table, whose folders are still
    those of single runs. Where a run needs what the one before left in a stored table, it is processed by itself.

    ``usage_logs`` and ``categorized`` are stored tables that the job keeps: every batch publishes a version of each with its
    categories, and counts what they change there. With ``append_logs`` a message without a usage-log id gets a row in
    ``usage_logs``, and a key that is new a row in ``categorized``.
    """

    sinks: Sinks
    load_patterns: Callable[[], DataFrame] | None = None
    load_labels: Callable[[], DataFrame] | None = None
    load_usage_logs: Callable[[], DataFrame] | None = None
    drop_repeats: bool = False
    fold_every: int | None = None
    session_servers: str | None = None
    usage_logs: VersionedTable | None = None
    categorized: VersionedTable | None = None
    append_logs: bool = False
    patterns: PatternStore | None = None
    most_rows: int | None = None
    _known: dict[int, Dictionary] = field(default_factory=dict, repr=False, compare=False)

    def process(self, raw: DataFrame, batch_id: int) -> None:
        """Classify one batch and write every table.

        Each write replaces this batch's own folder. An error is raised, not
        swallowed: the batch then runs again from the checkpointed position.
        """
        self.process_messages(normalize(raw), batch_id)

    def process_messages(self, messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        if self.most_rows:
            with scratch_scope(spark):
                runs = row_ranges(messages, self.most_rows)
            self._process_runs(messages, batch_id, runs or [(0, 0)])
        else:
            self._process_part(messages, batch_id)
        if self.fold_every and batch_id and batch_id % self.fold_every == 0:
            # Batches before this one never run again.
            fold(spark, self.sinks, (part_id(batch_id, 0) if self.most_rows else batch_id) - 1)

    def _process_runs(self, messages: DataFrame, batch_id: int, runs: list[tuple[int, int]]) -> None:
        spark = messages.sparkSession
        numbers = [(part_id(batch_id, number), first, last) for number, (first, last) in enumerate(runs)]
        alone = self.usage_logs or self.categorized or self.load_usage_logs
        at_once = 1 if alone else max(1, min(MOST_RUNS, MOST_AT_ONCE // self.most_rows))
        for start in range(0, len(numbers), at_once):
            some = numbers[start : start + at_once]
            (run, first, _), (_, _, last) = some[0], some[-1]
            within = messages.where(F.col("seq").between(first, last))
            if len(some) == 1:
                self._process_part(within, run)
                continue
            limits = spark.createDataFrame(some, "batch_id long, run_first long, run_last long")
            among = F.col("seq").between(F.col("run_first"), F.col("run_last"))
            dealt = within.join(F.broadcast(limits), among).drop("run_first", "run_last")
            self._process_part(dealt, run, some[-1][0])

    def _process_part(self, messages: DataFrame, batch_id: int, upto: int | None = None) -> None:
        """One batch, or those from ``batch_id`` up to ``upto`` together, if ``messages`` say in a column ``batch_id`` which one is theirs."""
        spark = messages.sparkSession
        # A batch that runs again does not count until it is whole again.
        if upto is None:
            remove_path(spark, f"{self.sinks.metrics}/batch_id={batch_id}")
        else:
            for name in ("metrics", *TABLES):
                for again in stored_batches(spark, self.sinks.table(name)):
                    if batch_id <= again <= upto:
                        remove_path(spark, f"{self.sinks.table(name)}/batch_id={again}")
        with scratch_scope(spark):  # all that the batch needs is written by its end
            self._write_tables(messages, batch_id, upto)
        if self.session_servers:
            send_sessions(spark, self.sinks, lambda events: write_session_events(events, self.session_servers))

    def _dictionary(self, spark: SparkSession) -> Dictionary | DataFrame:
        if self.patterns is None:
            return self.load_patterns()
        version = self.patterns.version(spark)
        if version not in self._known:
            self._known.clear()
            self._known[version] = prepared(self.patterns.read(spark, version))
        return self._known[version]

    def _write_tables(self, messages: DataFrame, batch_id: int, upto: int | None = None) -> None:
        spark, sinks = messages.sparkSession, self.sinks
        patterns = self._dictionary(spark)
        labels = self.load_labels() if self.load_labels else None
        if self.drop_repeats:
            seen = batches(spark, sinks, "seen_ids").where(F.col("batch_id") < batch_id)
            messages = without_repeats(messages, seen)
        classified = attach_category_id(classify(messages, patterns, labels), patterns)
        # Read by all writes below. A lost block is computed again from the source.
        classified = classified.persist(StorageLevel.MEMORY_AND_DISK)

        by = [] if upto is None else ["batch_id"]

        def write(df: DataFrame, name: str) -> None:
            if by:
                write_batches(df, sinks.table(name), PARTED.get(name))
            else:
                write_batch(df, sinks.table(name), batch_id, PARTED.get(name))

        try:
            updates = latest_per_id(classified, "usage_log_id", "category_id", ["session_date"], by)
            write(updates.drop("session_date"), "usage_log_updates")
            # The first write has filled the cache.
            others = {
                "categorized_updates": latest_per_id(classified, "categorized_data_id", "category_id", by=by),
                "leaderboard_deltas": daily_totals(leaderboard_entries(classified, by), by=by),
                "session_scores": session_outbox(classified, by),
                "to_label": unresolved_keys(classified, by),
            }
            if self.drop_repeats:
                ids = classified.where(valid_id(F.col("usage_log_id")))
                others["seen_ids"] = ids.select(*by, F.lower("usage_log_id").alias("record_id")).distinct()
            side_by_side(spark, [partial(write, rows, name) for name, rows in others.items()])
            counts = None
            if self.usage_logs:
                counts = publish_usage_logs(self.usage_logs, batch_id, classified, updates, self.append_logs)
            if self.categorized:
                publish_categorized(self.categorized, batch_id, classified, self.append_logs)
            if self.load_usage_logs:
                write(update_counts(self.load_usage_logs(), "usage_log_id", "category_id", updates), "update_counts")
            elif counts:
                row = [(counts.updates, counts.matched, counts.modified, counts.no_op)]
                write(spark.createDataFrame(row, UPDATE_COUNTS), "update_counts")
            write(batch_metrics(classified, by), "metrics")
        finally:
            classified.unpersist()

    def start(
        self, raw_stream: DataFrame, interval: str | None = "2 seconds", normalized: bool = False
    ) -> StreamingQuery:
        """Run continuously, or over what is there now with ``interval=None``."""
        spark = configure(raw_stream.sparkSession)
        step = self.process_messages if normalized else self.process
        trigger = {"processingTime": interval} if interval else {"availableNow": True}
        return (
            raw_stream.writeStream.foreachBatch(step)
            .option("checkpointLocation", self.sinks.checkpoint)
            .trigger(**trigger)
            .start()
        )

    def run_available(self, raw_stream: DataFrame, normalized: bool = False) -> None:
        """Process everything available, then return; raises what a batch raised."""
        self.start(raw_stream, interval=None, normalized=normalized).awaitTermination()


#: Runs of one batch have numbers of their own within this many.
PARTS = 1_000_000
#: Runs are written together up to so many messages, and so many runs, as each message is compared with the limits of each.
MOST_AT_ONCE = 2_000_000
MOST_RUNS = 500


def part_id(batch_id: int, number: int) -> int:
    """The batch number of a run of a batch; the same runs get the same numbers when the batch runs again."""
    return batch_id * PARTS + number


def usage_log_table(root: str) -> VersionedTable:
    """Stored usage logs by session date."""
    return VersionedTable(root, USAGE_LOGS, "usage_log_id")


def categorized_table(root: str) -> VersionedTable:
    """Stored natural keys by a hash of their id."""
    return VersionedTable(root, CATEGORIZED_PARTED, "categorized_data_id", "part")


def publish_usage_logs(
    table: VersionedTable, version: int, classified: DataFrame, updates: DataFrame, append: bool = False
) -> Published | None:
    """A version of the stored logs with the categories of ``updates``; with ``append`` also a row for each message without an id."""
    spark = classified.sparkSession
    unnamed = classified.where(~valid_id(F.coalesce("usage_log_id", F.lit(""))))
    new = usage_log_insert(new_usage_logs(unnamed)) if append else None
    return table.publish(spark, version, new, updates, "category_id")


def publish_categorized(table: VersionedTable, version: int, classified: DataFrame, append: bool = False) -> Published | None:
    """A version of the stored keys with the batch's categories; with ``append`` also a row for each id that is new."""
    spark = classified.sparkSession
    updates = with_id_part(latest_per_id(classified, "categorized_data_id", "category_id"), "record_id")
    new = None
    if append:
        rows = classified.where(valid_id(F.col("categorized_data_id"))).select(
            "categorized_data_id", "app", "url", "title", "category_id", F.col("is_llm").alias("is_llm_based")
        )
        new = with_id_part(rows.distinct(), "categorized_data_id")
    return table.publish(spark, version, new, updates, "category_id")


def batch_metrics(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Messages per classification method, with the counts that explain missing output; ``by`` names further columns of the key."""

    return classified.groupBy(*by, "method").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(excluded_entry()).alias("excluded"),
        F.count_if(~valid_id(F.col("usage_log_id"))).alias("invalid_ids"),
        F.count_if(F.col("is_end")).alias("ended"),
    )


# ---- Reading the tables back ------------------------------------------------


def folds(spark: SparkSession, sinks: Sinks) -> list:
    """(batch_id, segment), a row per fold: the last batch it holds, and the name of its folders."""
    return read_batches(spark, sinks.folds, FOLDS).orderBy("batch_id").collect()


def _segment(sinks: Sinks, name: str, segment: str) -> str:
    return f"{sinks.root}/folded/{name}/segment={segment}"


def _segments(spark: SparkSession, sinks: Sinks, name: str, listed: list) -> DataFrame:
    kept = T.StructType([*TABLES[name].fields, T.StructField("batch_id", T.LongType())])
    if not listed:
        return spark.createDataFrame([], kept)
    full = T.StructType([*kept.fields, T.StructField("segment", T.StringType())])
    paths = [_segment(sinks, name, row.segment) for row in listed]
    found = spark.read.schema(full).option("basePath", f"{sinks.root}/folded/{name}").parquet(*paths)
    return found.select(*kept.fieldNames())


def _unfolded(spark: SparkSession, sinks: Sinks, name: str, after: int) -> DataFrame:
    """Rows of the finished batches after ``after``."""
    written = read_batches(spark, sinks.table(name), TABLES[name]).where(F.col("batch_id") > after)
    finished = read_batches(spark, sinks.metrics, BATCH_METRICS).where(F.col("batch_id") > after)
    return written.join(finished.select("batch_id").distinct(), "batch_id", "left_semi")


def batches(spark: SparkSession, sinks: Sinks, name: str) -> DataFrame:
    """A table's rows of all finished batches, with their ``batch_id``; what is folded has that of the fold."""
    listed = folds(spark, sinks)
    rows = _unfolded(spark, sinks, name, listed[-1].batch_id if listed else -1)
    return rows.unionByName(_segments(spark, sinks, name, listed)) if listed else rows


def _last_updates(rows: DataFrame) -> DataFrame:
    last = by_id(rows, "record_id").agg(F.max(F.struct("batch_id", "seq", "category_id")).alias("last"))
    return last.select("record_id", "last.category_id", "last.seq")


def fold(spark: SparkSession, sinks: Sinks, upto: int) -> str | None:
    """One segment per table of the finished batches up to ``upto`` that no fold holds yet; returns its name.

    The work is that of those batches, whatever came before. A fold counts once it is listed, which is the last thing
    written; one that is listed already is not made again (None). Batches of the fold before are then
    removed: a reader that began before this fold still finds its own files.
    """
    listed = folds(spark, sinks)
    after = listed[-1].batch_id if listed else -1
    if upto <= after:
        return None
    segment = f"{upto}-{uuid.uuid4().hex}"
    writes = []
    for name in TABLES:
        rows = _unfolded(spark, sinks, name, after).where(F.col("batch_id") <= upto)
        if name.endswith("_updates"):
            rows = _last_updates(rows)
        elif name == "leaderboard_deltas":
            rows = merged_days(rows.where(_open(*closed_upto(spark, sinks))))
        elif name in ("to_label", "seen_ids"):
            rows = rows.drop("batch_id").distinct()
        if "batch_id" not in rows.columns:
            rows = rows.withColumn("batch_id", F.lit(upto).cast("bigint"))
        writes.append(partial(write_snapshot, rows, _segment(sinks, name, segment), PARTED.get(name)))
    side_by_side(spark, writes)
    write_batch(spark.range(1).select(F.lit(segment).alias("segment")), sinks.folds, upto)
    _retire(spark, sinks, after)
    return segment


def _retire(spark: SparkSession, sinks: Sinks, upto: int) -> None:
    """Remove the batches up to ``upto``, which an earlier fold holds; as many as lie between two folds."""
    done = read_batches(spark, sinks.metrics, BATCH_METRICS).where(F.col("batch_id") <= upto)
    for row in done.select("batch_id").distinct().collect():
        for name in TABLES:
            remove_path(spark, f"{sinks.table(name)}/batch_id={row.batch_id}")


# ---- Closed days ----------------------------------------------------------------


def closed_upto(spark: SparkSession, sinks: Sinks) -> tuple[int, dt.date | None]:
    """(last batch, first open day): what the closed days hold is the days before that, of batches up to that."""
    table = sinks.closed_days
    notes = {row.kind: row.part for row in table.manifest(spark, table.version(spark))}
    return (int(notes["upto"]), dt.date.fromisoformat(notes["before"])) if "upto" in notes else (-1, None)


def _open(upto: int, before: dt.date | None) -> Column:
    """Deltas that the closed days do not hold; both columns are names of folders, so no other file is opened."""
    return F.lit(True) if before is None else (F.col("batch_id") > upto) | (F.col("day") >= F.lit(before))


def open_deltas(spark: SparkSession, sinks: Sinks) -> DataFrame:
    """The leaderboard deltas of open days, and late ones of closed days, with their ``batch_id``."""
    listed = folds(spark, sinks)
    rows = _unfolded(spark, sinks, "leaderboard_deltas", listed[-1].batch_id if listed else -1)
    upto, before = closed_upto(spark, sinks)  # after the deltas: days closed meanwhile are not missed
    early = [row for row in listed if row.batch_id <= upto]
    rows = rows.where(_open(upto, before))
    if early:
        rows = rows.unionByName(_segments(spark, sinks, "leaderboard_deltas", early).where(F.col("day") >= F.lit(before)))
    late = [row for row in listed if row.batch_id > upto]
    return rows.unionByName(_segments(spark, sinks, "leaderboard_deltas", late)) if late else rows


def close_days(spark: SparkSession, sinks: Sinks, before: dt.date) -> int | None:
    """Store the final sums of the days before ``before``; returns the number of days written, None if there was nothing to do.

    Runs beside the stream. A day is written when it is closed, and once more if messages for it came later; a day's
    rows are in order of users. Days once closed stay closed.
    """
    with scratch_scope(spark):
        upto, open_from = closed_upto(spark, sinks)
        before = max(before, open_from or before)
        new = open_deltas(spark, sinks).where(F.col("day") < F.lit(before))
        finished = batches(spark, sinks, "metrics").agg(F.max("batch_id")).first()[0]
        if finished is None or (finished <= upto and before == open_from):
            return None
        new = stored(new.where(F.col("batch_id") <= finished), "closing")
        days = {str(row.day) for row in new.select("day").distinct().collect()}
        table = sinks.closed_days
        kept = table.read(spark, table.version(spark), days)
        names = DAILY_TOTALS.fieldNames()
        sums = merged_days(kept.select(*names).unionByName(new.select(*names))).select(*names)
        table.replace_parts(spark, (table.version(spark) or 0) + 1, sums, {"upto": str(finished), "before": str(before)})
    return len(days)


def daily_sums(spark: SparkSession, sinks: Sinks, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Sums per (user, category, day), or parts of such sums, over all finished batches; ``first`` and ``last`` name the days wanted."""
    deltas = open_deltas(spark, sinks)
    table = sinks.closed_days
    version = table.version(spark)
    held = {row.part for row in table.manifest(spark, version) if row.kind == "data"}
    wanted = {d for d in held if (first is None or d >= str(first)) and (last is None or d <= str(last))}
    if first is not None:
        deltas = deltas.where(F.col("day") >= F.lit(first))
    if last is not None:
        deltas = deltas.where(F.col("day") <= F.lit(last))
    names = DAILY_TOTALS.fieldNames()
    return deltas.select(*names).unionByName(table.read(spark, version, wanted).select(*names))


def current_board(spark: SparkSession, sinks: Sinks, period_kind: str, period: str) -> DataFrame:
    """The boards of one period alone (as ``day`` ``2024-01-05``, ``week`` ``2024-W1`` or ``month`` ``2024-M1``); no other day is read."""
    first, last = period_days(period_kind, period)
    boards = merge_deltas(daily_sums(spark, sinks, first, last))
    return boards.where((F.col("period_kind") == period_kind) & (F.col("period") == period))


def current_leaderboard(spark: SparkSession, sinks: Sinks) -> DataFrame:
    """The leaderboard as of the last finished batch."""
    return merge_deltas(daily_sums(spark, sinks))


def current_updates(spark: SparkSession, sinks: Sinks, name: str = "usage_log_updates") -> DataFrame:
    """The last category written for each record, over all finished batches."""
    return _last_updates(batches(spark, sinks, name))


def current_usage_logs(spark: SparkSession, usage_logs: DataFrame, sinks: Sinks) -> DataFrame:
    """Stored usage logs with the categories the stream has set so far."""
    return set_by_id(usage_logs, "usage_log_id", "category_id", current_updates(spark, sinks))


def current_categorized(spark: SparkSession, categorized_data: DataFrame, sinks: Sinks) -> DataFrame:
    """Stored natural keys with the categories the stream has set so far."""
    updates = current_updates(spark, sinks, "categorized_updates")
    return set_by_id(categorized_data, "categorized_data_id", "category_id", updates)


def open_keys(spark: SparkSession, sinks: Sinks, learned_labels: DataFrame) -> DataFrame:
    """Keys some batch could not resolve and that have no answer yet, each once."""
    seen = batches(spark, sinks, "to_label").select(*OPEN_KEYS.fieldNames()).distinct()
    answered = learned_labels.where(F.col("label").isNotNull()).select("query").distinct()
    return seen.join(answered, "query", "left_anti")


def label_open_keys(
    spark: SparkSession, sinks: Sinks, labels_root: str, run_id: int, labeller: Labeller, load_labels: Callable[[], DataFrame]
) -> None:
    """Ask an external labeller for every open key that has tries left, and store its raw answers as one more label folder.

    Runs beside the stream, which sees the answers from its next batch on. The ledger of tries is written first; a run that is tried
    again under its number asks again and replaces its own rows.
    """
    root = sinks.table("label_attempts")
    earlier = read_batches(spark, root, LABEL_ATTEMPTS).where(F.col("batch_id") != run_id).drop("batch_id")
    write_batch(attempt_labels(open_keys(spark, sinks, load_labels()), earlier, labeller), root, run_id)
    made = read_batches(spark, root, LABEL_ATTEMPTS).where(F.col("batch_id") == run_id)
    write_batch(answers(made), labels_root, run_id)


def send_sessions(spark: SparkSession, sinks: Sinks, send: Callable[[DataFrame], None]) -> int:
    """Hand the session records of finished batches that were not sent yet to ``send``; returns the last batch sent.

    The position is noted after sending, so a failure in between sends those records again, with the event ids they had.
    """
    noted = read_batches(spark, sinks.table("sent"), SENT).agg(F.max("batch_id")).first()[0]
    sent = -1 if noted is None else noted
    last = batches(spark, sinks, "metrics").agg(F.max("batch_id")).first()[0]
    if last is None or last <= sent:
        return sent
    events = batches(spark, sinks, "session_scores").where((F.col("batch_id") > sent) & (F.col("batch_id") <= last))
    send(events.drop("batch_id"))
    write_batch(spark.range(1).select(F.lit(events.count()).cast("bigint").alias("events")), sinks.table("sent"), last)
    return last


def current_session_scores(spark: SparkSession, sinks: Sinks) -> DataFrame:
    return batches(spark, sinks, "session_scores").drop("event_id")


def current_metrics(spark: SparkSession, sinks: Sinks) -> DataFrame:
    return batches(spark, sinks, "metrics")


def current_update_counts(spark: SparkSession, sinks: Sinks) -> DataFrame:
    return batches(spark, sinks, "update_counts")


def live_daily_usage(classified: DataFrame, lateness: str) -> DataFrame:
    """A live view of usage per local day, for a dashboard: it forgets a day ``lateness`` after its end.

    It counts the entries that the boards count, but a message that comes later than that is in the
    boards only, which is why no table of the job is made from it. Days of the boards' zone start at 15:00 UTC.
    """
    timed = classified.where(~excluded_entry()).withColumn("event_time", F.timestamp_seconds("ts_epoch"))
    local_day = F.window("event_time", "1 day", startTime="15 hours")
    return (
        timed.withWatermark("event_time", lateness)
        .groupBy(local_day.alias("local_day"), "user_id", "category")
        .agg(F.sum("duration").alias("duration"))
        .select(
            F.to_date(F.col("local_day.end")).alias("day"), "user_id", "category", "duration"
        )
    )
