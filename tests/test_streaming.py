"""The job over split files: same tables as one batch, however often a batch runs."""

import datetime as dt
import os
import random
import subprocess
import sys
import threading

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallyboard.operators import classify as cl
from tallyboard.operators import leaderboard as lb
from tallyboard.operators import records as rec
from tallyboard.operators.sessions import session_scores
from tallyboard.schemas import (
    BATCH_METRICS,
    CATEGORY_PATTERNS,
    CATEGORY_UPDATES,
    LABEL_ATTEMPTS,
    LEARNED_LABELS,
    RAW_MESSAGES,
    USAGE_LOGS,
    ZERO_ID,
)
from tallyboard.sources.messages import from_json_records, normalize, read_raw, stream_raw
from tallyboard.sources.tables import read_batches, write_batch
from tallyboard.streaming import app, live
from tallyboard.streaming import pipeline as pl

FILES = 3


def hex_id(n):
    return f"{n:024x}"


def raw_rows(count=120):
    rng = random.Random(11)
    for seq in range(count):
        values = {
            "userId": f"u{rng.randrange(9)}",
            "pomodoroUsageLogId": "bad-id" if seq % 17 == 0 else hex_id(rng.randrange(60)),
            "categorizedDataId": hex_id(1000 + rng.randrange(12)),
            "app": rng.choice(["Code", "Chrome", "Safari", ""]),
            "title": f"t{rng.randrange(4)}",
            "url": rng.choice(["https://docs.x/", "https://game.y/", ""]),
            "session": str(rng.randrange(4)),
            "sessionDate": "2024-01-05",
            "sessionMinutes": "25",
            "duration": "NaN" if seq % 31 == 0 else str(rng.randrange(400) / 4),
            "timestamp": str(1.7e9 + rng.randrange(40 * 86400)),
            "isEnd": str(seq % 5 == 0).lower(),
        }
        if seq % 13 == 0:
            del values["timestamp"]
        yield seq, values


@pytest.fixture
def source(spark, tmp_path):
    rows = list(raw_rows())
    for n in range(FILES):
        part = spark.createDataFrame(rows[n * 40 : (n + 1) * 40], RAW_MESSAGES)
        part.coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    return str(tmp_path / "in")


def patterns(spark, shift=0):
    rows = [
        (hex_id(1 + shift), "Development", ["code"], [], 1),
        (hex_id(2 + shift), "Documentation", [], ["docs."], 2),
        (hex_id(3 + shift), "Game", [], ["game."], 3),
    ]
    return spark.createDataFrame(rows, CATEGORY_PATTERNS)


def labels(spark):
    return spark.createDataFrame([("app: chrome, title: t1, url: ", "Finance")], "query string, label string")


def make_job(spark, root, **changes):
    options = {"load_patterns": lambda: patterns(spark), "load_labels": lambda: labels(spark), **changes}
    return pl.UsageJob(pl.Sinks(str(root)), **options)


def stored_logs(spark):
    rows = [(hex_id(i), "u", hex_id(1000), ZERO_ID, 1, 25, dt.date(2024, 1, 5), 0.0, 0.0) for i in range(0, 80, 2)]
    return spark.createDataFrame(rows, USAGE_LOGS)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def tables(spark, sinks):
    return {
        "leaderboard": rows_of(pl.current_leaderboard(spark, sinks)),
        "scores": rows_of(pl.current_session_scores(spark, sinks).drop("batch_id")),
        "logs": rows_of(pl.current_usage_logs(spark, stored_logs(spark), sinks)),
        "categorized": rows_of(pl.current_updates(spark, sinks, "categorized_updates").drop("seq")),
        "metrics": rows_of(
            pl.current_metrics(spark, sinks).groupBy("method").agg(F.sum("messages"), F.sum("excluded"), F.sum("invalid_ids"), F.sum("ended"))
        ),
    }


def batch_tables(spark, source):
    """The same tables straight from the operators."""
    messages = normalize(read_raw(spark, source, "json"))
    done = cl.attach_category_id(cl.classify(messages, patterns(spark), labels(spark)), patterns(spark))
    updates = rec.latest_per_id(done, "usage_log_id", "category_id")
    return {
        "leaderboard": rows_of(lb.leaderboard(lb.leaderboard_entries(done))),
        "scores": rows_of(session_scores(done)),
        "logs": rows_of(rec.set_usage_log_category(stored_logs(spark), updates)),
        "categorized": rows_of(rec.latest_per_id(done, "categorized_data_id", "category_id").drop("seq")),
        "metrics": rows_of(pl.batch_metrics(done)),
    }


def stream(spark, source):
    return stream_raw(spark, source, "json", max_files_per_trigger=1)


def test_stream_equals_batch_and_replays_safely(spark, source, tmp_path):
    job = make_job(spark, tmp_path / "out")
    job.run_available(stream(spark, source))
    want = batch_tables(spark, source)
    assert want["metrics"] and want["leaderboard"] and len(want["scores"]) == 24
    assert pl.current_metrics(spark, job.sinks).select("batch_id").distinct().count() == FILES
    # Categories depend on the message alone, so file order does not show.
    for name in ("leaderboard", "scores", "metrics"):
        assert tables(spark, job.sinks)[name] == want[name]

    before = tables(spark, job.sinks)
    first = read_batches(spark, job.sinks.metrics, BATCH_METRICS).where("batch_id = 0").agg(F.sum("messages")).first()[0]
    assert first == 40
    job.run_available(stream(spark, source))  # nothing new
    assert tables(spark, job.sinks) == before

    # A second job, with all files in one batch, keeps arrival order for updates too.
    whole = make_job(spark, tmp_path / "whole")
    whole.run_available(stream_raw(spark, source, "json"))
    assert tables(spark, whole.sinks) == want
    whole.process(read_raw(spark, source, "json"), 0)  # the batch again
    assert tables(spark, whole.sinks) == want


def test_a_failed_batch_runs_again(spark, source, tmp_path, monkeypatch):
    job = make_job(spark, tmp_path / "out")
    failures = iter([False, True])

    def failing(df, root, batch_id, *by):
        write_batch(df, root, batch_id, *by)
        if root == job.sinks.metrics and next(failures, False):
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(pl, "write_batch", failing)
    with pytest.raises(StreamingQueryException, match="lost after the write"):
        job.run_available(stream(spark, source))
    job.run_available(stream(spark, source))
    want = batch_tables(spark, source)
    got = tables(spark, job.sinks)
    for name in ("leaderboard", "scores", "metrics"):
        assert got[name] == want[name]


def test_empty_batch_writes_no_rows(spark, tmp_path):
    job = make_job(spark, tmp_path / "out")
    job.process(spark.createDataFrame([], RAW_MESSAGES), 0)
    assert all(not rows for name, rows in tables(spark, job.sinks).items() if name != "logs")
    assert pl.current_leaderboard(spark, pl.Sinks(str(tmp_path / "never"))).count() == 0


def test_dictionary_is_read_again_for_each_batch(spark, source, tmp_path):
    versions = iter([0, 100, 100])
    job = make_job(spark, tmp_path / "out", load_patterns=lambda: patterns(spark, next(versions)))
    job.run_available(stream(spark, source))
    ids = read_batches(spark, job.sinks.table("usage_log_updates"), CATEGORY_UPDATES).where(F.col("category_id") != ZERO_ID)
    by_batch = {r.batch_id: set(r.ids) for r in ids.groupBy("batch_id").agg(F.collect_set("category_id").alias("ids")).collect()}
    assert by_batch[0] <= {hex_id(i) for i in (1, 2, 3)}
    assert by_batch[1] | by_batch[2] <= {hex_id(i) for i in (101, 102, 103)}


def test_a_batch_counts_when_it_is_whole(spark, source, tmp_path, monkeypatch):
    job = make_job(spark, tmp_path / "out")
    raw = read_raw(spark, source, "json")
    job.process(raw.where("seq < 60"), 0)
    before = tables(spark, job.sinks)

    def broken(df, root, batch_id, *by):
        if root == job.sinks.metrics:
            raise RuntimeError("lost before the metrics")
        write_batch(df, root, batch_id, *by)

    with monkeypatch.context() as patch:
        patch.setattr(pl, "write_batch", broken)
        with pytest.raises(RuntimeError):
            job.process(raw.where("seq >= 60"), 1)
        assert tables(spark, job.sinks) == before  # all but one table of batch 1 are there
        with pytest.raises(RuntimeError):
            job.process(raw.where("seq < 60"), 0)
    assert pl.current_leaderboard(spark, job.sinks).count() == 0  # batch 0 is being written again
    job.process(raw.where("seq < 60"), 0)
    assert tables(spark, job.sinks) == before


def test_folds_change_nothing_and_old_batches_go(spark, source, tmp_path):
    raw = read_raw(spark, source, "json")
    plain, folding = make_job(spark, tmp_path / "plain"), make_job(spark, tmp_path / "folding", fold_every=1)
    for batch_id in range(4):
        part = raw.where(F.col("seq") % 4 == batch_id)
        plain.process(part, batch_id)
        folding.process(part, batch_id)
        assert tables(spark, folding.sinks) == tables(spark, plain.sinks)
        opened = [rows_of(pl.open_keys(spark, job.sinks, labels(spark))) for job in (plain, folding)]
        assert opened[0] == opened[1]
    left = {r.batch_id for r in read_batches(spark, folding.sinks.metrics, BATCH_METRICS).collect()}
    assert left == {2, 3}  # the last fold, of batch 2, keeps what the folds before did not hold
    listed = pl.folds(spark, folding.sinks)
    assert [row.batch_id for row in listed] == [0, 1, 2]

    # The last batch again, after its fold: nothing is folded twice, nothing is left over.
    def folders():
        return sorted(str(p) for p in (tmp_path / "folding" / "folded").glob("*/segment=*"))

    held = folders()
    folding.process(raw.where("seq % 4 = 3"), 3)
    assert folders() == held and len(held) == 3 * len(pl.TABLES) and pl.fold(spark, folding.sinks, 2) is None
    assert tables(spark, folding.sinks) == tables(spark, plain.sinks)


def raw_message(seq, record_id=None, user="u", ts="1700000000"):
    values = {"userId": user, "duration": "2"}
    values |= {} if record_id is None else {"pomodoroUsageLogId": record_id}
    return seq, values | ({} if ts is None else {"timestamp": ts})


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_repeats_count_twice_unless_dropped(spark, tmp_path, ansi):
    upper = hex_id(10).upper()
    first = [raw_message(1, hex_id(1)), raw_message(2, hex_id(1)), raw_message(3, user="a"), raw_message(4, user="b"), raw_message(5, "bad-id", "c")]
    second = [raw_message(6, hex_id(1)), raw_message(7, hex_id(2), "late", None), raw_message(8, hex_id(10)), raw_message(9, upper)]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for drops, wanted in ((False, {"u": 10.0, "a": 2.0, "b": 2.0, "c": 2.0, "late": 2.0}), (True, {"u": 4.0, "a": 2.0, "b": 2.0, "c": 2.0, "late": 2.0})):
            job = make_job(spark, tmp_path / f"{drops}", drop_repeats=drops)
            for batch_id, rows in enumerate((first, second, [])):
                job.process(spark.createDataFrame(rows, RAW_MESSAGES), batch_id)
            job.process(spark.createDataFrame(second, RAW_MESSAGES), 1)  # again
            days = pl.current_leaderboard(spark, job.sinks).where("period_kind = 'month'")
            assert {r.user_id: r.score for r in days.groupBy("user_id").agg(F.sum("score").alias("score")).collect()} == wanted
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_update_counts_of_a_batch(spark, source, tmp_path):
    job = make_job(spark, tmp_path / "out", load_usage_logs=lambda: stored_logs(spark))
    job.process(read_raw(spark, source, "json"), 0)
    row = pl.current_update_counts(spark, job.sinks).first()
    updates = {r.record_id: r.category_id for r in pl.current_updates(spark, job.sinks).collect()}
    stored = {r.usage_log_id: r.category_id for r in stored_logs(spark).collect()}
    hit = [i for i in updates if i in stored]
    assert (row.updates, row.matched, row.no_op) == (len(updates), len(hit), len(updates) - len(hit))
    assert row.modified == sum(updates[i] != stored[i] for i in hit) and 0 < row.modified < row.matched < row.updates


def test_closed_days_are_read_from_their_sums(spark, source, tmp_path):
    """Deltas of closed days are not opened: without their files all boards stay the same."""
    job, plain = make_job(spark, tmp_path / "out", fold_every=2), make_job(spark, tmp_path / "plain")
    raw = read_raw(spark, source, "json")
    for batch_id in range(5):
        part = raw.where(F.col("seq") % 5 == batch_id)
        job.process(part, batch_id)
        plain.process(part, batch_id)
        if batch_id in (2, 3):
            assert pl.close_days(spark, job.sinks, dt.date(2023, 12, 5 * (batch_id - 1))) is not None
        assert rows_of(pl.current_leaderboard(spark, job.sinks)) == rows_of(pl.current_leaderboard(spark, plain.sinks))
    assert pl.close_days(spark, job.sinks, dt.date(2023, 12, 10)) > 0  # late messages of closed days
    assert pl.close_days(spark, job.sinks, dt.date(2023, 12, 1)) is None
    want = rows_of(pl.current_leaderboard(spark, plain.sinks))
    gone = 0
    for folder in [*(tmp_path / "out").glob("leaderboard_deltas/batch_id=*/day=*"), *(tmp_path / "out").glob("folded/leaderboard_deltas/*/day=*")]:
        if folder.name < "day=2023-12-10":
            for file in folder.glob("*"):
                file.write_bytes(b"")  # no reader survives opening it
                gone += 1
    assert gone and rows_of(pl.current_leaderboard(spark, job.sinks)) == want
    for kind, period in (("day", "2023-12-05"), ("week", "2023-W49"), ("month", "2023-M12"), ("month", "1970-M1")):
        some = [row for row in want if row[1] == kind and row[2] == period]
        assert rows_of(pl.current_board(spark, job.sinks, kind, period)) == some


def test_the_job_keeps_its_stored_tables(spark, source, tmp_path):
    logs = pl.usage_log_table(str(tmp_path / "logs"))
    logs.publish(spark, -1, appended=stored_logs(spark))
    keys = pl.categorized_table(str(tmp_path / "keys"))
    job = make_job(spark, tmp_path / "out", usage_logs=logs, categorized=keys, append_logs=True, fold_every=2)
    job.run_available(stream(spark, source))
    stored = {r.usage_log_id: r.category_id for r in logs.read(spark).collect()}
    want = {r[0]: r[3] for r in tables(spark, job.sinks)["logs"]}
    assert {i: stored[i] for i in want} == want
    unnamed = sum(seq % 17 == 0 for seq, _ in raw_rows())
    assert len(stored) == len(want) + unnamed
    assert {r.categorized_data_id: r.category_id for r in keys.read(spark).collect()} == dict(tables(spark, job.sinks)["categorized"])
    assert pl.current_update_counts(spark, job.sinks).agg(F.sum("updates"), F.sum("matched")).first()[1] > 0
    version = logs.version(spark)
    job.process(read_raw(spark, source, "json").where("seq >= 80"), version)  # the last batch again
    assert logs.version(spark) == version and logs.read(spark).count() == len(stored)


def test_batches_of_bounded_size_and_a_dictionary_that_stays(spark, source, tmp_path, monkeypatch):
    from tallyboard.operators import classify as cl_module
    from tallyboard.sources.messages import row_ranges
    from tallyboard.sources.tables import PatternStore

    store = PatternStore(str(tmp_path / "patterns"))
    store.publish(patterns(spark), 4)
    loaded = []
    real = cl_module.load_rules
    monkeypatch.setattr(cl_module, "load_rules", lambda *a, **k: loaded.append(1) or real(*a, **k))
    job = make_job(spark, tmp_path / "out", load_patterns=None, patterns=store, most_rows=25)
    job.run_available(stream_raw(spark, source, "json"))
    sizes = pl.current_metrics(spark, job.sinks).groupBy("batch_id").agg(F.sum("messages").alias("n")).collect()
    assert sorted(r.n for r in sizes) == [20, 25, 25, 25, 25] and len(loaded) == 1
    want = batch_tables(spark, source)
    for name in ("leaderboard", "scores", "metrics", "logs"):
        assert tables(spark, job.sinks)[name] == want[name]
    messages = normalize(read_raw(spark, source, "json"))
    assert row_ranges(messages, 50) == [(0, 49), (50, 99), (100, 119)]
    assert row_ranges(messages.limit(0), 50) == []
    assert store.version(spark) == 4 and PatternStore(str(tmp_path / "none")).version(spark) is None


def test_runs_of_a_batch_are_written_together(spark, source, tmp_path, monkeypatch):
    monkeypatch.setattr(pl, "MOST_AT_ONCE", 80)
    parts, real = [], pl.UsageJob._process_part
    monkeypatch.setattr(pl.UsageJob, "_process_part", lambda self, *a: parts.append(a[1:]) or real(self, *a))
    job, first = make_job(spark, tmp_path / "out", most_rows=20), make_job(spark, tmp_path / "first")
    raw = read_raw(spark, source, "json")
    job.process(raw, 0)
    assert parts == [(0, 3), (4, 5)]
    # Each run is a batch of its own, with the rows that it has when it is processed alone.
    first.process(raw.where("seq between 20 and 39"), 1)
    stale = pl.batches(spark, first.sinks, "to_label").drop("batch_id")
    write_batch(stale.select(F.lit("old").alias("query"), "app", "title", "url", "prompt"), job.sinks.table("to_label"), 1)
    job.process(raw, 0)  # again, after a run that failed
    for name in set(pl.TABLES) - {"seen_ids", "update_counts"}:
        assert rows_of(pl.batches(spark, job.sinks, name).where("batch_id = 1")) == rows_of(pl.batches(spark, first.sinks, name))
    sizes = pl.current_metrics(spark, job.sinks).groupBy("batch_id").agg(F.sum("messages").alias("n")).collect()
    assert sorted((r.batch_id, r.n) for r in sizes) == [(n, 20) for n in range(6)]


def test_tables_of_a_batch_are_written_side_by_side(spark, source, tmp_path, monkeypatch):
    meeting = threading.Barrier(2, timeout=60)

    def meets(df, root, *more):
        if root.endswith(("session_scores", "to_label")):
            meeting.wait()
        write_batch(df, root, *more)

    monkeypatch.setattr(pl, "write_batch", meets)
    job = make_job(spark, tmp_path / "out")
    job.process(read_raw(spark, source, "json"), 0)
    assert pl.current_session_scores(spark, job.sinks).count() == 24


def test_a_job_leaves_no_scratch(spark, source, tmp_path):
    from tallyboard.session import shared_dir

    before = set(os.listdir(shared_dir(spark)))
    many = [(hex_id(100 + n), "Design", [], [f"p{n}."], 10 + n) for n in range(20)]  # beyond one expression
    job = make_job(spark, tmp_path / "out", load_patterns=lambda: patterns(spark).unionByName(spark.createDataFrame(many, CATEGORY_PATTERNS)))
    raw = read_raw(spark, source, "json")
    for batch_id in range(4):
        job.process(raw.where(F.col("seq") % 4 == batch_id), batch_id)
    job.process(raw.where("seq % 4 = 3"), 3)
    assert set(os.listdir(shared_dir(spark))) == before


def test_sent_sessions_keep_their_ids(spark, source, tmp_path):
    job = make_job(spark, tmp_path / "out")
    raw = read_raw(spark, source, "json")
    sent = []

    def send(events):
        sent.extend(r.event_id for r in events.collect())

    job.process(raw.where("seq < 60"), 0)
    pl.send_sessions(spark, job.sinks, send)
    first = list(sent)
    job.process(raw.where("seq < 60"), 0)  # again: the same records
    assert pl.send_sessions(spark, job.sinks, send) == 0 and sent == first

    def broken(events):
        send(events)
        raise RuntimeError("lost after sending")

    job.process(raw.where("seq >= 60"), 1)
    with pytest.raises(RuntimeError):
        pl.send_sessions(spark, job.sinks, broken)
    pl.send_sessions(spark, job.sinks, send)
    assert len(set(sent)) == 24 and len(sent) == 24 + (24 - len(first))


def test_bounded_repeats(spark, tmp_path):
    from tallyboard.sources.messages import without_repeats_bounded

    def put(name, *rows):
        spark.createDataFrame(rows, RAW_MESSAGES).coalesce(1).write.mode("append").json(str(tmp_path / "in"))

    def run():
        messages = without_repeats_bounded(normalize(stream_raw(spark, str(tmp_path / "in"), "json")), "1 day")
        writer = messages.select("seq").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
        writer.option("path", str(tmp_path / "o")).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.seq for r in spark.read.parquet(str(tmp_path / "o")).collect())

    day = 86_400
    put("a", raw_message(1, hex_id(1), ts="1700000000"), raw_message(2, "bad-id"), raw_message(3, "bad-id"))
    assert run() == [1, 2, 3]
    put("b", raw_message(4, hex_id(1).upper(), ts=str(1_700_000_000 + 60)), raw_message(5, hex_id(2), ts=str(1_700_000_000 + 5 * day)))
    assert run() == [1, 2, 3, 5]  # 4 repeats within the bound
    put("c", raw_message(6, hex_id(9), ts=str(1_700_000_000 + 9 * day)))
    run()
    put("d", raw_message(7, hex_id(1), ts=str(1_700_000_000 + 9 * day)))
    assert run() == [1, 2, 3, 5, 6, 7]  # beyond it the id counts again


def test_arrival_follows_the_broker_time(spark):
    def record(partition, offset, second, app):
        value = f'{{"userId": "u", "app": "{app}", "categorizedDataId": "{hex_id(7)}"}}'
        return partition, offset, dt.datetime(2024, 1, 1, 0, 0, second), value

    records = [record(5, 0, 1, "old"), record(0, 1_000_000, 2, "new"), record(0, 999_999, 2, "between")]
    raw = from_json_records(spark.createDataFrame(records, "partition int, offset long, timestamp timestamp, value string"))
    latest = rec.latest_per_id(normalize(raw), "categorized_data_id", "app")
    assert [r.app for r in latest.collect()] == ["new"]
    assert normalize(raw).select("seq").distinct().count() == 3


def test_session_events_are_json_records(spark):
    from tallyboard.operators.sessions import session_events

    scores = spark.createDataFrame([("u1", "2024-01-05", 3)], "user_id string, session_date string, session_no long")
    assert [tuple(r) for r in session_events(scores).collect()] == [
        ("u1", '{"userId":"u1","sessionDate":"2024-01-05","session":"3"}')
    ]


def test_live_daily_usage(spark, source):
    messages = normalize(stream_raw(spark, source, "json")).withColumn("category", F.lit("Any"))
    live = pl.live_daily_usage(messages, "100000 days")
    query = live.writeStream.outputMode("complete").format("memory").queryName("live_usage").trigger(availableNow=True).start()
    query.awaitTermination()
    entries = normalize(read_raw(spark, source, "json")).withColumn("category", F.lit("Any"))
    want = lb.daily_totals(lb.leaderboard_entries(entries)).select("user_id", "day", "duration")
    assert rows_of(spark.table("live_usage").select("user_id", "day", "duration")) == rows_of(want)


def _periods_so_far(spark, root):
    entries = spark.readStream.schema("category string, duration double, ts_epoch double").parquet(f"{root}/in/*")
    writer = live.live_usage_by_period(entries, "1 day").writeStream.format("parquet").option("path", f"{root}/out")
    with live.keyed_state(spark, stores=2):
        query = writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(live.PERIOD_USAGE).parquet(f"{root}/out")


def test_periods_are_given_out_as_they_close(spark, tmp_path):
    """Three runs of one stream: the second closes a week that crosses a year's end, the third the months."""
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")

    def add(name, *rows):
        values = [(category, duration, day(*date)) for category, duration, date in rows]
        spark.createDataFrame(values, "category string, duration double, ts_epoch double").write.parquet(f"{tmp_path}/in/{name}")

    def day(*date):
        return dt.datetime(*date, tzinfo=dt.UTC).timestamp()

    def given_out():
        return {(r.period_kind, r.period, r.category): (r.total_duration, r.messages) for r in _periods_so_far(spark, tmp_path).collect()}

    # 2024-12-31 15:00 UTC is the first of January in the boards' zone; NaN and no duration are not counted.
    add("a", ("A", 0.1, (2024, 12, 30, 1)), ("A", 0.2, (2024, 12, 31, 14, 59)), ("A", 0.4, (2024, 12, 31, 15)))
    add("b", ("B", float("nan"), (2024, 12, 30, 2)), ("B", None, (2024, 12, 30, 3)))
    assert given_out() == {("day", "2024-12-30", "A"): (0.1, 1)}  # over by a day, to the second
    add("c", ("A", 1.0, (2025, 1, 4, 1)), ("B", 7.0, (2025, 1, 6, 16)))
    first = given_out()
    assert first == {
        ("day", "2024-12-30", "A"): (0.1, 1),
        ("day", "2024-12-31", "A"): (0.2, 1),
        ("day", "2025-01-01", "A"): (0.4, 1),
        ("day", "2025-01-04", "A"): (1.0, 1),
        ("month", "2024-M12", "A"): (0.3, 2),
        ("week", "2025-W1", "A"): (1.7, 4),
    }
    # Too late for any period; then the end of January and of a leap year's February.
    add("d", ("A", 99.0, (2024, 12, 30, 5)), ("A", 0.5, (2025, 1, 31, 14)), ("C", 1.0, (2028, 2, 29, 14)), ("C", 1.0, (2028, 3, 5)))
    last = given_out()
    assert {key: value for key, value in last.items() if key in first} == first
    assert last["month", "2025-M1", "A"] == (1.9, 3)
    assert last["month", "2028-M2", "C"] == (1.0, 1)
    assert ("month", "2028-M3", "C") not in last
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider


def test_labels_come_back_into_the_stream(spark, source, tmp_path):
    """Open keys are answered outside the batch; the next batch uses the answers."""
    labels_root = str(tmp_path / "labels")

    def load_labels():
        return read_batches(spark, labels_root, LEARNED_LABELS)

    def labeller(prompts):
        if any("t3" in p for p in prompts):
            raise RuntimeError("no connection")
        return ["Game" if "safari" in p else None for p in prompts]

    job = make_job(spark, tmp_path / "out", load_labels=load_labels)
    raw = read_raw(spark, source, "json")
    job.process(raw, 0)
    before = {r.query for r in pl.open_keys(spark, job.sinks, load_labels()).collect()}
    assert before == {
        r.query for r in cl.unresolved_keys(cl.classify(normalize(raw), patterns(spark))).select("query").collect()
    }
    pl.label_open_keys(spark, job.sinks, labels_root, 0, labeller, load_labels)
    after = {r.query for r in pl.open_keys(spark, job.sinks, load_labels()).collect()}
    assert after == {q for q in before if "safari" not in q or "t3" in q} and len(after) < len(before)
    ledger = read_batches(spark, job.sinks.table("label_attempts"), LABEL_ATTEMPTS)
    assert {r.query: r.outcome for r in ledger.collect()} == {
        q: "failed" if "t3" in q else "answered" if "safari" in q else "no answer" for q in before}
    for run in range(1, 7):
        pl.label_open_keys(spark, job.sinks, labels_root, run, labeller, load_labels)
    tries = read_batches(spark, job.sinks.table("label_attempts"), LABEL_ATTEMPTS).groupBy("query").agg(F.max("tries").alias("n"))
    assert {r.n for r in tries.collect()} == {1, 5}  # what has no answer after five tries is left
    job.process(raw, 1)
    by_label = pl.current_metrics(spark, job.sinks).where("method = 'label'")
    assert [r.batch_id for r in by_label.collect()] == [1]


def test_command_line_job(spark, source, tmp_path):
    patterns(spark).write.parquet(str(tmp_path / "patterns"))
    labels(spark).write.parquet(str(tmp_path / "labels" / "batch_id=0"))
    argv = ["--messages", source, "--patterns", str(tmp_path / "patterns"), "--labels", str(tmp_path / "labels")]
    app.main([*argv, "--out", str(tmp_path / "out"), "--once"])
    got = tables(spark, pl.Sinks(str(tmp_path / "out")))
    assert got == batch_tables(spark, source)


def test_entry_point_runs_by_itself(spark, source, tmp_path):
    """As the README says, in a process of its own and from another folder."""
    patterns(spark).write.parquet(str(tmp_path / "patterns"))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    argv = ["--messages", source, "--patterns", str(tmp_path / "patterns"), "--out", str(tmp_path / "out"), "--once"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, f"{root}/usage_job.py", *argv], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert pl.current_leaderboard(spark, pl.Sinks(str(tmp_path / "out"))).count() > 0
