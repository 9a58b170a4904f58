"""Inserts, finds and keyed updates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyboard.operators import records as rec
from tallyboard.schemas import CATEGORIZED_DATA, USAGE_LOGS, ZERO_ID
from tallyboard.sources.tables import read_batches, write_batch, write_snapshot

DAY = dt.date(2024, 1, 5)


def hex_id(n):
    return f"{n:024x}"


def logs(spark, *rows):
    """(id, user, session)"""
    data = [(i, u, hex_id(900), ZERO_ID, s, 25, DAY, 1.5, 2.5) for i, u, s in rows]
    return spark.createDataFrame(data, USAGE_LOGS)


def categorized(spark, *rows):
    """(id, app, url, title)"""
    return spark.createDataFrame([(*r, ZERO_ID, False) for r in rows], CATEGORIZED_DATA)


def changes(spark, *rows):
    return spark.createDataFrame(rows, "seq bigint, usage_log_id string, category_id string")


def test_insert_keeps_ids_and_derives_missing_ones(spark):
    rows = logs(spark, (hex_id(1), "a", 1), (ZERO_ID, "a", 1), (ZERO_ID, "a", 1), ("", "b", 1))
    rows = rows.withColumn("seq", F.monotonically_increasing_id())
    first, again = (rec.usage_log_insert(rows).collect() for _ in range(2))
    ids = [r.usage_log_id for r in first]
    assert first == again and hex_id(1) in ids and ZERO_ID not in ids and len(set(ids)) == 4


def test_new_categorized_rows_are_one_per_key(spark):
    msgs = spark.createDataFrame([("a", "u", "t")] * 3 + [("a", "ut", "")], "app string, url string, title string")
    made = rec.new_categorized_data(msgs)
    assert made.count() == 2 and made.select("categorized_data_id").distinct().count() == 2
    assert made.columns == CATEGORIZED_DATA.fieldNames()


def test_find_usage_log(spark):
    table = logs(spark, (hex_id(3), "a", 1), (hex_id(2), "a", 1), (hex_id(1), "a", 2))
    assert rec.find_usage_log(table, "a", DAY, 1).first().usage_log_id == hex_id(2)
    assert rec.find_usage_log(table, "a", DAY, 9).count() == 0
    bulk = {(r.user_id, r.session_no): r.usage_log_id for r in rec.first_usage_logs(table).collect()}
    assert bulk == {("a", 1): hex_id(2), ("a", 2): hex_id(1)}


def test_point_finds_reach_the_scan(spark, tmp_path):
    path = write_snapshot(logs(spark, (hex_id(3), "a", 1)), str(tmp_path / "logs"), "session_date")
    plan = rec.find_usage_log(spark.read.schema(USAGE_LOGS).parquet(path), "a", DAY, 1)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id,a)" in text and "session_date" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert plan.first().usage_log_id == hex_id(3)


def test_find_categorized(spark):
    table = categorized(spark, (hex_id(2), "a", "u", "t"), (hex_id(5), "a", "u", "t"), (hex_id(3), "A", "u", "t"))
    assert rec.find_categorized(table, "a", "u", "t").first().categorized_data_id == hex_id(2)
    assert rec.find_categorized(table, "a", "u", "T").count() == 0
    keys = spark.createDataFrame([("a", "u", "t"), ("a", "u", "t"), ("x", "", "")], "app string, url string, title string")
    assert [r.categorized_data_id for r in rec.find_many(table, keys).collect()] == [hex_id(5)]
    assert [tuple(r) for r in rec.new_keys(keys, table).collect()] == [("x", "", "")]


def test_last_value_per_id_wins_and_bad_ids_are_skipped(spark):
    upper = "ABCDEF" + "0" * 18
    updates = rec.latest_per_id(
        changes(spark, (1, hex_id(1), "Y"), (0, hex_id(1), "X"), (2, "bad-id", "Z"), (3, "", "Z"), (4, upper, "Q")),
        "usage_log_id",
        "category_id",
    )
    assert {r.record_id: r.category_id for r in updates.collect()} == {hex_id(1): "Y", upper.lower(): "Q"}


def test_updates_change_stored_rows_only(spark):
    table = logs(spark, (hex_id(1), "a", 1), (hex_id(2), "b", 1))
    updates = rec.latest_per_id(
        changes(spark, (0, hex_id(1), ZERO_ID), (1, hex_id(1), hex_id(70)), (2, hex_id(9), hex_id(70))),
        "usage_log_id",
        "category_id",
    )
    got = {r.usage_log_id: r for r in rec.set_usage_log_category(table, updates).collect()}
    assert {i: r.category_id for i, r in got.items()} == {hex_id(1): hex_id(70), hex_id(2): ZERO_ID}
    assert got[hex_id(2)].duration == 2.5
    assert [r.record_id for r in rec.matched_updates(table, "usage_log_id", updates).collect()] == [hex_id(1)]


def test_zero_id_overwrites(spark):
    table = logs(spark, (hex_id(1), "a", 1)).withColumn("category_id", F.lit(hex_id(70)))
    update = rec.single_update(spark, hex_id(1), "category_id", ZERO_ID)
    assert rec.set_usage_log_category(table, update).first().category_id == ZERO_ID


def test_single_updates(spark):
    table = logs(spark, (hex_id(171), "a", 1))
    moved = rec.single_update(spark, hex_id(171).upper(), "categorized_data_id", hex_id(5))
    assert rec.set_usage_log_categorized(table, moved).first().categorized_data_id == hex_id(5)
    unknown = rec.single_update(spark, hex_id(8), "category_id", hex_id(5))
    assert rec.matched_updates(table, "usage_log_id", unknown).count() == 0
    assert rec.single_update(spark, "bad", "category_id", hex_id(5)).count() == 0
    cat = categorized(spark, (hex_id(2), "a", "u", "t"))
    done = rec.set_categorized_category(cat, rec.single_update(spark, hex_id(2), "category_id", hex_id(6)))
    assert done.first().category_id == hex_id(6) and done.columns == cat.columns


def test_batch_folders_replace_themselves(spark, tmp_path):
    root = str(tmp_path / "t")
    schema = logs(spark).schema
    assert read_batches(spark, root, schema).count() == 0
    write_batch(logs(spark, (hex_id(1), "a", 1), (hex_id(2), "a", 1)), root, 0)
    write_batch(logs(spark, (hex_id(3), "a", 1)), root, 1)
    write_batch(logs(spark, (hex_id(4), "a", 1)), root, 0)
    assert {(r.batch_id, r.usage_log_id) for r in read_batches(spark, root, schema).collect()} == {(0, hex_id(4)), (1, hex_id(3))}
    write_batch(logs(spark), root, 0)
    assert {r.batch_id for r in read_batches(spark, root, schema).collect()} == {1}


def test_snapshots_are_never_overwritten(spark, tmp_path):
    path = write_snapshot(logs(spark, (hex_id(1), "a", 1)), str(tmp_path / "s"))
    with pytest.raises(Exception, match="already exists"):
        write_snapshot(logs(spark), path)
