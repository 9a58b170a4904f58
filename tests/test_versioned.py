"""Versioned tables: appends that add once, updates that rewrite what changes, readers that are not disturbed."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallyboard.operators.lookup import id_filter, maybe_held, merged_filters
from tallyboard.schemas import USAGE_LOGS, ZERO_ID
from tallyboard.session import new_run_dir, scratch_scope, shared_dir, stored
from tallyboard.sources.versioned import VersionedTable, with_id_part
from tallyboard.streaming.pipeline import categorized_table, publish_categorized, usage_log_table


def hex_id(n):
    return f"{n:024x}"


def logs(spark, *rows):
    """(id, day of January or None)"""
    data = [(i, "u", hex_id(900), ZERO_ID, 1, 25, d and dt.date(2024, 1, d), 1.5, 2.5) for i, d in rows]
    return spark.createDataFrame(data, USAGE_LOGS)


def updates(spark, *rows):
    """(id, category[, day])"""
    if rows and len(rows[0]) == 2:
        return spark.createDataFrame(rows, "record_id string, category_id string")
    dated = [(i, c, dt.date(2024, 1, d)) for i, c, d in rows]
    return spark.createDataFrame(dated, "record_id string, category_id string, session_date date")


def categories(df):
    return {r.usage_log_id: r.category_id for r in df.collect()}


def files(root):
    found = {}
    for folder, _, names in os.walk(f"{root}/data"):
        for name in names:
            if name.endswith(".parquet"):
                found[f"{folder}/{name}"] = os.stat(f"{folder}/{name}").st_mtime_ns
    return found


@pytest.fixture
def table(tmp_path):
    return usage_log_table(str(tmp_path / "logs"))


def test_only_dates_with_a_changed_value_are_written(spark, table):
    table.publish(spark, 0, appended=logs(spark, (hex_id(1), 5), (hex_id(2), 5), (hex_id(3), 6), (hex_id(4), None)))
    before, old = files(table.root), table.read(spark, 0)
    done = table.publish(spark, 1, updates=updates(spark, (hex_id(1), "X"), (hex_id(3), ZERO_ID), (hex_id(9), "Y")), target="category_id")
    assert (done.updates, done.matched, done.modified, done.no_op, done.rewritten_parts) == (3, 2, 1, 1, 1)
    assert categories(table.read(spark)) == {hex_id(1): "X", hex_id(2): ZERO_ID, hex_id(3): ZERO_ID, hex_id(4): ZERO_ID}
    after = files(table.root)
    assert before.items() <= after.items()  # nothing was touched
    assert all("session_date=2024-01-05" in name for name in after.keys() - before.keys())
    assert categories(old) == dict.fromkeys([hex_id(k) for k in (1, 2, 3, 4)], ZERO_ID)  # opened before, read after
    assert categories(table.read(spark, 0)) == categories(old)


def test_a_version_is_written_once(spark, table):
    table.publish(spark, 3, appended=logs(spark, (hex_id(1), 5)))
    change = updates(spark, (hex_id(1), "X"))
    assert table.publish(spark, 4, updates=change, target="category_id").modified == 1
    held = files(table.root)
    for again in (4, 2):
        assert table.publish(spark, again, updates=updates(spark, (hex_id(1), "Z")), target="category_id") is None
    assert files(table.root) == held and table.version(spark) == 4


def test_updates_that_name_a_wrong_or_no_date_still_arrive(spark, table):
    table.publish(spark, 0, appended=logs(spark, (hex_id(1), 5), (hex_id(2), 6), (hex_id(3), None), (hex_id(10), 7)))
    change = updates(spark, (hex_id(1), "A", 5), (hex_id(2), "B", 9), (hex_id(3), "C", 5), (hex_id(77), "D", 5))
    done = table.publish(spark, 1, updates=change, target="category_id")
    assert (done.matched, done.modified) == (3, 3)
    assert categories(table.read(spark)) == {hex_id(1): "A", hex_id(2): "B", hex_id(3): "C", hex_id(10): ZERO_ID}


def test_appends_add_each_id_once(spark, table):
    upper = hex_id(171).upper()
    first = logs(spark, (hex_id(1), 5), (upper, 6), (hex_id(1), 5))
    assert table.publish(spark, 0, appended=first).appended == 2
    assert table.publish(spark, 1, appended=first).appended == 0
    # In another date than it is stored under, and in other letters.
    assert table.publish(spark, 2, appended=logs(spark, (hex_id(1), 9), (hex_id(171), 9), (hex_id(5), 9))).appended == 1
    both = table.publish(spark, 3, appended=logs(spark, (hex_id(6), 5)), updates=updates(spark, (hex_id(1), "X", 5)), target="category_id")
    assert (both.appended, both.modified) == (1, 1)
    rows = table.read(spark).collect()
    assert sorted((r.usage_log_id, r.session_date.day) for r in rows) == sorted(
        [(hex_id(1), 5), (upper, 6), (hex_id(5), 9), (hex_id(6), 5)]
    )


def test_empty_versions_and_filters_that_are_merged(spark, table, monkeypatch):
    from tallyboard.sources import versioned

    monkeypatch.setattr(versioned, "MOST_FILTERS", 2)
    assert table.read(spark).count() == 0 and table.version(spark) is None
    table.publish(spark, 0, appended=logs(spark), updates=updates(spark, (hex_id(1), "X")), target="category_id")
    for version in range(1, 7):
        table.publish(spark, version, appended=logs(spark, (hex_id(version), version)))
    assert sum(row.kind == versioned.FILTER for row in table.manifest(spark, 6)) <= 3
    again = logs(spark, *[(hex_id(n), 20 + n) for n in range(1, 8)])
    assert table.publish(spark, 7, appended=again).appended == 1
    assert table.read(spark, 7, ["2024-01-03"]).count() == 1


def test_expired_versions_take_only_their_own_files(spark, table):
    for version in range(3):
        table.publish(spark, version, appended=logs(spark, (hex_id(version), 5)), updates=updates(spark, (hex_id(0), f"c{version}")), target="category_id")
    assert table.expire(spark, 2) == 2 and table.expire(spark, 9) == 0
    assert categories(table.read(spark)) == {hex_id(0): "c2", hex_id(1): ZERO_ID, hex_id(2): ZERO_ID}
    assert len(files(table.root)) <= 2


def test_a_crowded_date_is_split_over_files(spark, tmp_path):
    table = VersionedTable(str(tmp_path / "t"), USAGE_LOGS, "usage_log_id", filter_bits=1 << 16)
    many = spark.range(3000).select(F.lpad(F.hex("id"), 24, "0").alias("record_id"))
    crowd = logs(spark, (hex_id(0), 5)).drop("usage_log_id").crossJoin(many).withColumnRenamed("record_id", "usage_log_id")
    table.publish(spark, 0, appended=crowd.select(*USAGE_LOGS.fieldNames()))
    assert table.read(spark).count() == 3000


def test_keys_without_a_date_lie_by_their_id(spark, tmp_path):
    table = categorized_table(str(tmp_path / "keys"))
    kind = "seq long, categorized_data_id string, app string, url string, title string, category_id string, is_llm boolean"
    rows = [(1, hex_id(1), "a", "u", "t", "X", False), (2, hex_id(2), "b", "u", "t", "Y", True), (3, "bad", "c", "", "", "Z", True)]
    publish_categorized(table, 0, spark.createDataFrame(rows, kind), append=True)
    publish_categorized(table, 1, spark.createDataFrame([(4, hex_id(2), "b", "u", "t", "W", True)], kind), append=True)
    assert {(r.categorized_data_id, r.category_id) for r in table.read(spark).collect()} == {(hex_id(1), "X"), (hex_id(2), "W")}
    assert with_id_part(table.read(spark).drop("part"), "categorized_data_id").exceptAll(table.read(spark)).count() == 0


def test_id_filters_miss_nothing(spark):
    bits = 1 << 16
    ids = spark.range(3000).select(F.lpad(F.hex(F.col("id") * 7), 24, "0").alias("record_id"))
    halves = [id_filter(ids.where(f"conv(record_id, 16, 10) % 2 = {k}"), "record_id", bits) for k in (0, 1)]
    whole = halves[0].unionByName(halves[1])
    assert maybe_held(ids, "record_id", whole, bits).count() == 3000
    others = spark.range(3000).select(F.lpad(F.hex(F.col("id") * 7 + 100_001), 24, "0").alias("record_id"))
    assert maybe_held(others, "record_id", whole, bits).count() < 60
    assert maybe_held(ids, "record_id", whole.limit(0), bits).count() == 0
    assert merged_filters(whole).count() == whole.select("bucket").distinct().count()


def test_scratch_goes_with_its_scope(spark):
    def held():
        return set(os.listdir(shared_dir(spark)))

    before = held()
    with pytest.raises(RuntimeError), scratch_scope(spark):
        stored(spark.range(3), "inner")
        with scratch_scope(spark):
            stored(spark.range(3), "deeper")
            assert len(held() - before) == 2
        assert len(held() - before) == 1
        raise RuntimeError
    assert held() == before
    assert new_run_dir(spark, "x") != new_run_dir(spark, "x")
