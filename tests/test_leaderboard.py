"""Boards, periods and ranks against brute force in Python."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyboard.operators import leaderboard as lb
from tallyboard.operators.sessions import session_scores
from tallyboard.schemas import WORK_CATEGORIES

SEOUL = dt.timezone(dt.timedelta(hours=9))
ENTRY = "user_id string, category string, duration double, ts_epoch double"


def brute_force(entries):
    board = defaultdict(float)
    for user, category, duration, ts in entries:
        day = dt.datetime.fromtimestamp(int(ts), SEOUL).date()
        year, week, _ = day.isocalendar()
        for name in [category] + (["work"] if category in WORK_CATEGORIES else []):
            for period in (day.isoformat(), f"{year}-W{week}", f"{day.year}-M{day.month}"):
                board[f"leaderboard:{name}:{period}", user] += duration
    return dict(board)


def scores(df):
    return {(r.key, r.user_id): r.score for r in df.collect()}


@pytest.fixture(scope="module")
def entries():
    rng = random.Random(5)
    categories = ["Development", "Game", "work", "Meetings", "Custom"]
    return [
        (f"u{rng.choice([0, 0, rng.randrange(30)])}", rng.choice(categories), rng.randrange(-100, 1000) / 4, 1.70e9 + rng.randrange(90 * 86400))
        for _ in range(3000)
    ]


def test_leaderboard(spark, entries):
    board = lb.leaderboard(spark.createDataFrame(entries, ENTRY))
    assert scores(board) == brute_force(entries)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_lose_nothing(spark, ansi):
    """Tiny amounts add up, huge ones neither fail nor vanish, and the order of adding does not show."""
    rows = [("tiny", "Game", 0.004, 0.0)] * 1000 + [("huge", "Game", 1e17, 0.0), ("huge", "Game", 0.5, 0.0)]
    rows += [("most", "Game", 1.7e308, 0.0), ("fine", "Game", 1e-30, 0.0), ("many", "Game", 9.9e14, 0.0)]
    rows += [("cents", "Game", 0.1, 0.0)] * 10
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = scores(lb.leaderboard(spark.createDataFrame(rows, ENTRY).repartition(5)))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    day = {user: score for (key, user), score in got.items() if key.endswith("1970-01-01")}
    assert day == {"tiny": 4.0, "huge": 1e17 + 0.5, "most": 1.7e308, "fine": 1e-30, "many": 9.9e14, "cents": 1.0}


def test_one_exchange_serves_all_boards(spark, entries):
    plan = lb.leaderboard(spark.createDataFrame(entries, ENTRY))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2  # daily totals, then by user


def test_zero_and_negative_durations_count(spark):
    rows = [("a", "Game", 0.0, 0.0), ("a", "Game", -1.0, 0.0), ("b", "Game", 0.0, 0.0)]
    assert scores(lb.leaderboard(spark.createDataFrame(rows, ENTRY))) == brute_force(rows)


def test_category_named_work_shares_the_work_board(spark):
    rows = [("a", "work", 1.0, 0.0), ("a", "Development", 2.0, 0.0)]
    assert scores(lb.leaderboard(spark.createDataFrame(rows, ENTRY)))["leaderboard:work:1970-W1", "a"] == 3.0


def test_uncountable_entries_are_left_out_and_counted(spark):
    rows = [("a", "Game", d, t) for d, t in ((1.0, 0.0), (None, 0.0), (float("inf"), 0.0), (float("nan"), 0.0), (2.0, float("nan")), (4.0, 1e18))]
    df = spark.createDataFrame(rows, ENTRY)
    assert scores(lb.leaderboard(lb.leaderboard_entries(df)))["leaderboard:Game:1970-01-01", "a"] == 1.0
    assert df.where(lb.excluded_entry()).count() == 5


def test_usage_by_period(spark, entries):
    got = {(r.period, r.category): (r.total_duration, r.messages) for r in lb.usage_by_period(spark.createDataFrame(entries, ENTRY)).collect()}
    want = defaultdict(lambda: [0.0, 0])
    for user, category, duration, ts in entries:
        day = dt.datetime.fromtimestamp(int(ts), SEOUL).date()
        year, week, _ = day.isocalendar()
        for period in (day.isoformat(), f"{year}-W{week}", f"{day.year}-M{day.month}"):
            want[period, category][0] += duration
            want[period, category][1] += 1
    assert got == {k: tuple(v) for k, v in want.items()}


def test_ranks(spark):
    """One board with most rows, ties, and small boards that start and end inside partitions."""
    rng = random.Random(3)
    rows = [("big", f"u{i:05d}", float(rng.randrange(40))) for i in range(5000)]
    rows += [(f"b{i % 37}", f"u{i:05d}", float(rng.randrange(5))) for i in range(700)]
    df = spark.createDataFrame(rows, "key string, user_id string, score double")
    want = {}
    for key in {r[0] for r in rows}:
        best = sorted(((s, u) for k, u, s in rows if k == key), reverse=True)
        want |= {(key, u): n for n, (s, u) in enumerate(best, 1)}
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = {(r.key, r.user_id): r["rank"] for r in lb.rank_all(df).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "2")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert got == want
    top = {(r.key, r.user_id): r["rank"] for r in lb.top_k(df, 3).collect()}
    assert top == {k: n for k, n in want.items() if n <= 3}
    plan = lb.top_k(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_sums_of_mixed_amounts(spark):
    """Whole millionths, finer and larger amounts of both signs in one group, in any order: the exact sum, rounded once."""
    from fractions import Fraction

    rng = random.Random(9)
    kinds = [lambda: rng.randrange(-(10**9), 10**9) / 100, lambda: rng.randrange(-(10**12), 10**12) / 10**6, lambda: rng.choice([0.1, -0.3, 1e-9, 5e-12]),
             lambda: float(rng.randrange(-(10**14), 10**14)), lambda: 0.0, lambda: -999_999_999.999999]
    rows = [(f"g{i % 40}", kinds[rng.randrange(len(kinds))]()) for i in range(4000)]
    frame = spark.createDataFrame(rows, "g string, d double")
    got = [{r.g: r.t for r in frame.repartition(n).groupBy("g").agg(lb.total(F.col("d")).alias("t")).collect()} for n in (1, 6)]
    assert got[0] == got[1]
    want = {g: float(sum((Fraction(repr(d)) for h, d in rows if h == g), Fraction())) for g in got[0]}
    assert got[0] == want


def test_ranks_of_single_users(spark):
    rng = random.Random(4)
    rows = [("big", f"u{i:05d}", float(rng.choice([rng.randrange(40), rng.randrange(10**6) / 7, 0, -rng.randrange(50) / 3]))) for i in range(4000)]
    rows += [("ties", f"u{i:05d}", 1.5) for i in range(500)] + [("one", "u00000", -0.0), ("far", "u1", 1.7e308), ("far", "u2", 5e-324), ("far", "u3", -1e300)]
    board = spark.createDataFrame(rows, "key string, user_id string, score double")
    asked = board.where("user_id rlike '[05]0$' or key = 'far'").select("key", "user_id").unionByName(
        spark.createDataFrame([("big", "nobody"), ("none", "u00000")], "key string, user_id string"))
    want = {}
    for key in {r[0] for r in rows}:
        for n, (s, u) in enumerate(sorted(((s, u) for k, u, s in rows if k == key), reverse=True), 1):
            want[key, u] = (s, n)
    found = lb.user_ranks(board, asked)
    wanted = {(r.key, r.user_id) for r in asked.collect()} & want.keys()
    assert {(r.key, r.user_id): (r.score, r["rank"]) for r in found.collect()} == {k: want[k] for k in wanted} and len(wanted) > 90
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "rangepartitioning" not in plan
    assert lb.rank_index(board).groupBy("key").agg(F.sum("users").alias("n")).where("key = 'ties'").first().n == 500


def test_session_scores_keep_repeats(spark):
    rows = [("u", dt.date(2024, 1, 5), 3, True)] * 2 + [("u", dt.date(1, 1, 1), 1, True), ("u", dt.date(2024, 1, 5), 4, False)]
    df = spark.createDataFrame(rows, "user_id string, session_date date, session_no bigint, is_end boolean")
    assert sorted(map(tuple, session_scores(df).collect())) == [("u", "0001-01-01", 1)] + [("u", "2024-01-05", 3)] * 2
