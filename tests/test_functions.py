"""Text, id, label and calendar rules, case by case."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyboard.functions import keys, parsing, periods
from tallyboard.schemas import OFFERED_LABELS, RAW_MESSAGES, VALID_LABELS, WORK_CATEGORIES
from tallyboard.sources.messages import from_json_records, normalize

INF = float("inf")


def apply(spark, expression, values, kind="string"):
    """``expression`` of each value, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}").repartition(3)
    rows = df.select("i", expression(F.col("v")).alias("r")).collect()
    return [row.r for row in sorted(rows, key=lambda row: row.i)]


@pytest.mark.parametrize(
    "text,value",
    [
        ("5", 5),
        ("+5", 5),
        ("-12", -12),
        ("007", 7),
        ("5.7", 0),
        (" 5 ", 0),
        ("5\n", 0),
        ("", 0),
        (None, 0),
        ("1_000", 0),
        ("0x10", 0),
        ("9223372036854775807", 2**63 - 1),
        ("9223372036854775808", 0),
        ("99999999999999999999", 0),
    ],
)
def test_integers(spark, text, value):
    assert apply(spark, parsing.long_or_zero, [text]) == [value]


def test_floats(spark):
    cases = {
        "1e3": 1000.0,
        "-2.5": -2.5,
        "+.5": 0.5,
        "5.": 5.0,
        "1.0d": 0.0,
        "1.0f": 0.0,
        " 1": 0.0,
        "1\n": 0.0,
        "": 0.0,
        ".": 0.0,
        "e5": 0.0,
        "1e400": 0.0,
        "-1e400": 0.0,
        "1e-400": 0.0,
        "inf": INF,
        "+Infinity": INF,
        "-INF": -INF,
        "+nan": 0.0,
        "infin": 0.0,
        "1,5": 0.0,
    }
    assert dict(zip(cases, apply(spark, parsing.double_or_zero, list(cases)))) == cases
    nan, missing = apply(spark, parsing.double_or_zero, ["NaN", None])
    assert nan != nan and missing == 0.0


def test_flags(spark):
    cases = {"1": True, "t": True, "T": True, "TRUE": True, "true": True, "True": True}
    cases |= {"tRuE": False, "yes": False, "0": False, "f": False, "": False, " true": False, "true\n": False}
    assert dict(zip(cases, apply(spark, parsing.flag_or_false, list(cases)))) == cases
    assert apply(spark, parsing.flag_or_false, [None]) == [False]


def test_dates(spark):
    none, day = dt.date(1, 1, 1), dt.date(2024, 1, 5)
    cases = {
        "2024-01-05": day,
        "2024-01-05T23:30:00+09:00": day,
        "2024-01-05T00:10:00-08:00": day,
        "2024-01-05T23:30:00Z": day,
        "2024-01-05T23:30:00.123456Z": day,
        "2024-1-5": none,
        "2024-02-30": none,
        "2024-02-29": dt.date(2024, 2, 29),
        "2023-02-29": none,
        "2024-01-05T23:30:00": none,
        "2024-01-05T24:00:00Z": none,
        "2024-01-05 ": none,
        "2024-01-05\n": none,
        "20240105": none,
        "+12024-01-05": none,
        "": none,
    }
    assert dict(zip(cases, apply(spark, parsing.date_or_missing, list(cases)))) == cases


def test_normalize_fills_every_missing_field(spark):
    raw = spark.createDataFrame([(7, {}), (8, {"app": "Code", "isEnd": "1", "session": "2"})], RAW_MESSAGES)
    empty, partial = normalize(raw).orderBy("seq").collect()
    assert empty.asDict() == {
        "seq": 7,
        "user_id": "",
        "usage_log_id": "",
        "categorized_data_id": "",
        "app": "",
        "url": "",
        "title": "",
        "session_no": 0,
        "session_minutes": 0,
        "session_date": dt.date(1, 1, 1),
        "duration": 0.0,
        "ts_epoch": 0.0,
        "is_end": False,
    }
    assert (partial.app, partial.is_end, partial.session_no) == ("Code", True, 2)


def test_broker_records(spark):
    records = spark.createDataFrame(
        [(1, 5, bytearray(b'{"userId":"u","duration":"2.5"}'))], "partition int, offset bigint, value binary"
    )
    row = normalize(from_json_records(records)).first()
    assert (row.seq, row.user_id, row.duration) == ((1 << 40) + 5, "u", 2.5)


def test_valid_ids(spark):
    good = ["0123456789abcdef01234567", "0123456789ABCDEF01234567", "0" * 24]
    bad = ["bad-id", "", "0" * 23, "0" * 25, "g" * 24, "0" * 24 + "\n"]
    assert apply(spark, keys.valid_id, good + bad) == [True] * 3 + [False] * 6


def test_derived_ids_repeat_and_differ(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("a", "bc")], "x string, y string")
    ids = [r[0] for r in df.select(keys.derived_id(F.col("x"), F.col("y"))).collect()]
    assert ids[0] == ids[2] != ids[1] and all(len(i) == 24 for i in ids)


def test_label_text(spark):
    df = spark.createDataFrame([("Chrome", "", "u"), ("Chrome", "T", "U"), ("", "", "")], "app string, title string, url string")
    parts = F.col("app"), F.col("title"), F.col("url")
    rows = df.select(keys.label_prompt(*parts).alias("p"), keys.label_query(*parts).alias("q")).collect()
    assert [r.p for r in rows] == ["Application: chrome\nURL: u", "Application: chrome\nTitle: T\nURL: U", ""]
    assert [r.q for r in rows] == [
        "app: chrome, title: , url: u",
        "app: chrome, title: T, url: U",
        "app: , title: , url: ",
    ]


def test_label_validation(spark):
    answers = [" Game\n", "game", "Music", "AFK", " Design　", "", None, "Finance Browsing"]
    wanted = ["Game", "Uncategorized", "Uncategorized", "AFK", "Design", "Uncategorized", None, "Uncategorized"]
    assert apply(spark, keys.validated_label, answers) == wanted


def test_fixed_lists():
    assert len(VALID_LABELS) == len(set(VALID_LABELS)) == 19
    assert len(OFFERED_LABELS) == len(set(OFFERED_LABELS)) == 18
    assert len(WORK_CATEGORIES) == 13 and set(WORK_CATEGORIES) <= set(VALID_LABELS)
    assert set(OFFERED_LABELS) - set(VALID_LABELS) == {"Communication", "Music"}
    assert set(VALID_LABELS) - set(OFFERED_LABELS) == {"AFK", "Uncategorized", "Meetings"}


def seoul(*when):
    return dt.datetime(*when, tzinfo=dt.timezone(dt.timedelta(hours=9))).timestamp()


@pytest.mark.parametrize(
    "epoch,day,week,month",
    [
        (seoul(2024, 12, 30, 12), "2024-12-30", "2025-W1", "2024-M12"),
        (seoul(2021, 1, 3, 12), "2021-01-03", "2020-W53", "2021-M1"),
        (1704036600.9, "2024-01-01", "2024-W1", "2024-M1"),
        (seoul(2023, 12, 31, 23, 59, 59) + 0.999, "2023-12-31", "2023-W52", "2023-M12"),
        (0.0, "1970-01-01", "1970-W1", "1970-M1"),
        (-0.9, "1970-01-01", "1970-W1", "1970-M1"),
        (-32401.0, "1969-12-31", "1970-W1", "1969-M12"),
    ],
)
def test_periods(spark, epoch, day, week, month):
    df = spark.createDataFrame([(epoch,)], "t double").select(periods.board_day(F.col("t")).alias("d"))
    d = F.col("d")
    row = df.select(periods.day_period(d), periods.week_period(d), periods.month_period(d)).first()
    assert tuple(row) == (day, week, month)


def test_times_outside_the_calendar_have_no_day(spark):
    df = spark.createDataFrame([(INF,), (-INF,), (float("nan"),), (1e18,), (1e300,), (-1e15,)], "t double")
    assert [r[0] for r in df.select(periods.board_day(F.col("t"))).collect()] == [None] * 6


def test_iso_weeks_over_thirty_years(spark):
    start = dt.date(1995, 1, 1)
    days = [start + dt.timedelta(days=i) for i in range(0, 365 * 30)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r.d: r.w for r in df.select("d", periods.week_period(F.col("d")).alias("w")).collect()}
    assert got == {d: "{}-W{}".format(*d.isocalendar()[:2]) for d in days}
