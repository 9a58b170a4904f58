"""Usage totals per board, period and user, and their ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyboard.functions.periods import board_day, board_key, day_period, month_period, week_period
from tallyboard.operators.lookup import attach
from tallyboard.schemas import BOARD_ZONE, WORK_BOARD, WORK_CATEGORIES
from tallyboard.session import new_run_dir, stored

DAY, WEEK, MONTH = "day", "week", "month"


def is_work(category: Column) -> Column:
    return category.isin(*WORK_CATEGORIES)


def leaderboard_entries(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(user_id, category, duration, ts_epoch) of the messages that can be counted, and the columns ``by``.

    A duration that is not finite, or a time outside the calendar, would spoil a
    total for good and is left out; ``excluded_entry`` counts such rows.
    """
    kept = classified.where(~excluded_entry())
    return kept.select(*by, "user_id", "category", "duration", "ts_epoch")


def excluded_entry() -> Column:
    # False for NaN too, which sorts last; a missing duration is no duration.
    finite = F.coalesce(F.abs("duration") < float("inf"), F.lit(False))
    return ~finite | board_day(F.col("ts_epoch")).isNull()


#: Amounts are counted in millionths, and the sum of those in two parts that cannot overflow.
_UNIT = 1_000_000
_PART = 1 << 20
_HELD = 1 << 31


def total(amount: Column) -> Column:
    """Sum of doubles in which the order of adding does not show, never null for a group with a value.

    Amounts below 10^9 that are whole millionths are summed as integers. The others, if a decimal holds them to the last
    digit, are added as such; those too large or too fine for it are added as doubles. Should the decimal sum overflow, all are.
    """
    units = F.rint(amount * _UNIT)
    whole = F.coalesce((F.abs(amount) < 1e9) & (units / _UNIT == amount), F.lit(False))
    counted = F.when(whole, units).cast("bigint")
    high = F.sum(F.shiftright(counted, 20))
    low = F.sum(counted.bitwiseAND(F.lit(_PART - 1).cast("bigint")))
    as_decimal = F.when(~whole, amount).try_cast("decimal(38,16)")
    fits = ~whole & F.coalesce((F.abs(amount) < 1e15) & (as_decimal.cast("double") == amount), F.lit(False))
    fine = F.try_sum(F.when(fits, as_decimal))
    other = F.sum(F.when(~whole & ~fits, amount))
    sum_units = high.cast("decimal(38,0)") * F.lit(_PART).cast("decimal(8,0)") + low.cast("decimal(20,0)")
    counted_sum = sum_units.cast("decimal(30,0)") / F.lit(_UNIT).cast("decimal(8,0)")
    exact = F.when(fine.isNull(), counted_sum.cast("double")).otherwise(
        F.coalesce(F.try_add(F.coalesce(counted_sum.cast("decimal(38,16)"), F.lit(0).cast("decimal(38,16)")), fine).cast("double"))
    )
    overflowed = F.sum(F.when(fits, amount)) + F.coalesce(counted_sum.cast("double"), F.lit(0.0))
    kept = F.coalesce(exact, overflowed)
    rest = F.when(other.isNull(), kept).otherwise(F.coalesce(kept, F.lit(0.0)) + other)
    # Millionths that a double holds to the last one: their quotient is the same without decimals, and nearly all sums are such.
    held = F.coalesce(fine.isNull() & other.isNull() & (F.abs(high) < _HELD) & (low < _HELD * _PART), F.lit(False))
    return F.when(held, (high * _PART + low).cast("double") / _UNIT).otherwise(rest)


def daily_totals(entries: DataFrame, zone: str = BOARD_ZONE, by: Sequence[str] = ()) -> DataFrame:
    """Duration per (user, category, local day): all that the boards need. ``by`` names further columns of the key."""
    return (
        entries.withColumn("day", board_day(F.col("ts_epoch"), zone))
        .groupBy(*by, "user_id", "category", "day")
        .agg(total(F.col("duration")).alias("duration"))
    )


def boards_of(category: Column) -> Column:
    return F.when(is_work(category), F.array(category, F.lit(WORK_BOARD))).otherwise(F.array(category))


def periods_of(day: Column) -> Column:
    kinds = ((DAY, day_period(day)), (WEEK, week_period(day)), (MONTH, month_period(day)))
    return F.array(
        *[F.struct(F.lit(kind).alias("period_kind"), period.alias("period")) for kind, period in kinds]
    )


def fan_out(daily: DataFrame) -> DataFrame:
    """Three periods for the category's board, three more for the work board."""
    boards = daily.select("user_id", "day", "duration", F.explode(boards_of(F.col("category"))).alias("board"))
    periods = boards.select("user_id", "board", "duration", F.inline(periods_of(F.col("day"))))
    return periods.select(
        "board",
        "period_kind",
        "period",
        board_key(F.col("board"), F.col("period")).alias("key"),
        "user_id",
        "duration",
    )


def leaderboard(entries: DataFrame, zone: str = BOARD_ZONE) -> DataFrame:
    """Score per (board key, user).

    Days are summed before the fan-out multiplies rows. What is left of a user is
    then small (categories times days), so one exchange by user serves every
    board and period.
    """
    return _rolled_up(daily_totals(entries, zone).repartition("user_id"))


def _rolled_up(daily: DataFrame) -> DataFrame:
    """``fan_out`` and the sums, with periods as their first days until those are made."""
    boards = daily.select("user_id", "day", "duration", F.explode(boards_of(F.col("category"))).alias("board"))
    firsts = ((DAY, F.col("day")), (WEEK, F.trunc("day", "week")), (MONTH, F.trunc("day", "month")))
    each = F.array(*[F.struct(F.lit(kind).alias("period_kind"), first.alias("first")) for kind, first in firsts])
    sums = (
        boards.select("user_id", "board", "duration", F.inline(each))
        .groupBy("user_id", "board", "period_kind", "first")
        .agg(total(F.col("duration")).alias("score"))
    )
    day, kind = F.col("first"), F.col("period_kind")
    period = F.when(kind == DAY, day_period(day)).when(kind == WEEK, week_period(day)).otherwise(month_period(day))
    return sums.select("board", "period_kind", period.alias("period"), "user_id", "score").select(
        "board",
        "period_kind",
        "period",
        board_key(F.col("board"), F.col("period")).alias("key"),
        "user_id",
        "score",
    )


def merged_days(deltas: DataFrame) -> DataFrame:
    """One row per (user, category, day) from the totals of several batches."""
    return deltas.groupBy("user_id", "category", "day").agg(total(F.col("duration")).alias("duration"))


def merge_deltas(deltas: DataFrame) -> DataFrame:
    """Leaderboard from the per-batch daily totals, whatever their order or number."""
    return _rolled_up(merged_days(deltas).repartition("user_id"))


def usage_by_period(entries: DataFrame, zone: str = BOARD_ZONE) -> DataFrame:
    """Total usage and active users per calendar window and category, over all users."""
    days = (
        entries.withColumn("day", board_day(F.col("ts_epoch"), zone))
        .groupBy("category", "day")
        .agg(total(F.col("duration")).alias("duration"), F.count(F.lit(1)).alias("messages"))
    )
    windows = days.select("category", "duration", "messages", F.inline(periods_of(F.col("day"))))
    return windows.groupBy("period_kind", "period", "category").agg(
        total(F.col("duration")).alias("total_duration"),
        F.sum("messages").alias("messages"),
    )


# ---- Ranking ----------------------------------------------------------------
# Highest score first; equal scores by user id, descending. Ranks start at 1.


def _best_first() -> list[Column]:
    return [F.col("score").desc(), F.col("user_id").desc()]


def top_k(board: DataFrame, k: int) -> DataFrame:
    """The first ``k`` users of each board. Each task keeps at most k rows per key before the shuffle."""
    place = F.row_number().over(Window.partitionBy("key").orderBy(*_best_first()))
    return (
        board.withColumn("rank", place.cast("bigint"))
        .where(F.col("rank") <= k)
        .select("key", "user_id", "score", "rank")
    )


def rank_all(board: DataFrame) -> DataFrame:
    """Every user's rank, with no board gathered in one task.

    The rows are range-partitioned into final order, so a large board spans many
    partitions; a row's rank is its place in its partition plus the rows its
    board has in earlier ones. The ordered rows are written to the shared folder
    too, as both uses of them must see the same partition limits.
    """
    spark = board.sparkSession
    order = [F.col("key").asc(), *_best_first()]
    # Written first: the range limits are sampled from the table, not by computing the board twice.
    plain = new_run_dir(spark, "board")
    board.select("key", "user_id", "score").write.parquet(plain)
    ordered = (
        spark.read.parquet(plain)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id())
    )
    path = new_run_dir(spark, "ranked")
    ordered.write.parquet(path)
    located = spark.read.schema(ordered.schema).parquet(path).withColumn("part", F.shiftright("place", 33))
    runs = located.groupBy("key", "part").agg(
        F.min("place").alias("first_place"), F.count(F.lit(1)).alias("run_rows")
    )
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        "key", "part", "first_place", F.coalesce(F.sum("run_rows").over(earlier), F.lit(0)).alias("before")
    )
    return attach(located, offsets, ["key", "part"]).select(
        "key", "user_id", "score", F.expr("before + place - first_place + 1").alias("rank")
    )


# ---- Ranks of single users ----------------------------------------------------
# Buckets are ranges of scores: 64 to each power of two, so some hundreds for a board, whatever its size.

_BUCKETS = 64
_LARGEST = 1.7976931348623157e308


def score_bucket(score: Column) -> Column:
    """The number of the bucket of a score; it never falls as the score rises."""
    # Powers of two from -1,074 to 1,024 give numbers below 100,000 on either side of zero.
    place = F.floor(F.log2(F.least(F.abs(score), F.lit(_LARGEST))) * _BUCKETS).cast("int")
    return F.when(score > 0, F.lit(100_000) + place).when(score < 0, -(F.lit(100_000) + place)).otherwise(0)


def rank_index(board: DataFrame) -> DataFrame:
    """(key, bucket, users, above): a histogram of each board's scores, with the users in all higher buckets."""
    counts = board.groupBy("key", score_bucket(F.col("score")).alias("bucket")).agg(F.count(F.lit(1)).alias("users"))
    higher = Window.partitionBy("key").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("above", F.coalesce(F.sum("users").over(higher), F.lit(0)))


def user_ranks(board: DataFrame, asked: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """(key, user_id, score, rank) of the ``asked`` (key, user_id), as ``rank_all`` has them, without sorting any board.

    A rank is the number of users in higher buckets and, within the user's own bucket, of those ahead. ``index`` is the
    board's ``rank_index``, if it is stored. Users that a board does not have get no row. The work beside the histogram is that of
    the buckets asked for, once for each user asked in them: meant for some users, not for all.
    """
    wanted = asked.select("key", "user_id").distinct()
    placed = board.select("key", "user_id", "score", score_bucket(F.col("score")).alias("bucket"))
    mine = stored(placed.join(_hashed(wanted), ["key", "user_id"], "left_semi"), "asked")
    names = {"key": "k", "bucket": "b", "user_id": "u", "score": "s"}
    rivals = placed.join(
        _hashed(mine.select(*[F.col(name).alias(short) for name, short in names.items()])),
        (F.col("key") == F.col("k")) & (F.col("bucket") == F.col("b")),
    ).where((F.col("score") > F.col("s")) | ((F.col("score") == F.col("s")) & (F.col("user_id") > F.col("u"))))
    ahead = rivals.groupBy(F.col("k").alias("key"), F.col("u").alias("user_id")).agg(F.count(F.lit(1)).alias("ahead"))
    buckets = (rank_index(board) if index is None else index).select("key", "bucket", "above")
    found = mine.join(_hashed(ahead), ["key", "user_id"], "left").join(_hashed(buckets), ["key", "bucket"])
    return found.select("key", "user_id", "score", (F.col("above") + F.coalesce("ahead", F.lit(0)) + 1).alias("rank"))


def _hashed(df: DataFrame) -> DataFrame:
    """The side that is held by its keys; Spark broadcasts it where its size is known to be small."""
    return df.hint("shuffle_hash")
