"""Usage per calendar period over a stream, by keyed state with timers.

ISO weeks cross the ends of years and months differ in length, so neither is a window of fixed size. Local days are:
they are summed first, with Spark's map-side combining, so that a hot category costs the keyed state one row a day.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from decimal import Context, Decimal

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tallyboard.functions.periods import board_day, whole_seconds
from tallyboard.operators.leaderboard import DAY, MONTH, WEEK, excluded_entry, periods_of, total
from tallyboard.schemas import BOARD_ZONE

_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A commit writes its changes, not all of the store's files.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Filters inferred from a parsed and classified stream multiply until planning does not end (over two minutes, instead of seconds).
    "spark.sql.constraintPropagation.enabled": "false",
}

#: Wide enough that a sum of finite doubles is not rounded before its end.
_EXACT = Context(prec=800)

PERIOD_USAGE = T.StructType(
    [
        T.StructField("period_kind", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("total_duration", T.DoubleType()),
        T.StructField("messages", T.LongType()),
    ]
)


#: Stores of a query. Its state is a row per category and open day or period, however many messages come, and a store costs about a megabyte.
STORES = 16


@contextmanager
def keyed_state(spark: SparkSession, stores: int = STORES) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which keyed state needs; a query keeps the settings it started with.

    ``stores`` is their number of partitions, which the checkpoint fixes for good. Partial sums leave at most a row per category
    and day of each task of the input for them.
    """
    settings = _SETTINGS | {"spark.sql.shuffle.partitions": str(stores)}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


class PeriodTotals(StatefulProcessor):
    """Adds up the days of one (period, category) and gives the sum out when the period ends."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        # The sum is kept as decimal text: days may come in any order and any number of batches.
        self._sums = handle.getValueState("sums", "duration string, messages long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._sums.get() if self._sums.exists() else ("0", 0)
        duration, messages = Decimal(held[0]), held[1]
        for row in rows:
            duration = _EXACT.add(duration, Decimal(repr(row.duration)))
            messages += row.messages
            closes = row.closes
        self._sums.update((str(duration), messages))
        self._handle.registerTimer(closes)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        duration, messages = self._sums.get()
        self._sums.clear()
        yield Row(**dict(zip(PERIOD_USAGE.names, (*key, float(duration), messages))))

    def close(self) -> None:
        pass


def _closes(kind: Column, day: Column, zone: str) -> Column:
    """Milliseconds at which the period that holds ``day`` is over."""
    after = (
        F.when(kind == WEEK, F.date_add(F.trunc(day, "week"), 7))
        .when(kind == MONTH, F.add_months(F.trunc(day, "month"), 1))
        .when(kind == DAY, F.date_add(day, 1))
    )
    return F.unix_millis(F.to_utc_timestamp(after.cast("timestamp"), zone))


def live_usage_by_period(classified: DataFrame, lateness: str) -> DataFrame:
    """``usage_by_period`` of a stream: each day, week and month once, ``lateness`` after its end; append mode only.

    It counts the entries that the boards count. A message that comes later than that is in the boards only. State is a row per
    open day and category, then one per open period and category, gone when that closes; a period that no later message
    closes is not given out. Start it inside ``keyed_state``. Days of the boards' zone start at 15:00 UTC all year.
    """
    timed = classified.withColumn("event_time", F.timestamp_seconds(whole_seconds(F.col("ts_epoch"))))
    local_day = F.window("event_time", "1 day", startTime="15 hours")
    days = (
        timed.withWatermark("event_time", lateness)
        .where(~excluded_entry())
        .groupBy(local_day.alias("local_day"), "category")
        .agg(total(F.col("duration")).alias("duration"), F.count(F.lit(1)).alias("messages"))
    )
    day = board_day(F.unix_seconds(F.col("local_day.start")))
    periods = days.select("local_day", day.alias("day"), "category", "duration", "messages", F.inline(periods_of(day)))
    keyed = periods.withColumn("closes", _closes(F.col("period_kind"), F.col("day"), BOARD_ZONE))
    return keyed.groupBy("period_kind", "period", "category").transformWithState(
        statefulProcessor=PeriodTotals(), outputStructType=PERIOD_USAGE, outputMode="Append", timeMode="EventTime"
    )
