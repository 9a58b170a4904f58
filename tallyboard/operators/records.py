"""The two stored collections: constructing, inserting, finding and updating rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from tallyboard.functions.keys import id_or_derived, valid_id
from tallyboard.schemas import CATEGORIZED_DATA, USAGE_LOGS, ZERO_ID

NATURAL_KEY = ["app", "url", "title"]


# ---- Inserts ----------------------------------------------------------------


def new_usage_logs(messages: DataFrame) -> DataFrame:
    """Usage-log rows that have no id yet; ``seq`` keeps equal logs apart."""
    category_id = F.col("category_id") if "category_id" in messages.columns else F.lit(ZERO_ID)
    return messages.select(
        F.lit(ZERO_ID).alias("usage_log_id"),
        "user_id",
        "categorized_data_id",
        category_id.alias("category_id"),
        "session_no",
        "session_minutes",
        "session_date",
        "ts_epoch",
        "duration",
        "seq",
    )


def usage_log_insert(rows: DataFrame) -> DataFrame:
    """Rows ready to append: a zero id becomes one derived from the row itself."""
    record_id = id_or_derived(
        F.col("usage_log_id"),
        F.col("user_id"),
        F.col("categorized_data_id"),
        F.col("session_date"),
        F.col("session_no"),
        F.col("seq"),
    )
    return rows.withColumn("usage_log_id", record_id).select(*USAGE_LOGS.fieldNames())


def new_categorized_data(messages: DataFrame) -> DataFrame:
    """One row per natural key, with its id derived from that key."""
    return categorized_insert(
        messages.select(*NATURAL_KEY)
        .distinct()
        .select(
            F.lit(ZERO_ID).alias("categorized_data_id"),
            *NATURAL_KEY,
            F.lit(ZERO_ID).alias("category_id"),
            F.lit(False).alias("is_llm_based"),
        )
    )


def categorized_insert(rows: DataFrame) -> DataFrame:
    record_id = id_or_derived(F.col("categorized_data_id"), *[F.col(c) for c in NATURAL_KEY])
    return rows.withColumn("categorized_data_id", record_id).select(*CATEGORIZED_DATA.fieldNames())


# ---- Finds ------------------------------------------------------------------


def find_usage_log(usage_logs: DataFrame, user_id: str, session_date: date, session_no: int) -> DataFrame:
    """The log of a user's session, or no row; the lowest id where several exist."""
    wanted = (
        (F.col("user_id") == user_id)
        & (F.col("session_date") == F.lit(session_date))
        & (F.col("session_no") == session_no)
    )
    return usage_logs.where(wanted).orderBy("usage_log_id").limit(1)


def find_categorized(categorized_data: DataFrame, app: str, url: str, title: str) -> DataFrame:
    wanted = (F.col("app") == app) & (F.col("url") == url) & (F.col("title") == title)
    return categorized_data.where(wanted).orderBy("categorized_data_id").limit(1)


def first_usage_logs(usage_logs: DataFrame) -> DataFrame:
    """``find_usage_log`` for every (user, session date, session) at once."""
    return _first_per_key(usage_logs, ["user_id", "session_date", "session_no"], "usage_log_id")


def first_categorized(categorized_data: DataFrame) -> DataFrame:
    """``find_categorized`` for every natural key at once."""
    return _first_per_key(categorized_data, NATURAL_KEY, "categorized_data_id")


def _first_per_key(rows: DataFrame, keys: list[str], record_id: str) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys and c != record_id]
    first = rows.groupBy(*keys).agg(F.min(F.struct(record_id, *rest)).alias("first"))
    return first.select(*keys, "first.*").select(*rows.columns)


def find_many(categorized_data: DataFrame, keys: DataFrame) -> DataFrame:
    """The stored row of each wanted natural key; the last id where several exist.

    Both sides shrink to one row per key before they meet, so a key repeated many
    times on either side costs no more than any other.
    """
    rest = [c for c in categorized_data.columns if c not in NATURAL_KEY and c != "categorized_data_id"]
    stored = categorized_data.groupBy(*NATURAL_KEY).agg(
        F.max(F.struct("categorized_data_id", *rest)).alias("last")
    )
    wanted = keys.select(*NATURAL_KEY).distinct()
    return stored.join(wanted, NATURAL_KEY, "left_semi").select(*NATURAL_KEY, "last.*").select(
        *categorized_data.columns
    )


def new_keys(keys: DataFrame, categorized_data: DataFrame) -> DataFrame:
    """Natural keys that are not stored yet."""
    wanted = keys.select(*NATURAL_KEY).distinct()
    stored = categorized_data.select(*NATURAL_KEY).distinct()
    return wanted.join(stored, NATURAL_KEY, "left_anti")


# ---- Keyed updates ----------------------------------------------------------
# Update-only: ids that are not stored change nothing, ids that are not ids are skipped.


def latest_per_id(
    messages: DataFrame, record_id: str, value: str, also: Sequence[str] = (), by: Sequence[str] = ()
) -> DataFrame:
    """(record_id, value, seq) with the value that arrived last for each valid id, and ``also`` other columns of that message.

    Arrival is the broker's time where messages have it (``arrived``), then ``seq``.
    Ids are bytes written in hexadecimal: upper and lower case are one id. ``by`` names columns whose values are taken apart.
    """
    rows = messages.where(valid_id(F.col(record_id)))
    order = [name for name in ("arrived", "seq") if name in messages.columns]
    latest = by_id(rows.withColumn("record_id", F.lower(record_id)), "record_id", by).agg(
        F.max(F.struct(*order, F.col(value).alias("value"), *also)).alias("latest")
    )
    more = [f"latest.{name}" for name in also]
    return latest.select(*by, "record_id", F.col("latest.value").alias(value), F.col("latest.seq").alias("seq"), *more)


def by_id(rows: DataFrame, record_id: str, by: Sequence[str] = ()) -> GroupedData:
    """Groups by id. Their texts begin alike, which makes sorting slow, as aggregates of texts do; a hash in front decides most comparisons."""
    return rows.groupBy(F.xxhash64(record_id).alias("id_hash"), *by, record_id)


def set_by_id(table: DataFrame, id_column: str, target: str, updates: DataFrame) -> DataFrame:
    """``table`` with ``target`` replaced where ``updates`` (record_id, target, …) has the row's id.

    Ids are unique on both sides, so no key is hot, and whether the updates are
    few enough to broadcast is left to Spark's own size statistics. Stored ids keep their letters.
    """
    changes = updates.select("record_id", F.col(target).alias("updated_value"))
    joined = table.join(changes, F.lower(id_column) == F.col("record_id"), "left")
    return joined.withColumn(target, F.coalesce("updated_value", target)).select(*table.columns)


def set_usage_log_category(usage_logs: DataFrame, updates: DataFrame) -> DataFrame:
    return set_by_id(usage_logs, "usage_log_id", "category_id", updates)


def set_usage_log_categorized(usage_logs: DataFrame, updates: DataFrame) -> DataFrame:
    return set_by_id(usage_logs, "usage_log_id", "categorized_data_id", updates)


def set_categorized_category(categorized_data: DataFrame, updates: DataFrame) -> DataFrame:
    return set_by_id(categorized_data, "categorized_data_id", "category_id", updates)


def matched_updates(table: DataFrame, id_column: str, updates: DataFrame) -> DataFrame:
    """Updates that hit a stored row; the others were no-ops."""
    stored = table.select(F.lower(id_column).alias("record_id"))
    return updates.join(stored, "record_id", "left_semi")


def update_counts(table: DataFrame, id_column: str, target: str, updates: DataFrame) -> DataFrame:
    """One row: updates, those that hit a stored row (matched), changed it (modified), or hit none (no_op)."""
    stored = table.select(F.lower(id_column).alias("record_id"), F.col(target).alias("stored_value"), F.lit(True).alias("hit"))
    joined = updates.select("record_id", target).join(stored, "record_id", "left")
    return joined.agg(
        F.count(F.lit(1)).alias("updates"),
        F.count_if("hit").alias("matched"),
        F.count_if(F.col("hit") & ~F.col("stored_value").eqNullSafe(F.col(target))).alias("modified"),
        F.count_if(F.col("hit").isNull()).alias("no_op"),
    )


def single_update(spark: SparkSession, record_id: str, target: str, value: str) -> DataFrame:
    """One update as a frame, for the functions above."""
    row = spark.range(1).select(
        F.lit(record_id).alias("given"), F.lit(value).alias(target), F.lit(0).cast("bigint").alias("seq")
    )
    return row.where(valid_id(F.col("given"))).select(F.lower("given").alias("record_id"), target, "seq")

