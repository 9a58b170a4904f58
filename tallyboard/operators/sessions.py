"""Finished sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.functions.keys import derived_id
from tallyboard.schemas import SESSION_SCORE_STREAM


def session_scores(messages: DataFrame) -> DataFrame:
    """One record per message that ends a session; repeats are kept."""
    return messages.where("is_end").select(
        "user_id", F.date_format("session_date", "yyyy-MM-dd").alias("session_date"), "session_no"
    )


def session_outbox(messages: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``session_scores`` with ``event_id``, derived from the message, so that a batch that runs again gives it again, and the columns ``by``."""
    names = [name for name in ("arrived", "seq") if name in messages.columns]
    event = derived_id(F.col("user_id"), F.col("session_date"), F.col("session_no"), *[F.col(name) for name in names])
    ended = messages.where("is_end").withColumn("event_id", event)
    day = F.date_format("session_date", "yyyy-MM-dd")
    return ended.select(*by, "user_id", day.alias("session_date"), "session_no", "event_id")


def session_events(scores: DataFrame) -> DataFrame:
    """Session records as stream records: the user as key, all fields as a JSON object of strings.

    An ``event_id`` goes into a header of that name, by which a receiver knows a record that was sent twice.
    """
    fields = [F.col(name).cast("string").alias(name) for name in ("user_id", "session_date", "session_no")]
    names = [F.struct(fields[0].alias("userId"), fields[1].alias("sessionDate"), fields[2].alias("session"))]
    records = [F.col("user_id").alias("key"), F.to_json(*names).alias("value")]
    if "event_id" in scores.columns:
        header = F.struct(F.lit("event_id").alias("key"), F.col("event_id").cast("binary").alias("value"))
        records.append(F.array(header).alias("headers"))
    return scores.select(*records)


def write_session_events(scores: DataFrame, servers: str, topic: str = SESSION_SCORE_STREAM) -> None:
    """Append the records to a topic. Needs the Kafka connector on the class path."""
    writer = session_events(scores).write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("includeHeaders", "true").option("topic", topic).save()
