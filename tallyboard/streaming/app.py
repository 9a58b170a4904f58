"""Command line of the streaming job.

    spark-submit usage_job.py --messages <folder> --patterns <table> --out <folder>

Messages come from a folder of JSON or parquet files, or from Kafka with
``--kafka`` and the connector on the class path.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyboard.schemas import LEARNED_LABELS, MESSAGE_STREAM
from tallyboard.session import build_session
from tallyboard.sources.messages import normalize, stream_raw, stream_raw_kafka
from tallyboard.sources.tables import PatternStore, read_batches, read_patterns
from tallyboard.streaming.pipeline import Sinks, UsageJob, categorized_table, close_days, usage_log_table


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Classify usage messages and keep leaderboards.")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--messages", help="folder of raw messages")
    source.add_argument("--kafka", help="bootstrap servers")
    parser.add_argument("--format", default="json", choices=("json", "parquet"))
    parser.add_argument("--topic", default=MESSAGE_STREAM)
    dictionary = parser.add_mutually_exclusive_group(required=True)
    dictionary.add_argument("--patterns", help="category dictionary, parquet")
    dictionary.add_argument("--pattern-versions", help="folder of its versions; one that has not changed is not read again")
    parser.add_argument("--labels", help="folder of label answers, parquet")
    parser.add_argument("--out", required=True, help="folder for the result tables and the checkpoint")
    parser.add_argument("--interval", default="2 seconds")
    parser.add_argument("--limit", type=int, help="files (or Kafka records) per batch")
    parser.add_argument("--rows", type=int, help="messages that a batch may hold; larger ones are processed in parts")
    parser.add_argument("--once", action="store_true", help="stop when all present messages are done")
    parser.add_argument("--drop-repeats", action="store_true", help="leave out messages with a usage-log id seen before")
    parser.add_argument("--fold-every", type=int, metavar="BATCHES", help="merge old batches this often", default=500)
    parser.add_argument("--session-servers", help="bootstrap servers that get the session records")
    parser.add_argument("--usage-logs", help="versioned table of usage logs that gets the categories and counts the changes")
    parser.add_argument("--categorized", help="versioned table of natural keys that gets them too")
    parser.add_argument("--append", action="store_true", help="add logs and keys that those tables do not have")
    parser.add_argument("--close-before", type=dt.date.fromisoformat, metavar="DAY", help="close the days before, then stop")
    return parser.parse_args(argv)


def message_stream(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.kafka:
        raw = stream_raw_kafka(spark, args.kafka, args.topic, args.limit)
    else:
        raw = stream_raw(spark, args.messages, args.format, args.limit)
    return normalize(raw)


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session()
    sinks = Sinks(args.out.rstrip("/"))
    if args.close_before:
        close_days(spark, sinks, args.close_before)
        return
    job = UsageJob(
        sinks,
        load_patterns=lambda: read_patterns(spark, args.patterns),
        patterns=PatternStore(args.pattern_versions) if args.pattern_versions else None,
        usage_logs=usage_log_table(args.usage_logs) if args.usage_logs else None,
        categorized=categorized_table(args.categorized) if args.categorized else None,
        append_logs=args.append,
        most_rows=args.rows,
        load_labels=(lambda: read_batches(spark, args.labels, LEARNED_LABELS)) if args.labels else None,
        drop_repeats=args.drop_repeats,
        fold_every=args.fold_every,
        session_servers=args.session_servers,
    )
    messages = message_stream(spark, args)
    if args.once:
        job.run_available(messages, normalized=True)
    else:
        job.start(messages, args.interval, normalized=True).awaitTermination()


if __name__ == "__main__":
    main()
