"""The library's input tables, derived from the given TPC-H-like star schema.

``events`` supplies the usage messages and ``pages`` their URLs; see FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.functions.keys import label_query, valid_id
from tallyboard.schemas import CATEGORY_PATTERNS, VALID_LABELS, ZERO_ID

# Fixed values of the mapping: event type -> (type number, app).
EVENT_APPS = {
    "error": (0, "Terminal"),
    "view": (1, "YouTube"),
    "click": (2, "Chrome"),
    "signup": (3, "Safari"),
    "purchase": (4, "Figma"),
}

# The dictionary used for classification.
CATEGORY_DOCUMENTS = (
    (1, "Development", ["terminal"], []),
    (2, "Entertainment", ["youtube"], []),
    (3, "Design", ["Figma"], []),
    (4, "Documentation", [], ["blog."]),
    (5, "SNS", [], ["m."]),
    (6, "Browsing", [], ["example.net"]),
    (7, "Education", [], ["/de/"]),
    (8, "E-commerce & Shopping", [], ["cheap-pills"]),
    (9, "Finance", [], ["example.org/e"]),
)

# Raw labeller answers, by page_id % 9 (the ninth is "no answer").
RAW_ANSWERS = (" Game\n", "game", "Music", "AFK", "Finance", " Music ", "\tDesign ", "")

BROWSER_APPS = ("Chrome", "Safari", "Figma")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex_id(number: Column) -> Column:
    return F.lpad(F.lower(F.hex(number)), 24, "0")


def _by_event_type(position: int) -> Column:
    chosen = None
    for name, values in EVENT_APPS.items():
        value = F.lit(values[position])
        branch = F.col("event_type") == name
        chosen = F.when(branch, value) if chosen is None else chosen.when(branch, value)
    return chosen


def visits(events: DataFrame, pages: DataFrame) -> DataFrame:
    """Each event with the page it visits.

    The page count is read from file footers; as a plain number it leaves an
    ordinary equi-join, whose strategy follows from the sizes of the files.
    """
    page_count = pages.count()
    at = events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        (F.col("event_id") % page_count).alias("page_id"),
    )
    return at.join(pages.select("page_id", "url"), "page_id")


def messages_from(events: DataFrame, pages: DataFrame) -> DataFrame:
    event = F.col("event_id")
    return visits(events, pages).select(
        event.alias("seq"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(event % 97 == 0, "bad-id").otherwise(hex_id(event)).alias("usage_log_id"),
        hex_id(F.col("page_id") * 10 + _by_event_type(0)).alias("categorized_data_id"),
        _by_event_type(1).alias("app"),
        "url",
        F.concat(F.lit("Page "), F.col("page_id").cast("string")).alias("title"),
        (F.lit(1) + F.floor(F.hour("ts") / 6)).cast("bigint").alias("session_no"),
        F.lit(25).cast("bigint").alias("session_minutes"),
        F.to_date("ts").alias("session_date"),
        F.col("value").alias("duration"),
        (F.unix_micros("ts") / F.lit(1000000.0)).alias("ts_epoch"),
        (event % 10 == 0).alias("is_end"),
        "page_id",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from(table(spark, sf_dir, "events"), table(spark, sf_dir, "pages"))


def raw_from(events: DataFrame, pages: DataFrame) -> DataFrame:
    """The messages as text fields, some of them odd in ways a parser must survive."""
    typed = messages_from(events, pages)
    kind = F.col("seq") % 50
    day = F.date_format("session_date", "yyyy-MM-dd")
    session = F.col("session_no").cast("string")
    fields = {
        "userId": F.col("user_id"),
        "categorizedDataId": F.col("categorized_data_id"),
        "pomodoroUsageLogId": F.col("usage_log_id"),
        "url": F.col("url"),
        "title": F.col("title"),
        "app": F.col("app"),
        "session": F.when(kind == 1, "5.7").when(kind == 7, " 5 ").otherwise(session),
        "sessionDate": F.when(kind == 4, "2024-1-5")
        .when(kind == 5, F.concat(day, F.lit("T23:30:00+09:00")))
        .otherwise(day),
        "sessionMinutes": F.col("session_minutes").cast("string"),
        "duration": F.when(kind != 0, F.col("duration").cast("string")),
        "timestamp": F.when(kind != 6, F.col("ts_epoch").cast("string")),
        "isEnd": F.when(kind == 2, "yes").when(kind == 3, "T").otherwise(F.col("is_end").cast("string")),
    }
    pairs = [part for name, value in fields.items() for part in (F.lit(name), value)]
    return typed.select("seq", F.create_map(*pairs).alias("values"))


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from(table(spark, sf_dir, "events"), table(spark, sf_dir, "pages"))


def stream_raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` file read as a stream, as raw messages."""
    stored = table(spark, sf_dir, "events")
    events = (
        spark.readStream.schema(stored.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    return raw_from(events, table(spark, sf_dir, "pages"))


def closing_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last message once more, ten years later: after it no period of the others is open."""
    last = messages(spark, sf_dir).orderBy(F.col("seq").desc()).limit(1)
    return last.withColumn("ts_epoch", F.col("ts_epoch") + F.lit(10 * 366 * 86400.0))


def category_patterns(spark: SparkSession) -> DataFrame:
    rows = [(f"{ord_:024x}", category, apps, urls, ord_) for ord_, category, apps, urls in CATEGORY_DOCUMENTS]
    return spark.createDataFrame(rows, CATEGORY_PATTERNS).coalesce(1)


def site_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary that grows with ``pages``: one document per page.

    It has repeated patterns, repeated and blank categories, upper-case apps and
    empty URL patterns.
    """
    page = F.col("page_id")
    labels = F.array(*[F.lit(label) for label in VALID_LABELS])
    category = F.when(page % 23 == 0, "").otherwise(F.get(labels, (page % len(VALID_LABELS)).cast("int")))
    site = F.regexp_extract("url", r"^[a-z]+://(?:m\.|blog\.|www\.)?([a-z0-9-]+)", 1)
    path = F.regexp_extract("url", r"(/[a-z]+/[0-9]+)", 1)
    return (
        table(spark, sf_dir, "pages")
        .select("page_id", category.alias("category"), site.alias("site"), path.alias("path"))
        .select(
            hex_id(F.lit(1000) + page).alias("category_id"),
            "category",
            F.array("site", F.initcap("site")).alias("app_patterns"),
            F.array("site", "path").alias("domain_patterns"),
            page.alias("ord"),
        )
    )


def pattern_additions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns to add to the site dictionary: two pages extend each of its documents."""
    site = F.regexp_extract("url", r"^[a-z]+://(?:m\.|blog\.|www\.)?([a-z0-9-]+)", 1)
    host = F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1)
    offered = F.array(
        F.struct(F.lit("app").alias("kind"), site.alias("pattern")),
        F.struct(F.lit("url").alias("kind"), site.alias("pattern")),
        F.struct(F.lit("url").alias("kind"), host.alias("pattern")),
    )
    return (
        table(spark, sf_dir, "pages")
        .select(
            hex_id(F.lit(1000) + F.floor(F.col("page_id") / 2).cast("bigint")).alias("category_id"),
            "page_id",
            F.posexplode(offered).alias("pos", "offer"),
        )
        .select(
            "category_id", "offer.kind", "offer.pattern", (F.col("page_id") * 10 + F.col("pos")).alias("seq")
        )
    )


def learned_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels for two pages in three, in each browser-like app."""
    page = F.col("page_id")
    app = F.explode(F.array(*[F.lit(app) for app in BROWSER_APPS])).alias("app")
    seen = table(spark, sf_dir, "pages").where(page % 3 != 2).select("page_id", "url", app)
    title = F.concat(F.lit("Page "), page.cast("string"))
    return seen.select(
        label_query(F.col("app"), title, F.col("url")).alias("query"),
        F.when(page % 3 == 0, "Finance").otherwise(" Music ").alias("label"),
    )


def labeller_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = F.array(*[F.lit(answer) for answer in RAW_ANSWERS])
    return table(spark, sf_dir, "pages").select(
        "page_id", F.get(answers, (F.col("page_id") % (len(RAW_ANSWERS) + 1)).cast("int")).alias("answer")
    )


def categorized_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored natural keys: those of three pages in four."""
    stored = messages(spark, sf_dir).where(F.col("page_id") % 4 != 3)
    return (
        stored.select("categorized_data_id", "app", "url", "title")
        .distinct()
        .withColumns({"category_id": F.lit(ZERO_ID), "is_llm_based": F.lit(False)})
    )


def usage_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored logs: messages with a valid id, less one in 53."""
    stored = messages(spark, sf_dir).where(valid_id(F.col("usage_log_id")) & (F.col("seq") % 53 != 0))
    return stored.select(
        "usage_log_id",
        "user_id",
        "categorized_data_id",
        F.lit(ZERO_ID).alias("category_id"),
        "session_no",
        "session_minutes",
        "session_date",
        "ts_epoch",
        "duration",
    )


def logs_to_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of every message, two in three of them without an id yet."""
    keeps_id = F.col("seq") % 3 == 0
    return messages(spark, sf_dir).select(
        F.when(keeps_id, hex_id(F.col("seq"))).otherwise(F.lit(ZERO_ID)).alias("usage_log_id"),
        "user_id",
        "categorized_data_id",
        F.lit(ZERO_ID).alias("category_id"),
        "session_no",
        "session_minutes",
        "session_date",
        "ts_epoch",
        "duration",
        "seq",
    )
