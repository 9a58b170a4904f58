"""Table schemas and the fixed values of the domain."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- Fixed values -----------------------------------------------------------

# Labels accepted from an external labeller; compared case-sensitively.
VALID_LABELS = (
    "Marketing",
    "Browsing",
    "E-commerce & Shopping",
    "AFK",
    "Uncategorized",
    "Development",
    "LLM",
    "Documentation",
    "Design",
    "Video Editing",
    "Meetings",
    "SNS",
    "Entertainment",
    "Productivity",
    "File Management",
    "System & Utilities",
    "Game",
    "Education",
    "Finance",
)

# Categories offered to the labeller. Not the same list: Communication and Music
# are offered but rejected on return.
OFFERED_LABELS = (
    "SNS",
    "Documentation",
    "Design",
    "Communication",
    "LLM",
    "Development",
    "Productivity",
    "Video Editing",
    "Entertainment",
    "File Management",
    "System & Utilities",
    "Game",
    "Education",
    "Finance",
    "Browsing",
    "Marketing",
    "Music",
    "E-commerce & Shopping",
)

# Categories that also count on the aggregate work board.
WORK_CATEGORIES = (
    "Development",
    "LLM",
    "Documentation",
    "Design",
    "Video Editing",
    "Education",
    "Productivity",
    "Finance",
    "File Management",
    "Browsing",
    "Marketing",
    "System & Utilities",
    "Meetings",
)

DEFAULT_CATEGORY = "Uncategorized"
WORK_BOARD = "work"
BOARD_ZONE = "Asia/Seoul"
BOARD_KEY_PREFIX = "leaderboard"
ZERO_ID = "0" * 24
MISSING_DATE = "0001-01-01"

# Stream names of the deployed topics.
MESSAGE_STREAM = "pattern_match_stream"
SESSION_SCORE_STREAM = "session_score_stream"

# ---- Schemas ----------------------------------------------------------------


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()

RAW_MESSAGES = _struct(seq=_L, values=T.MapType(_S, _S))

MESSAGES = _struct(
    seq=_L,
    user_id=_S,
    usage_log_id=_S,
    categorized_data_id=_S,
    app=_S,
    url=_S,
    title=_S,
    session_no=_L,
    session_minutes=_L,
    session_date=T.DateType(),
    duration=_D,
    ts_epoch=_D,
    is_end=T.BooleanType(),
)

CATEGORY_PATTERNS = _struct(
    category_id=_S,
    category=_S,
    app_patterns=T.ArrayType(_S),
    domain_patterns=T.ArrayType(_S),
    ord=_L,
)

CATEGORIZED_DATA = _struct(
    categorized_data_id=_S, app=_S, url=_S, title=_S, category_id=_S, is_llm_based=T.BooleanType()
)

CATEGORIZED_PARTED = T.StructType([*CATEGORIZED_DATA.fields, T.StructField("part", T.IntegerType())])

USAGE_LOGS = _struct(
    usage_log_id=_S,
    user_id=_S,
    categorized_data_id=_S,
    category_id=_S,
    session_no=_L,
    session_minutes=_L,
    session_date=T.DateType(),
    ts_epoch=_D,
    duration=_D,
)

LEARNED_LABELS = _struct(query=_S, label=_S)

OPEN_KEYS = _struct(query=_S, app=_S, title=_S, url=_S, prompt=_S)

DAILY_TOTALS = _struct(user_id=_S, category=_S, day=T.DateType(), duration=_D)

SESSION_SCORES = _struct(user_id=_S, session_date=_S, session_no=_L)

CATEGORY_UPDATES = _struct(record_id=_S, category_id=_S, seq=_L)

BATCH_METRICS = _struct(method=_S, messages=_L, excluded=_L, invalid_ids=_L, ended=_L)

SEEN_IDS = _struct(record_id=_S)

UPDATE_COUNTS = _struct(updates=_L, matched=_L, modified=_L, no_op=_L)

FOLDS = _struct(segment=_S)

MANIFEST = _struct(kind=_S, part=_S, folder=_S)

#: Session records of a job, with an id that a repeated sending shows.
SESSION_OUTBOX = T.StructType([*SESSION_SCORES.fields, T.StructField("event_id", _S)])

SENT = _struct(events=_L)

LABEL_ATTEMPTS = _struct(query=_S, tries=_L, outcome=_S, label=_S)
