"""Record ids, lookup keys and the text handed to a labeller."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyboard.schemas import DEFAULT_CATEGORY, VALID_LABELS, ZERO_ID

# Fixed text form of a record id.
RECORD_ID_TEXT = r"^[0-9a-fA-F]{24}\z"


def valid_id(record_id: Column) -> Column:
    return record_id.rlike(RECORD_ID_TEXT)


def derived_id(*parts: Column) -> Column:
    """A 24-digit id computed from the row, so that a retried task assigns it again."""
    texts = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.substring(F.sha2(F.concat_ws("\u0001", *texts), 256), 1, 24)


def id_or_derived(record_id: Column, *parts: Column) -> Column:
    absent = record_id.isNull() | record_id.isin("", ZERO_ID)
    return F.when(absent, derived_id(*parts)).otherwise(record_id)


def label_query(app: Column, title: Column, url: Column) -> Column:
    """Key of the learned-label table; the app is lower-cased, the rest is not."""
    return F.concat(F.lit("app: "), F.lower(app), F.lit(", title: "), title, F.lit(", url: "), url)


def label_prompt(app: Column, title: Column, url: Column) -> Column:
    """The non-empty fields as labelled lines."""
    fields = (("Application: ", F.lower(app)), ("Title: ", title), ("URL: ", url))
    lines = [F.when(value != "", F.concat(F.lit(name), value)) for name, value in fields]
    return F.concat_ws("\n", *lines)


def validated_label(answer: Column) -> Column:
    """Trim any Unicode white space, then keep known labels only.

    No answer (null) stays null: the key still waits for one.
    """
    trimmed = F.regexp_replace(answer, r"(?U)^\s+|\s+$", "")
    known = F.when(trimmed.isin(*VALID_LABELS), trimmed).otherwise(F.lit(DEFAULT_CATEGORY))
    return F.when(answer.isNotNull(), known)
