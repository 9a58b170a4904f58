"""Lenient text-to-value parsing: whatever does not parse becomes a zero value.

Spark's own casts trim blanks and accept forms such as ``1.0d`` or ``yes`` that
must count as unparsable here, so each cast is guarded by a whole-string pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyboard.schemas import MISSING_DATE

# Fixed text forms.
INTEGER_TEXT = r"^[+-]?[0-9]+\z"
DECIMAL_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
HEXADECIMAL_TEXT = r"^([+-]?)0[xX]([0-9a-fA-F]*)\.?([0-9a-fA-F]*)[pP]([+-]?[0-9]+)\z"
NON_FINITE_TEXT = r"^([+-]?(?i:inf|infinity)|(?i:nan))\z"
DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
RFC3339_TEXT = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T([01]?[0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]"
    r"([.,][0-9]+)?(Z|[+-]([01][0-9]|2[0-4]):[0-5][0-9])\z"
)
TRUE_TEXT = ("1", "t", "T", "TRUE", "true", "True")


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def long_or_zero(text: Column) -> Column:
    parsed = F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint"))
    return F.coalesce(parsed, F.lit(0).cast("bigint"))


def double_or_zero(text: Column) -> Column:
    """Finite decimal or hexadecimal numbers and the infinity and NaN words; out-of-range digits give 0."""
    number = text.try_cast("double")
    finite = F.when(text.rlike(DECIMAL_TEXT) & (F.abs(number) < float("inf")), number)
    word = F.when(text.rlike(NON_FINITE_TEXT), number)
    # Rare, so looked at last; as a lambda it stays out of the generated code, which it would swell.
    hexadecimal = F.when(text.rlike(HEXADECIMAL_TEXT), F.get(F.transform(F.array(text), _hexadecimal), F.lit(0)))
    return F.coalesce(finite, word, hexadecimal, F.lit(0.0))


def _hexadecimal(text: Column) -> Column:
    """Sign, digits and a power of two: 0x1.8p3 is 12. The leading 15 digits count, which is more than a double holds."""
    sign, whole, part, power = (F.regexp_extract(text, HEXADECIMAL_TEXT, n) for n in (1, 2, 3, 4))
    digits = F.regexp_replace(F.concat(whole, part), "^0+(?=.)", "")
    kept = F.substring(digits, 1, 15)
    size = F.conv(kept, 16, 10).try_cast("bigint").cast("double")
    exponent = power.try_cast("int") - 4 * F.char_length(part) + 4 * (F.char_length(digits) - F.char_length(kept))
    # In two steps, as the power alone can be out of range where the product is not.
    half = F.floor(exponent / 2)
    value = size * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), exponent - half)
    signed = F.when(sign == "-", -value).otherwise(value)
    return F.when((digits != "") & (F.abs(signed) < float("inf")), signed)


def flag_or_false(text: Column) -> Column:
    return F.coalesce(text.isin(*TRUE_TEXT), F.lit(False))


def date_or_missing(text: Column) -> Column:
    """A plain date or an RFC 3339 time, whose date is read in its own offset."""
    dated = text.rlike(DATE_TEXT) | text.rlike(RFC3339_TEXT)
    day = F.try_to_date(F.when(dated, F.substring(text, 1, 10)), "yyyy-MM-dd")
    return F.coalesce(day, F.lit(MISSING_DATE).cast("date"))
