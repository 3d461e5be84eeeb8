"""Guarded conversions from text. A value that fails its pattern becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import specs
from ledgerloom.functions.text import strip_all

# \z and not $: the latter also matches before a final newline.
UNSIGNED = r"^\d+\z"
SIGNED = r"^-?\d+\z"
DECIMAL = r"^-?\d+(\.\d+)?\z"
NON_ZERO_DIGIT = "[1-9]"
DATE_PREFIX = r"^\d{4}-\d{2}-\d{2}"
WHOLE_DATE = DATE_PREFIX + r"\z"
ISO_WITH_OFFSET = (
    r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|[+-]\d{2}(:?\d{2})?)\z"
)
PLAIN_UTC = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?Z\z"
ISO_LOCAL = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?)?\z"


def _calendar_day(c: Column) -> Column:
    day = F.substring(c, 1, 10)
    return F.when(c.rlike(DATE_PREFIX) & (F.substring(c, 1, 4) != "0000"), day.try_cast("date"))


def parse_day(c: Column) -> Column:
    """The valid calendar day a text starts with, as a date."""
    return _calendar_day(c)


def parse_date(c: Column) -> Column:
    """The valid calendar day a text starts with, as a zone-less midnight timestamp."""
    return _calendar_day(c).cast("timestamp_ntz")


def parse_whole_date(c: Column) -> Column:
    """A text that is exactly one calendar day, but for white space around it."""
    def exact(text: Column) -> Column:
        return F.when(text.rlike(WHOLE_DATE) & ~text.startswith("0000"), text.try_cast("date"))

    return F.coalesce(exact(c), exact(strip_all(c)))


def bool_value(c: Column) -> Column:
    token = F.lower(c)
    return F.when(token.isin(specs.TRUE_TOKENS), F.lit(True)).when(token.isin(specs.FALSE_TOKENS), F.lit(False))


def digits_to_bigint(c: Column) -> Column:
    return F.when(c.rlike(UNSIGNED), c.try_cast("bigint"))


def to_signed_int(c: Column) -> Column:
    return F.when(c.rlike(SIGNED), c.try_cast("int"))


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    return F.when(c.rlike(DECIMAL), c.try_cast(f"decimal({precision},{scale})"))


def negative_text(c: Column) -> Column:
    """Sign test on unrounded text: any length, no precision loss."""
    return c.startswith("-") & c.rlike(NON_ZERO_DIGIT)


def above_one_text(c: Column) -> Column:
    """Whether a non-negative decimal text exceeds 1, without rounding it."""
    whole = F.regexp_extract(c, r"^0*(\d*)", 1)
    fraction = F.regexp_extract(c, r"\.(\d+)\z", 1)
    return (F.length(whole) > 1) | (whole > "1") | ((whole == "1") & fraction.rlike(NON_ZERO_DIGIT))


def bad_number(c: Column, pattern: str, wrong: Column) -> Column:
    """Missing, not a number, or a number for which ``wrong`` holds."""
    return c.isNull() | F.when(c.rlike(pattern), wrong).otherwise(F.lit(True))


def parse_utc_timestamp(c: Column) -> Column:
    """ISO text whose offset is mandatory, as an instant."""
    text = strip_all(c)
    point = F.replace(text, F.lit(","), F.lit("."))
    # The cast wants seconds before an offset, and minutes in it.
    no_seconds = F.substring(text, 17, 1) != ":"
    with_seconds = F.when(no_seconds, F.overlay(point, F.lit(":00"), F.lit(17), F.lit(0))).otherwise(point)
    bare_hours = F.substring(text, -3, 1).isin("+", "-")
    full = F.when(bare_hours, F.concat(with_seconds, F.lit(":00"))).otherwise(with_seconds)
    other = F.when(text.rlike(ISO_WITH_OFFSET), full.try_cast("timestamp"))
    return F.when(c.rlike(PLAIN_UTC), c.try_cast("timestamp")).otherwise(other)


def lacks_offset(c: Column) -> Column:
    """A readable ISO time that fails only because no offset is given."""
    text = F.replace(strip_all(c), F.lit(","), F.lit("."))
    return text.rlike(ISO_LOCAL) & text.try_cast("timestamp_ntz").isNotNull()


# What a text of each stored numeric type looks like; anything else fails the batch.
NUMBER_TEXT = {
    "int": SIGNED, "integer": SIGNED, "bigint": SIGNED, "smallint": SIGNED, "decimal": DECIMAL,
    "float": r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\z", "double": r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\z",
}


def to_stored_type(c: Column, type_name: str) -> Column:
    """Convert a source text to the stored column type; empty is NULL, a bad value fails the batch and is named.

    The session's ANSI mode does not matter: every conversion is tried, and what it leaves NULL is raised.
    White space around a value counts for nothing. A decimal is rounded half up to the scale; one that does
    not fit its precision is a bad value.
    """
    if type_name == "string":
        return F.nullif(c, F.lit(""))
    text = strip_all(c)
    kind = type_name.split("(")[0]
    if kind == "boolean":
        token = F.lower(text)
        parsed = F.when(token.isin(specs.TRUE_TOKENS), F.lit(True)).when(token.isin(specs.FALSE_TOKENS), F.lit(False))
    elif kind.startswith("timestamp"):
        parsed = parse_utc_timestamp(c)
    elif kind == "date":
        parsed = parse_whole_date(c)
    elif kind in NUMBER_TEXT:
        parsed = F.when(text.rlike(NUMBER_TEXT[kind]), text.try_cast(type_name))
    else:
        raise ValueError(f"no text is converted to {type_name}")
    failed = F.raise_error(F.concat(F.lit(f"invalid {kind} value: "), c)).cast(type_name)
    return F.when(text != "", F.coalesce(parsed.cast(type_name), failed))
