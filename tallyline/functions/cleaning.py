"""Column expressions that clean and type raw values. A bad value becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.schemas import RATE

# Every character with the Unicode White_Space property. SQL trim() alone strips U+0020 only.
WHITESPACE = "".join(
    map(
        chr,
        [
            *range(0x0009, 0x000E),
            0x0020,
            0x0085,
            0x00A0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ],
    )
)

# The first and the last character of printable ASCII, and the one after them.
PRINTABLE, PAST_PRINTABLE = ("!", "~"), "\x7f"

# Spark also reads '2026', '2026-07' and a bare '10:00' (which takes today's date) as timestamps.
# Asking for a full date keeps a rerun on another day equal.
FULL_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ Tt]|$)"

# A time of day that is followed by a zone.
ZONED_TIME = r":\d[\d:.]*\s*[A-Za-z+-]"


# A full date and time of day without zone; nearly all timestamps look like this.
PLAIN_MOMENT = r"\A\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}:\d{1,2}(?:\.\d{1,9})?\z"


def clean_text(value: Column) -> Column:
    """Strip surrounding whitespace.

    Once their spaces are off, nearly all ids and codes begin and end with printable ASCII, so
    that trim and two comparisons do. All other texts take btrim with the character list, which
    costs three times as much.
    """
    trimmed = F.trim(value)
    begins = (trimmed >= PRINTABLE[0]) & (trimmed < PAST_PRINTABLE)
    return F.when(begins & F.right(trimmed, F.lit(1)).between(*PRINTABLE), trimmed).otherwise(
        F.btrim(value, F.lit(WHITESPACE))
    )


def clean_status(value: Column) -> Column:
    return F.upper(clean_text(value))


def blank_to_null(value: Column) -> Column:
    return F.nullif(clean_text(value), F.lit(""))


def safe_amount(value: Column, kind: T.DataType = T.StringType()) -> Column:
    """A whole number. Text must be one; a number with a fraction is rounded, halves away from zero."""
    if isinstance(kind, (T.DecimalType, T.FractionalType)):
        value = F.round(value, 0)
    return value.try_cast("bigint")


def safe_rate(value: Column) -> Column:
    return value.try_cast(RATE)


def utc_moment(local: Column) -> Column:
    """The timestamp at which clocks in UTC show a time without zone, whatever the session's zone."""
    seconds = F.unix_date(local.cast("date")).cast("bigint") * 86_400 + F.hour(local) * 3_600 + F.minute(local) * 60
    micros = F.extract(F.lit("SECOND"), local) * 1_000_000
    return F.timestamp_micros(seconds * 1_000_000 + micros.cast("bigint"))


def safe_timestamp(value: Column) -> Column:
    """Text to timestamp. A text without zone is in UTC, whatever the session's zone.

    A plain one is cast once, with its zone added. All others take the long way.
    """
    plain = F.concat(value, F.lit("Z")).try_cast("timestamp")
    return F.when(value.rlike(PLAIN_MOMENT), plain).otherwise(_other_timestamp(value))


def _other_timestamp(value: Column) -> Column:
    moment = F.when(value.rlike(ZONED_TIME), value.try_cast("timestamp")).otherwise(
        utc_moment(value.try_cast("timestamp_ntz"))
    )
    return F.when(value.rlike(FULL_DATE), moment)
