"""Tolerant text parsing: coordinates and ISO-8601 times."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wall-clock zone in which times that carry an offset are stored.
DEFAULT_ZONE = "America/La_Paz"

_DIGITS = r"\d+(_\d+)*"
_NUMBER = (
    rf"(?i)^\s*[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})(e[+-]?{_DIGITS})?\s*$"
)
_SPECIAL = r"(?i)^\s*[+-]?(inf|infinity|nan)\s*$"


def parse_coordinate(c: Column) -> Column:
    """Text to double; null when the text is not a number.

    Accepts decimal numbers with an optional exponent, digit-group underscores,
    infinities and NaN.  The pattern keeps out forms that only the JVM reads as
    a number, such as ``1.5f``.
    """
    text = F.trim(c.cast("string"))
    unsigned_nan = F.regexp_replace(text, r"(?i)^[+-]nan$", "nan")
    return F.when(text.rlike(_NUMBER), F.regexp_replace(text, "_", "").try_cast("double")).when(
        text.rlike(_SPECIAL), unsigned_nan.try_cast("double")
    )


# Date, and optionally time and numeric offset, each in the extended or the basic
# form; behind a blank only a time in the extended form, and before it such a date.
_ISO = (
    r"^(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:(?:T|(?<=-\d{2}) (?=\d{2}:))(\d{2})(:?)(\d{2})(?:\6(\d{2})([.,]\d{1,9})?)?(Z|[+-]\d{2}(?::?\d{2})?)?)?$"
)
# The clock in the extended form, a mark that the text cannot hold, the offset.
_PARTS = "$1-$3-$4 $5:$7:$8$9|$10"
_EPOCH = "1970-01-01 00:00:00"


def instant_to_clock(c: Column, zone: str = DEFAULT_ZONE) -> Column:
    """A timestamp (an instant) to the wall clock of ``zone``, whatever the session's zone."""
    utc_clock = F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit(_EPOCH).cast("timestamp_ntz"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_clock)


def parse_iso_timestamp(c: Column, zone: str = DEFAULT_ZONE) -> Column:
    """ISO-8601 text to a time without zone; null when it cannot be read.

    Reads a date, alone or with a time, alone or with a numeric offset or ``Z``,
    in the extended (``2024-01-01T10:00:00``) or basic form
    (``20240101T100000``), and nothing else: no zone names, no time without a
    date.  Text without an offset is taken as it stands.  Text with one names an
    instant and becomes the wall clock of ``zone``.  Neither depends on the
    session time zone.
    """
    text = F.translate(F.upper(F.trim(c)), "|", "?")
    # Parts that the text does not have leave their separators before the mark.
    parts = F.replace(F.replace(F.regexp_replace(text, _ISO, _PARTS), F.lit(" ::|"), F.lit("|")), F.lit(":|"), F.lit("|"))
    clock = F.translate(F.substring_index(parts, "|", 1), ",", ".").try_cast("timestamp_ntz")
    offset = F.substring_index(parts, "|", -1)
    at_zone = F.convert_timezone(offset, F.lit(zone), clock)
    # Text that is no time has come through without a mark.
    return F.when(F.contains(parts, F.lit("|")), F.when(offset == "", clock).otherwise(at_zone))


def format_timestamp(c: Column, separator: str = " ") -> Column:
    """Time to text with six fraction digits, separated by a blank or by ``T``."""
    gap = "'T'" if separator == "T" else separator
    return F.date_format(c, f"yyyy-MM-dd{gap}HH:mm:ss.SSSSSS")


def ntz(value: datetime) -> Column:
    """Literal without zone; a plain ``lit`` would depend on the session time zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
