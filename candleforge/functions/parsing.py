"""Text to typed values. A value that does not parse becomes null, never a job failure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last microsecond of the years 0001 to 9999.
MIN_MICROS = -62_135_596_800_000_000
MAX_MICROS = 253_402_300_799_999_999

# From this size on an epoch cannot be milliseconds of a plausible year (5138).
MICROS_FROM = 100_000_000_000_000

# Fixed value: a date, a time to the second at least, and perhaps a zone.
ISO_INSTANT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})?$"

EPOCH_UNITS = ("auto", "ms", "us")


def to_id(text: Column) -> Column:
    return text.try_cast("bigint")


def to_amount(text: Column) -> Column:
    return text.try_cast("decimal(38,8)")


def to_flag(text: Column) -> Column:
    """``true`` in any case is true, other text false, null stays null."""
    return F.lower(text) == F.lit("true")


def epoch_to_timestamp(epoch: Column, unit: str = "auto", near: Column | None = None) -> Column:
    """Epoch number to a timestamp with its sub-second part.

    ``auto`` takes milliseconds or microseconds, whichever lies closer to the date ``near``;
    without a date it goes by size. A time outside the years 0001 to 9999 is null, so the
    row becomes invalid.
    """
    if unit not in EPOCH_UNITS:
        raise ValueError(f"unknown epoch unit {unit!r}, expected one of {EPOCH_UNITS}")
    from_millis = F.try_multiply(epoch, F.lit(1000).cast("bigint"))
    if unit == "us":
        micros = epoch
    elif unit == "ms":
        micros = from_millis
    else:
        is_millis = epoch.between(-MICROS_FROM + 1, MICROS_FROM - 1)
        if near is not None:
            day = F.unix_micros(near.cast("timestamp"))
            # As doubles, which cannot overflow.
            away = [F.abs(x.cast("double") - day) for x in (from_millis, epoch)]
            is_millis = F.coalesce(away[0] < away[1], is_millis)
        micros = F.when(is_millis, from_millis).otherwise(epoch)
    return F.timestamp_micros(F.when(micros.between(MIN_MICROS, MAX_MICROS), micros))


def to_instant(iso_text: Column) -> Column:
    """Full ISO date-time text to a timestamp, null for any other text."""
    return F.try_to_timestamp(F.when(iso_text.rlike(ISO_INSTANT), iso_text))


def date_prefix(text: Column) -> Column:
    """The date of text that starts ``yyyyMMdd_``, null for any other text."""
    digits = F.regexp_extract(text, r"^(\d{8})_", 1)
    return F.try_to_timestamp(digits, F.lit("yyyyMMdd")).cast("date")
