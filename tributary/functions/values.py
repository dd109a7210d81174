"""Safe casts and dates. Malformed text becomes NULL, also with ANSI mode on."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats of event times and opening dates.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
# Text of plain digits in that format; the cast reads it like the formatter, in half the time.
PLAIN_TIMESTAMP = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\z"


def parse_timestamp(text: Column) -> Column:
    """the fixed format and nothing else."""
    formatted = F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT))
    return F.when(text.rlike(PLAIN_TIMESTAMP), text.try_cast("timestamp")).otherwise(formatted)


def to_timestamp(value: Column) -> Column:
    """format-free conversion, the identity on a timestamp."""
    return F.try_to_timestamp(value)


def parse_float(text: Column) -> Column:
    """32-bit, as the amounts are kept."""
    return text.try_cast("float")


def parse_date(text: Column) -> Column:
    """F12."""
    return F.try_to_date(text, DATE_FORMAT)


def age_in_days(opened: Column, as_of: date | None = None) -> Column:
    """days from ``opened`` to ``as_of`` (today when not given)."""
    return F.datediff(F.lit(as_of) if as_of else F.current_date(), opened)
