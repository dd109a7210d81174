"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the cleaning rules.
NON_DIGITS = r"[^0-9]"
JSON_OBJECT_SHAPE = r"^\s*\{.*\}\s*$"
STATE_IN_ADDRESS = r", ([A-Z]{2}) "
ZIP_AT_END = r"([0-9]{5})$"
# Unicode white space, plus the four separators U+001C..U+001F that also count as blank.
VISIBLE = r"(?U)[^\s\x1c-\x1f]"


def not_blank(body: Column) -> Column:
    """True when the text holds anything but white space; NULL for NULL."""
    return body.rlike(VISIBLE)


def looks_like_json_object(body: Column) -> Column:
    """Braces around one line of text. Only a flag, it never filters."""
    return body.rlike(JSON_OBJECT_SHAPE)


def digits_only(phone: Column) -> Column:
    """F1."""
    return F.regexp_replace(phone, NON_DIGITS, "")


def full_name(first: Column, last: Column) -> Column:
    """NULL when either part is NULL."""
    return F.concat(first, F.lit(" "), last)


def dashes_for_commas(address: Column) -> Column:
    """a character-for-character swap, so ``translate`` and no regular expression."""
    return F.translate(address, ",", "-")


def country_or_unknown(country: Column) -> Column:
    """the empty string is kept."""
    return F.coalesce(country, F.lit("Unknown"))


def trimmed(text: Column) -> Column:
    """strips spaces only, other white space stays."""
    return F.trim(text)


def address_line(address: Column, index: int) -> Column:
    """F16: 0-based line of a multi-line address; NULL when there is no such line."""
    return F.get(F.split(address, "\n"), F.lit(index))


def state_code(line: Column) -> Column:
    """two capitals between comma and blank; '' when there are none."""
    return F.regexp_extract(line, STATE_IN_ADDRESS, 1)


def postal_code(line: Column) -> Column:
    """five digits at the end; '' when there are none."""
    return F.regexp_extract(line, ZIP_AT_END, 1)
