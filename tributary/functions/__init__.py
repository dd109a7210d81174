"""Column expressions. All are built-in Spark expressions, so they stay in generated code."""

from tributary.functions.accounts import (
    FX_TO_USD,
    STATUS_MEANINGS,
    active_flag,
    risk_level,
    usd_value,
)
from tributary.functions.exact import PARTS, exact_parts, exact_sum, exact_total
from tributary.functions.text import (
    address_line,
    country_or_unknown,
    dashes_for_commas,
    digits_only,
    full_name,
    looks_like_json_object,
    not_blank,
    postal_code,
    state_code,
    trimmed,
)
from tributary.functions.values import (
    age_in_days,
    parse_date,
    parse_float,
    parse_timestamp,
    to_timestamp,
)

__all__ = [
    "FX_TO_USD",
    "PARTS",
    "STATUS_MEANINGS",
    "active_flag",
    "address_line",
    "age_in_days",
    "country_or_unknown",
    "dashes_for_commas",
    "digits_only",
    "exact_parts",
    "exact_sum",
    "exact_total",
    "full_name",
    "looks_like_json_object",
    "not_blank",
    "parse_date",
    "parse_float",
    "parse_timestamp",
    "postal_code",
    "risk_level",
    "state_code",
    "to_timestamp",
    "trimmed",
    "usd_value",
]
