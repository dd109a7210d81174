"""Account attributes: activity, risk and currency conversion."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Conversion rates to US dollars.
FX_TO_USD = {"USD": 1.0, "EUR": 1.08, "PKR": 0.0036}

# Account statuses and what they mean.
STATUS_MEANINGS = {
    "active": "Account is active and usable",
    "inactive": "Account exists but disabled",
    "blocked": "Account is restricted/flagged",
}

# Statuses that raise the risk level; every other status, also NULL, is LOW.
RISK_BY_STATUS = {"blocked": "HIGH", "inactive": "MEDIUM"}


def _lookup(table: Mapping[str, object], key: Column) -> Column:
    """Value of ``key`` in a literal map; NULL for an unknown or NULL key."""
    entries = [F.lit(item) for pair in table.items() for item in pair]
    return F.try_element_at(F.create_map(*entries), key)


def active_flag(status: Column) -> Column:
    """1 for exactly ``active``, otherwise 0."""
    return F.coalesce((status == "active").cast("int"), F.lit(0))


def risk_level(status: Column) -> Column:
    """HIGH, MEDIUM or LOW."""
    return F.coalesce(_lookup(RISK_BY_STATUS, status), F.lit("LOW"))


def usd_value(amount: Column, currency: Column, rates: Mapping[str, float] = FX_TO_USD) -> Column:
    """amount in US dollars; NULL when there is no rate for the currency."""
    return amount * _lookup(rates, currency)
