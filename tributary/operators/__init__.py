"""Relational building blocks that need more than one Spark call."""

from tributary.operators.combine import every_combination
from tributary.operators.enrich import enrich
from tributary.operators.keyset import may_be_among
from tributary.operators.keep_latest import keep_latest, newest_order
from tributary.operators.parse import parse_json_text
from tributary.operators.payloads import explode_parquet_payloads

__all__ = [
    "enrich",
    "every_combination",
    "explode_parquet_payloads",
    "keep_latest",
    "may_be_among",
    "newest_order",
    "parse_json_text",
]
