"""Event bodies to landing rows (I1-I6), the same expressions in batch and in a stream.

A body of a parsed topic is

* *parsed* when it is one strict JSON object with at least one key and every key names a column of
  the landing table, in any letter case and no column twice;
* *rejected* when it is valid JSON of any other kind: the table could not take it. Rejected events
  go to a side table, none is lost;
* *raw* when it is not valid JSON; the text itself is kept.

Bodies of the other topics are always raw. Values become text: numbers as JSON prints them, nested
values as JSON text, and ``true`` or ``"NaN"`` (with quotes) for the values that have no other text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import not_blank
from tributary.schemas import BRONZE, PARSED_TABLES, RAW, REJECTS, TOPICS

# Strict JSON, as opposed to the lenient default.
STRICT = {"allowSingleQuotes": "false"}

# Bodies are parsed as the first item of an array closed by a marker. It is the second and last
# item only if the body is exactly one JSON value: the parser itself ignores trailing text. A body
# that spells out the marker gets one with its own digest, which no body can contain.
END = "end-of-body"

TARGET = "target"
PARSED, RAW_KIND, REJECT = "parsed", "raw", "reject"

_LANDED = {
    table: [f.name for f in BRONZE[table].fields if f.name != RAW] for table in PARSED_TABLES
}
# Columns of the parsed tables. They differ even without regard to case, so one frame holds both.
LANDING_COLUMNS = [*(name for names in _LANDED.values() for name in names), RAW]


def visible_events(events: DataFrame) -> DataFrame:
    """Drop events without a visible character."""
    return events.filter(not_blank(F.col("body")))


def _table_of(topic: Column) -> Column:
    entries = [F.lit(item) for pair in TOPICS.items() for item in pair]
    return F.try_element_at(F.create_map(*entries), topic)


def _marker(body: Column) -> Column:
    own = F.concat(F.lit(f"{END}-"), F.sha2(body, 256))
    # A backslash may hide the marker's letters.
    spelled = F.contains(body, F.lit(END)) | F.contains(body, F.lit("\\u"))
    return F.when(spelled, own).otherwise(F.lit(END))


def _closed_array(body: Column, item: str, end: Column) -> Column:
    text = F.concat(F.lit("["), body, F.lit(","), end, F.lit("]"))
    return F.from_json(text, f"array<{item}>", STRICT)


def _names_columns(keys: Column, table: Column) -> Column:
    """True when there are lower-cased ``keys`` and all are columns of ``table``."""
    known = F.lit(False)
    for name in PARSED_TABLES:
        allowed = F.array(*[F.lit(f.name.lower()) for f in BRONZE[name].fields])
        known = F.when(table == name, F.size(F.array_except(keys, allowed)) == 0).otherwise(known)
    return (F.size(keys) > 0) & known


def landing_rows(events: DataFrame) -> DataFrame:
    """``(topic, body)`` to rows of ``target`` table, ``topic`` and all landing columns.

    Events of unknown topics are dropped. A column that the target table lacks is NULL.
    """
    table, body = F.col("_table"), F.col("body")
    parses = table.isin(*PARSED_TABLES)
    marker = _marker(body)
    end_object = F.concat(F.lit('{"'), marker, F.lit('":""}'))
    items = F.when(parses, _closed_array(body, "map<string,string>", end_object))
    routed = (
        visible_events(events)
        .withColumn("_table", _table_of(F.col("topic")))
        .filter(table.isNotNull())
        .withColumn("_items", items)
    )

    # One whole object: two items, the second being the marker.
    is_marker = F.get(F.map_keys(F.get(F.col("_items"), F.lit(1))), F.lit(0)) == marker
    whole = (F.size("_items") == 2) & is_marker
    # A repeated key counts once, with its last value: keys are looked up from the end.
    located = (
        routed.withColumn("_whole", F.coalesce(whole, F.lit(False)))
        .withColumn("_object", F.when(F.col("_whole"), F.get(F.col("_items"), F.lit(0))))
        .withColumn("_spelled", F.map_keys("_object"))
        .withColumn("_keys", F.reverse(F.transform("_spelled", lambda key: F.lower(key))))
        .withColumn("_values", F.reverse(F.map_values("_object")))
        # Only a body that is no object needs the second look for other JSON values.
        .withColumn(
            "_other",
            F.when(
                parses & ~F.col("_whole"),
                _closed_array(body, "string", F.concat(F.lit('"'), marker, F.lit('"'))),
            ),
        )
    )
    same_spelling = F.size(F.array_distinct("_spelled")) == F.size(F.array_distinct("_keys"))
    other = (F.size("_other") == 2) & (F.get(F.col("_other"), F.lit(1)) == marker)
    kind = (
        F.when(_names_columns(F.col("_keys"), table) & same_spelling, PARSED)
        .when(F.col("_whole") | other, REJECT)
        .otherwise(RAW_KIND)
    )

    def value(column: str) -> Column:
        position = F.array_position(F.col("_keys"), column.lower())
        return F.get(F.col("_values"), (position - 1).cast("int"))

    is_parsed = F.col("_kind") == PARSED
    target = F.when(F.col("_kind") == REJECT, REJECTS).otherwise(table)
    # Generated rather than projected, so that a filter on the target stays above the parser; the
    # optimizer would move it below a projection and classify every body twice.
    classified = located.withColumn("_kind", kind).withColumn(TARGET, F.explode(F.array(target)))
    return classified.select(
        TARGET,
        "topic",
        *[
            F.when(is_parsed & (table == name), value(column)).alias(column)
            for name, columns in _LANDED.items()
            for column in columns
        ],
        # `raw_data` is itself a column of every table, so a body may name it.
        F.when(is_parsed, value(RAW)).otherwise(body).alias(RAW),
    )


def table_columns(table: str) -> list[str]:
    """Columns of a landing table; rejects have their topic and body."""
    return ["topic", RAW] if table == REJECTS else BRONZE[table].names


def landing_columns(rows: DataFrame, table: str) -> DataFrame:
    """Landing rows of one table cut to its columns, those never filled being NULL."""
    present = set(rows.columns)
    return rows.select(
        *[
            F.col(c) if c in present else F.lit(None).cast("string").alias(c)
            for c in table_columns(table)
        ]
    )


def landing_table(events: DataFrame, table: str) -> DataFrame:
    """One landing table, or the rejects, straight from events; other topics are not parsed."""
    tables = PARSED_TABLES if table == REJECTS else [table]
    topics = [topic for topic, target in TOPICS.items() if target in tables]
    rows = landing_rows(events.filter(F.col("topic").isin(topics)))
    return landing_columns(rows.filter(F.col(TARGET) == table), table)
