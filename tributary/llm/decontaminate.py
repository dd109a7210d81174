"""Benchmark decontamination: short test items found inside long documents.

Containment search by MinHash sketches, partitioned by size. Items are classed by their number n of
shingles. To reach a containment of 3/4 at most n // 4 shingles may be missing, so of any n // 4 + 1
at least one is in the document: the shingles with that many least hash values, the same number for a class of
sizes, are an item's sketch. Hash values are those of weighted minwise hashing: -ln(u) times the number of
items that share the shingle, so that wording common to many items is seldom in a sketch and does not make
candidates. Documents are probed with all their shingles; candidates are confirmed by exact containment of the shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.arrays import words_of
from tributary.llm.tables import Stage

SHINGLE, CONTAINMENT = 5, 75
#: Sizes of one class differ by at most this factor; sketch entries (a hash and an item) that are broadcast at most.
GROWTH, BROADCAST_ROWS = 1.25, 1_000_000


def normal_words(text: Column) -> Column:
    """Lower-case words without punctuation."""
    plain = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[^\p{L}\p{N}\x20\x09-\x0D]+", "")
    return words_of(F.lower(plain))


def _grams(words: str, size: str, value: str) -> Column:
    """``value`` of every run of ``size`` words; none of a shorter list."""
    return F.expr(f"if(size({words}) < {size}, array(), transform(sequence(1, size({words}) - {size} + 1), i -> {value.format(f'slice({words}, i, {size})')}))")


def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rep, item_id, width, grams): each item, and the smallest id of those with equal shingles."""
    words = items.select(F.col(id_col).cast("long").alias("item_id"), normal_words(F.col(text_col)).alias("w")).where("size(w) > 0")
    wide = words.withColumn("width", F.least(F.size("w"), F.lit(SHINGLE)))
    grams = wide.withColumn("grams", F.sort_array(F.array_distinct(_grams("w", "width", "array_join({}, ' ')"))))
    return grams.select(F.min("item_id").over(Window.partitionBy("grams", "width")).alias("rep"), "item_id", "width", "grams").distinct()


def _sketches(items: DataFrame) -> DataFrame:
    """(width, hash, item_id), floor(u / 4) + 1 for each item, u the largest size of its class."""
    grams = items.select("item_id", "width", "n", F.explode("grams").alias("g"))
    shared = grams.groupBy("g").agg(F.count("*").alias("items"))
    # Classes of sizes grow by a factor, and so do the sketches; a sketch is never more than the item.
    size_class = F.ceil(F.round(F.log("n") / F.log(F.lit(GROWTH)), 9))
    largest = F.floor(F.pow(F.lit(GROWTH), size_class) + 1e-9)
    ranked = grams.join(shared, "g").withColumn("k", F.floor(largest * (100 - CONTAINMENT) / 100) + 1)
    hashed = ranked.withColumn("hash", F.xxhash64("g"))
    uniform = (F.pmod(F.xxhash64("hash", F.lit(SHINGLE)), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    hashed = hashed.withColumn("value", -F.log(uniform) * F.col("items")).groupBy("item_id", "width", "k").agg(
        F.sort_array(F.collect_list(F.struct("value", "hash"))).alias("all")  # the shingles of one short item
    )
    return hashed.select("item_id", "width", F.explode(F.slice("all", F.lit(1), F.col("k").cast("int"))).alias("x")).select(
        "item_id", "width", F.col("x.hash").alias("hash")
    )


def _hits(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, stage: Stage) -> DataFrame:
    """(id, tag, item_id, n, common) of all texts that hold an item; ``tag`` is a hash of the text."""
    every = stage.table(_items(benchmark, item_col, item_text), "every-item")
    items = stage.table(every.select(F.col("rep").alias("item_id"), "width", "grams", F.size("grams").alias("n")).dropDuplicates(["item_id", "width"]), "items")
    sketches = stage.table(_sketches(items), "sketches")
    small = sketches.count() <= BROADCAST_ROWS
    index = stage.table(sketches.groupBy("width", "hash").agg(F.collect_set("item_id").alias("items")), "index")
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # 1 to 5
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("tag"), F.col(text_col).alias("text"))
    source = source.select("id", "tag", "text", normal_words(F.col("text")).alias("w"))
    probes = None
    for width in widths or [SHINGLE]:
        hashes = _grams("w", str(width), "xxhash64(array_join({}, ' '))")
        # The outer form keeps the optimizer from testing the array below, where it would be made twice.
        one = source.select("id", "tag", hashes.alias("h")).select("id", "tag", F.explode_outer("h").alias("hash")).withColumn("width", F.lit(width))
        probes = one if probes is None else probes.union(one)
    known = F.broadcast(index) if small else index
    pairs = probes.join(known, ["width", "hash"]).select("id", "tag", F.explode("items").alias("item_id")).distinct()
    pairs = stage.table(pairs, "candidates")
    asked = stage.table(pairs.select(F.col("id").alias("key"), F.col("tag").alias("key_tag")).distinct(), "asked")
    same = F.col("key").eqNullSafe(F.col("id")) & (F.col("key_tag") == F.col("tag"))
    texts = source.select("id", "tag", "text").join(asked, same, "left_semi")
    all_grams = F.concat(*[_grams("w", str(k), "array_join({}, ' ')") for k in (widths or [SHINGLE])])
    # Rows equal in id and text are one.
    found = texts.groupBy("id", "tag").agg(F.first("text").alias("text")).withColumn("w", normal_words(F.col("text")))
    found = stage.table(found.select(F.col("id").alias("key"), F.col("tag").alias("key_tag"), F.array_distinct(all_grams).alias("have")), "found")
    both = pairs.join(items.select("item_id", "n", "grams"), "item_id").join(found, same).withColumn("common", F.size(F.array_intersect("grams", "have")))
    hits = both.where(100 * F.col("common") >= CONTAINMENT * F.col("n")).select("id", "tag", F.col("item_id").alias("rep"), "n", "common")
    return hits.join(every.select("rep", "item_id"), "rep").select("id", "tag", "item_id", "n", "common")


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Pairs (id, item_id, n_shingles, n_common): at least 3/4 of the item's word shingles are in the document.

    Words are compared without case and punctuation. An item shorter than a shingle counts as one
    shingle of its own length; items without a word are left out. Items with equal shingles are each
    reported. Rows without an id are searched and reported with a null id; rows with the same id are
    reported together. Null texts are empty. Other columns are not carried along. Empty tables give
    an empty result.
    """
    hits = _hits(docs, benchmark, id_col, text_col, item_col, item_text, Stage(docs.sparkSession))
    return hits.groupBy("id", "item_id").agg(F.max("n").cast("long").alias("n_shingles"), F.max("common").cast("long").alias("n_common")).withColumnRenamed("id", id_col)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows whose text holds no item, with all columns whatever their names.

    Each row is judged by its own text, also rows that share an id or have none. Null and empty texts
    stay; an empty benchmark removes nothing.
    """
    stage = Stage(docs.sparkSession)
    hits = _hits(docs, benchmark, id_col, text_col, item_col, item_text, stage)
    holding = stage.table(hits.select(F.col("id").alias("key"), F.col("tag").alias("key_tag")).distinct(), "holding")
    stage.keep("holding")
    own = docs.select(
        F.struct([F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.col(text_col).cast("string")).alias("tag"),
    )
    same = F.col("key").eqNullSafe(F.col("id")) & (F.col("key_tag") == F.col("tag"))
    return own.join(holding, same, "left_anti").select("row.*")
