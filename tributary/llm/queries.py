"""One query per operator, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import decontaminate, licenses, neardup, packing, pii, quality, repeats, resample, runs, secret_scan, suffixes, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(_read(spark, folder, "documents"))
    base, every = ([k.name for k in pii.KINDS if k.always or not only] for only in (True, False))
    return found.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(pii.spans_text(base), 256).alias("base_sha256"), pii.spans_text(every).alias("spans"), pii.scores_text(every).alias("scores"),
    )


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_contamination(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find_licenses(_read(spark, folder, "documents"), licenses.known_licenses(spark))


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_read(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    return toxicity.score_toxicity(docs, toxicity.train_chain(docs, _read(spark, folder, "labels")))


def op6_minhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, folder, "documents"))


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(_read(spark, folder, "pages"))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    found = secret_scan.find_secrets(docs, secret_scan.train(secret_scan.labelled_findings(docs), secret_scan.frequent_words(docs)))
    # The outer form keeps the optimizer from testing, and so making, the array twice.
    rows = found.select("doc_id", F.explode_outer("secret_candidates").alias("x")).where("x is not null")
    return rows.select("doc_id", "x.start", "x.stop", F.sha2("x.value", 256).alias("value_sha256"), "x.score", "x.secret")


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(_read(spark, folder, "documents")).drop("kept")


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    judged = quality.judge(docs, quality.learn_rules(docs, _read(spark, folder, "labels")))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(
        "doc_id", *(f"quality_statistics.{c}" for c in base),
        F.col("quality_base_failed").alias("base_failed"), F.col("quality_kept").alias("kept"),
    )


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.find_runs(runs.with_planted_runs(_read(spark, folder, "documents")))
    start, length, period = (F.col(f"best.{c}") for c in ("start", "length", "period"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(runs.runs_text(), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample.resample(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


def op13_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeated_bytes(_read(spark, folder, "documents")).drop("kept")


QUERIES: dict[str, Query] = {
    "op1_pii": op1_pii,
    "op2_decontamination": op2_decontamination,
    "op3_licenses": op3_licenses,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_toxicity": op5_toxicity,
    "op6_minhash_neardup": op6_minhash_neardup,
    "op7_warc": op7_warc,
    "op8_secrets": op8_secrets,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_suffix_array_dedup": op13_suffix_array_dedup,
}

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_PLAIN = r"lower(regexp_replace(coalesce(text, ''), '[^\p{{L}}\p{{N}}\x20\x09-\x0D]+', '', 'g'))".format()

# CRC-32 of the bytes of a text, bit by bit, for tables without that function.
_CRC = (
    "xor(list_reduce(list_transform(range(0, octet_length(encode({0}))), lambda k: CAST('0x' || substr(hex(encode({0})), 2 * k + 1, 2) AS BIGINT)), "
    "lambda c, b: list_reduce(range(0, 8), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)), xor(c, b)), CAST(4294967295 AS BIGINT)), 4294967295)"
)
_FEATURES = r"list_filter(regexp_split_to_array({}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

SQL: dict[str, str] = {
    "op2_decontamination": f"""
WITH b AS (SELECT item_id, {_WORDS.format(_PLAIN)} AS w FROM benchmark),
bi AS (SELECT item_id, w, least(len(w), 5) AS width, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM b WHERE len(w) > 0),
bg AS (SELECT DISTINCT item_id, width, array_to_string(w[i : i + width - 1], ' ') AS g FROM bi),
size AS (SELECT item_id, count(*) AS n FROM bg GROUP BY item_id),
d AS (SELECT doc_id, {_WORDS.format(_PLAIN)} AS w FROM documents),
di AS (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM d, (SELECT DISTINCT width FROM bg) WHERE len(w) >= width),
dg AS (SELECT DISTINCT doc_id, width, array_to_string(w[i : i + width - 1], ' ') AS g FROM di)
SELECT doc_id, item_id, CAST(n AS BIGINT) AS n_shingles, count(*) AS n_common
FROM dg JOIN bg USING (width, g) JOIN size USING (item_id) GROUP BY doc_id, item_id, n HAVING 100 * count(*) >= 75 * n""",
    "op6_minhash_neardup": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
e AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS k FROM e),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (k) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
m AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
    doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)""",
    "op7_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS hex FROM p),
o AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS owner FROM h),
b AS (SELECT *, list_transform(range(0, 8), lambda g: CAST('0x' || hex[5 * g + 1 : 5 * g + 5] AS BIGINT)) AS g FROM o),
t AS (SELECT *, list_transform(range(0, 32), lambda k: 1 + ((g[1 + k // 4] >> (15 - 5 * (k % 4))) & 31)) AS t FROM b)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(t, lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', k, 1)), '') AS payload_digest,
    CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id < owner THEN owner END AS refers_to
FROM t""",
    "op9_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
e AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS k FROM e),
f AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM win JOIN f USING (k), range(0, 13) AS t(j) WHERE m < doc_id),
g AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
    sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(ps, []), i)), ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)""",
    "op11_periodic_runs": f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w, {_CRC.format("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
c AS (SELECT *, len(w) AS n, len(w) > 0 AND h % 10 = 0 AS planted, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS q FROM d),
b AS (SELECT *, 1 + (n - a) // q AS p FROM c),
t AS (SELECT doc_id, n, CASE WHEN planted THEN list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM b),
e AS (SELECT doc_id, n, unnest(w) AS x, unnest(range(0, n)) AS i FROM t),
s AS (SELECT y.doc_id, y.i, z.i - y.i AS q FROM e y JOIN e z ON z.doc_id = y.doc_id AND z.x = y.x AND z.i > y.i AND 4 * (z.i - y.i) <= y.n),
g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM s),
m AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM g GROUP BY doc_id, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT doc_id, s, l, min(q) AS q FROM m GROUP BY ALL),
o AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listed FROM r GROUP BY doc_id),
f AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY l / q DESC, s, q) = 1),
k AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (SELECT doc_id, unnest(range(s + q, s + l)) AS i FROM r) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, l AS length, q AS period, CAST(1000 * l // q AS BIGINT) AS exponent_milli,
    sha256(coalesce(listed, '')) AS runs_sha256,
    sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(gone, []), i - 1)), ' ')) AS collapsed_sha256
FROM t LEFT JOIN o USING (doc_id) LEFT JOIN f USING (doc_id) LEFT JOIN k USING (doc_id)""",
    "op12_importance_resampling": f"""
WITH d AS (SELECT doc_id, {_FEATURES.format(_LOWER)} AS w FROM documents),
dw AS (SELECT doc_id, unnest(w) AS x FROM d),
bw AS (SELECT unnest({_FEATURES.format(_LOWER)}) AS x FROM benchmark),
v AS MATERIALIZED (SELECT x, {_CRC.format("x")} % 10000 AS k FROM (SELECT x FROM dw UNION SELECT x FROM bw)),
s AS (SELECT k, count(*) AS n FROM dw JOIN v USING (x) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM bw JOIN v USING (x) GROUP BY k),
z AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS s, (SELECT coalesce(sum(n), 0) FROM t) AS t),
g AS (SELECT k, floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * (z.s + 10000) AS DOUBLE) / CAST((s.n + 1) * (z.t + 10000) AS DOUBLE))) AS gain FROM s LEFT JOIN t USING (k), z),
m AS (SELECT doc_id, floor(sum(gain) / count(*)) AS weight FROM dw JOIN v USING (x) JOIN g USING (k) GROUP BY doc_id),
h AS (SELECT doc_id, CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h FROM d),
r AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM d JOIN h USING (doc_id) LEFT JOIN m USING (doc_id)),
o AS (SELECT doc_id, CAST(row_number() OVER (ORDER BY score DESC, doc_id) AS BIGINT) AS place FROM r WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT 10 * count(*) // 100 FROM o) THEN place END AS rank FROM r LEFT JOIN o USING (doc_id)""",
    "op13_suffix_array_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
c AS (SELECT doc_id, n, c, substr(x, 2 * c + 1, 798) AS x FROM (SELECT doc_id, x, n, unnest(range(0, n - 199, 200)) AS c FROM d WHERE n >= 200)),
w AS (SELECT doc_id, c + j AS i, md5(substr(x, 2 * j + 1, 400)) AS k FROM (SELECT *, unnest(range(0, least(200, n - 199 - c))) AS j FROM c)),
o AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
r AS (SELECT doc_id, i, i - lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) > 200 AS new FROM w JOIN o USING (k)),
g AS (SELECT doc_id, i, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM r),
s AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM g GROUP BY doc_id, g),
p AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM s),
f AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, CAST(count(*) AS BIGINT) AS n_spans, max(b) AS last,
    string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM p JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN f USING (doc_id)""",
}
