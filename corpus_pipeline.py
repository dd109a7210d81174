"""A corpus from raw documents to training sequences, each stage on all that the one before kept.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of the documents table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import decontaminate, neardup, packing, quality, secret_scan
from tributary.llm.queries import TOKENIZER
from tributary.llm.tables import Stage


def _in_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row): operators add columns of their own, which names in ``row`` cannot clash with."""
    return docs.select("doc_id", "text", F.struct([F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the learned decision list.

    Null and empty texts fail it. Rows are judged each for itself, those that repeat or have no id too. Without
    labels only the base rule counts; an empty table gives an empty one.
    """
    rows = _in_rows(docs)
    rules = quality.learn_rules(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(rows, rules).where("quality_kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id, null last.

    Texts that are not alike stay though they share an id; of rows equal in id and text one stays. Texts
    without words stay. An empty table gives an empty one.
    """
    return neardup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark.

    Each row is judged by its own text, whether or not it has an id or shares one. Null and empty
    texts stay. Empty tables, also of the benchmark, remove nothing.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked, and ``n_chars`` of the text as it then is.

    Null and empty texts stay as they are (``n_chars`` of a null text is null). Equal rows are masked alike;
    ids play no part. An empty table gives an empty one.
    """
    rows = _in_rows(docs)
    model = secret_scan.train(secret_scan.labelled_findings(rows), secret_scan.frequent_words(rows))
    masked = secret_scan.mask_secrets(rows, model)
    types = dict(zip(docs.columns, (f.dataType for f in docs.schema.fields)))
    made = {"text": F.col("text"), "n_chars": F.length("text")}
    return masked.select([(made[c].cast(types[c]) if c in made else F.col("row")[c]).alias(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in training sequences.

    Null texts are empty: one piece with the end mark. Rows that repeat are packed each for itself. An empty
    table gives an empty one.
    """
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_neardup", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage.table(function(spark, docs, sf_dir), name)
    return docs


#: A learned list, a forest and a tokenizer are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None
