"""A training corpus from raw documents: toxicity, near duplicates, personal data, source mix, tokens.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last
return the columns of ``documents``, and each works on what its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studyloom.llm import bpe, mixing, neardup, pii, toxicity
from studyloom.llm.common import small_batches, table
from studyloom.storage import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; the model learns from this stage's documents. Null and empty texts are scored as
    empty ones; repeated rows stay or go together; labels of one kind drop nothing; no documents give no documents."""
    small_batches(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates stays, null ids last. Null and empty texts are one group;
    of repeated rows one stays; no documents give no documents."""
    small_batches(spark)
    return neardup.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every found span becomes the name of its kind; n_chars follows the new text. Null texts stay null with their n_chars; repeated rows
    are masked alike; all columns stay; no documents give no documents."""
    small_batches(spark)
    return docs.withColumn("text", pii.masked_text(F.col("text"))).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document that begins within the mix, whole. Documents without words take no part; a null source is a
    source; repeated rows queue each by itself; no documents give no documents."""
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids, n_tokens and the decoded bytes' digest of every row. A null text is empty and has no ids; repeated rows get
    equal rows; no documents give no rows."""
    small_batches(spark)
    path, pattern = bpe.production()
    out = docs.select("doc_id", "source", bpe.round_trip(F.col("text"), path, pattern).alias("t"))
    return out.select("doc_id", "source", "t.ids", F.size("t.ids").cast("long").alias("n_tokens"), F.sha2("t.decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("personal data", mask_personal_data),
    ("mixing", mix_sources),
    ("tokens", tokenize),
]

#: Boosted trees and byte-level BPE have no SQL form; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
