"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again as the next one's input.

Toxic documents go; of each group of near copies the smallest id stays; documents that hold benchmark passages go; secrets are
masked in the text; the rest is encoded.  All but the last stage return the columns of ``documents``.

Null, empty and wordless texts pass every stage (they are neither toxic nor copies nor contaminated); of rows that repeat id and text one stays;
rows with a null id stay; an empty table gives an empty table; other columns, whatever their names, are carried along (the last stage
replaces ids, n_tokens and lossless).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociforge.llm import bpe, decontaminate, ngram_join, queries, secret_scan, toxicity
from lociforge.llm.storage import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str, threshold: float = 0.3) -> DataFrame:
    """Rejects documents that the classifier, fitted on the labelled ones outside the held-out quarter, scores at ``threshold`` or more."""
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.toxicity_score(model, F.col("text")) < threshold)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of documents linked by word 5-shingles at a similarity of 0.75 or more."""
    return ngram_join.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a ten-word window of a benchmark item occurs."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks found secrets; n_chars is counted again where a text changed."""
    was = next(name for i in range(len(docs.columns) + 1) if (name := f"_was{i}") not in docs.columns)
    masked = secret_scan.redact_secrets(docs.withColumn(was, F.xxhash64("text")), queries.secret_forest())
    return masked.withColumn("n_chars", F.when(F.xxhash64("text") == F.col(was), F.col("n_chars")).otherwise(F.char_length("text"))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds token ids, their number, and whether decoding gives the text back."""
    return bpe.encode_documents(docs, queries.tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("byte_bpe", encode),
]

#: The stages learn a classifier, walk a graph and train a forest; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, one after another."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
