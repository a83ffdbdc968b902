"""Corpus pipeline: documents -> token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs. All but the last return the
columns of documents, extra ones included.

Defined cases: a null text counts as empty everywhere; equal texts (nulls and empty ones among them) become one
row, that of largest id; a null id loses to any other; texts of any length are taken whole; repeated rows are
copies; columns of any name are carried; an empty table stays empty and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollplane.llm import bpe, exact_dedup, mixing, near_dedup, quality_classifier
from rollplane.llm.common import written
from rollplane.session import configure
from rollplane.sources.tables import read_table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    configure(spark)
    return quality_classifier.good_documents(docs, read_table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of largest id stays."""
    configure(spark)
    return exact_dedup.distinct_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays (the smallest id)."""
    configure(spark)
    return near_dedup.distinct_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 3, 1, 2, .. share 150 % of all words, at most twice their own; a
    document taken twice stands twice."""
    configure(spark)
    return mixing.mixed_documents(docs, mixing.WEIGHTS, budget=1.5, max_epochs=2.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding: doc_id, ids, n_tokens, digests."""
    import public_tokenizers as P
    configure(spark)
    return bpe.tokenized(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


STAGES = [("quality_classifier", classify), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("mix_sources", mix), ("byte_bpe", encode)]

# The classifier, the near-duplicate classes and the merges are not SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
