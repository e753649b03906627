"""Corpus pipeline: raw documents to token ids, in stages that each write a table.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of
documents; the last returns a row per document of the mix with the digests of its ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigor.llm import byte_bpe, line_dedup, mixing, ngram_join, quality_rules
from vigor.llm.shared import stored, table

#: Some stages have no SQL form; tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents hold stay in one; ``n_chars`` follows the text."""
    return line_dedup.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the smallest doc_id stays.

    Rows that share a doc_id are one document and stay or go together; those without one stay.
    """
    found = ngram_join.join(docs, k=5, share=(80, 100))
    return docs.join(found.filter("component_id < doc_id").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come near their target weights: documents are repeated or left out."""
    return mixing.repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document of the mix."""
    return byte_bpe.digests(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "_"))
    return docs
