"""A training-text pipeline over ``documents``: language, exact copies, near
copies, benchmark passages, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before
has kept. All but the last return the columns of ``documents``; an empty table
passes through all of them. Rows that repeat are copies and are dealt with as
such; NULL texts count as empty ones, which have no language and leave in the
first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.llm import bpe, language
from quillgrid.llm.common import shared_path, table
from quillgrid.llm.decontaminate import drop_contaminated
from quillgrid.llm.exact_dedup import drop_duplicates
from quillgrid.llm.jaccard import drop_near_duplicates
from quillgrid.llm.queries import learns_language, tokenizer_path


def told_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told. Those without a letter go, and those
    that two languages pack nearly equally well."""
    return language.accepted(docs, learns_language())


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, the one with the smallest id."""
    return drop_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class that links of similarity 0.8 over five-word
    shingles make, the one with the smallest id."""
    return drop_near_duplicates(docs, percent=80, width=5)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which fewer than one word in twenty lies in a benchmark window."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and as ``text`` what the ids decode to."""
    both = bpe.round_trip(docs, tokenizer_path(), decoded_col="text")
    others = [F.col(f"`{c}`") for c in docs.columns]
    return both.select(*others, F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("language ID", told_language),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("BPE encoding and decoding", tokens),
]
# Compression by zstandard and BPE are not within SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
