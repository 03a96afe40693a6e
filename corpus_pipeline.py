"""From raw documents to packed sequences: quality rules, line chunks, near duplicates, packing.

Each stage takes all documents that its predecessor kept and returns them in the columns of
``documents``; the last returns the packed pieces. Between stages a table in the shared folder
is written and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepwise.llm.common import ship_code
from stepwise.llm.jaccard import near_groups
from stepwise.llm.line_dedup import clean_lines
from stepwise.llm.packing import pack_documents
from stepwise.llm.quality import keep_good
from stepwise.session import shared_dir

TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a repetition rule go."""
    return keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line chunks that an earlier document has are cut out; the documents stay, with ``n_chars`` as it is then."""
    cleaned = clean_lines(docs, counts=False)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast("long"))
    return cleaned.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays; documents without an id stay."""
    kept = near_groups(docs).where("doc_id = component_id").select("doc_id").distinct()
    known = docs.where("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").select(*docs.columns)
    return known.unionByName(docs.where("doc_id IS NULL"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER), END_ID)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]

#: Rolling hashes, set similarity and the linear program have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ship_code(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        out = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
