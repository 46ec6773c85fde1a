"""A training-corpus pipeline over the documents table.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept, whose result
is written as Parquet and read again in between. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm import decontaminate, nearcopies, packing, quality, repeats
from martkit.llm.frames import Workspace, ready, scratch_scope, table
from martkit.operators.reduction import anti_reduced

# What is a near copy here; op3_near_copies has limits of its own.
SHINGLE, PERCENT = 5, 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.train(docs, table(ready(spark), sf_dir, "labels"))
    return quality.score_documents(docs, model).where(F.col("score") >= 0.5).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; all others, and rows without id, stay."""
    ready(spark)
    gone = nearcopies.near_copies(docs, SHINGLE, PERCENT).where("not kept and doc_id is not null").select("doc_id").distinct()
    return anti_reduced(docs, gone, {"doc_id": "doc_id"})  # texts that surely stay are not shuffled


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the byte strings that start earlier in the corpus."""
    ready(spark)
    return repeats.without_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.keep_clean(docs, table(ready(spark), sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents with their places in sequences."""
    ready(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", one_of_each),
    ("suffix-array dedup", drop_repeats),
    ("benchmark decontamination", drop_leaks),
    ("best-fit packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    work = Workspace(ready(spark), "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with scratch_scope():
            done = work.put(stage(spark, docs, sf_dir))
        if work.made > 1:
            work.drop(docs)
        docs = done
    return docs
