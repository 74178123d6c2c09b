"""A corpus pipeline of five stages; each works on all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. Rows travel as one struct, so that columns of documents can't clash with those of an operator. Repeated rows
are documents each; null texts are empty ones, which the base rules reject; a null doc_id is a document like others; an
empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel_jobs.llm.exact_dedup import exact_groups
from parcel_jobs.llm.packing import pack_documents
from parcel_jobs.llm.quality import quality_verdicts
from parcel_jobs.llm.shared import forget, new_path, scratch, written
from parcel_jobs.llm.similar import similar_groups
from parcel_jobs.llm.toxicity import score_toxicity


def _held(docs: DataFrame, *fields: str) -> DataFrame:
    """Each row as one column, doc, beside the named fields."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *fields)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    scored = score_toxicity(_held(docs, "doc_id"), spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=("doc",), text="doc.text")
    return scored.where("predicted = 0").select("doc.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or diverge from their language go."""
    return quality_verdicts(_held(docs), carry=("doc",), text="doc.text", lang="doc.lang").where("kept").select("doc.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return exact_groups(_held(docs, "doc_id"), carry=("doc",), text="doc.text").where("kept").select("doc.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near-duplicate links join, texts that share four fifths of their five-word shingles, one stays."""
    return similar_groups(_held(docs, "doc_id"), carry=("doc",), text="doc.text").where("first").select("doc.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, placed in sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [("toxicity", toxicity), ("quality", quality), ("exact dedup", exact), ("near dedup", near), ("packing", packing)]

#: Learned weights and greedy partitions are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn. A stage's own tables go when its result is written, and the result when the next one's is."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        tag = name.replace(" ", "-")
        path = new_path(spark, tag)
        with scratch(spark, f"{tag}-work"):
            kept = written(stage(spark, docs, sf_dir), tag, path)
        forget(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
