"""The corpus pipeline: quality, exact copies, near copies, benchmark passages, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the last return the
columns of documents. There is no SQL for it, as models and near copies have none: its tests hold it
against a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphtables.llm.common import ascii_lower, read, settled
from graphtables.llm.decontaminate import without_contamination
from graphtables.llm.exact_dedup import exact_dedup
from graphtables.llm.mixing import mix
from graphtables.llm.near_dedup import near_duplicates
from graphtables.llm.quality import scorer


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.5 go."""
    score = scorer(docs, read(spark, sf_dir, "labels"))
    return docs.where(score(docs["text"]) >= 0.5)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays, once if its row is repeated."""
    stays = exact_dedup(docs).where("kept").select(F.col("doc_id").alias("stays_id"), F.col("text_sha256").alias("stays_sha"))
    own = next(n for n in ("own_sha" + "_" * k for k in range(len(docs.columns) + 1)) if n not in docs.columns)
    named = docs.withColumn(own, F.sha2(ascii_lower(docs["text"]).cast("binary"), 256))
    same = (named[own] == stays["stays_sha"]) & named["doc_id"].eqNullSafe(stays["stays_id"])
    return named.join(stays, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 of their 5-word shingles the one with the smallest id stays."""
    stays = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("stays_id"))
    return docs.join(stays, docs["doc_id"].eqNullSafe(stays["stays_id"]), "left_semi")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return without_contamination(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document that is left."""
    return mix(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = settled(docs, "pipeline")
    return docs
