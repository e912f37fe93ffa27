"""Exact dedup: groups of equal content hash, one row of each stays, bytes compared inside groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphtables.llm.common import ascii_lower, pick, read, settled


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Documents are equal when their texts are, byte for byte, after lower-casing A-Z; null is empty.
    Groups are made on the 128-bit md5 of that text. ``keep`` says which id of a group stays:
    ``smallest`` or ``largest``. While the group is formed the smallest and the largest text of it
    are found, which are the same if and only if all are; a group where they differ (a collision of
    the hash) is formed anew on hash and text together, so different texts never share a group.

    Rows that repeat id and text are one document: one row comes out, and it counts once. Rows of one
    id with different texts are different documents. A null id takes part; it stays only in a
    group without any other id. An empty table gives an empty table.

    A hot group is no problem: each task sends one row of it, as aggregates are combined before the
    shuffle, and the join that labels the rows moves ids and hashes only.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    chosen = {"smallest": F.min, "largest": F.max}[keep]
    rows = pick(docs, id=id_col, text=text_col).select("id", ascii_lower(F.col("text")).alias("text"))
    hashed = rows.select("id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("h"), "text")

    labels = hashed.select("id", "h", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")).distinct()
    sizes = labels.groupBy("h").agg(chosen("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    checked = hashed.groupBy("h").agg((F.min("text") == F.max("text")).alias("same"))
    groups = settled(sizes.join(checked, "h"), "exact_groups")

    out = labels.join(groups.where("same"), "h").select("id", "keep_id", "group_size", "text_sha256")
    collided = groups.where("NOT same").select("h")
    if not collided.isEmpty():
        out = out.unionByName(_by_text(hashed.join(collided, "h", "left_semi"), chosen))
    return out.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def _by_text(hashed: DataFrame, chosen) -> DataFrame:
    """Groups of the texts themselves, for the hashes that more than one text has."""
    rows = hashed.distinct()
    groups = rows.groupBy("h", "text").agg(chosen("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    sha = F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    return rows.join(groups, ["h", "text"]).select("id", "keep_id", "group_size", sha)


def op4_exact_dedup(spark, sf_dir):
    return exact_dedup(read(spark, sf_dir, "documents"), keep="largest")


QUERIES = {"op4_exact_dedup": op4_exact_dedup}

ORACLE = {
    "op4_exact_dedup": """
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS norm
            FROM documents
        ), g AS (
            SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
        FROM t JOIN g USING (norm)
    """,
}
