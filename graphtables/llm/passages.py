"""Substring dedup: a de Bruijn graph of word windows, compacted, finds repeated passages."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphtables.llm.common import read, settled
from graphtables.llm.regions import cover, keyed, packed, per_document, regions, repeated_regions, unkeyed, unpack
from graphtables.llm.wordhash import FIRST, SECOND, SPACED, to_bytes, word_hashes, word_spans


#: Edges of a path, about, and how often the known way to its first edge is doubled.
CUT, ROUNDS = 8, 5


def _numbers(text: str) -> np.ndarray:
    data = to_bytes(text)
    return word_hashes(data, *word_spans(data, SPACED))


def _edges(size: int):
    """For the open regions of a document, its windows as edges between the nodes of one word less.

    ``edge`` and ``check`` are two independent hashes of the words at the source coordinates.
    """

    def edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for id_, tag, data, spans in zip(batch["id"], batch["tag"], batch["packed"], batch["spans"], strict=True):
                h = _numbers(unpack(data).decode("utf-8", "surrogatepass"))
                at = np.unique(np.concatenate([np.arange(s["first"], s["first"] + s["count"]) for s in spans]))
                sums, checks = FIRST.sums(h), SECOND.sums(h)
                yield pd.DataFrame({
                    "id": id_, "tag": tag, "first": at,
                    "edge": FIRST.runs(sums, at, at + size).view(np.int64),
                    "check": SECOND.runs(checks, at, at + size).view(np.int64),
                    "source": FIRST.runs(sums, at, at + size - 1).view(np.int64),
                    "target": FIRST.runs(sums, at + 1, at + size).view(np.int64),
                })

    return edges


def compact(edges: DataFrame) -> DataFrame:
    """edge, check, path, step: the repeated ``edges`` (edge, check, source, target; one row each) on nonbranching paths.

    An edge is followed by another if the node between has no other edge in or out. Paths are cut before
    every edge whose hash falls in one of CUT, so that they are about CUT edges long, and named by their first
    edge; each of ROUNDS joins of the links with themselves doubles the way that is known towards it. An edge whose
    way is longer still, as on a cycle without a cut, stays a path of its own.
    """
    ins = edges.groupBy("target").agg(F.count(F.lit(1)).alias("n_in")).where("n_in = 1").select(F.col("target").alias("node"))
    outs = edges.groupBy("source").agg(F.count(F.lit(1)).alias("n_out")).where("n_out = 1").select(F.col("source").alias("node"))
    after = edges.where(F.pmod("edge", F.lit(CUT)) != 0).select("edge", F.col("source").alias("node"))
    before = edges.select(F.col("edge").alias("back"), F.col("target").alias("node"))
    links = after.join(ins, "node").join(outs, "node").join(before, "node").where("edge != back").select("edge", "back")
    ways = edges.select("edge", "check").join(links, "edge", "left")
    step = F.col("back").isNotNull().cast("bigint").alias("step")
    ways = settled(ways.select("edge", "check", F.coalesce("back", "edge").alias("back"), step), "paths")
    for _ in range(ROUNDS):
        heads = ways.select(F.col("edge").alias("back"), F.col("back").alias("far"), F.col("step").alias("more"))
        longer = ways.join(heads, "back").select("edge", "check", F.col("far").alias("back"), (F.col("step") + F.col("more")).alias("step"))
        ways = settled(longer, "paths")
    lost = F.col("step") >= 2**ROUNDS
    return ways.select(
        "edge", "check",
        F.when(lost, F.col("edge")).otherwise(F.col("back")).alias("path"),
        F.when(lost, 0).otherwise(F.col("step")).alias("step"),
    )


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 50, seed: int | None = None
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, spans, kept_sha256.

    Words are runs of anything but white space. A word is removed if it lies in a window of ``size`` words whose
    words also start anywhere else, in another document or the same. ``spans`` are the removed runs of words
    (first, count); kept_sha256 is the hash of the other words joined by one space.

    The windows are the edges of a de Bruijn graph. Edges in a row that share a minimizer are compacted
    where they are read, into regions; equal regions are found by one grouping. The edges of regions that share a
    minimizer but differ are counted one by one, and the repeated ones compacted to nonbranching paths by joins;
    where a document runs along a path is one span of it. Two hashes of the words at the source coordinates,
    independent of each other, must agree for edges to be the same.

    Null texts have no words, and texts shorter than a window lose none. Rows that repeat id and text are
    one document (each comes out, and they are no repeat of each other); a null id counts as an id of its
    own, and rows of one id with different texts as different documents. Ids are integers.
    """
    rows = keyed(docs, id_col, text_col)
    found = repeated_regions(regions(rows, _numbers, size, seed or max(1, size // 2)))
    found = settled(found, "passages")
    texts = packed(rows)

    open_spans = per_document(found.where("open"))
    edges = texts.join(open_spans, ["id", "tag"]).mapInPandas(
        _edges(size), "id long, tag long, first long, edge long, check long, source long, target long"
    )
    edges = settled(edges, "edges")
    # an open region stands for all that equal it, so one edge may do if its region occurs again
    again = found.where("open AND again").select("id", "tag", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1)).alias("first"))
    counted = edges.join(again.distinct().withColumn("again", F.lit(1)), ["id", "tag", "first"], "left")
    place = F.struct("id", "tag", "first")
    repeated = counted.groupBy("edge", "check").agg(
        F.min("source").alias("source"), F.min("target").alias("target"),
        F.min(place).alias("low"), F.max(place).alias("high"), F.max("again").alias("again"),
    ).where("low != high OR again = 1")
    paths = compact(settled(repeated.select("edge", "check", "source", "target"), "repeated_edges"))
    # runs of steps of one path in one document, at source coordinates
    on_path = edges.select("id", "tag", "first", "edge", "check").join(paths, ["edge", "check"])
    origin = F.col("first") - F.col("step")
    runs = on_path.groupBy("id", "tag", "path", origin.alias("origin")).agg(F.collect_set("first").alias("firsts"))
    spans = runs.select("id", "tag", F.explode(_runs(F.array_sort("firsts"))).alias("s")).select("id", "tag", "s.first", "s.count")

    every = per_document(found.where("again").select("id", "tag", "first", "count").union(spans.select("id", "tag", "first", "count")))
    out = texts.join(every, ["id", "tag"], "left").mapInPandas(
        _removed(size), "id long, n_words long, n_removed long, spans array<struct<first:long,count:long>>, kept_sha256 string"
    )
    return out.select(unkeyed(id_col), "n_words", "n_removed", "spans", "kept_sha256")


def _runs(sorted_numbers):
    """Sorted numbers as runs (first, count) of neighbours."""
    empty = F.expr("array()").cast("array<struct<first:bigint,count:bigint>>")

    def step(acc, x):
        last = F.element_at(acc, -1)
        longer = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["first"].alias("first"), (last["count"] + 1).alias("count"))))
        new = F.concat(acc, F.array(F.struct(x.alias("first"), F.lit(1).cast("bigint").alias("count"))))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["first"] + F.try_element_at(acc, F.lit(-1))["count"] == x), longer).otherwise(new)

    return F.aggregate(sorted_numbers, empty, step)


def _removed(size: int):
    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for id_, data, spans in zip(batch["id"], batch["packed"], batch["spans"], strict=True):
                text = np.frombuffer(unpack(data), np.uint8)
                starts, ends = word_spans(text, SPACED)
                gone = cover(spans, size, len(starts))
                kept = b" ".join(text[s:e].tobytes() for s, e in zip(starts[~gone], ends[~gone], strict=True))
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                runs = [(int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2], strict=True)]
                rows.append((id_, len(starts), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(rows, columns=["id", "n_words", "n_removed", "spans", "kept_sha256"])

    return remove


def op10_repeated_passages(spark, sf_dir):
    return repeated_passages(read(spark, sf_dir, "documents"), size=35).drop("spans")


QUERIES = {"op10_repeated_passages": op10_repeated_passages}

ORACLE = {
    "op10_repeated_passages": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), p AS (
            SELECT doc_id, i, md5(array_to_string(ws[i + 1 : i + 35], ' ')) AS k
            FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - 34)) AS i FROM d WHERE len(ws) >= 35)
        ), r AS (
            SELECT doc_id, i FROM p WHERE k IN (SELECT k FROM p GROUP BY k HAVING count(*) > 1)
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM r
        ), w AS (
            SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS i FROM d
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
            FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
}
