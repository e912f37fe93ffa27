"""Benchmark decontamination: a prefix-filtered join of benchmark windows with whole documents."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphtables.llm.common import pick, read, settled
from graphtables.llm.wordhash import LETTERS, WORDS, to_bytes, word_hashes, word_spans

#: Words of a window and of a shingle.
WINDOW, SHINGLE = 10, 5
#: Words of benchmark text that are matched in one go; a larger benchmark is matched block after block.
BLOCK_WORDS = 1_000_000
#: Items are cut into pieces of this share of a block, so that blocks are of about one size.
PIECES = 16


def tokens(text: str | None):
    """The bytes of a text in lower case (A-Z), the spans of its words, and their hashes."""
    data = to_bytes(text, lower=True)
    starts, ends = word_spans(data, LETTERS)
    return data, starts, ends, word_hashes(data, starts, ends)


def spell(data, starts, ends, first: int, n: int) -> bytes:
    return b" ".join(data[s:e].tobytes() for s, e in zip(starts[first : first + n], ends[first : first + n], strict=True))


class Windows:
    """The distinct windows of some benchmark items, indexed by their shingles.

    ``key[i]`` is the window's words as bytes, ``items[i]`` the ids it occurs in, ``hashes[i]`` its word
    hashes. A shingle is SHINGLE words, or all words of a window that has fewer. A document can hold a
    window only if it holds all its shingles, so one of them, the necessary prefix, is enough to
    find all candidates: the one that the fewest documents hold.
    """

    def __init__(self, items: list[tuple[str, str | None]]):
        found: dict[bytes, int] = {}
        self.items: list[set[str]] = []
        self.hashes: list[np.ndarray] = []
        for item, text in items:
            data, starts, ends, h = tokens(text)
            n = min(WINDOW, len(h))
            for first in range(len(h) - n + 1 if n else 0):
                k = found.setdefault(spell(data, starts, ends, first, n), len(found))
                if k == len(self.items):
                    self.items.append(set())
                    self.hashes.append(h[first : first + n])
                self.items[k].add(item)
        self.key = list(found)
        #: shingle sizes in use
        self.sizes = sorted({min(SHINGLE, len(h)) for h in self.hashes})
        every = [WORDS.windows(h, min(SHINGLE, len(h))) for h in self.hashes]
        self.shingles = np.unique(np.concatenate([*every, np.zeros(0, np.uint64)]))
        self.every = every

    def places(self, hashes: np.ndarray, wanted: np.ndarray):
        """Number in ``wanted`` (sorted) and position of each wanted shingle in a document, per shingle size."""
        for size in self.sizes:
            own = WORDS.windows(hashes, size)
            if len(own) and len(wanted):
                at = np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)
                where = np.flatnonzero(wanted[at] == own)
                yield size, at[where], where

    def order(self, counts: np.ndarray) -> None:
        """Choose every window's prefix by the number of documents that hold each shingle."""
        prefixes: dict[int, list[tuple[int, int]]] = {}
        for k, own in enumerate(self.every):
            seen = counts[np.searchsorted(self.shingles, own)]
            if seen.min() > 0:  # a shingle that no document has rules the window out
                offset = int(seen.argmin())
                prefixes.setdefault(int(own[offset]), []).append((k, offset))
        self.prefix = np.array(sorted(prefixes), np.uint64)
        self.windows_of = [prefixes[int(p)] for p in self.prefix]
        self.every = self.shingles = None

    def match(self, text: str | None):
        """Words of the text, covered spans (start, end; merged), ids of the items found."""
        data, starts, ends, h = tokens(text)
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for size, number, where in self.places(h, self.prefix):
            for p, at in zip(number, where, strict=True):
                for k, offset in self.windows_of[p]:
                    own = self.hashes[k]
                    first = at - offset
                    # positional and length bounds, then the words themselves
                    if min(SHINGLE, len(own)) != size or first < 0 or first + len(own) > len(h):
                        continue
                    if np.array_equal(h[first : first + len(own)], own) and spell(data, starts, ends, first, len(own)) == self.key[k]:
                        spans.append((int(first), int(first + len(own))))
                        items |= self.items[k]
        merged: list[tuple[int, int]] = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1] = merged[-1][0], max(merged[-1][1], b)
            else:
                merged.append((a, b))
        return len(h), merged, sorted(items)


def _count_shingles(block: Windows):
    """For every partition the number of documents that hold each shingle of the block."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(len(block.shingles), np.int64)
        for batch in batches:
            for text in batch["text"]:
                hashes = tokens(text)[3]
                for _, number, _ in block.places(hashes, block.shingles):
                    counts[np.unique(number)] += 1
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"shingle": at, "docs": counts[at]})

    return count


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, spans, items, n_items, items_sha256, contaminated.

    Words are runs of digits, letters a-z after lower-casing A-Z, and anything outside ASCII. A window is
    WINDOW words in a row of an item, or the whole item if it has fewer (but some). ``spans`` are the word
    spans of the document that windows cover (a to b, end exclusive; those of one block merged); n_hit is the words in them;
    ``items`` are the ids, as text, of the items whose windows occur, sorted; items_sha256 is the hash of
    those ids joined by commas.

    Null texts have no words; a null item id counts as the empty id; items and documents may repeat
    (ids count once, documents get a row each); without items nothing is contaminated.

    The benchmark is a query set: its windows are matched with all documents in blocks of about ``block_words`` words, one
    after another: a block is sent to the executors as a whole, and what it hits is written out before the next is
    gathered, so one block is held at a time. Long items are cut into pieces that overlap, so no window is lost. Documents are
    never shuffled for the first block; of the others only the hits are. Every block reads the texts twice:
    for the number of documents that hold each shingle, and for the join. Other columns are not looked at, whatever their names.
    """
    rows = pick(docs, id=id_col, text=text_col).select("id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"))
    blocks = _blocks(benchmark, item_id, item_text, block_words)
    out = rows.select("id", "tag", _matcher(_indexed(rows, next(blocks)))("text").alias("m")).select("id", "tag", "m.*")
    more = []
    for items in blocks:
        out = settled(out, "matched") if not more else out
        hits = rows.select("id", "tag", _matcher(_indexed(rows, items))("text").alias("m")).select("id", "tag", "m.spans", "m.items")
        more.append(settled(hits.where(F.size("spans") > 0), "hits"))
    if more:
        named = F.explode("spans").alias("s"), "items"
        hits = reduce(DataFrame.union, more).select(F.col("id").alias("hit_id"), F.col("tag").alias("hit_tag"), *named)
        hits = hits.groupBy("hit_id", "hit_tag").agg(
            F.collect_set("s").alias("more_spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("more_items")
        )
        same = out["id"].eqNullSafe(hits["hit_id"]) & (out["tag"] == hits["hit_tag"])
        joined = out.join(hits, same, "left")
        both = lambda a, b: F.when(F.col(b).isNull(), F.col(a)).otherwise(F.concat(a, b)).alias(a)
        out = joined.select("id", "n_words", both("spans", "more_spans"), both("items", "more_items"))
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        _covered(F.array_sort("spans")).alias("n_hit"),
        F.array_sort("spans").alias("spans"),
        F.array_sort(F.array_distinct("items")).alias("items"),
    ).select(
        "*",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _cut(most: int):
    """Items in pieces of at most ``most`` windows; a piece has the words of its windows, so neighbours overlap."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, text in zip(batch["item"], batch["text"], strict=True):
                data, starts, ends, _ = tokens(text)
                for first in range(0, max(1, len(starts) - WINDOW + 1) if len(starts) else 0, most):
                    last = min(len(starts), first + most + WINDOW - 1) - 1
                    piece = data[starts[first] : ends[last]].tobytes().decode("utf-8", "surrogatepass")
                    rows.append((item, piece, last + 1 - first))
            yield pd.DataFrame(rows, columns=["item", "text", "words"])

    return cut


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, block_words: int) -> Iterator[list[tuple[str, str]]]:
    """The pieces of the items, block after block; at least one block, which may be empty."""
    items = pick(benchmark, item=item_id, text=item_text).select(
        F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"), "text"
    )
    pieces = settled(items.mapInPandas(_cut(max(1, block_words // PIECES)), "item string, text string, words long").distinct(), "benchmark")
    n_blocks = max(1, -(-(pieces.agg(F.sum("words")).first()[0] or 0) // block_words))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks))
    for i in range(n_blocks):
        yield [tuple(r) for r in pieces.where(block == i).select("item", "text").collect()]


def _indexed(rows: DataFrame, items: list[tuple[str, str]]) -> Windows:
    """The windows of a block, by the shingle of each that the fewest of the texts hold."""
    block = Windows(items)
    counts = np.zeros(len(block.shingles), np.int64)
    counted = rows.select("text").mapInPandas(_count_shingles(block), "shingle long, docs long")
    for r in counted.groupBy("shingle").agg(F.sum("docs").alias("docs")).toLocalIterator():
        counts[r.shingle] = r.docs
    block.order(counts)
    return block


def without_contamination(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The rows of ``docs``, all columns, in whose texts no window of the benchmark occurs.

    Null texts hold no window and stay. Of each block but the last, the hit texts are settled as hashes before the next is gathered;
    a text goes by its 128-bit content hash, so repeated rows go together.
    """
    texts = pick(docs, text=text_col).select(F.coalesce("text", F.lit("")).alias("text"))
    content = lambda text: F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    last, gone = None, []
    for items in _blocks(benchmark, item_id, item_text, block_words):
        if last is not None:
            gone.append(settled(texts.where(F.size(last(texts["text"])["spans"]) > 0).select(content(texts["text"]).alias("gone")).distinct(), "hits"))
        last = _matcher(_indexed(texts, items))
    clean = docs.where(F.size(last(docs[text_col])["spans"]) == 0)
    for hits in gone:
        clean = clean.join(hits, content(clean[text_col]) == hits["gone"], "left_anti")
    return clean


def _matcher(block: Windows):
    def match(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([block.match(t) for t in batch], columns=["n_words", "spans", "items"])

    return F.pandas_udf(match, "n_words long, spans array<struct<a:long,b:long>>, items array<string>")


def _covered(spans):
    """Words in sorted spans; those of one block don't overlap, those of several may."""
    start = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n"))
    step = lambda acc, s: F.struct(
        F.greatest(acc["end"], s["b"]).alias("end"),
        (acc["n"] + F.greatest(s["b"] - F.greatest(acc["end"], s["a"]), F.lit(0).cast("bigint"))).alias("n"),
    )
    return F.aggregate(spans, start, step, lambda acc: acc["n"])


def op2_decontaminate(spark, sf_dir):
    out = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


QUERIES = {"op2_decontaminate": op2_decontaminate}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
ORACLE = {
    "op2_decontaminate": f"""
        WITH b AS (
            SELECT item_id, {_WORDS} AS ws FROM benchmark
        ), sized AS (
            SELECT item_id, ws, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0
        ), w AS (
            SELECT DISTINCT item_id, n, array_to_string(ws[i + 1 : i + n], ' ') AS k
            FROM (SELECT item_id, n, ws, unnest(range(0, len(ws) - n + 1)) AS i FROM sized)
        ), d AS (
            SELECT doc_id, {_WORDS} AS ws FROM documents
        ), p AS (
            SELECT doc_id, n, i, array_to_string(ws[i + 1 : i + n], ' ') AS k
            FROM (SELECT doc_id, ws, n, unnest(range(0, len(ws) - n + 1)) AS i
                  FROM d, (SELECT DISTINCT n FROM w) WHERE len(ws) >= n)
        ), hit AS (
            SELECT DISTINCT doc_id, item_id, n, i FROM p JOIN w USING (n, k)
        ), words AS (
            SELECT doc_id, count(DISTINCT word) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM hit) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
}
