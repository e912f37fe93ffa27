"""Windows that occur more than once, found without a row per window.

Every window of ``size`` symbols belongs to the least hash of its runs of ``seed`` symbols (its minimizer), which
depends on the window alone. Windows in a row that share it are one region, about (size - seed) / 2
of them. So equal windows lie in regions of one minimizer: a region whose minimizer occurs once holds no repeat, a
region that occurs again as a whole holds nothing else, and only regions of one minimizer that differ
must be looked at window by window. Nothing is sampled: every window is in exactly one region.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphtables.llm.common import pick
from graphtables.llm.wordhash import WORDS, sliding_min

#: Windows of a text that are worked on at once; regions end where a piece ends.
PIECE = 1 << 18
_LOW = np.uint64((1 << 20) - 1)
NO_ID = -(2**63)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, tag, text: rows of one id and text (tag is its hash) are one document; a null id is the smallest."""
    rows = pick(docs, id=id_col, text=text_col)
    text = F.coalesce("text", F.lit(""))
    return rows.select(F.coalesce(F.col("id").cast("bigint"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("tag"), text.alias("text"))


def unkeyed(id_col: str):
    return F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col)


def regions_of(numbers: np.ndarray, size: int, seed: int):
    """First window, windows, minimizer, hash of the whole, and whether the minimizer occurs twice, of each region."""
    n = len(numbers) - size + 1
    for a in range(0, n, PIECE):
        part = numbers[a : a + PIECE + size - 1]
        sums = WORDS.sums(part)
        _, down = WORDS._powers(len(part))
        m = len(part) - seed + 1
        grams = ((sums[seed:] - sums[:m]) * down[:m]) * np.uint64(0x9E3779B97F4A7C15)
        grams = (grams ^ (grams >> np.uint64(32))) & ~_LOW
        place = np.arange(m, dtype=np.uint64)
        left = sliding_min(grams | place, size - seed + 1)
        right = sliding_min(grams | (_LOW - place), size - seed + 1)
        keys = left & ~_LOW
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        count = np.diff(np.append(first, len(keys)))
        twice = np.minimum.reduceat(left & _LOW, first) != _LOW - np.minimum.reduceat(right & _LOW, first)
        whole = WORDS.runs(sums, first, first + count - 1 + size)
        yield first + a, count, keys[first], whole, twice


def regions(rows: DataFrame, numbers_of: Callable[[str], np.ndarray], size: int, seed: int) -> DataFrame:
    """id, tag, key, whole, at of every region; ``at`` is first window << 22 | windows << 1 | occurs twice."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 64):
                some = batch.iloc[i : i + 64]
                ids, tags, found = [], [], []
                for id_, tag, text in zip(some["id"], some["tag"], some["text"], strict=True):
                    for first, count, key, whole, twice in regions_of(numbers_of(text), size, seed):
                        ids.append(np.full(len(first), id_, np.int64))
                        tags.append(np.full(len(first), tag, np.int64))
                        found.append((key.view(np.int64), whole.view(np.int64), first << 22 | count << 1 | twice))
                if ids:
                    key, whole, at = (np.concatenate(x) for x in zip(*found, strict=True))
                    yield pd.DataFrame({"id": np.concatenate(ids), "tag": np.concatenate(tags), "key": key, "whole": whole, "at": at})

    return rows.mapInPandas(cut, "id long, tag long, key long, whole long, at long")


def repeated_regions(found: DataFrame) -> DataFrame:
    """Of ``regions``, those that may hold a repeated window: id, tag, key, first, count, and marks.

    ``again``: the region occurs elsewhere as a whole; ``earliest``: it is the first by id, tag and place of
    those that are equal; ``open``: other regions have its minimizer, or it has it twice, so its windows
    must be compared one by one (of equal regions only the earliest). The windows are unordered aggregates
    over a sorted partition, which spill: the rows of a hot minimizer are never in memory together.
    """
    by_key, by_whole = Window.partitionBy("key"), Window.partitionBy("key", "whole")
    place = F.struct("id", "tag", "at")
    marked = found.select(
        "id", "tag", "key", "at",
        F.min(place).over(by_whole).alias("low"), F.max(place).over(by_whole).alias("high"), place.alias("own"),
        (F.min("whole").over(by_key) != F.max("whole").over(by_key)).alias("others"),
        F.max(F.col("at").bitwiseAND(F.lit(1))).over(by_key).alias("twice"),
    )
    again, earliest = F.col("low") != F.col("high"), F.col("own") == F.col("low")
    return (
        marked.select(
            "id", "tag", "key",
            F.shiftright("at", 22).alias("first"),
            F.shiftright("at", 1).bitwiseAND(F.lit((1 << 21) - 1)).alias("count"),
            again.alias("again"), earliest.alias("earliest"),
            (earliest & (F.col("others") | (F.col("twice") == 1))).alias("open"),
        )
        .where("again OR open")
    )


def squeeze():
    """A function that compresses a text column; null counts as empty."""

    def pack(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in texts:
            yield pd.Series([packer.compress((t or "").encode("utf-8", "surrogatepass")) for t in batch])

    return F.pandas_udf(pack, "binary")


def packed(rows: DataFrame) -> DataFrame:
    """id, tag and the texts compressed, as they are shuffled twice."""
    return rows.select("id", "tag", squeeze()("text").alias("packed"))


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data, max_output_size=max(1, zstandard.frame_content_size(data)))


def per_document(spans: DataFrame) -> DataFrame:
    """id, tag, and the spans (first window, windows) of each document in order; a document bounds its list."""
    return spans.groupBy("id", "tag").agg(F.array_sort(F.collect_set(F.struct("first", "count"))).alias("spans"))


def cover(spans, size: int, n: int) -> np.ndarray:
    """Which of ``n`` symbols lie in a window of the spans."""
    turns = np.zeros(n + 1, np.int64)
    for s in spans if spans is not None else ():
        turns[s["first"]] += 1
        turns[min(n, s["first"] + s["count"] - 1 + size)] -= 1
    return np.cumsum(turns[:n]) > 0
