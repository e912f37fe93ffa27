"""Suffix-array dedup: shard Burrows-Wheeler transforms merged by refining their interleave."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphtables.llm.common import read, settled
from graphtables.llm.regions import cover, keyed, packed, per_document, regions, repeated_regions, unkeyed, unpack
from graphtables.llm.wordhash import FIRST, SECOND, WORDS, to_bytes

#: Bytes of a shard, whose suffixes are sorted, and of a block, whose shards are merged.
SHARD, BLOCK = 1 << 14, 1 << 16
#: Bytes of open regions of one minimizer beyond which its windows are grouped by Spark instead.
HOT = 1 << 22


def _symbols(text: str) -> np.ndarray:
    return WORDS.symbols[to_bytes(text)]


class Shard:
    """The Burrows-Wheeler transform of some strings, each closed by an end mark and read as a circle.

    ``order`` holds the places in the order of the first ``depth`` symbols that start there, ``before`` the
    ``step`` symbols in front of each, as one number.
    """

    def __init__(self, codes: np.ndarray, begin: np.ndarray, length: np.ndarray, depth: int, step: int, radix: int):
        off = np.arange(len(codes)) - begin
        rank, h = codes * radix + codes[begin + (off + 1) % length], 2
        order = np.argsort(rank, kind="stable")
        while h < depth:
            key = rank * (len(codes) + radix * radix) + rank[begin + (off + h) % length]
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            rank = np.empty_like(rank)
            rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
            h *= 2
            if rank[order[-1]] == len(codes) - 1:
                break
        self.order = order
        before = np.zeros(len(codes), np.int64)
        for k in range(step, 0, -1):
            before = before * radix + codes[begin + (off - k) % length]
        self.before = before[order].astype(np.uint16)


def merge(shards: list[Shard], rounds: int):
    """Suffixes (numbered shard after shard in their orders) that share their interval, and the number of that interval.

    The interleave says which suffix comes next in the merged order. Each round puts it in the order of the symbols
    before (stable, so the order of what follows them is kept) and goes from each suffix to the one that begins with
    these symbols, whose place in its shard follows from the transform alone. After ``rounds`` rounds
    the suffixes are in the order of all the symbols read in them. Neighbours that differ in the symbols or were in
    different intervals are now in different ones, so the round in which a bound appears is their common prefix, and
    what no bound divides is a repeated interval. No suffixes are compared.

    A suffix that is alone in its interval stays alone, and so does the one that it leads to in the next round: both
    are left out, and the rounds shrink to what is repeated.
    """
    before = np.concatenate([s.before for s in shards])
    leads, base = np.empty(len(before), np.int32), 0
    for s in shards:
        leads[base + np.argsort(s.before, kind="stable")] = np.arange(base, base + len(s.before), dtype=np.int32)
        base += len(s.before)
    suffix = np.arange(len(before), dtype=np.int32)
    interval = np.zeros(len(before), np.int32)
    bounds = 1
    for _ in range(rounds):
        symbols = before[suffix]
        order = np.argsort(symbols, kind="stable")
        symbols, interval = symbols[order], interval[order]
        new = (symbols[1:] != symbols[:-1]) | (interval[1:] != interval[:-1])
        new = np.concatenate([[True], new, [True]])
        shared = ~(new[:-1] & new[1:])
        suffix = leads[suffix[order[shared]]]
        interval = np.cumsum(new[:-1][shared], dtype=np.int32)
        if not len(suffix):
            break
        now = len(before) - len(suffix) + int(interval[-1])
        if now == bounds:  # a round without a new bound is the last
            break
        bounds = now
    return suffix, interval


def repeated_windows(strings: list[bytes], counts: np.ndarray, size: int):
    """Number of the string, place in it, and number of the interval, of windows that occur more than once.

    The first ``counts[i]`` windows of string i are asked about.
    """
    lengths = np.array([len(s) + 1 for s in strings])
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64) + 1
    raw[begins + lengths - 1] = 0  # the end marks
    used = np.unique(raw)
    codes = np.searchsorted(used, raw)
    step = 2 if len(used) <= 256 and size % 2 == 0 else 1
    begin, length = np.repeat(begins, lengths), np.repeat(lengths, lengths)
    cuts = [0]
    for b, n in zip(begins, lengths, strict=True):
        if b + n - cuts[-1] > SHARD and b > cuts[-1]:
            cuts.append(int(b))
    cuts.append(len(codes))
    shards = [Shard(codes[a:b], begin[a:b] - a, length[a:b], size, step, len(used)) for a, b in zip(cuts, cuts[1:], strict=False)]
    suffix, interval = merge(shards, size // step)
    place = np.concatenate([s.order + a for s, a in zip(shards, cuts, strict=False)])[suffix]
    string = np.repeat(np.arange(len(strings)), lengths)[place]
    off = place - begins[string]
    asked = off < counts[string]
    string, off, interval = string[asked], off[asked], interval[asked]
    many = np.bincount(interval, minlength=1)[interval] > 1
    return string[many], off[many], interval[many]


def _strings(size: int):
    """The bytes of the open regions of a document."""

    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for id_, tag, data, spans in zip(batch["id"], batch["tag"], batch["packed"], batch["spans"], strict=True):
                text = unpack(data)
                rows += [(s["key"], id_, tag, s["first"], s["count"], text[s["first"] : s["first"] + s["count"] - 1 + size]) for s in spans]
            yield pd.DataFrame(rows, columns=["key", "id", "tag", "first", "count", "string"])

    return strings


def _later(size: int):
    """Of sorted batches of strings, the windows that start earlier elsewhere, as spans of their documents."""

    def search(block: pd.DataFrame) -> pd.DataFrame:
        block = block.drop_duplicates(["key", "id", "tag", "first"])
        string, off, interval = repeated_windows(list(block["string"]), block["count"].to_numpy(), size)
        id_, tag = block["id"].to_numpy()[string], block["tag"].to_numpy()[string]
        first = block["first"].to_numpy()[string] + off
        order = np.lexsort((first, tag, id_, interval))
        id_, tag, first, interval = id_[order], tag[order], first[order], interval[order]
        later = np.concatenate([np.zeros(min(1, len(interval)), bool), interval[1:] == interval[:-1]])
        id_, tag, first = id_[later], tag[later], first[later]
        order = np.lexsort((first, tag, id_))
        id_, tag, first = id_[order], tag[order], first[order]
        new = np.concatenate([np.ones(min(1, len(first)), bool), (id_[1:] != id_[:-1]) | (tag[1:] != tag[:-1]) | (first[1:] != first[:-1] + 1)])
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(first)))
        return pd.DataFrame({"id": id_[at], "tag": tag[at], "first": first[at], "count": count})

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole minimizers, some together, up to the size of a block or of the largest one that is not hot."""
        kept: list[pd.DataFrame] = []
        held = 0
        for batch in batches:
            if batch.empty:
                continue
            sizes = (batch["count"] + size).to_numpy()
            keys = batch["key"].to_numpy()
            begin = 0
            previous = kept[-1]["key"].iloc[-1] if kept else None
            turns = np.flatnonzero(np.concatenate([[previous is not None and keys[0] != previous], keys[1:] != keys[:-1]]))
            total = np.concatenate([[0], np.cumsum(sizes)])
            for t in turns:
                if held + total[t] - total[begin] >= BLOCK:
                    yield search(pd.concat([*kept, batch.iloc[begin:t]], ignore_index=True))
                    kept, held, begin = [], 0, t
            kept.append(batch.iloc[begin:])
            held += int(total[-1] - total[begin])
        if kept:
            yield search(pd.concat(kept, ignore_index=True))

    return blocks


def _hashed(size: int):
    """Two independent hashes of every window of strings."""

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                numbers = WORDS.symbols[np.frombuffer(row.string, np.uint8)]
                edge, check = FIRST.windows(numbers, size), SECOND.windows(numbers, size)
                at = np.arange(row.first, row.first + row.count)
                yield pd.DataFrame({"id": row.id, "tag": row.tag, "first": at, "edge": edge.view(np.int64), "check": check.view(np.int64)})

    return windows


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 100, seed: int | None = None) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, spans, kept_sha256.

    A byte of the UTF-8 text is removed if a string of ``size`` bytes covers it that also starts earlier: in a
    document of smaller id, or at an earlier place of the same one. Overlaps count, and strings never reach
    beyond a document. ``spans`` are the removed runs (first, count); kept_sha256 is the hash of the rest.

    Regions of strings (see ``regions``) that occur again as a whole are found by a grouping. The open ones, which
    share a minimizer but differ, are dealt by minimizer: a task sorts shards of them, builds their
    Burrows-Wheeler transforms, and merges these block by block; the repeated intervals of ``size`` bytes say
    which suffixes start earlier elsewhere. Equal strings have one minimizer, so none is split. Minimizers whose
    open regions exceed HOT bytes (a passage that very many documents surround differently) never meet in one
    task: their strings are grouped by two independent hashes, which is exact as well.

    Null counts as empty; a text shorter than ``size`` loses nothing. Rows that repeat id and text are one document
    (each comes out, and they are no repeat of each other); a null id is the smallest; rows of one id with
    different texts are different documents, ordered by a hash of the text. Ids are integers.
    """
    rows = keyed(docs, id_col, text_col)
    found = settled(repeated_regions(regions(rows, _symbols, size, seed or max(1, 3 * size // 10))), "repeats")
    texts = packed(rows)

    opened = found.where("open")
    hot = opened.groupBy("key").agg(F.sum(F.col("count") + size - 1).alias("bytes")).where(F.col("bytes") > HOT).select("key", F.lit(1).alias("hot"))
    spans = opened.join(settled(hot, "hot"), "key", "left").groupBy("id", "tag").agg(
        F.collect_set(F.struct("key", "first", "count", "hot")).alias("spans")
    )
    spans = settled(spans, "open")
    columns = "key long, id long, tag long, first long, count long, string binary"
    cold = texts.join(spans.select("id", "tag", F.filter("spans", lambda s: s["hot"].isNull()).alias("spans")), ["id", "tag"]).mapInPandas(_strings(size), columns)
    later = cold.repartition("key").sortWithinPartitions("key", "id", "tag", "first").mapInPandas(
        _later(size), "id long, tag long, first long, count long"
    )
    again = found.where("again AND NOT earliest").select("id", "tag", "first", "count")
    every = [again, settled(later, "later")]
    warm = spans.select("id", "tag", F.filter("spans", lambda s: s["hot"].isNotNull()).alias("spans")).where(F.size("spans") > 0)
    if not warm.isEmpty():
        windows = texts.join(warm, ["id", "tag"]).mapInPandas(_strings(size), columns).mapInPandas(
            _hashed(size), "id long, tag long, first long, edge long, check long"
        )
        windows = settled(windows, "hot_windows")
        place = F.struct("id", "tag", "first")
        groups = windows.groupBy("edge", "check").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low != high")
        every.append(windows.join(groups, ["edge", "check"]).where(place != F.col("low")).select("id", "tag", "first", F.lit(1).cast("bigint").alias("count")))
    union = every[0]
    for more in every[1:]:
        union = union.unionByName(more)
    out = texts.join(per_document(union), ["id", "tag"], "left").mapInPandas(
        _kept(size), "id long, n_bytes long, n_removed long, n_spans long, spans array<struct<first:long,count:long>>, kept_sha256 string"
    )
    return out.select(unkeyed(id_col), "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256")


def _kept(size: int):
    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for id_, data, spans in zip(batch["id"], batch["packed"], batch["spans"], strict=True):
                text = np.frombuffer(unpack(data), np.uint8)
                gone = cover(spans, size, len(text))
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                runs = [(int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2], strict=True)]
                rows.append((id_, len(text), int(gone.sum()), len(runs), runs, hashlib.sha256(text[~gone].tobytes()).hexdigest()))
            yield pd.DataFrame(rows, columns=["id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"])

    return keep


def op6_repeated_bytes(spark, sf_dir):
    return repeated_bytes(read(spark, sf_dir, "documents")).drop("spans")


QUERIES = {"op6_repeated_bytes": op6_repeated_bytes}
ORACLE: dict[str, str] = {}
