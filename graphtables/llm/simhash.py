"""SimHash near-dedup: fingerprints embedded as segment popcounts, joined in grids, verified exactly."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphtables.llm.common import pick, read, settled
from graphtables.llm.components import components
from graphtables.session import join_side, size_of

#: Fixed value of the fingerprints: the seed of XXH64.
SEED = 42
#: Segments (of two bits each) of an embedding, and the groups into which grids divide them.
SEGMENTS, GROUPS = 32, 7
#: Members of a block of a cell, and bytes of a text that are hashed at once.
BLOCK, PIECE = 8192, 1 << 20
_LOW = 0x5555555555555555  # every second bit
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_KEY = ["grid", "cell", "block"]


def _pieces(data: bytes) -> Iterator[bytes]:
    """``data`` cut at white space, about PIECE bytes each (a longer word stays whole)."""
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + PIECE)
        end = gap.start() if gap else len(data)
        yield data[at:end]
        at = end


def fingerprint(text: str | None, size: int = 3) -> int:
    """The 64 bits (signed) that are set in over half of the hashes of a text's word shingles, repeats included."""
    counts, n, held = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest

    def add(words: list[bytes], width: int) -> int:
        raw, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        spans = zip((ends - lengths)[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
        hashes = np.array([digest(raw[a:b], SEED) for a, b in spans], np.uint64)
        counts[:] += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        return len(hashes)

    for piece in _pieces((text or "").encode("utf-8", "surrogatepass").lower()):
        held += piece.split()  # bytes are lowered at A-Z only, and split at \x20 and \x09-\x0D only
        if len(held) >= size:
            n += add(held, size)
            held = held[len(held) - size + 1 :]
    if not n and held:
        n = add(held, len(held))
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def _fingerprints(size: int):
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, size) for t in batch], dtype="int64")

    return F.pandas_udf(of, "long")


def embedding(f: Column) -> Column:
    """The bits of each segment counted, 0 to 2, in unary: 00, 01, 11. So the Manhattan distance of two embeddings is
    the number of bits in which they differ, and it is at most that of the fingerprints."""
    other = F.shiftrightunsigned(f, 1)
    some, both = f.bitwiseOR(other).bitwiseAND(F.lit(_LOW)), f.bitwiseAND(other).bitwiseAND(F.lit(_LOW))
    return some.bitwiseOR(F.shiftleft(both, 1))


def _differ(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def grids(distance: int, groups: int = GROUPS) -> list[int]:
    """The segments (as signed bit masks) whose counts are the coordinates of each grid.

    The segments are dealt to groups. Of two points within ``distance`` at most so many groups differ, so there is a
    grid over the other groups that has both in one cell.
    """
    if not 0 <= distance < groups <= SEGMENTS:
        raise ValueError("there must be more groups than the distance, and no more than segments")
    of_group = [sum(3 << (2 * s) for s in range(g, SEGMENTS, groups)) for g in range(groups)]
    masks = [sum(chosen) for chosen in combinations(of_group, groups - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _close(signs: np.ndarray, own: np.uint64, distance: int) -> np.ndarray:
    return np.bitwise_count(signs ^ own) <= distance


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The groups of sorted batches by _KEY; at most one group and one batch are held."""
    rest = None
    for batch in batches:
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        keys = batch[_KEY].to_numpy()
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1)] if len(batch) else [0]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.iloc[a:b]
        rest = batch.iloc[cuts[-1] :]
    if rest is not None and len(rest):
        yield rest


def _links_between(distance: int):
    """Of blocks of cells links enough to join what is linked: askers are held against the members of other components."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _cells(batches):
            f, ids = group["f"].to_numpy().view(np.uint64), group["id"].to_numpy()
            comp, home = group["comp"].to_numpy().copy(), group["home"].to_numpy()
            links = []
            for i in np.flatnonzero(group["asks"].to_numpy()):
                others = np.flatnonzero(home & (comp != comp[i]))
                for j in others[_close(f[others], f[i], distance)]:
                    if comp[j] != comp[i]:
                        links.append((ids[i], ids[j]))
                        comp[comp == comp[j]] = comp[i]
            yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return search


def _links(prints: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) that join all fingerprints of ``prints`` (f, id) which chains of links join.

    Cells of the grids with one fingerprint are left. In the others each member is held against the one with the smallest id; then,
    in cells whose members are still of several components, those that are not of the cell's largest
    component are held against all others, in blocks of bounded size. What is left uncompared is in one component.
    """
    spread = prints.select("f", "id", embedding(F.col("f")).alias("e")).select(
        "f", "id", F.posexplode(F.array(*[F.col("e").bitwiseAND(F.lit(m)) for m in grids(distance)])).alias("grid", "cell")
    )
    cells = spread.groupBy("grid", "cell").agg(F.min(F.struct("id", "f")).alias("low"), F.count(F.lit(1)).alias("m")).where("m > 1")
    shared = settled(spread.join(cells.hint("merge"), ["grid", "cell"]), "simhash_cells")
    near = (_differ(embedding(F.col("f")), embedding(F.col("low.f"))) <= distance) & (_differ(F.col("f"), F.col("low.f")) <= distance)
    stars = settled(shared.where("id != low.id").where(near).select(F.col("low.id").alias("a"), F.col("id").alias("b")).distinct(), "simhash_stars")
    joined = components(stars)

    # of two members one is the smallest, so they were compared
    at = shared.where("m > 2").join(joined.hint("merge"), "id", "left").select("grid", "cell", "m", "f", "id", F.coalesce("comp", "id").alias("comp"))
    sizes = at.groupBy("grid", "cell", "comp").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("grid", "cell").agg(F.max(F.struct("n", "comp")).alias("top"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    at = at.join(largest.select("grid", "cell", F.col("top.comp").alias("main")).hint("merge"), ["grid", "cell"])
    n = F.ceil(F.col("m") / BLOCK).cast("int")
    own, asks = F.pmod(F.xxhash64("id"), n).cast("int"), F.col("comp") != F.col("main")
    blocks = F.when(asks, F.sequence(F.lit(0), n - 1)).otherwise(F.array(own))
    dealt = at.select("grid", "cell", F.explode(blocks).alias("block"), own.alias("own"), "f", "id", "comp", asks.alias("asks"))
    dealt = dealt.select(*_KEY, "f", "id", "comp", "asks", (F.col("own") == F.col("block")).alias("home"))
    # the number of partitions is given: rows are small here and the work is not, so few partitions should not be made of many
    n_tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n_tasks, *_KEY).sortWithinPartitions(*_KEY)
    return stars.unionByName(settled(dealt.mapInPandas(_links_between(distance), "a long, b long"), "simhash_links"))


def simhash_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, distance: int = 3) -> DataFrame:
    """One row per document: id, fingerprint (16 hexadecimal digits), component_id.

    Words are runs of anything but white space, A-Z in lower case. A document's shingles are every ``size`` words,
    repeats included, joined by one space; fewer words are one shingle. A bit of the fingerprint is set if it is set in over half of
    the shingles' hashes (XXH64, seed 42). Texts that are null, empty or without words have fingerprint zero, and
    are linked like any other. Documents are linked when their fingerprints differ in at most ``distance`` bits;
    component_id is the smallest id that links reach.

    Texts of any length are hashed whole, in pieces. Rows that repeat give a row each. An id with several texts links
    what they link. A row without an id links nothing and has the component of its fingerprint, null if no other
    row has it. An empty table gives an empty table; other columns are not looked at.

    Fingerprints that are equal are one point, so copies cost nothing. A point is the vector of the bit counts of its 32
    segments; its Manhattan distance is a lower bound of the distance of the fingerprints. Points meet in the cells of grids
    (see :func:`grids`), and pairs that meet are compared exactly.
    """
    rows = pick(docs, id=id_col, text=text_col)
    rows = settled(rows.select("id", _fingerprints(size)("text").alias("f")), "fingerprints")
    prints = settled(rows.where("id IS NOT NULL").groupBy("f").agg(F.min("id").alias("id")), "prints")
    links = _links(prints, distance)
    torn = rows.where("id IS NOT NULL").groupBy("id").agg(F.min("f").alias("f"), F.max("f").alias("g")).where("f != g").select("id")
    if not torn.isEmpty():
        several = rows.join(torn.hint("merge"), "id").select(F.col("id").alias("b"), "f").distinct()
        links = links.unionByName(several.join(prints.withColumnRenamed("id", "a").hint("merge"), "f").select("a", "b"))
    joined = components(links)
    side = prints.join(joined.hint("merge"), "id", "left").select("f", F.coalesce("comp", "id").alias("component_id"))
    side = settled(side, "simhash_components")
    labelled = rows.join(join_side(side, size_of(side)), "f", "left")
    text = F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint")
    return labelled.select(F.col("id").alias(id_col), text, "component_id")


def op12_simhash(spark, sf_dir):
    return simhash_duplicates(read(spark, sf_dir, "documents"), size=3)


QUERIES = {"op12_simhash": op12_simhash}
ORACLE: dict[str, str] = {}
