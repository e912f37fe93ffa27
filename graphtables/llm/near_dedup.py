"""MinHash near-dedup: banded candidates, sequential Bayesian pruning, exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphtables.llm.common import pick, read, settled
from graphtables.llm.components import components
from graphtables.llm.regions import squeeze, unpack
from graphtables.llm.wordhash import SPACED, mix, to_bytes, word_hashes, word_spans

#: Bands and rows of a band: a pair of similarity 0.8 is missed with probability (1 - 0.8**5)**40 = 1.3e-7.
BANDS, ROWS = 40, 5
#: Hashes that are compared at once, and the probability at which a similar pair may be pruned.
BATCH, MISS = 40, 1e-7
#: Members of a bucket that one task compares with each other; larger buckets are dealt out in blocks.
BLOCK = 4000
#: What a pair of blocks of a bucket is known by.
GROUP = ["who", "low", "m", "i", "j"]

_FACTORS = np.random.default_rng(809).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, size: int) -> np.ndarray:
    """The set of a text's word shingles as sorted 64-bit hashes; fewer words are one shingle, none is empty."""
    data = to_bytes(text, lower=True)
    h = word_hashes(data, *word_spans(data, SPACED))
    if not len(h):
        return h
    n = min(size, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k])
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    """The least value of every hash function over a set."""
    out = np.full(len(_FACTORS), 2**32 - 1, np.uint64)
    for i in range(0, len(found), 1024):
        values = _FACTORS[:, None] * found[None, i : i + 1024]
        np.minimum(out, (values >> np.uint64(32)).min(axis=1), out=out)
    return out


def key_of(found: np.ndarray) -> bytes:
    """A 128-bit hash of a set."""
    return np.array([mix(found).sum(dtype=np.uint64), mix(found ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64)]).tobytes()


def _banded(size: int):
    """For each text the size of its set, a 128-bit hash of it, a hash per band, and one byte of each hash."""

    def band(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for text in batch:
                found = shingles(text, size)
                s = signature(found)
                bands = np.arange(BANDS, dtype=np.uint64)
                for column in s.reshape(BANDS, ROWS).T:
                    bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + column)
                sign = (s & np.uint64(255)).astype(np.uint8).tobytes()
                rows.append((len(found), key_of(found), bands.view(np.int64) if len(found) else [], sign))
            yield pd.DataFrame(rows, columns=["n", "key", "bands", "sign"])

    return F.pandas_udf(band, "n long, key binary, bands array<long>, sign binary")


def _sets(size: int):
    """For each packed text its set, as bytes, and the hash of that."""

    def sets(packs: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in packs:
            found = [shingles(unpack(p).decode("utf-8", "surrogatepass"), size) for p in batch]
            yield pd.DataFrame({"found": [f.tobytes() for f in found], "key": [key_of(f) for f in found]})

    return F.pandas_udf(sets, "found binary, key binary")


def needed(similarity: float, miss: float = MISS, batch: int = BATCH, total: int = BANDS * ROWS) -> list[tuple[int, int]]:
    """After so many compared hashes, so many must agree, or the pair is pruned.

    With a uniform prior of the similarity s, and hashes that agree with probability s + (1 - s) / 256 as
    one byte is compared, the posterior probability of s >= ``similarity`` is below ``miss`` for fewer.
    """
    s = (np.arange(4000) + 0.5) / 4000
    agree = s + (1 - s) / 256
    out = []
    for n in range(batch, total + 1, batch):
        least = 0
        for m in range(n + 1):
            log = m * np.log(agree) + (n - m) * np.log1p(-agree)
            p = np.exp(log - log.max())
            if p[s >= similarity].sum() / p.sum() >= miss:
                least = m
                break
        out.append((n, least))
    return out


class Verifier:
    """Whether two sets reach the similarity: sizes, then batches of the signature, then the whole sets."""

    def __init__(self, similarity: float):
        self.percent = round(100 * similarity)
        self.needed = needed(similarity)

    def open(self, sign: np.ndarray, signs: np.ndarray, size: int, sizes: np.ndarray) -> np.ndarray:
        """Numbers of the ``signs`` that may be similar to ``sign``."""
        at = np.flatnonzero(100 * np.minimum(size, sizes) >= self.percent * np.maximum(size, sizes))
        agreed, before = np.zeros(len(at), np.int64), 0
        for n, least in self.needed:
            agreed += (signs[at, before:n] == sign[before:n]).sum(axis=1)
            keep = agreed >= least
            at, agreed, before = at[keep], agreed[keep], n
        return at

    def similar(self, a: np.ndarray, b: np.ndarray) -> bool:
        """100 * intersection >= percent * union, on the whole sets."""
        if len(a) > len(b):
            a, b = b, a
        at = np.minimum(np.searchsorted(b, a), len(b) - 1)
        common = int((b[at] == a).sum())
        return 100 * common >= self.percent * (len(a) + len(b) - common)


def _open_pairs(similarity: float):
    """Of rows (a, b, with size and signature of each) the pairs that sizes and signatures leave open."""

    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        check = Verifier(similarity)
        for batch in batches:
            signs = [np.frombuffer(s, np.uint8)[None] for s in batch["sign_b"]]
            sizes = batch["n_b"].to_numpy()
            still = [
                len(check.open(np.frombuffer(sign, np.uint8), signs[i], n, sizes[i : i + 1])) > 0
                for i, (sign, n) in enumerate(zip(batch["sign_a"], batch["n_a"], strict=True))
            ]
            yield batch.loc[still, ["a", "b"]]

    return prune


def _linked_pairs(similarity: float):
    """Of rows (a, b, with the set of each) the pairs that are linked."""

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        check = Verifier(similarity)
        for batch in batches:
            linked = [check.similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in zip(batch["found_a"], batch["found_b"], strict=True)]
            yield batch.loc[linked, ["a", "b"]]

    return verify


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The groups of sorted batches, by GROUP; what is held is one batch and one group, which is a pair of blocks."""
    rest = None
    for batch in batches:
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        keys = batch[GROUP].to_numpy()
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.iloc[a:b]
        rest = batch.iloc[cuts[-1] :]
    if rest is not None and len(rest):
        yield rest


def _others(group: pd.DataFrame, check: Verifier):
    """Signatures, and a function that gives the open partners of a member: of other components, in the other block."""
    side, n = group["side"].to_numpy(), group["n"].to_numpy()
    signs = np.frombuffer(b"".join(group["sign"]), np.uint8).reshape(len(group), -1)
    two = side.max() > side.min()
    asks = np.flatnonzero(side == side.min())

    def partners(i: int, comp: np.ndarray) -> np.ndarray:
        others = np.flatnonzero((comp != comp[i]) & ((side != side[i]) if two else (np.arange(len(group)) > i)))
        return others[check.open(signs[i], signs[others], n[i], n[others])]

    return asks, partners


def _open_members(similarity: float):
    """Members of pairs of blocks that have an open partner of another component."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        check = Verifier(similarity)
        for group in _groups(batches):
            asks, partners = _others(group, check)
            comp, live = group["comp"].to_numpy(), np.zeros(len(group), bool)
            for i in asks:
                found = partners(i, comp)
                live[found] = True
                live[i] |= len(found) > 0
            if live.any():
                yield group[live]

    return search


def _links_in_blocks(similarity: float):
    """Links enough to join all members that are linked and were not joined: what a link joins is one component then."""

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        check = Verifier(similarity)
        for group in _groups(batches):
            asks, partners = _others(group, check)
            ids, comp = group["id"].to_numpy(), group["comp"].to_numpy().copy()
            sets = [np.frombuffer(f, np.uint64) for f in group["found"]]
            links = []
            for i in asks:
                for j in partners(i, comp):
                    if comp[j] != comp[i] and check.similar(sets[i], sets[j]):
                        links.append((ids[i], ids[j]))
                        comp[comp == comp[j]] = comp[i]
            yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return verify


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, similarity: float = 0.8
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Words are runs of anything but white space, A-Z in lower case; a document's set is its distinct shingles
    of ``size`` words, all its words as one if they are fewer. Documents are linked when the Jaccard similarity of
    their sets is at least ``similarity`` (in whole percent); component_id is the smallest id that links reach;
    that document is kept. Texts that are null or without words have no shingles, are linked with
    nothing and kept. Ids are integers; rows of one id are one document with the set of one of them (the one with
    the smallest hash); a row without an id is kept as its own component, null. An empty table gives an empty table.

    Equal sets are one class, represented by its smallest id, before anything is compared. Representatives that
    share a band are candidates. First every member of a bucket is compared with the bucket's smallest id;
    then, in buckets that still hold several components, the members of different components with each
    other (in blocks of bounded size), as far as links found meanwhile have not joined them. Nothing
    is capped: pairs that stay uncompared are in one component already.
    """
    rows = pick(docs, id=id_col, text=text_col)
    banded = settled(rows.select("id", _banded(size)("text").alias("f")).select("id", "f.*"), "bands")
    named = banded.where("id IS NOT NULL").groupBy("id").agg(F.min(F.struct("key", "n")).alias("f")).select("id", "f.key", "f.n")
    named = settled(named, "sets")
    reps = settled(named.where("n > 0").groupBy("key").agg(F.min("id").alias("rep")), "classes")
    stands = reps.select("key", F.col("rep").alias("id")).hint("merge")
    members = settled(banded.where("n > 0").join(stands, ["id", "key"]).dropDuplicates(["id"]).select("id", "key", "n", "sign", "bands"), "members")

    spread = members.select("id", F.explode("bands").alias("band"))
    buckets = spread.groupBy("band").agg(
        F.min("id").alias("low"), F.count(F.lit(1)).alias("m"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("who")
    ).where("m > 1")
    in_buckets = settled(spread.join(buckets.hint("merge"), "band").drop("band").distinct(), "buckets")

    stars = in_buckets.where("id != low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()
    opened = _with(_with(stars, members, "b", "n", "sign"), members, "a", "n", "sign").mapInPandas(_open_pairs(similarity), "a long, b long")
    opened = settled(opened, "open_pairs")
    sets = _sets_of(rows, members, opened.select(F.explode(F.array("a", "b")).alias("id")), size)
    links = _with(_with(opened, sets, "b", "found"), sets, "a", "found").mapInPandas(_linked_pairs(similarity), "a long, b long")
    links = settled(links, "links")
    joined = components(links)

    # buckets with members of several components, each set of members once
    at = in_buckets.where("m > 2").join(joined, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    several = at.groupBy("who", "low", "m").agg(F.min("comp").alias("c"), F.max("comp").alias("d")).where("c != d").select("who", "low", "m")
    dealt = _blocks(at.join(several, ["who", "low", "m"])).join(members.select("id", "n", "sign").hint("merge"), "id")
    dealt = dealt.select(*GROUP, "side", "id", "comp", "n", "sign")
    columns = "who decimal(38,0), low long, m long, i long, j long, side int, id long, comp long, n long, sign binary"
    live = settled(_by_group(dealt).mapInPandas(_open_members(similarity), columns), "open_members")
    if not live.isEmpty():
        found = _sets_of(rows, members, live.select("id"), size)
        more = _by_group(live.join(found, "id").select(*dealt.columns, "found")).mapInPandas(_links_in_blocks(similarity), "a long, b long")
        joined = components(links.union(settled(more, "more_links")))

    by_class = reps.join(joined.withColumnRenamed("id", "rep"), "rep", "left").select("key", F.coalesce("comp", "rep").alias("comp"))
    labelled = named.join(by_class, "key", "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("comp", "id").alias("component_id"))
    unnamed = banded.where("id IS NULL").select("id", F.col("n").alias("n_shingles"), F.lit(None).cast("bigint").alias("component_id"))
    out = labelled.union(unnamed)
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _with(pairs: DataFrame, table: DataFrame, end: str, *names: str) -> DataFrame:
    """``pairs`` with columns of one of their ends, whose rows in ``table`` are unique."""
    side = table.select(F.col("id").alias(end), *[F.col(n).alias(f"{n}_{end}") for n in names])
    return pairs.join(side.hint("merge"), end)


def _sets_of(rows: DataFrame, members: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """id, found: the whole sets of some documents. Their texts are the only ones that are read again as texts."""
    wanted = ids.distinct().join(members.select("id", F.col("key").alias("own")), "id").hint("merge")
    texts = rows.where("id IS NOT NULL").select("id", squeeze()("text").alias("packed")).join(wanted, "id")
    found = texts.select("id", "own", _sets(size)("packed").alias("f")).where("f.key = own").select("id", "f.found")
    return settled(found.dropDuplicates(["id"]), "sets")


def _by_group(dealt: DataFrame) -> DataFrame:
    return dealt.repartition(*GROUP).sortWithinPartitions(*GROUP)


def _blocks(at: DataFrame) -> DataFrame:
    """Members of each bucket in pairs of blocks (i <= j): every two members meet in a pair of blocks.

    A bucket of up to BLOCK members is one block. Blocks are dealt by the hash of the id, so their size is
    bounded by what their number says.
    """
    n = F.ceil(F.col("m") / BLOCK).cast("bigint")
    own = F.pmod(F.xxhash64("id"), n)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    dealt = at.select("who", "low", "m", "id", "comp", own.alias("own"), other.alias("other"))
    return dealt.select(
        "who", "low", "m", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "id", "comp",
    )


def op8_near_dedup(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"), size=2)


QUERIES = {"op8_near_dedup": op8_near_dedup}
ORACLE: dict[str, str] = {}
