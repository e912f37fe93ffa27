"""Exact, near and passage duplicates against plain versions."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from graphtables.llm import near_dedup, passages, registry, suffixes
from graphtables.llm.components import components
from graphtables.llm.exact_dedup import _by_text, exact_dedup
from tests.llm import plain


def rows(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def docs_of(table, pairs):
    return table([(i, t, "en", "a") for i, t in pairs])


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_against_sql(spark, sf_dir, duck, name):
    df = registry.queries()[name](spark, sf_dir)
    cursor = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(rows(df, *names), key=repr) == sorted(cursor.fetchall(), key=repr)


def test_exact_odd_rows(table, odd_rows):
    out = exact_dedup(table(odd_rows))
    got = Counter(rows(out, "doc_id", "keep_id", "group_size", "kept"))
    # null, empty; the repeated row 5 is one document
    assert got[(1, 1, 3, True)] == 1 and got[(2, 1, 3, False)] == 1 and got[(None, 1, 3, False)] == 1
    assert got[(4, 4, 2, True)] == 1 and got[(5, 4, 2, False)] == 1
    assert got[(None, None, 1, True)] == 1
    assert out.count() == len(odd_rows) - 1
    assert exact_dedup(table([])).collect() == []


def test_exact_collisions_are_told_apart(spark):
    hashed = spark.createDataFrame([(1, b"h", "a"), (2, b"h", "b"), (3, b"h", "a")], "id long, h binary, text string")
    got = sorted(rows(_by_text(hashed, F.min), "id", "keep_id", "group_size"))
    assert got == [(1, 1, 2), (2, 2, 1), (3, 1, 2)]


@pytest.mark.parametrize("size", [1, 2, 5])
def test_near_against_plain(table, noisy, size):
    out = near_dedup.near_duplicates(docs_of(table, noisy), size=size)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()}
    assert got == plain.near(noisy, size)


def test_near_large_buckets_are_compared_in_blocks(table, monkeypatch):
    """A chain of near copies: the first is linked with few, and blocks are tiny."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    words = [f"w{k}" for k in range(60)]
    chain = []
    for i in range(24):
        words = [f"n{i}_{k}" if (k + 2 * i) % 60 < 2 else w for k, w in enumerate(words)]
        chain.append((i, " ".join(words)))
    out = near_dedup.near_duplicates(docs_of(table, chain), size=1)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()} == plain.near(chain, 1)


def test_near_odd_rows(table, odd_rows):
    out = near_dedup.near_duplicates(table(odd_rows), size=2)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out.where("doc_id IS NOT NULL").collect()}
    assert got[1] == (0, 1, True) and got[3] == (0, 3, True) and got[4][1:] == (4, True) and got[5][1:] == (4, False)
    assert got[6][1] == 6 and got[7][1] == 6 and got[9] == (1, 9, True)
    assert near_dedup.near_duplicates(table([])).collect() == []


def test_pruning_keeps_similar_pairs():
    check = near_dedup.Verifier(0.8)
    assert all(least <= n * 0.8 for n, least in check.needed)
    assert [n for n, _ in check.needed][-1] == near_dedup.BANDS * near_dedup.ROWS


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (102, 101), (7, 7)], "a long, b long")
    got = dict(rows(components(edges), "id", "comp"))
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100)}


@pytest.mark.parametrize("hot", [1 << 22, 300])
def test_bytes_against_plain(table, noisy, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    out = suffixes.repeated_bytes(docs_of(table, noisy), size=20)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()}
    assert got == plain.later_bytes(noisy, 20)


def test_bytes_of_query_size(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = registry.queries()["op6_repeated_bytes"](spark, sf_dir)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()}
    assert got == plain.later_bytes(rows(docs, "doc_id", "text"), 100)


def test_merged_shards_give_the_order_of_all(monkeypatch):
    """Intervals of the merged order are the classes of equal windows, in their order, for any cut into shards."""
    import numpy as np

    strings = [b"abababababab", b"xabababab", b"aaaaaaaaaaaaa", b"ab", b"zzabababzz"]
    counts = np.array([max(0, len(s) - 5) for s in strings])
    for shard in (8, 20, 1 << 16):
        monkeypatch.setattr(suffixes, "SHARD", shard)
        string, off, interval = suffixes.repeated_windows(strings, counts, 6)
        windows = Counter(strings[i][p : p + 6] for i in range(len(strings)) for p in range(counts[i]))
        assert Counter(strings[i][p : p + 6] for i, p in zip(string, off)) == Counter({w: n for w, n in windows.items() if n > 1})
        pairs = sorted({(int(k), strings[i][p : p + 6]) for i, p, k in zip(string, off, interval)})
        assert [w for _, w in pairs] == sorted(w for w, n in windows.items() if n > 1)


@pytest.mark.parametrize("size", [3, 9])
def test_passages_against_plain(table, noisy, size):
    out = passages.repeated_passages(docs_of(table, noisy), size=size)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out.collect()}
    assert got == plain.repeated_words(noisy, size)


def test_paths_join_what_does_not_branch(spark):
    """1 -> 2 -> 3 -> 4 is one path; 10 and 11 both follow 9, so no path goes through."""
    rows_ = [(1, 1, 101, 102), (2, 1, 102, 103), (3, 1, 103, 104), (4, 1, 104, 105), (9, 1, 201, 202), (10, 1, 202, 203), (11, 1, 202, 204)]
    edges = spark.createDataFrame(rows_, "edge long, check long, source long, target long")
    got = {r.edge: (r.path, r.step) for r in passages.compact(edges).collect()}
    assert got == {1: (1, 0), 2: (1, 1), 3: (1, 2), 4: (1, 3), 9: (9, 0), 10: (10, 0), 11: (11, 0)}


@pytest.mark.parametrize("find", [lambda d: suffixes.repeated_bytes(d, size=20), lambda d: passages.repeated_passages(d, size=3)])
def test_repeats_odd_rows(table, odd_rows, find):
    got = find(table(odd_rows))
    removed = Counter(rows(got, "doc_id", "n_removed"))
    assert got.count() == len(odd_rows)  # repeated rows come out twice, and are no repeats of each other
    assert removed[(1, 0)] == 1 and removed[(2, 0)] == 1 and removed[(5, 0)] == 2 and removed[(None, 0)] == 2
    assert {i for i, n in removed if n} <= {6, 7}
    assert find(table([])).collect() == []
