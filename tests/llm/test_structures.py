"""Merkle manifest, SimHash classes and conversation repair against plain versions and SQL."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from graphtables.llm import conversations, merkle, simhash
from graphtables.llm.components import components
from tests.llm import plain


# --- manifest ---------------------------------------------------------------------------------


def proofs(df):
    out = merkle.manifest(df, merkle.leaf_of(df["doc_id"], df["source"], df["text"]), source="source", order="doc_id")
    leaf = merkle.hex_of(F.col("leaf"))
    rows = out.select("source", "doc_id", leaf, merkle.hex_of(F.col("subroot")), merkle.hex_of(F.col("root")),
                      merkle.siblings(F.col("segment")), merkle.folded(F.col("leaf"), F.col("segment"))).collect()
    return sorted(map(tuple, rows), key=repr)


def plain_proofs(rows):
    """The same, level by level over lists."""

    def tree(nodes):
        """Root of a list of digests, and the siblings of each leaf."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, p in enumerate(at):
                paths[k] += [nodes[q] for q in range(p // 3 * 3, min(p // 3 * 3 + 3, len(nodes))) if q != p]
            at = [p // 3 for p in at]
            nodes = [plain.sha("".join(nodes[q : q + 3])) for q in range(0, len(nodes), 3)]
        return nodes[0], paths

    def leaf(*values):
        return plain.sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    sources = {}
    for doc_id, text, source in rows:
        sources.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf(doc_id, source, text), doc_id))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in order}
    root, above = tree([trees[s][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for (_, _, own, doc_id), path in zip(sorted(sources[s], key=lambda x: x[:3]), trees[s][1], strict=True):
            out.append((s, doc_id, own, trees[s][0], root, plain.sha("".join(path + above[k])), root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [(1,), (2,), (3, 1), (4, 28, 1, 1), (82, 9, 10, 27, 1, 2, 3)])
def test_proofs_of_trees_of_many_heights(spark, sizes):
    rows = [(100 * k + i, f"t{i}\n", f"s{k}") for k, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert proofs(df) == plain_proofs(rows)


def test_proofs_of_odd_rows(table, odd_rows):
    # other columns have names that the operator uses itself
    df = table(odd_rows).withColumns({n: F.lit(1) for n in ("tree", "place", "level", "digest", "segment", "pos")})
    assert proofs(df) == plain_proofs([(i, t, s) for i, t, _, s in odd_rows])
    assert proofs(df.where("id = 'none'")) == []


def test_only_tampered_text_changes_the_root(spark, sf_dir):
    rows = merkle.op11_merkle_manifest(spark, sf_dir).collect()
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    for r in rows:
        bent = zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and "\n" in (text[r["doc_id"]] or "")
        assert r["verified"] != bent


# --- SimHash ----------------------------------------------------------------------------------


def plain_print(text, size):
    import xxhash

    words = plain.spaced((text or "").translate(plain.UPPER))
    n = min(size, len(words))
    found = [xxhash.xxh64_intdigest(" ".join(words[k : k + n]).encode(), 42) for k in range(len(words) - n + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def joined(prints, distance=3):
    """Node -> smallest node reachable, of nodes with lists of fingerprints."""
    comp = {i: i for i in prints}
    moved = True
    while moved:
        moved = False
        for a in comp:
            for b in comp:
                near = any((x ^ y).bit_count() <= distance for x in prints[a] for y in prints[b])
                if near and comp[a] != comp[b]:
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    moved = True
    return comp


@pytest.mark.parametrize("piece", [1 << 20, 40])
def test_fingerprints(noisy, monkeypatch, piece):
    monkeypatch.setattr(simhash, "PIECE", piece)
    for _, text in [*noisy, (0, None), (0, " \n"), (0, "\x0bOne\x1cword\x85 "), (0, "ÀB c" + "x" * 90)]:
        assert simhash.fingerprint(text, 3) % 2**64 == plain_print(text, 3)


def test_simhash_classes(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    own = {r["doc_id"]: [plain_print(r["text"], 3)] for r in rows}
    comp = joined(own)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op12_simhash(spark, sf_dir).collect()}
    assert got == {i: (f"{own[i][0]:016x}", comp[i]) for i in own}


def test_simhash_odd_rows(table, odd_rows):
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.simhash_duplicates(table(odd_rows)).collect()), key=repr)
    own = {}
    for i, text, _, _ in odd_rows:
        if i is not None:
            own.setdefault(i, []).append(plain_print(text, 5))
    comp = joined(own)
    by_print = {}
    for i in sorted(own):
        for f in own[i]:
            by_print.setdefault(f, comp[i])
    want = [(i, f"{plain_print(t, 5):016x}", by_print.get(plain_print(t, 5))) for i, t, _, _ in odd_rows]
    assert got == sorted(want, key=repr)
    assert simhash.simhash_duplicates(table([])).collect() == []


def test_an_id_with_two_texts_links_them(table):
    rows = [(5, "one two three four five six", None, None), (5, "an other text without common words", None, None), (3, "one two three four five six", None, None)]
    got = simhash.simhash_duplicates(table([*rows, (4, rows[1][1], None, None)])).collect()
    assert {r["component_id"] for r in got} == {3}


def test_clusters_of_prints_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 20)
    draw, prints = random.Random(3), {}
    for _ in range(3):
        centre = draw.getrandbits(64)
        for _ in range(90):
            f = centre
            for b in draw.sample(range(64), draw.randint(0, 9)):
                f ^= 1 << b
            prints.setdefault(f, len(prints))
    rows = [(f - (1 << 64) if f >> 63 else f, i) for f, i in prints.items()]
    links = simhash._links(spark.createDataFrame(rows, "f long, id long"), 3)
    got = {r["id"]: r["comp"] for r in components(links).collect()}
    want = joined({i: [f] for f, i in prints.items()})
    assert {i: got.get(i, i) for i in want} == want


def test_grids_hold_every_close_pair():
    draw = random.Random(1)
    masks = [m % 2**64 for m in simhash.grids(3)]
    for _ in range(500):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), 3):
            b ^= 1 << bit
        counts = [[(x >> 2 * s & 3).bit_count() for s in range(32)] for x in (a, b)]
        assert any(all(p == q for s, (p, q) in enumerate(zip(*counts, strict=True)) if m >> 2 * s & 3) for m in masks)


# --- conversations ----------------------------------------------------------------------------

FOLLOWS = {"s": ((0,), 1), "u": ((0, 1, 3), 2), "a": ((2,), 3)}


def every_repair(rows):
    """The cheapest and least of all sequences of edits of (initial, must go, truncated): cost, edits, roles."""
    best = None

    def go(i, state, cost, edits, roles):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        for gap in ("", "u", "a", "ua", "au"):
            at, fits = state, True
            for x in gap:
                fits = fits and at in FOLLOWS[x][0]
                at = FOLLOWS[x][1]
            if not fits:
                continue
            c, e, r = cost + 2 * len(gap), edits + "I" * len(gap), roles + gap
            if i == len(rows):
                if at in (0, 3) and (best is None or (c, e) < best[:2]):
                    best = (c, e, r)
                continue
            own, must_go, truncated = rows[i]
            go(i + 1, at, c + 3, e + "D", r)
            for x in "" if must_go else "sua":
                if at in FOLLOWS[x][0]:
                    if x == own:
                        go(i + 1, FOLLOWS[x][1], c + truncated, e + "K", r + x)
                    if x != "s":
                        go(i + 1, FOLLOWS[x][1], c + 2 + truncated, e + "R", r + x)

    go(0, 0, 0, "", "")
    return best


def searched(rows):
    search, steps, most = conversations.Repair(), [], 0
    for k, row in enumerate(rows):
        steps += search.add(k, *row)
        most = max(most, k + 1 - len(steps))
    steps += search.end()
    return (steps[-1].cost if steps else 0, "".join(s.edit for s in steps), "".join(s.initial for s in steps)), most


def drawn_rows(draw, n):
    return [(draw.choice("uuaasut"), draw.random() < 0.2, int(draw.random() < 0.3)) for _ in range(n)]


def test_repairs_are_the_cheapest_and_least():
    draw = random.Random(5)
    for _ in range(1500):
        rows = drawn_rows(draw, draw.randint(0, 5))
        assert searched(rows)[0] == every_repair(rows)


def test_edits_come_out_before_the_end():
    _, waiting = searched(drawn_rows(random.Random(6), 20_000))
    assert waiting < 200
    # two ways that never meet, of one cost: all is held, and compared
    assert searched([("u", False, 0)] * 400)[0][:2] == (400, "KR" * 200)


def test_conversations_of_odd_rows(spark):
    columns = "conv_id long, turn long, role string, text string, edit string, place long, key string, c long, first long"
    big = 2**60 + 1
    rows = [
        (big, 0, "user", "Hello."), (big, 1, "assistant", "Yes. \n"), (None, None, None, None), (None, 2, "user", "Hm"), (None, 2, "user", "Hm"),
        (1, None, "user", "First."), (1, 5, "user", "First."), (1, 5, "assistant", "Long " * 50_000 + "!"), (2, 0, "system", "s.\u0085"), (3, 0, "tool", "\u0085"),
    ]
    df = spark.createDataFrame([(*r, "x", 1, "k", 2, 3) for r in rows], columns)
    edits = {}
    for r in sorted(conversations.repair(df).collect(), key=lambda r: r["place"]):
        edits.setdefault(r["conv_id"], []).append((r["edit"], r["fault"], r["role"]))
    assert edits == {
        big: [("K", None, "user"), ("K", None, "assistant")],
        None: [("D", "blank", None), ("D", "truncated", None), ("D", "duplicate", None)],
        1: [("K", None, "user"), ("K", None, "assistant"), ("D", "duplicate", None)],
        2: [("D", "truncated", None)],
        3: [("D", "truncated", None)],
    }
    assert conversations.repair(df.where("conv_id = 77")).collect() == []


def test_digests_of_conversations_without_rows(spark, tmp_path):
    gone = next(i for i in range(999) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    one = next(i for i in range(999) if zlib.crc32(f"{i}:0".encode()) % 20 > 4)
    df = spark.createDataFrame([(gone, 0, "user", "Hi."), (one, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.op13_conversation_repair(spark, str(tmp_path)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", sha("")), one: (0, 0, 0, 0, 0, 2, "KI", sha("user:Hi.\nassistant:"))}


# --- language ID --------------------------------------------------------------------------------


def test_every_language_is_learned(spark):
    from graphtables.llm import langid

    rows = [(100 * k + i, f"{chr(97 + k) * 3} {chr(98 + k) * 2} " * 9 + str(i), f"zz{k:02d}") for k in range(20) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.language_id(df, max_rows=40).collect()}
    assert {got[i] for i, _, _ in rows} == {lang for _, _, lang in rows}
