"""Merkle manifest of a dataset: a tree per source, a tree over the sources, and a proof for every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphtables.llm.common import crc32_sql, crc_of_id, read, settled
from graphtables.operators.order import numbered
from graphtables.session import join_side, size_of

#: Nodes of a run, and levels of a tree that are made of one gathering of nodes.
WIDTH = 3
LEVELS = 3
#: The tree over the sources has this number; sources are 0, 1, 2, ... by name.
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_SEGMENT = "array<struct<before: binary, after: binary>>"


def leaf_of(*values: Column) -> Column:
    """sha256 (as bytes) of values, each ``-`` if null, else its length in UTF-8 bytes, a colon, and itself."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hex_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _node(digests: Column) -> Column:
    """The digest (as bytes) of a node over an array of digests."""
    return F.unhex(F.sha2(F.concat_ws("", F.transform(digests, hex_of)), 256))


def _joined(digests: Column) -> Column:
    """The digests of an array one after another."""
    return F.aggregate(digests, F.lit(b""), lambda a, d: F.concat(a, d))


def _runs(digests: Column) -> Column:
    """The nodes over an array of neighbours, which is not empty."""
    numbers = F.sequence(F.lit(0), F.ceil(F.size(digests) / WIDTH).cast("int") - 1)
    return F.transform(numbers, lambda j: _node(F.slice(digests, j * WIDTH + 1, WIDTH)))


def _levels(nodes: DataFrame, base: int) -> DataFrame:
    """LEVELS levels above ``base`` of all trees at once: tree, height, level, place, digest, before, after.

    ``nodes`` has the level ``base``: tree, height (of that tree), place, digest. Runs of one level lie
    within runs of the next, so WIDTH ** LEVELS neighbours, which is the bound of what is gathered, give the levels above
    them and every node's neighbours in its run. The highest level that comes out has no neighbours yet.
    """
    span = WIDTH**LEVELS
    own = F.transform(F.array_sort(F.collect_list(F.struct("place", "digest"))), lambda x: x["digest"])
    group = nodes.groupBy("tree", "height", F.floor(F.col("place") / span).alias("at")).agg(own.alias("d0"))
    for k in range(1, LEVELS + 1):
        below = F.col(f"d{k - 1}")
        exists = (F.col("height") >= base + k) & (F.size(below) > 0)
        group = group.withColumn(f"d{k}", F.when(exists, _runs(below)).otherwise(F.array().cast("array<binary>")))

    def entries(k: int) -> Column:
        digests = F.col(f"d{k}")

        def entry(digest, i):
            first = i - i % WIDTH
            before, after = F.slice(digests, first + 1, i % WIDTH), F.slice(digests, i + 2, first + WIDTH - 1 - i)
            level, place = F.lit(base + k).alias("level"), (F.col("at") * WIDTH ** (LEVELS - k) + i).alias("place")
            none = F.lit(None).cast("binary")
            sides = (none, none) if k == LEVELS else (_joined(before), _joined(after))
            return F.struct(level, place, digest.alias("digest"), sides[0].alias("before"), sides[1].alias("after"))

        return F.transform(digests, entry)

    return group.select("tree", "height", F.inline(F.concat(*[entries(k) for k in range(LEVELS + 1)])))


def _tree(leaves: DataFrame, height: int) -> list[DataFrame]:
    """All nodes of all trees: tables with tree, height, level, place, digest, and the neighbours before and after.

    ``height`` is the greatest height. A tree ends in one node, at its own height, which has no neighbours.
    """
    tables, base, nodes = [], 0, leaves
    while True:
        made = settled(_levels(nodes, base), "merkle_levels")
        ends = base + LEVELS > height
        tables.append(made if ends else made.where(F.col("level") < base + LEVELS))
        if ends:
            return tables
        base += LEVELS
        nodes = made.where(F.col("level") == base).select("tree", "height", "place", "digest")


def _height(n: Column) -> Column:
    """Levels above ``n`` leaves until one node is left."""
    steps = F.sequence(F.lit(1), F.lit(40))  # 3 ** 40 is more than a bigint holds
    return F.aggregate(steps, F.struct(n.alias("n"), F.lit(0).alias("h")), lambda a, _: F.struct(
        F.ceil(a["n"] / WIDTH).cast("bigint").alias("n"), (a["h"] + (a["n"] > 1).cast("int")).alias("h")), lambda a: a["h"])


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _pointed(nodes: DataFrame, top_height: int) -> DataFrame:
    """Every node with its name (t, l, p), the name of its parent (ut, ul, up; null at the root) and its segment.

    What ends the tree of a source is a leaf of the tree over the sources and is named so.
    """
    ends = (F.col("tree") != TOP) & (F.col("level") == F.col("height"))
    named = nodes.select(
        F.when(ends, F.lit(TOP)).otherwise(F.col("tree")).alias("t"), F.when(ends, 0).otherwise(F.col("level")).alias("l"),
        F.when(ends, F.col("tree")).otherwise(F.col("place")).alias("p"),
        "tree", "level", "height", "place", "digest", F.col("before"), F.col("after"),
    )
    above_source = (F.col("t") != TOP) & (F.col("l") + 1 == F.col("height"))
    is_root = (F.col("t") == TOP) & (F.col("l") == top_height)
    return named.select(
        "t", "l", "p", "tree", "level", "place", "digest",
        F.when(~is_root, F.when(above_source, F.lit(TOP)).otherwise(F.col("t"))).alias("ut"),
        F.when(~is_root, F.when(above_source, 0).otherwise(F.col("l") + 1)).alias("ul"),
        F.when(~is_root, F.when(above_source, F.col("tree")).otherwise(F.floor(F.col("p") / WIDTH))).alias("up"),
        F.when(~is_root, F.array(F.struct(F.coalesce("before", F.lit(b"")).alias("before"), F.coalesce("after", F.lit(b"")).alias("after"))))
        .otherwise(F.array()).cast(_SEGMENT).alias("segment"),
    )


def _jumped(rows: DataFrame, targets: DataFrame, size: int) -> DataFrame:
    """``rows`` pointing where their targets point, with the segments of both; those at the root stay as they are."""
    far = targets.select(
        F.col("t").alias("ut"), F.col("l").alias("ul"), F.col("p").alias("up"), F.col("ut").alias("ft"), F.col("ul").alias("fl"),
        F.col("up").alias("fp"), F.col("segment").alias("more"), F.lit(True).alias("met"),
    )
    joined = rows.join(join_side(far, size), ["ut", "ul", "up"], "left")
    new = {"ut": "ft", "ul": "fl", "up": "fp"}
    return joined.select(*[
        F.when(F.col("met"), F.col(new[c])).alias(c) if c in new
        else F.when(F.col("met"), F.concat("segment", "more")).otherwise(F.col("segment")).alias(c) if c == "segment"
        else F.col(c) for c in rows.columns
    ])


def _proofs(leaves: DataFrame, inner: DataFrame, depth: int) -> DataFrame:
    """``leaves`` with segments that reach the root, by pointer jumping.

    Leaves and inner nodes hold the segment towards an ancestor at a distance of 1, 2, 4, ...; a join of the
    nodes with themselves doubles that. A leaf of a source only ever points to levels of its tree that are multiples of the distance
    (or beyond its tree), so inner nodes between them are left behind.
    """
    distance = 1
    while distance < depth:
        between = (F.col("t") != TOP) & (F.col("l") % distance != 0)
        inner = inner.where(~between)
        size = size_of(inner)
        leaves = _jumped(leaves, inner, size)
        distance *= 2
        if distance < depth:
            leaves, inner = settled(leaves, "merkle_leaves"), settled(_jumped(inner, inner, size), "merkle_inner")
    return leaves


def manifest(rows: DataFrame, leaf: Column, *, source: str, order: str, keep: list[Column] = ()) -> DataFrame:
    """One row per row: ``keep``, source, order, leaf, subroot, root (32 bytes each), and segment, the proof.

    Leaves of a source ascend by ``order`` (nulls first, rows of one value by their leaves); while several nodes are left, every WIDTH
    consecutive ones become the digest of their hexadecimal digests (the last run may be shorter, even one node).
    What is left is the subroot of the source, a lone leaf itself. Subroots in the order of the
    sources' UTF-8 bytes, null first, give the root in the same way. ``segment`` has for every level from the leaf to
    the root the neighbours before and after in the run, as bytes; :func:`folded` puts a leaf into it.

    Rows that repeat are leaves each. A null source is a source. Empty texts and very long ones are one
    digest like any other. An empty table gives an empty one. The columns are chosen by name and may be called anything.

    No task sees a source whole: places in a source come from ranges of the order of all rows, levels are
    made of WIDTH ** LEVELS nodes at a time, and proofs by pointer jumping in log2(height) joins whose right side (the
    inner nodes) is unique and, where many leaves point to few nodes, small enough to be broadcast after it was measured.
    """
    kept = {f"k{i}": c for i, c in enumerate(keep)}
    own = rows.select(
        rows[source].cast("string").alias("source"), rows[order].alias("by"), leaf.alias("digest"),
        *[c.alias(n) for n, c in kept.items()], F.monotonically_increasing_id().alias("row"),
    )
    own = settled(own, "merkle_rows")
    along = [F.col("source").asc_nulls_first(), F.col("by").asc_nulls_first(), F.col("digest"), F.col("row")]
    placed = numbered(own, along, "pos")
    sources = placed.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    sources = settled(numbered(sources, [F.col("first")], "tree").withColumn("height", _height(F.col("n"))), "merkle_sources")
    n_sources, height = sources.agg(F.count(F.lit(1)), F.coalesce(F.max("height"), F.lit(0))).first()
    if not n_sources:
        return own.select(*kept, "source", F.col("by").alias(order), F.col("digest").alias("leaf"), F.col("digest").alias("subroot"),
                          F.col("digest").alias("root"), F.array().cast(_SEGMENT).alias("segment"))
    of_row = sources.select(F.col("source").alias("s"), "tree", "height", "first")
    leaves = placed.join(join_side(of_row, size_of(of_row)), F.col("source").eqNullSafe(F.col("s"))).withColumn("place", F.col("pos") - F.col("first"))
    leaves = settled(leaves.select(*kept, "source", "by", "digest", "tree", "height", "place"), "merkle_placed")

    below = _tree(leaves.select("tree", "height", "place", "digest"), height)
    subroots = settled(_union(below).where("level = height").select("tree", "digest"), "merkle_subroots")
    top_height = _levels_of(n_sources)
    above = _tree(subroots.select(F.lit(TOP).cast("bigint").alias("tree"), F.lit(top_height).alias("height"), F.col("tree").alias("place"), "digest"), top_height)
    root = _union(above).where(F.col("level") == top_height).first()["digest"]
    # the end of a source's tree has its neighbours in the tree over the sources
    beside = _union(above).where("level = 0").select(F.col("place").alias("end"), F.col("before").alias("b"), F.col("after").alias("a"))
    nodes = _union(below)
    ends = nodes.where("level = height").drop("before", "after").join(beside.hint("merge"), F.col("tree") == F.col("end"))
    ends = ends.select("tree", "height", "level", "place", "digest", F.col("b").alias("before"), F.col("a").alias("after"))
    nodes = _union([nodes.where("level < height"), ends, _union(above).where("level > 0")])
    pointed = settled(_pointed(nodes, top_height), "merkle_pointed")

    name = ["tree", "place"]
    start = pointed.where(f"level = 0 AND tree != {TOP}").select(*name, "ut", "ul", "up", "segment")
    start = leaves.join(start.hint("merge"), name).select(*kept, "source", "by", "digest", "tree", "ut", "ul", "up", "segment")
    inner = settled(pointed.where(f"level > 0 OR tree = {TOP} OR t = {TOP}").select("t", "l", "p", "ut", "ul", "up", "segment"), "merkle_inner")
    proved = _proofs(settled(start, "merkle_leaves"), inner, height + top_height)
    side = subroots.select("tree", F.col("digest").alias("subroot"))
    return proved.join(join_side(side, size_of(side)), "tree").select(
        *kept, "source", F.col("by").alias(order), F.col("digest").alias("leaf"), "subroot", F.lit(bytes(root)).alias("root"), "segment"
    )


def _levels_of(n: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // WIDTH), levels + 1
    return levels


def siblings(segment: Column) -> Column:
    """sha256 (hexadecimal) of the digests of a proof, level by level to the root, left to right."""
    return F.sha2(F.concat_ws("", F.transform(segment, lambda s: F.concat(hex_of(s["before"]), hex_of(s["after"])))), 256)


def folded(leaf: Column, segment: Column) -> Column:
    """The root (hexadecimal) to which a leaf and a proof lead."""
    return F.aggregate(segment, hex_of(leaf), lambda node, s: F.sha2(F.concat(hex_of(s["before"]), node, hex_of(s["after"])), 256))


def op11_merkle_manifest(spark, sf_dir):
    """The proofs of ``documents``, tried with leaves of which every second one (by crc32 of the id) was tampered with.

    A null id is no number and is not tampered with; a null text stays null.
    """
    docs = read(spark, sf_dir, "documents")
    values = {f: docs[f] for f in FIELDS}
    tampered = F.coalesce((crc_of_id(docs["doc_id"]) % 2 == 0) & docs["doc_id"].isNotNull(), F.lit(False))
    bent = F.when(tampered, leaf_of(*{**values, "text": F.translate(docs["text"], "\n", "")}.values()))
    proofs = manifest(docs, leaf_of(*values.values()), source="source", order="doc_id", keep=[bent])
    shown = proofs.select(
        "doc_id", hex_of(F.col("leaf")).alias("leaf"), hex_of(F.col("subroot")).alias("subroot"), hex_of(F.col("root")).alias("root"),
        siblings(F.col("segment")).alias("proof_sha256"), folded(F.coalesce("k0", "leaf"), F.col("segment")).alias("folded_root"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_leaf(text: str) -> str:
    values = [f"CAST({f} AS VARCHAR)" if f in ("doc_id", "n_chars") else f for f in (*FIELDS[:-1], text)]
    return " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values)


QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}
_SIDES = """(SELECT t.src, t.lvl, t.idx,
               coalesce(string_agg(s.d, '' ORDER BY s.idx) FILTER (s.idx < t.idx), '') AS before,
               coalesce(string_agg(s.d, '' ORDER BY s.idx) FILTER (s.idx > t.idx), '') AS after
        FROM {tree} t JOIN {tree} s ON s.src = t.src AND s.lvl = t.lvl AND s.idx // 3 = t.idx // 3
        WHERE t.n > 1 GROUP BY ALL)"""

ORACLE = {
    "op11_merkle_manifest": f"""
        WITH RECURSIVE leaves AS (
            SELECT doc_id, coalesce('v' || source, '') AS src,
                   sha256({_sql_leaf("text")}) AS leaf,
                   CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 2 = 0
                        THEN sha256({_sql_leaf("replace(text, chr(10), '')")}) ELSE sha256({_sql_leaf("text")}) END AS bent
            FROM documents
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY src) AS n
            FROM leaves
        ), tree AS (
            SELECT src, 0 AS lvl, idx, leaf AS d, n FROM placed
            UNION ALL
            SELECT src, lvl + 1, idx // 3, sha256(string_agg(d, '' ORDER BY idx)), (any_value(n) + 2) // 3
            FROM tree WHERE n > 1 GROUP BY src, lvl, idx // 3
        ), subroots AS (
            SELECT src, d, row_number() OVER (ORDER BY src) - 1 AS sid, count(*) OVER () AS n FROM tree WHERE n = 1
        ), top AS (
            SELECT 'top' AS src, 0 AS lvl, sid AS idx, d, n FROM subroots
            UNION ALL
            SELECT src, lvl + 1, idx // 3, sha256(string_agg(d, '' ORDER BY idx)), (any_value(n) + 2) // 3
            FROM top WHERE n > 1 GROUP BY src, lvl, idx // 3
        ), own_sides AS {_SIDES.format(tree="tree")}, top_sides AS {_SIDES.format(tree="top")}
        , climb AS (
            SELECT doc_id, p.src, 0 AS lvl, p.idx, bent AS h, '' AS proof FROM placed p
            UNION ALL
            SELECT c.doc_id, c.src, c.lvl + 1, c.idx // 3, sha256(s.before || c.h || s.after), c.proof || s.before || s.after
            FROM climb c JOIN own_sides s ON s.src = c.src AND s.lvl = c.lvl AND s.idx = c.idx
        ), climbed AS (
            SELECT doc_id, c.src, r.d AS subroot, r.sid, h, proof
            FROM climb c JOIN subroots r USING (src) JOIN tree t ON t.src = c.src AND t.lvl = c.lvl AND t.n = 1
        ), onward AS (
            SELECT doc_id, 0 AS lvl, sid AS idx, h, proof FROM climbed
            UNION ALL
            SELECT c.doc_id, c.lvl + 1, c.idx // 3, sha256(s.before || c.h || s.after), c.proof || s.before || s.after
            FROM onward c JOIN top_sides s ON s.lvl = c.lvl AND s.idx = c.idx
        )
        SELECT o.doc_id, leaf, subroot, t.d AS root, sha256(o.proof) AS proof_sha256, o.h AS folded_root, o.h = t.d AS verified
        FROM onward o JOIN top t ON t.lvl = o.lvl AND t.n = 1
        JOIN placed USING (doc_id) JOIN climbed USING (doc_id)
    """,
}
