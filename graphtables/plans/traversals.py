"""Edge queries over the whole demonstration graph."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from graphtables.model import EDGE, VERTEX, Label, Space
from graphtables.operators import traverse
from graphtables.plans import sql
from graphtables.plans.demo import contains_feed, demo_space, prefixed, settled, table
from graphtables.sources.scan import scan_vertices

AROUND = ["in_region", "in_nation", "placed", "supplied_by"]
MATCH_LIMIT = 1000


def _vids(space, tag):
    return scan_vertices(space, tag, no_column=True).select(F.col("_vertexId").alias("vid"))


def match_edges(spark, sf_dir):
    return traverse.match_edges(demo_space(spark, sf_dir, "did"), "did", ["value"])


def match_edges_limit(spark, sf_dir):
    """The first edges by key: the limit is part of this query."""
    space = demo_space(spark, sf_dir, "did")
    return traverse.match_edges(space, "did", ["value"], limit=MATCH_LIMIT)


def match_edges_from_tag(spark, sf_dir):
    """Of the edges into a nation, those that start at a supplier."""
    space = demo_space(spark, sf_dir, "supplier", "in_nation")
    return traverse.match_edges_from_tag(space, "in_nation", "supplier")


def match_vertices(spark, sf_dir):
    return traverse.match_vertices(demo_space(spark, sf_dir, "customer"), "customer")


def line_keys(spark, sf_dir):
    """The returned lines by key; a key that was accepted anew has no edge."""
    rank = F.when(F.col("l_returnflag") == "A", F.col("l_linenumber") + 10).otherwise(F.col("l_linenumber"))
    return contains_feed(spark, sf_dir).filter("l_returnflag <> 'N'").select(
        F.col("order_id").alias("_srcId"), F.col("part_id").alias("_dstId"), rank.cast("bigint").alias("_rank")
    )


def fetch_edges(spark, sf_dir):
    """The returned lines by key."""
    space = demo_space(spark, sf_dir, "contains")
    return traverse.fetch_edges(space, "contains", line_keys(spark, sf_dir), ["l_quantity"])


def subgraph_edges(spark, sf_dir):
    """Three steps from all regions: nations, then customers and suppliers, then what they touch."""
    space = settled(demo_space(spark, sf_dir, "region", *AROUND), "supplied_by")
    return traverse.subgraph_edges(space, _vids(space, "region"), 3, AROUND)


def subgraph_edges_with_props(spark, sf_dir):
    """Two steps from all orders, and of the edges met those of one label with a property."""
    labels = ["placed", "in_nation"]
    space = demo_space(spark, sf_dir, "orders", *labels)
    met = traverse.subgraph_edges(space, _vids(space, "orders"), 2, labels)
    return traverse.with_props(space, "placed", met, ["o_totalprice"])


def all_paths_edges(spark, sf_dir):
    """The edges of all paths from a customer to a part, one row per edge and path."""
    labels = ["placed", "contains"]
    space = settled(demo_space(spark, sf_dir, "customer", "part", *labels), "contains")
    paths = traverse.all_paths(space, _vids(space, "customer"), _vids(space, "part"), 2, labels)
    return traverse.path_edges(paths)


def all_paths_edges_three_hops(spark, sf_dir):
    """The paths from a part over supplier and nation to a region, as text."""
    labels = ["supplied_by", "in_nation", "in_region"]
    space = settled(demo_space(spark, sf_dir, "part", "region", *labels), "supplied_by")
    paths = traverse.all_paths(space, _vids(space, "part"), _vids(space, "region"), 3, labels)
    ends = F.transform("path", lambda e: e["_dstId"])
    return paths.select(
        F.concat_ws("->", F.element_at("path", 1)["_srcId"], F.array_join(ends, "->")).alias("path")
    )


def flatten_edges(spark, sf_dir):
    """An edge, a list and a path per order line, flattened to the edges of one label."""
    space = demo_space(spark, sf_dir, "contains", "placed", "supplied_by")
    label = {n: space.label(EDGE, n) for n in space.names(EDGE)}
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_totalprice"
    )
    lines = table(spark, sf_dir, "lineitem").join(orders, "l_orderkey")
    order = F.concat(F.lit("o"), "l_orderkey")
    part = F.concat(F.lit("p"), "l_partkey")
    contains = traverse.edge_struct(
        label["contains"], order, part, F.col("l_linenumber"), {"l_quantity": F.col("l_quantity")}
    )
    supplied = traverse.edge_struct(
        label["supplied_by"], part, F.concat(F.lit("s"), "l_suppkey"), F.lit(0)
    )
    placed = traverse.edge_struct(
        label["placed"],
        F.concat(F.lit("c"), "o_custkey"),
        order,
        F.lit(0),
        {"o_totalprice": F.col("o_totalprice")},
    )
    none = F.lit(None).cast(traverse.EDGE_STRUCT)
    returned = F.col("l_returnflag") == "R"
    results = lines.select(
        F.when(returned, contains).alias("edge"),
        F.array(contains, supplied, none).alias("edges"),
        F.when(~returned, F.array(placed, contains)).alias("path"),
    )
    return traverse.flatten_edges(results, label["contains"], ["l_quantity"])


# --- a graph with cycles ------------------------------------------------------------------------


def ring_space(spark, sf_dir) -> Space:
    """The orders of each customer as a ring: from an order to the next one, to the one after that, and from the last to the first."""
    along = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("own"), F.lead("o_orderkey").over(along).alias("next"), F.lead("o_orderkey", 2).over(along).alias("second"),
        F.first("o_orderkey").over(whole).alias("first"),
    )
    back = F.when(F.col("next").isNull() & (F.col("own") != F.col("first")), F.col("first"))
    ends = [F.struct(c.alias("to"), F.lit(i).cast("bigint").alias("_rank")) for i, c in enumerate((F.col("next"), F.col("second"), back))]
    steps = placed.select("own", "first", "next", F.inline(F.array(*ends)))
    edges = steps.filter("to IS NOT NULL").select(prefixed("o", "own").alias("_srcId"), prefixed("o", "to").alias("_dstId"), "_rank")
    heads = placed.select(prefixed("o", "own").alias("_vertexId"), (F.col("own") == F.col("first")).alias("heads"), F.col("next").isNull().alias("ends"))
    space = Space("rings").with_table(Label("turn", VERTEX, {"heads": "BOOL", "ends": "BOOL"}), heads)
    return settled(space.with_table(Label("then", EDGE), edges), "then")


def _turns(space, which: str):
    return scan_vertices(space, "turn").filter(which).select(F.col("_vertexId").alias("vid"))


def all_paths_cyclic(spark, sf_dir):
    """Paths of up to four edges from the first order of a customer to the last one; some go round."""
    space = ring_space(spark, sf_dir)
    paths = traverse.all_paths(space, _turns(space, "heads"), _turns(space, "ends"), 4)
    step = F.transform("path", lambda e: F.concat_ws("-", e["_srcId"], e["_rank"].cast("string"), e["_dstId"]))
    return paths.select(F.array_join(step, " ").alias("path"))


def subgraph_cyclic(spark, sf_dir):
    """Three steps around the last orders."""
    space = ring_space(spark, sf_dir)
    return traverse.subgraph_edges(space, _turns(space, "ends"), 3)


QUERIES = {
    f.__name__: f
    for f in (
        match_edges,
        match_edges_limit,
        match_edges_from_tag,
        match_vertices,
        fetch_edges,
        subgraph_edges,
        subgraph_edges_with_props,
        all_paths_edges,
        all_paths_edges_three_hops,
        all_paths_cyclic,
        subgraph_cyclic,
        flatten_edges,
    )
}

_KEY = "_srcId, _dstId, _rank"


def _subgraph_sql(edges: str, starts: str, steps: int) -> str:
    """One level of vertices after another, then the edges with an end in one of them."""
    ctes = [
        f"e AS ({edges})",
        "adj AS (SELECT _srcId AS a, _dstId AS b FROM e UNION SELECT _dstId, _srcId FROM e)",
        f"v0 AS ({starts})",
    ]
    for i in range(1, steps):
        ctes.append(
            f"v{i} AS (SELECT vid FROM v{i - 1} UNION"
            f" SELECT b FROM adj JOIN v{i - 1} ON a = vid)"
        )
    last = f"v{steps - 1}"
    return (
        f"WITH {', '.join(ctes)} SELECT DISTINCT label, {_KEY} FROM e"
        f" WHERE _srcId IN (SELECT vid FROM {last}) OR _dstId IN (SELECT vid FROM {last})"
    )


_PLACED_CONTAINS = (
    f"SELECT p._srcId AS a, p._dstId AS b, c._dstId AS d, c._rank AS r FROM ({sql.edge('placed', [])}) p"
    f" JOIN ({sql.edge('contains', [])}) c ON p._dstId = c._srcId"
)
_THREE_TIMES = (
    "SELECT 'o' || l_orderkey AS _srcId, 'p' || l_partkey AS _dstId,"
    " l_linenumber::BIGINT AS _rank, l_quantity FROM lineitem"
)

_TURNS = (
    "SELECT o_orderkey AS own, lead(o_orderkey) OVER along AS nxt, lead(o_orderkey, 2) OVER along AS second,"
    " first(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS head"
    " FROM orders WINDOW along AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"
)
_RINGS = (
    f"SELECT 'then' AS label, 'o' || own AS _srcId, 'o' || there AS _dstId, rank::BIGINT AS _rank FROM ("
    f"SELECT own, nxt AS there, 0 AS rank FROM ({_TURNS}) UNION ALL SELECT own, second, 1 FROM ({_TURNS})"
    f" UNION ALL SELECT own, head, 2 FROM ({_TURNS}) WHERE nxt IS NULL AND own <> head) WHERE there IS NOT NULL"
)

ORACLE = {
    "match_edges": sql.edge("did", ["value"]),
    "match_edges_limit": f"SELECT * FROM ({sql.edge('did', ['value'])}) ORDER BY {_KEY}"
    f" LIMIT {MATCH_LIMIT}",
    "match_edges_from_tag": f"SELECT * FROM ({sql.edge('in_nation', [])})"
    f" WHERE _srcId IN (SELECT _vertexId FROM ({sql.tag('supplier', [])}))",
    "match_vertices": sql.tag("customer"),
    "fetch_edges": f"SELECT * FROM ({sql.edge('contains', ['l_quantity'])}) SEMI JOIN ("
    "SELECT 'o' || l_orderkey AS _srcId, 'p' || l_partkey AS _dstId, CASE WHEN l_returnflag = 'A'"
    " THEN l_linenumber + 10 ELSE l_linenumber END AS _rank FROM lineitem"
    f" WHERE l_returnflag <> 'N') USING ({_KEY})",
    "subgraph_edges": _subgraph_sql(sql.edge_union(AROUND), "SELECT 'r' || r_regionkey AS vid FROM region", 3),
    "subgraph_edges_with_props": f"SELECT {_KEY}, o_totalprice FROM ({sql.edge('placed')}) SEMI JOIN"
    " (SELECT * FROM ("
    + _subgraph_sql(sql.edge_union(["placed", "in_nation"]), "SELECT 'o' || o_orderkey AS vid FROM orders", 2)
    + f") WHERE label = 'placed') USING ({_KEY})",
    "all_paths_edges": "SELECT 'placed' AS label, a AS _srcId, b AS _dstId, 0::BIGINT AS _rank"
    f" FROM ({_PLACED_CONTAINS}) UNION ALL SELECT 'contains', b, d, r FROM ({_PLACED_CONTAINS})",
    "all_paths_edges_three_hops": "SELECT s._srcId || '->' || s._dstId || '->' || n._dstId || '->'"
    f" || r._dstId AS path FROM ({sql.edge('supplied_by', [])}) s JOIN ({sql.edge('in_nation', [])})"
    f" n ON s._dstId = n._srcId JOIN ({sql.edge('in_region', [])}) r ON n._dstId = r._srcId",
    "all_paths_cyclic": f"WITH RECURSIVE e AS (SELECT *, _srcId || '-' || _rank || '-' || _dstId AS step FROM ({_RINGS})), p AS ("
    "SELECT _dstId AS here, [step] AS path FROM e WHERE _srcId IN"
    f" (SELECT 'o' || own FROM ({_TURNS}) WHERE own = head)"
    " UNION ALL SELECT _dstId, list_append(path, step) FROM p JOIN e ON _srcId = here"
    " WHERE len(path) < 4 AND NOT list_contains(path, step))"
    f" SELECT array_to_string(path, ' ') AS path FROM p WHERE here IN (SELECT 'o' || own FROM ({_TURNS}) WHERE nxt IS NULL)",
    "subgraph_cyclic": _subgraph_sql(_RINGS, f"SELECT 'o' || own AS vid FROM ({_TURNS}) WHERE nxt IS NULL", 3),
    "flatten_edges": f"{_THREE_TIMES} UNION ALL {_THREE_TIMES}",
}
