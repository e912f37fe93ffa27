"""Edge queries as joins: matches, fetches, n-step subgraphs, all paths, flattened results.

The multi-hop queries work on keys alone and fetch properties at the end. Each hop is written
to the shared folder and read back, which keeps the plan small and survives lost executors. The
frontier is measured: a small one is broadcast and the edges are not shuffled. When a large one is met and
more hops follow, the edges are laid out at both ends once (see adjacency.py), and no later hop shuffles them; a
single large hop is joined by shuffle, where adaptive execution splits hub vertices.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphtables.functions import read_property
from graphtables.model import EDGE, EDGE_KEY, Label, Space
from graphtables.operators.adjacency import adjacency, beside, edges_of
from graphtables.session import is_small, join_side, materialize_measured, size_of
from graphtables.sources.scan import edge_keys, scan_edges, scan_vertices

LABELLED_KEY = ["label", *EDGE_KEY]
# An edge as a query result carries it.
EDGE_STRUCT = T.StructType(
    [
        T.StructField("src", T.StringType()),
        T.StructField("dst", T.StringType()),
        T.StructField("rank", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("props", T.MapType(T.StringType(), T.StringType())),
    ]
)


def _sized(df: DataFrame) -> DataFrame:
    """``df`` as the right side of a join, broadcast only when it is measured to be small."""
    return join_side(df, size_of(df))


def match_vertices(space: Space, tag: str, cols=()) -> DataFrame:
    return scan_vertices(space, tag, cols)


def match_edges(space: Space, label: str, cols=(), limit: int | None = None) -> DataFrame:
    """All edges of a label; with a limit, the first ones by key."""
    df = scan_edges(space, label, cols)
    return df if limit is None else df.orderBy(*EDGE_KEY).limit(limit)


def match_edges_from_tag(space: Space, label: str, tag: str, cols=()) -> DataFrame:
    """Edges of a label that start at a vertex of a tag."""
    heads = scan_vertices(space, tag, no_column=True).withColumnRenamed("_vertexId", "_srcId")
    df = scan_edges(space, label, cols)
    return df.join(_sized(heads), "_srcId", "left_semi").select(*df.columns)


def fetch_edges(space: Space, label: str, keys: DataFrame, cols=()) -> DataFrame:
    """The edges whose source, target and rank are listed in ``keys``."""
    keys = keys.select(*EDGE_KEY)
    wanted = join_side(keys.distinct(), size_of(keys))
    return scan_edges(space, label, cols).join(wanted, EDGE_KEY, "left_semi")


def with_props(space: Space, label: str, keys: DataFrame, cols=()) -> DataFrame:
    """The rows of ``keys`` (repeats kept) that are edges of ``label``, with properties."""
    wanted = keys.filter(F.col("label") == label).select(*EDGE_KEY)
    if not space.label(EDGE, label).selected(cols):
        return wanted
    df = scan_edges(space, label, cols)
    return wanted.join(df, EDGE_KEY).select(*df.columns)


def _neighbours(edges: DataFrame, frontier: DataFrame, size: int) -> DataFrame:
    """The vertices one edge away from the frontier, in either direction.

    The edges are the left side of a semi join and the found ids are made distinct on the map
    side, so a hub is met once per task and not once per edge.
    """
    sides = []
    for here, there in (("_srcId", "_dstId"), ("_dstId", "_srcId")):
        at = join_side(frontier.select(F.col("vid").alias(here)), size)
        found = edges.select(here, there).join(at, here, "left_semi")
        sides.append(found.select(F.col(there).alias("vid")))
    return sides[0].unionByName(sides[1]).distinct()


class Hops:
    """Edges, and their layout at both ends once a frontier asked for it."""

    def __init__(self, edges: DataFrame):
        self.edges = edges
        self.laid_out: DataFrame | None = None

    def near(self, frontier: DataFrame, size: int) -> DataFrame:
        """The vertices one edge away from the frontier, in either direction; there are more hops to come."""
        if self.laid_out is None and is_small(frontier.sparkSession, size):
            return _neighbours(self.edges, frontier, size)
        if self.laid_out is None:
            self.laid_out = adjacency(self.edges)
        return beside(self.laid_out, frontier).select(F.col("there").alias("vid")).distinct()

    def at(self, vertices: DataFrame, size: int) -> DataFrame:
        """The edges that have one of the vertices at an end, each once."""
        if self.laid_out is not None:
            return edges_of(beside(self.laid_out, vertices))
        out = self.edges
        for end in ("_srcId", "_dstId"):
            side = vertices.select(F.col("vid").alias(end), F.lit(True).alias(f"{end}_near"))
            out = out.join(join_side(side, size), end, "left")
        return out.filter(F.col("_srcId_near") | F.col("_dstId_near")).select(*LABELLED_KEY)


def _reached(edges: Hops, starts: DataFrame, hops: int) -> tuple[DataFrame, int]:
    """The vertices at most ``hops`` away and a bound of their bytes; ends when none is new."""
    level, rows, size = materialize_measured(_ids(starts), "level0")
    levels, sizes = [level], [size]
    for hop in range(1, hops + 1):
        # An edge leads at most one level away, so only the last two levels can be met again.
        known = join_side(_all_of(levels[-2:]), sum(sizes[-2:]))
        found = edges.near(levels[-1], sizes[-1])
        level, rows, size = materialize_measured(found.join(known, "vid", "left_anti"), f"level{hop}")
        levels.append(level)
        sizes.append(size)
        if not rows:
            break
    return _all_of(levels), sum(sizes)


def _ids(df: DataFrame) -> DataFrame:
    return df.select("vid").filter("vid is not null").distinct()


def _all_of(levels: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, levels)


def subgraph_edges(space: Space, starts: DataFrame, steps: int, labels=None) -> DataFrame:
    """Edges met on 1..``steps`` steps from ``starts`` (column ``vid``), in either direction.

    Each edge once, as ``label, _srcId, _dstId, _rank``. An edge is met when one of its ends is
    at most ``steps - 1`` away, so the last step needs no frontier of its own.
    """
    if steps <= 0:
        raise ValueError("steps must be positive")
    edges = Hops(edge_keys(space, labels))
    return edges.at(*_reached(edges, starts, steps - 1))


def _edge_id() -> Column:
    return F.struct(*[F.col(c).alias(c) for c in LABELLED_KEY])


def _distance_to(edges: DataFrame, targets: DataFrame, hops: int) -> tuple[DataFrame, int]:
    """Vertices from which a target can be reached in at most ``hops`` steps, with the least
    number of steps, and a bound of their bytes."""
    level, rows, size = materialize_measured(_ids(targets), "target0")
    levels, sizes = [level], [size]
    for hop in range(1, hops + 1):
        at = join_side(levels[-1].select(F.col("vid").alias("_dstId")), sizes[-1])
        before = edges.join(at, "_dstId", "left_semi").select(F.col("_srcId").alias("vid")).distinct()
        known = join_side(_all_of(levels), sum(sizes))
        level, rows, size = materialize_measured(before.join(known, "vid", "left_anti"), f"target{hop}")
        levels.append(level)
        sizes.append(size)
        if not rows:
            break
    steps = [level.withColumn("left", F.lit(i)) for i, level in enumerate(levels)]
    return _all_of(steps), sum(sizes)


def all_paths(
    space: Space, starts: DataFrame, targets: DataFrame, max_hops: int, labels=None
) -> DataFrame:
    """All directed paths of 1..``max_hops`` edges from a start to a target (columns ``vid``).

    A path does not use an edge twice; it may meet a vertex twice. Result: ``path``, an array of
    ``label, _srcId, _dstId, _rank``. Every path is in the result, so ``max_hops`` bounds the
    work. Edges from which no target is in reach are dropped before the first hop.
    """
    if max_hops <= 0:
        raise ValueError("max_hops must be positive")
    keys = edge_keys(space, labels).select(*LABELLED_KEY)
    reach, size = _distance_to(keys.select("_srcId", "_dstId"), targets, max_hops - 1)
    useful = keys.join(join_side(reach.withColumnRenamed("vid", "_dstId"), size), "_dstId")
    useful, _, edge_size = materialize_measured(useful.select("left", _edge_id().alias("edge")), "edges")
    heads, n_open, path_size = materialize_measured(_ids(starts), "heads")
    open_paths = heads.select(
        F.col("vid").alias("at"), F.array().cast(T.ArrayType(useful.schema["edge"].dataType)).alias("path")
    )
    found = []
    # The longest paths are left to the caller's own job: no later hop reads them.
    for hop in range(1, max_hops + 1):
        step = useful.filter(F.col("left") <= max_hops - hop).withColumn("at", F.col("edge._srcId"))
        if is_small(useful.sparkSession, path_size):
            open_paths = F.broadcast(open_paths)
        else:
            # the edges of this hop alone: few ones leave the paths where they are, however many of these meet in one vertex
            step = join_side(step, min(edge_size, size_of(step, ["at", "edge"])))
        longer = (
            open_paths.join(step, "at")
            .filter(~F.array_contains("path", F.col("edge")))
            .select(
                F.col("edge._dstId").alias("at"),
                (F.col("left") == 0).alias("there"),
                F.array_append("path", F.col("edge")).alias("path"),
            )
        )
        if hop < max_hops:
            longer, n_open, path_size = materialize_measured(longer, f"paths{hop}", ["at", "path"])
        found.append(longer.filter("there").select("path"))
        if hop < max_hops:
            open_paths = longer.select("at", "path")
            if not n_open:
                break
    return _all_of(found)


def path_edges(paths: DataFrame, label: str | None = None) -> DataFrame:
    """The edges of paths, one row per edge per path: an edge on two paths gives two rows."""
    rows = paths.select(F.inline("path"))
    return rows if label is None else rows.filter(F.col("label") == label)


def edge_struct(label: Label, src: Column, dst: Column, rank: Column, props: dict | None = None):
    """An edge as a query result carries it; the property values are text."""
    entries = [x for n, c in (props or {}).items() for x in (F.lit(n), c.cast("string"))]
    values = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")
    for name in props or {}:
        label.prop_type(name)
    return F.struct(
        src.alias("src"),
        dst.alias("dst"),
        rank.cast("bigint").alias("rank"),
        F.lit(label.name).alias("label"),
        values.alias("props"),
    )


def _is_edge(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) and kind.fieldNames() == EDGE_STRUCT.fieldNames()


def flatten_edges(results: DataFrame, label: Label, cols=()) -> DataFrame:
    """Edges, edge lists and paths in the cells of ``results`` as edge rows of one label.

    A null cell, an empty list and a null in a list give nothing; nothing is made distinct. A
    column of any other type is refused.
    """
    lists = []
    for f in results.schema.fields:
        if _is_edge(f.dataType):
            lists.append(F.when(F.col(f.name).isNotNull(), F.array(F.col(f.name))))
        elif isinstance(f.dataType, T.ArrayType) and _is_edge(f.dataType.elementType):
            lists.append(F.col(f.name))
        elif not isinstance(f.dataType, T.NullType):
            raise ValueError(f"column {f.name} is no edge, edge list or path: {f.dataType}")
    names = label.selected(cols)
    if not lists:
        raise ValueError("results have no edge columns")
    empty = F.array().cast(T.ArrayType(EDGE_STRUCT))
    cells = F.concat(*[F.coalesce(cell.cast(T.ArrayType(EDGE_STRUCT)), empty) for cell in lists])
    # Exploding and filtering stay in one generated stage; a filter on the array would not.
    edge = results.select(F.explode(cells).alias("e"))
    return edge.filter(F.col("e.label") == label.name).select(
        F.col("e.src").alias("_srcId"),
        F.col("e.dst").alias("_dstId"),
        F.col("e.rank").alias("_rank"),
        *[
            read_property(F.col("e.props")[n], label.prop_type(n), T.StringType()).alias(n)
            for n in names
        ],
    )
