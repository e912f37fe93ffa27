"""Graph pairs for graph algorithms: (id, properties), (source, target, (rank, properties))."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphtables.functions import hash_id, is_integer_text
from graphtables.model import EDGE, VERTEX, Space
from graphtables.operators.order import numbered
from graphtables.session import join_side, materialize, size_of
from graphtables.sources.scan import scan_edges, scan_vertices


def long_id(vid: Column, policy: str | None = None) -> Column:
    """An id as bigint: integer text as it is, any other text only under the hash policy."""
    if policy == "hash":
        return hash_id(vid)
    if policy:
        raise ValueError(f"ids become bigint under the hash policy only, not {policy}")
    wrong = F.raise_error(F.concat(F.lit("id is no integer, use the hash policy: "), vid))
    return F.when(is_integer_text(vid), vid.cast("bigint")).otherwise(wrong.cast("bigint"))


def id_dictionary(space: Space, labels: list[tuple[str, str]] | None = None) -> DataFrame:
    """``vid, id``: every id of some labels (all by default), of vertices and at the ends of edges, and its number from 0.

    The numbers follow the ids' bytes, have no gap, and no two ids share one, which hashes can not promise. They hold for
    these tables: ids that are added later change them. Ids are made distinct on the map side first, and numbered by ranges, so no
    task sees all of them and a hub counts once.
    """
    frames = []
    for kind, name in labels or space.labels:
        table = scan_vertices(space, name, no_column=True) if kind == VERTEX else scan_edges(space, name, no_column=True)
        frames += [table.select(F.col(k).alias("vid")) for k in table.columns if k != "_rank"]
    if not frames:
        raise ValueError(f"space {space.name} has no labels")
    every = reduce(DataFrame.unionByName, frames).filter("vid IS NOT NULL").distinct()
    return materialize(numbered(every, [F.col("vid")], "id"), "dictionary")


def _numbered(df: DataFrame, end: str, name: str, ids: DataFrame, size: int) -> DataFrame:
    """``df`` with the number of an id that it holds; the dictionary is unique and on the right, so hubs can be split."""
    side = ids.select(F.col("vid").alias(end), F.col("id").alias(name))
    return df.join(join_side(side, size), end)


def _listed(cols: list[str]) -> Column:
    return F.array(*[F.col(c).cast("string") for c in cols]).cast("array<string>")


def export_vertices(
    space: Space, label: str, cols=(), no_column: bool = False, policy: str | None = None, ids: DataFrame | None = None
) -> DataFrame:
    """``id bigint, props array<string>``; the id is its number in ``ids`` (see :func:`id_dictionary`) where that is given."""
    names = space.label(VERTEX, label).selected(cols, no_column)
    df = scan_vertices(space, label, cols, no_column)
    if ids is not None:
        return _numbered(df, "_vertexId", "id", ids, size_of(ids)).select("id", _listed(names).alias("props"))
    return df.select(long_id(F.col("_vertexId"), policy).alias("id"), _listed(names).alias("props"))


def export_edges(
    space: Space, label: str, cols=(), no_column: bool = False, policy: str | None = None, ids: DataFrame | None = None
) -> DataFrame:
    """``src bigint, dst bigint, attr struct<rank, props>``; ids as in :func:`export_vertices`."""
    names = space.label(EDGE, label).selected(cols, no_column)
    df = scan_edges(space, label, cols, no_column)
    if ids is not None:
        size = size_of(ids)
        df = _numbered(_numbered(df, "_srcId", "src", ids, size), "_dstId", "dst", ids, size)
        return df.select("src", "dst", F.struct(F.col("_rank").alias("rank"), _listed(names).alias("props")).alias("attr"))
    return df.select(
        long_id(F.col("_srcId"), policy).alias("src"),
        long_id(F.col("_dstId"), policy).alias("dst"),
        F.struct(F.col("_rank").alias("rank"), _listed(names).alias("props")).alias("attr"),
    )


def graph_triplets(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Each edge with the properties at both ends; null at an end that has no vertex.

    The edges are the left side of both joins, so that adaptive execution can split the rows of
    a vertex with very many edges. It does so when both sides are shuffled for the join alone:
    ``vertices`` is a table with one row per id (write it out first if it is an aggregate).
    """
    size = size_of(vertices)
    out = edges
    for end in ("src", "dst"):
        ends = vertices.select(F.col("id").alias(end), F.col("props").alias(f"{end}_props"))
        out = out.join(join_side(ends, size), end, "left")
    return out.select("src", "dst", "attr", "src_props", "dst_props")
