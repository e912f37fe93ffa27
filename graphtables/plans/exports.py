"""Graph pairs of the integer and the text space. Arrays are joined to text to be compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphtables.operators import export
from graphtables.plans import sql
from graphtables.plans.demo import demo_space, int_space


def _text(props):
    return F.array_join(props, "|", "null")


def export_vertices(spark, sf_dir):
    df = export.export_vertices(int_space(spark, sf_dir), "customer")
    return df.select("id", _text("props").alias("props"))


def export_edges(spark, sf_dir):
    df = export.export_edges(int_space(spark, sf_dir), "placed")
    return df.select("src", "dst", F.col("attr.rank").alias("rank"), _text("attr.props").alias("props"))


def export_edges_hash(spark, sf_dir):
    """Text ids as bigint under the hash policy."""
    df = export.export_edges(demo_space(spark, sf_dir, "did"), "did", ["value"], policy="hash")
    return df.select("src", "dst", F.col("attr.rank").alias("rank"), _text("attr.props").alias("props"))


def id_dictionary(spark, sf_dir):
    """Every id of users' events and of orders with a number of its own."""
    space = demo_space(spark, sf_dir, "orders", "did")
    return export.id_dictionary(space, [("vertex", "orders"), ("edge", "did")])


def export_edges_numbered(spark, sf_dir):
    """Text ids as their numbers in a dictionary."""
    space = demo_space(spark, sf_dir, "did")
    df = export.export_edges(space, "did", ["value"], ids=export.id_dictionary(space, [("edge", "did")]))
    return df.select("src", "dst", F.col("attr.rank").alias("rank"), _text("attr.props").alias("props"))


def graph_triplets(spark, sf_dir):
    """Customers and the orders they placed with what is known at both ends."""
    space = demo_space(spark, sf_dir, "customer", "orders", "placed")
    vertices = export.export_vertices(
        space, "customer", ["c_name", "c_mktsegment"], policy="hash"
    ).unionByName(
        export.export_vertices(space, "orders", ["o_orderpriority"], policy="hash")
    )
    triplets = export.graph_triplets(vertices, export.export_edges(space, "placed", policy="hash"))
    return triplets.select(
        "src",
        "dst",
        _text("attr.props").alias("props"),
        _text("src_props").alias("src_props"),
        _text("dst_props").alias("dst_props"),
    )


QUERIES = {
    f.__name__: f
    for f in (export_vertices, export_edges, export_edges_hash, export_edges_numbered, id_dictionary, graph_triplets)
}



def _dictionary_sql(*ids: str) -> str:
    return f"SELECT vid, row_number() OVER (ORDER BY vid) - 1 AS id FROM ({' UNION '.join(ids)})"


_DID_IDS = [f"SELECT {end} AS vid FROM ({sql.edge('did', [])})" for end in ("_srcId", "_dstId")]

ORACLE = {
    "id_dictionary": _dictionary_sql(f"SELECT _vertexId AS vid FROM ({sql.tag('orders', [])})", *_DID_IDS),
    "export_edges_numbered": f"WITH ids AS ({_dictionary_sql(*_DID_IDS)}) SELECT s.id AS src, d.id AS dst, _rank AS rank,"
    f" value::VARCHAR AS props FROM ({sql.edge('did')}) JOIN ids s ON s.vid = _srcId JOIN ids d ON d.vid = _dstId",
    "export_vertices": "SELECT c_custkey AS id, c_name || '|' || c_acctbal || '|' || c_mktsegment"
    " AS props FROM customer",
    "export_edges": "SELECT o_custkey AS src, o_orderkey AS dst, 0::BIGINT AS rank,"
    " o_totalprice::VARCHAR AS props FROM orders",
    "export_edges_hash": f"SELECT {sql.hash60('_srcId')} AS src, {sql.hash60('_dstId')} AS dst,"
    f" _rank AS rank, value::VARCHAR AS props FROM ({sql.edge('did')})",
    "graph_triplets": f"SELECT {sql.hash60('_srcId')} AS src, {sql.hash60('_dstId')} AS dst,"
    " p.o_totalprice::VARCHAR AS props, c_name || '|' || c_mktsegment AS src_props,"
    f" o_orderpriority AS dst_props FROM ({sql.edge('placed')}) p"
    f" LEFT JOIN ({sql.tag('customer')}) c ON c._vertexId = _srcId"
    f" LEFT JOIN ({sql.tag('orders')}) o ON o._vertexId = _dstId",
}
