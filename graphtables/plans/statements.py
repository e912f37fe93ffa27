"""Statement tables over whole change feeds; some feeds hold the same row very many times."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphtables.model import EDGE, STRING, VERTEX, EdgeWrite, Label, VertexWrite
from graphtables.operators import render
from graphtables.plans import sql
from graphtables.plans.demo import EDGES, TAGS, contains_feed, prefixed, table
from graphtables.plans.typed import sql_escape

BATCH = 512
ORDERS = Label("orders", VERTEX, TAGS["orders"])
CONTAINS = Label("contains", EDGE, EDGES["contains"])
SUPPLIED_BY = Label("supplied_by", EDGE, EDGES["supplied_by"])
SUPPLIER = Label("supplier", VERTEX, TAGS["supplier"])
DOCUMENT = Label("document", VERTEX, {"text": "STRING", "lang": "FIXED_STRING", "n_chars": "INT64"})


def orders_feed(spark, sf_dir):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return table(spark, sf_dir, "orders").select(
        prefixed("o", "o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice",
        "o_orderdate",
    )


def lines_feed(spark, sf_dir):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return contains_feed(spark, sf_dir).select(
        "order_id", "part_id", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )


def supply_feed(spark, sf_dir):
    """One row per order line: pairs of part and supplier repeat, suppliers still more."""
    return table(spark, sf_dir, "lineitem").select(
        prefixed("p", "l_partkey").alias("part"), prefixed("s", "l_suppkey").alias("supplier")
    )


LINE = ("order_id", "part_id", "l_linenumber")


def render_batches(spark, sf_dir):
    feed = lines_feed(spark, sf_dir)
    pieces = render.edge_pieces(feed, CONTAINS, EdgeWrite(*LINE), STRING)
    return render.render_batches(pieces, BATCH, render.part_count(feed))


def render_insert_vertices(spark, sf_dir):
    return render.render_vertices(orders_feed(spark, sf_dir), ORDERS, VertexWrite("id"), STRING)


def render_insert_vertices_hash(spark, sf_dir):
    write = VertexWrite("id", policy="hash", overwrite=False)
    return render.render_vertices(orders_feed(spark, sf_dir), ORDERS, write, STRING)


def render_insert_documents(spark, sf_dir):
    """Whole texts as property values, at few rows to a statement."""
    feed = table(spark, sf_dir, "documents").select(
        prefixed("d", "doc_id").alias("id"), "text", "lang", "n_chars"
    )
    return render.render_vertices(feed, DOCUMENT, VertexWrite("id", batch=16), STRING)


def render_insert_edges(spark, sf_dir):
    return render.render_edges(lines_feed(spark, sf_dir), CONTAINS, EdgeWrite(*LINE), STRING)


def render_insert_edges_unranked(spark, sf_dir):
    write = EdgeWrite("part", "supplier", dst_policy="uuid", overwrite=False)
    return render.render_edges(supply_feed(spark, sf_dir), SUPPLIED_BY, write, STRING)


def render_update_vertices(spark, sf_dir):
    feed = orders_feed(spark, sf_dir)
    return render.render_vertices(feed, ORDERS, VertexWrite("id", mode="update"), STRING)


def render_update_edges(spark, sf_dir):
    feed = lines_feed(spark, sf_dir)
    return render.render_edges(feed, CONTAINS, EdgeWrite(*LINE, mode="update"), STRING)


def render_delete_vertices(spark, sf_dir):
    feed = supply_feed(spark, sf_dir)
    write = VertexWrite("supplier", mode="delete", delete_edge=True)
    return render.render_vertices(feed, SUPPLIER, write, STRING)


def render_delete_edges(spark, sf_dir):
    feed = supply_feed(spark, sf_dir)
    write = EdgeWrite("part", "supplier", mode="delete", src_policy="hash")
    return render.render_edges(feed, SUPPLIED_BY, write, STRING)


QUERIES = {
    f.__name__: f
    for f in (
        render_batches,
        render_insert_vertices,
        render_insert_vertices_hash,
        render_insert_documents,
        render_insert_edges,
        render_insert_edges_unranked,
        render_update_vertices,
        render_update_edges,
        render_delete_vertices,
        render_delete_edges,
    )
}


def _statement_sql(piece: str, source: str, head="", sep=", ", tail="", batch=BATCH) -> str:
    """Runs of equal pieces, their part, their place in the part, and the joined statement."""
    place = sql.hash60("piece || '#' || run")
    return (
        f"WITH p AS (SELECT {piece} AS piece FROM {source}),"
        " r AS (SELECT piece, (row_number() OVER (PARTITION BY piece) - 1) // "
        f"{batch} AS run FROM p),"
        f" d AS (SELECT piece, run, ({place} % (SELECT greatest(1, ceil(count(*) /"
        f" {render.ROWS_PER_PART}))::BIGINT FROM p) + 1)::BIGINT AS part FROM r),"
        " b AS (SELECT piece, part, (row_number() OVER (PARTITION BY part ORDER BY piece, run) - 1)"
        f" // {batch} AS batch_no FROM d)"
        f" SELECT part, batch_no, count(*) AS n_rows, '{head}' ||"
        f" string_agg(piece, '{sep}' ORDER BY piece) || '{tail}' AS statement"
        " FROM b GROUP BY part, batch_no"
    )


_O_STATUS = "CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END"
_O_VALUES = [
    ("o_orderstatus", f"coalesce('\"' || {_O_STATUS} || '\"', 'null')"),
    ("o_totalprice", "o_totalprice::VARCHAR"),
    ("o_orderdate", f"'datetime(\"' || {sql.as_datetime('o_orderdate')} || '\")'"),
]
_L_VALUES = [
    ("l_quantity", "l_quantity::VARCHAR"),
    ("l_extendedprice", "l_extendedprice::VARCHAR"),
    ("l_shipdate", f"'date(\"' || {sql.as_date('l_shipdate')} || '\")'"),
]


def _listed(values) -> str:
    return " || ', ' || ".join(v for _, v in values)


def _assigned(values) -> str:
    return " || ',' || ".join(f"'`{n}`=' || {v}" for n, v in values)


def _names(values) -> str:
    return ",".join(f"`{n}`" for n, _ in values)


_O_ID = "'\"o' || o_orderkey || '\"'"
_L_ID = (
    "'\"o' || l_orderkey || '\"->\"p' || l_partkey || '\"@' || l_linenumber"
)
_ORDER_INSERT = f"|| ': (' || {_listed(_O_VALUES)} || ')'"
_BATCHES = _statement_sql(f"{_L_ID} || ': (' || {_listed(_L_VALUES)} || ')'", "lineitem")

ORACLE = {
    "render_batches": f"SELECT part, batch_no, n_rows FROM ({_BATCHES})",
    "render_insert_vertices": _statement_sql(
        f"{_O_ID} {_ORDER_INSERT}",
        "orders",
        f"INSERT vertex `orders`({_names(_O_VALUES)}) VALUES ",
    ),
    "render_insert_vertices_hash": _statement_sql(
        f"'hash(\"o' || o_orderkey || '\")' {_ORDER_INSERT}",
        "orders",
        f"INSERT vertex IF NOT EXISTS `orders`({_names(_O_VALUES)}) VALUES ",
    ),
    "render_insert_documents": _statement_sql(
        f"'\"d' || doc_id || '\": (\"' || {sql_escape('text')} || '\", \"' || lang || '\", ' ||"
        " n_chars || ')'",
        "documents",
        "INSERT vertex `document`(`text`,`lang`,`n_chars`) VALUES ",
        batch=16,
    ),
    "render_insert_edges": _statement_sql(
        f"{_L_ID} || ': (' || {_listed(_L_VALUES)} || ')'",
        "lineitem",
        f"INSERT edge `contains`({_names(_L_VALUES)}) VALUES ",
    ),
    "render_insert_edges_unranked": _statement_sql(
        "'\"p' || l_partkey || '\"->uuid(\"s' || l_suppkey || '\"): ()'",
        "lineitem",
        "INSERT edge IF NOT EXISTS `supplied_by`() VALUES ",
    ),
    "render_update_vertices": _statement_sql(
        f"'UPDATE VERTEX ON `orders` ' || {_O_ID} || ' SET ' || {_assigned(_O_VALUES)}",
        "orders",
        sep=";",
    ),
    "render_update_edges": _statement_sql(
        f"'UPDATE EDGE ON `contains` ' || {_L_ID} || ' SET ' || {_assigned(_L_VALUES)}",
        "lineitem",
        sep=";",
    ),
    "render_delete_vertices": _statement_sql(
        "'\"s' || l_suppkey || '\"'", "lineitem", "DELETE VERTEX ", ",", " WITH EDGE"
    ),
    "render_delete_edges": _statement_sql(
        "'hash(\"p' || l_partkey || '\")->\"s' || l_suppkey || '\"@0'",
        "lineitem",
        "DELETE EDGE `supplied_by` ",
        ",",
    ),
}
