"""Property and id expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphtables import functions as G
from graphtables.model import INT, STRING, EdgeWrite, Label, Space, VertexWrite
from graphtables.operators.mutate import mutate_edges, mutate_vertices
from graphtables.plans import sql
from graphtables.plans.demo import CONTAINS_ORDER, contains_feed, table
from graphtables.plans.typed import TYPED, sql_escape, typed_rows, typed_space, typed_sql
from graphtables.sources.scan import scan_vertices


def property_cast(spark, sf_dir):
    return scan_vertices(typed_space(spark, sf_dir), "reading")


def _each(df, expression):
    held = {f.name: f.dataType for f in df.schema.fields}
    cols = [expression(F.col(n), t, held[n]).alias(n) for n, t in TYPED.items()]
    return df.select("_vertexId", *cols)


def property_text(spark, sf_dir):
    return _each(typed_rows(spark, sf_dir), G.property_text)


def property_literal(spark, sf_dir):
    return _each(typed_rows(spark, sf_dir, nulls=True), G.property_literal)


def is_integer_text(spark, sf_dir):
    """Ids of four spellings for every event: plain, negative, with a newline, and other text."""
    texts = F.array(
        F.col("event_id").cast("string"),
        F.concat(F.lit("-"), F.col("event_id")),
        F.concat(F.col("event_id").cast("string"), F.lit("\n")),
        F.col("props"),
        F.col("event_type"),
        F.lit(""),
    )
    df = table(spark, sf_dir, "events").select("event_id", F.posexplode(texts).alias("nth", "text"))
    return df.select("event_id", "nth", G.is_integer_text(F.col("text")).alias("ok"))


def escape_text(spark, sf_dir):
    """Whole documents, pages and turns, each followed by one of every escaped character."""
    tail = F.lit("\\\t\n\"'\r\b")
    texts = (
        table(spark, sf_dir, "documents")
        .select(F.lit("document").alias("source"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("nth"), "text")
        .unionByName(
            table(spark, sf_dir, "pages").select(
                F.lit("page").alias("source"),
                F.col("page_id").alias("id"),
                F.lit(0).cast("bigint").alias("nth"),
                F.col("html").alias("text"),
            )
        )
        .unionByName(
            table(spark, sf_dir, "conversations").select(
                F.lit("turn").alias("source"),
                F.col("conv_id").alias("id"),
                F.col("turn").cast("bigint").alias("nth"),
                "text",
            )
        )
    )
    return texts.select("source", "id", "nth", G.escape_text(F.concat("text", tail)).alias("escaped"))


def vid_expr(spark, sf_dir):
    """The spelling of an id in a statement, for text ids, integer ids and under a policy."""
    vid = F.concat(F.lit('a"'), "c_name")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        G.vid_text(vid, None, STRING).alias("as_text"),
        G.vid_text(F.col("c_custkey"), None, INT).alias("as_integer"),
        G.vid_text(vid, None, INT).isNull().alias("refused"),
        G.vid_text(vid, "hash", STRING).alias("hashed"),
    )


def vid_hash_policy(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", G.hash_id(F.concat(F.lit("o"), "o_orderkey")).alias("vid")
    )


def vid_uuid_policy(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", G.uuid_id(F.concat(F.lit("o"), "o_orderkey")).alias("vid")
    )


def rank_expr(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    return df.select(
        "event_id",
        G.rank_value(F.concat(F.lit("-"), "event_id")).alias("from_text"),
        G.rank_value(F.col("user_id")).alias("from_long"),
        G.rank_value(F.col("props")).isNull().alias("refused"),
        G.rank_value(None).alias("not_given"),
    )


def vid_as_prop(spark, sf_dir):
    """Customers inserted with their id kept as a property as well."""
    label = Label("customer", "vertex", {"c_custkey": "INT64", "c_name": "STRING"})
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    held = rows.select(F.col("c_custkey").cast("string").alias("_vertexId"), "*")
    space = Space("as_prop", vid_type=INT).with_table(label, held.limit(0))
    write = VertexWrite("c_custkey", vid_as_prop=True)
    return mutate_vertices(space, "customer", rows, write).table("vertex", "customer")


def edge_as_prop(spark, sf_dir):
    """Order lines inserted with source and rank kept as properties, the target not."""
    label = Label("contains", "edge", {"order_id": "STRING", "l_linenumber": "INT32", "l_quantity": "DOUBLE"})
    rows = contains_feed(spark, sf_dir).select(
        "order_id", "part_id", "l_linenumber", "l_quantity", *[c for c in CONTAINS_ORDER if c != "l_quantity"]
    )
    held = rows.select(
        F.col("order_id").alias("_srcId"),
        F.col("part_id").alias("_dstId"),
        F.col("l_linenumber").cast("bigint").alias("_rank"),
        "order_id",
        "l_linenumber",
        "l_quantity",
    )
    space = Space("as_prop").with_table(label, held.limit(0))
    write = EdgeWrite(
        "order_id",
        "part_id",
        "l_linenumber",
        src_as_prop=True,
        rank_as_prop=True,
        order_by=tuple(CONTAINS_ORDER),
    )
    return mutate_edges(space, "contains", rows, write).table("edge", "contains")


QUERIES = {
    f.__name__: f
    for f in (
        property_cast,
        property_text,
        property_literal,
        is_integer_text,
        escape_text,
        vid_expr,
        vid_hash_policy,
        vid_uuid_policy,
        rank_expr,
        vid_as_prop,
        edge_as_prop,
    )
}

_TAIL = """chr(92) || chr(9) || chr(10) || '"' || '''' || chr(13) || chr(8)"""
_UUID = (
    "substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-'"
    " || substr(m, 17, 4) || '-' || substr(m, 21, 12)"
)
_VID = "'a\"' || c_name"

ORACLE = {
    "property_cast": typed_sql("read"),
    "property_text": typed_sql("text"),
    "property_literal": typed_sql("literal", nulls=True),
    "is_integer_text": "SELECT event_id, nth, regexp_full_match(text, '-?[0-9]+') AS ok FROM ("
    "SELECT event_id, unnest([event_id::VARCHAR, '-' || event_id, event_id || chr(10), props,"
    " event_type, '']) AS text, unnest([0, 1, 2, 3, 4, 5])::INTEGER AS nth FROM events)",
    "escape_text": f"SELECT source, id, nth, {sql_escape(f'(text || {_TAIL})')} AS escaped FROM ("
    "SELECT 'document' AS source, doc_id AS id, 0::BIGINT AS nth, text FROM documents"
    " UNION ALL SELECT 'page', page_id, 0, html FROM pages"
    " UNION ALL SELECT 'turn', conv_id, turn, text FROM conversations)",
    "vid_expr": f"SELECT c_custkey, '\"' || {sql_escape(f'({_VID})')} || '\"' AS as_text,"
    " c_custkey::VARCHAR AS as_integer, true AS refused,"
    f" 'hash(\"' || {_VID} || '\")' AS hashed FROM customer",
    "vid_hash_policy": "SELECT o_orderkey, " + sql.hash60("'o' || o_orderkey") + " AS vid FROM orders",
    "vid_uuid_policy": f"SELECT o_orderkey, {_UUID} AS vid FROM"
    " (SELECT o_orderkey, md5('o' || o_orderkey) AS m FROM orders)",
    "rank_expr": "SELECT event_id, -event_id AS from_text, user_id AS from_long,"
    " true AS refused, 0::BIGINT AS not_given FROM events",
    "vid_as_prop": "SELECT c_custkey::VARCHAR AS _vertexId, c_custkey, c_name FROM customer",
    "edge_as_prop": "SELECT _srcId, _dstId, _rank, _srcId AS order_id, _rank AS l_linenumber,"
    f" l_quantity FROM ({sql.edge('contains', ['l_quantity'])})",
}
