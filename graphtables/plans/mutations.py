"""Inserts, updates and deletes on the demonstration graph, fed by the order lines and events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphtables.model import EDGE, VERTEX, EdgeWrite, VertexWrite
from graphtables.operators.mutate import mutate_edges, mutate_vertices, reject_counts
from graphtables.plans import sql
from graphtables.plans.demo import (
    CONTAINS_ORDER,
    EDGES,
    TAGS,
    contains_feed,
    demo_space,
    int_space,
    prefixed,
    table,
)
from graphtables.session import scratch_path
from graphtables.sources.scan import scan, scan_vertices
from graphtables.sources.store import Store, save

ORDER_FEED_ORDER = ("l_quantity", "l_suppkey")


def order_feed(spark, sf_dir) -> DataFrame:
    """One order row per order line, so with several rows per key; accepted lines make new orders."""
    new_id = F.concat_ws("-", prefixed("x", "l_orderkey"), F.col("l_linenumber").cast("string"))
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", new_id)
        .otherwise(prefixed("o", "l_orderkey"))
        .alias("id"),
        F.col("l_linestatus").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"),
        F.col("l_shipdate").alias("o_orderdate"),
        F.concat_ws("-", "l_returnflag", F.col("l_linenumber").cast("string")).alias("o_orderpriority"),
        *ORDER_FEED_ORDER,
    )


def _orders_after(spark, sf_dir, changes, write) -> DataFrame:
    space = demo_space(spark, sf_dir, "orders")
    return mutate_vertices(space, "orders", changes, write).table(VERTEX, "orders")


def insert_vertices_overwrite(spark, sf_dir):
    write = VertexWrite("id", order_by=ORDER_FEED_ORDER)
    return _orders_after(spark, sf_dir, order_feed(spark, sf_dir), write)


def insert_vertices_if_absent(spark, sf_dir):
    write = VertexWrite("id", overwrite=False, order_by=ORDER_FEED_ORDER)
    return _orders_after(spark, sf_dir, order_feed(spark, sf_dir), write)


def update_vertices(spark, sf_dir):
    """Price and priority change, the price to null for filled lines; the rest stays."""
    feed = order_feed(spark, sf_dir).select(
        "id",
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderpriority",
        *ORDER_FEED_ORDER,
    )
    write = VertexWrite("id", mode="update", order_by=ORDER_FEED_ORDER)
    return _orders_after(spark, sf_dir, feed, write)


def insert_vertices_overwrite_int(spark, sf_dir):
    """Customers by integer id, from suppliers and customers in one text id column."""
    feed = (
        table(spark, sf_dir, "supplier")
        .select(
            F.col("s_suppkey").cast("string").alias("id"),
            F.col("s_name").alias("c_name"),
            F.col("s_acctbal").alias("c_acctbal"),
        )
        .unionByName(
            table(spark, sf_dir, "customer").select(
                F.concat(F.lit("-"), "c_custkey").alias("id"), "c_name", "c_acctbal"
            )
        )
        .withColumn("c_acctbal", F.col("c_acctbal").cast("string"))
    )
    space = int_space(spark, sf_dir)
    write = VertexWrite("id", order_by=("c_name",))
    return mutate_vertices(space, "customer", feed, write).table(VERTEX, "customer")


def gone_vertices(spark, sf_dir) -> DataFrame:
    """Customers and suppliers in debt, orders still open."""
    return (
        table(spark, sf_dir, "customer")
        .filter("c_acctbal < 0")
        .select(prefixed("c", "c_custkey").alias("id"))
        .unionByName(
            table(spark, sf_dir, "supplier")
            .filter("s_acctbal < 0")
            .select(prefixed("s", "s_suppkey").alias("id"))
        )
        .unionByName(
            table(spark, sf_dir, "orders")
            .filter("o_orderstatus = 'O'")
            .select(prefixed("o", "o_orderkey").alias("id"))
        )
    )


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def delete_vertices(spark, sf_dir):
    """The vertices that are left in every vertex label."""
    space = demo_space(spark, sf_dir, *TAGS)
    gone = gone_vertices(spark, sf_dir)
    mutation = mutate_vertices(space, None, gone, VertexWrite("id", mode="delete"))
    return _union(
        mutation.table(VERTEX, n).select(F.lit(n).alias("label"), "_vertexId") for n in TAGS
    )


def delete_vertices_with_edges(spark, sf_dir):
    """The edges that are left in every edge label when vertices go with their edges."""
    space = demo_space(spark, sf_dir)
    write = VertexWrite("id", mode="delete", delete_edge=True)
    mutation = mutate_vertices(space, None, gone_vertices(spark, sf_dir), write)
    return _union(
        mutation.table(EDGE, n).select(F.lit(n).alias("label"), "_srcId", "_dstId", "_rank")
        for n in EDGES
    )


def delete_vertices_with_edges_int(spark, sf_dir):
    """With integer ids an order and a customer may have the same id, and both go."""
    gone = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select("c_custkey")
    write = VertexWrite("c_custkey", mode="delete", delete_edge=True)
    mutation = mutate_vertices(int_space(spark, sf_dir), None, gone, write)
    return mutation.table(EDGE, "placed")


LINE_ID = ("order_id", "part_id", "line")


def line_feed(spark, sf_dir) -> DataFrame:
    """Lines that came back or were accepted; the accepted ones under a new line number."""
    accepted = F.col("l_returnflag") == "A"
    return (
        contains_feed(spark, sf_dir)
        .filter("l_returnflag <> 'N'")
        .select(
            "order_id",
            "part_id",
            F.when(accepted, F.col("l_linenumber") + 10)
            .otherwise(F.col("l_linenumber"))
            .alias("line"),
            (-F.col("l_quantity")).alias("l_quantity"),
            "l_extendedprice",
            "l_discount",
            "l_shipdate",
            "l_suppkey",
        )
    )


def _lines_after(spark, sf_dir, changes, **how) -> DataFrame:
    space = demo_space(spark, sf_dir, "contains")
    write = EdgeWrite(*LINE_ID, **how)
    return mutate_edges(space, "contains", changes, write).table(EDGE, "contains")


def insert_edges_overwrite(spark, sf_dir):
    feed = line_feed(spark, sf_dir)
    return _lines_after(spark, sf_dir, feed, order_by=tuple(CONTAINS_ORDER))


def insert_edges_if_absent(spark, sf_dir):
    feed = line_feed(spark, sf_dir)
    return _lines_after(spark, sf_dir, feed, order_by=tuple(CONTAINS_ORDER), overwrite=False)


def update_edges(spark, sf_dir):
    feed = line_feed(spark, sf_dir).select(
        *LINE_ID,
        F.when(F.col("l_discount") > 0.05, F.col("l_quantity")).alias("l_quantity"),
        (F.col("l_discount") * 2).alias("l_discount"),
        "l_extendedprice",
        "l_suppkey",
    )
    order = ("l_extendedprice", "l_suppkey")
    return _lines_after(spark, sf_dir, feed, order_by=order, mode="update")


def delete_edges(spark, sf_dir):
    return _lines_after(spark, sf_dir, line_feed(spark, sf_dir).select(*LINE_ID), mode="delete")


def event_feed(spark, sf_dir) -> DataFrame:
    """Events as price changes of placed orders: every kind of unusable row is among them."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.when(kind == "error", None)
        .when(kind == "click", F.concat(F.lit("u"), "user_id"))
        .otherwise(F.col("user_id").cast("string"))
        .alias("who"),
        F.when(kind == "view", F.concat("event_id", F.lit("9" * 19)))
        .otherwise(F.col("event_id").cast("string"))
        .alias("order_id"),
        F.when(kind == "signup", F.col("props")).otherwise("0").alias("nth"),
        F.when(F.col("value") > 50, F.col("props"))
        .otherwise(F.col("value").cast("string"))
        .alias("o_totalprice"),
    )


def _event_rejects(spark, sf_dir) -> DataFrame:
    write = EdgeWrite("who", "order_id", "nth", mode="update", order_by=("o_totalprice",))
    return mutate_edges(int_space(spark, sf_dir), "placed", event_feed(spark, sf_dir), write).rejects


def mutation_rejects(spark, sf_dir):
    return _event_rejects(spark, sf_dir)


def mutation_reject_counts(spark, sf_dir):
    return reject_counts(_event_rejects(spark, sf_dir))


def mutate_generic(spark, sf_dir):
    """An insert described by text options, applied to a stored space and read back."""
    space = demo_space(spark, sf_dir, "orders")
    store = Store(spark, scratch_path(spark, "space"), space)
    store.write({(VERTEX, "orders"): scan_vertices(space, "orders")})
    options = {
        "type": "vertex",
        "operateType": "write",
        "spaceName": "demo",
        "label": "orders",
        "vertexField": "id",
        "vidPolicy": "",
        "writeMode": "insert",
        "batch": 100,
        "orderBy": ",".join(ORDER_FEED_ORDER),
    }
    save(store, order_feed(spark, sf_dir), options)
    return scan(store.read(), VERTEX, "orders")


QUERIES = {
    f.__name__: f
    for f in (
        insert_vertices_overwrite,
        insert_vertices_if_absent,
        update_vertices,
        insert_vertices_overwrite_int,
        delete_vertices,
        delete_vertices_with_edges,
        delete_vertices_with_edges_int,
        insert_edges_overwrite,
        insert_edges_if_absent,
        update_edges,
        delete_edges,
        mutation_rejects,
        mutation_reject_counts,
        mutate_generic,
    )
}

# --- the same in SQL --------------------------------------------------------------------------

_ORDER_FEED = (
    "SELECT CASE WHEN l_returnflag = 'A' THEN 'x' || l_orderkey || '-' || l_linenumber"
    " ELSE 'o' || l_orderkey END AS _vertexId, l_linestatus AS o_orderstatus,"
    f" l_extendedprice AS o_totalprice, {sql.as_datetime('l_shipdate')} AS o_orderdate,"
    " l_returnflag || '-' || l_linenumber AS o_orderpriority, l_quantity, l_suppkey FROM lineitem"
)
_ORDER_COLS = "_vertexId, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _order_picked(direction: str) -> str:
    names = [*ORDER_FEED_ORDER, "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    order = ", ".join(f"{n} {direction}" for n in names)
    return (
        f"SELECT {_ORDER_COLS} FROM ({_ORDER_FEED}) QUALIFY row_number() OVER"
        f" (PARTITION BY _vertexId ORDER BY {order}) = 1"
    )


def _upsert_sql(current: str, changes: str, key: str) -> str:
    return (
        f"WITH cur AS ({current}), ch AS ({changes})"
        f" SELECT * FROM cur ANTI JOIN ch USING ({key}) UNION ALL BY NAME SELECT * FROM ch"
    )


def _absent_sql(current: str, changes: str, key: str) -> str:
    return (
        f"WITH cur AS ({current}), ch AS ({changes})"
        f" SELECT * FROM cur UNION ALL BY NAME SELECT * FROM ch ANTI JOIN cur USING ({key})"
    )


_ORDER_UPDATE = (
    "SELECT _vertexId, price, o_orderpriority FROM (SELECT *, CASE WHEN o_orderstatus <> 'F' THEN"
    f" o_totalprice END AS price FROM ({_ORDER_FEED})) QUALIFY row_number() OVER (PARTITION BY"
    " _vertexId ORDER BY l_quantity DESC, l_suppkey DESC, price DESC NULLS LAST,"
    " o_orderpriority DESC) = 1"
)
_GONE = (
    "SELECT 'c' || c_custkey AS id FROM customer WHERE c_acctbal < 0"
    " UNION ALL SELECT 's' || s_suppkey FROM supplier WHERE s_acctbal < 0"
    " UNION ALL SELECT 'o' || o_orderkey FROM orders WHERE o_orderstatus = 'O'"
)
_INT_CURRENT = "SELECT c_custkey::VARCHAR AS _vertexId, c_name, c_acctbal, c_mktsegment FROM customer"
# '-0' is the id 0, which a supplier has as well; the later name wins.
_INT_CHANGES = (
    "SELECT _vertexId, c_name, c_acctbal, NULL AS c_mktsegment FROM ("
    "SELECT s_suppkey::VARCHAR AS _vertexId, s_name AS c_name, s_acctbal AS c_acctbal FROM supplier"
    " UNION ALL SELECT (-c_custkey)::VARCHAR, c_name, c_acctbal FROM customer)"
    " QUALIFY row_number() OVER (PARTITION BY _vertexId ORDER BY c_name DESC, c_acctbal DESC) = 1"
)
_KEY = "_srcId, _dstId, _rank"
LINE_FEED_SQL = (
    "SELECT 'o' || l_orderkey AS _srcId, 'p' || l_partkey AS _dstId, (CASE WHEN l_returnflag = 'A'"
    " THEN l_linenumber + 10 ELSE l_linenumber END)::BIGINT AS _rank, -l_quantity AS l_quantity,"
    f" l_extendedprice, l_discount, {sql.as_date('l_shipdate')} AS l_shipdate,"
    " l_suppkey FROM lineitem WHERE l_returnflag <> 'N'"
)


def _lines_picked(direction: str) -> str:
    names = [*CONTAINS_ORDER, "l_discount"]
    order = ", ".join(f"{n} {direction}" for n in names)
    return (
        f"SELECT {_KEY}, l_quantity, l_extendedprice, l_discount, l_shipdate FROM ({LINE_FEED_SQL})"
        f" QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY {order}) = 1"
    )


_LINE_UPDATE = (
    f"SELECT {_KEY}, q, d, l_extendedprice FROM (SELECT *, l_discount * 2 AS d, CASE WHEN"
    f" l_discount > 0.05 THEN l_quantity END AS q FROM ({LINE_FEED_SQL})) QUALIFY row_number() OVER"
    f" (PARTITION BY {_KEY} ORDER BY l_extendedprice DESC, l_suppkey DESC, q DESC NULLS LAST,"
    " d DESC) = 1"
)
_EVENT_FEED = (
    "SELECT CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN 'u' || user_id ELSE"
    " user_id::VARCHAR END AS _srcId, CASE event_type WHEN 'view' THEN event_id || repeat('9', 19)"
    " ELSE event_id::VARCHAR END AS _dstId, CASE event_type WHEN 'signup' THEN props ELSE '0' END"
    " AS _rank, CASE WHEN value > 50 THEN props ELSE value::VARCHAR END AS price FROM events"
)


def _id_case(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL THEN 'null_key' WHEN NOT regexp_full_match({c}, '-?[0-9]+') THEN"
        f" 'vid_not_numeric' WHEN TRY_CAST({c} AS BIGINT) IS NULL THEN 'vid_out_of_range' END"
    )


_REJECTS = (
    "WITH f AS (SELECT *, coalesce("
    + _id_case("_srcId")
    + ", "
    + _id_case("_dstId")
    + ", CASE WHEN _rank IS NULL THEN 'null_key' WHEN NOT regexp_full_match(_rank, '-?[0-9]+') THEN"
    " 'rank_not_numeric' WHEN TRY_CAST(_rank AS BIGINT) IS NULL THEN 'rank_out_of_range' END,"
    " CASE WHEN price IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NULL THEN"
    f" 'bad_value:o_totalprice' END) AS reason FROM ({_EVENT_FEED}))"
    f" SELECT {_KEY}, reason FROM f WHERE reason IS NOT NULL UNION ALL"
    f" SELECT {_KEY}, 'no_such_key' FROM (SELECT DISTINCT {_KEY} FROM f WHERE reason IS NULL)"
    " ANTI JOIN (SELECT o_custkey::VARCHAR AS _srcId, o_orderkey::VARCHAR AS _dstId, '0' AS _rank"
    f" FROM orders) USING ({_KEY})"
)
_INSERT_ORDERS = _upsert_sql(sql.tag("orders"), _order_picked("DESC"), "_vertexId")

ORACLE = {
    "insert_vertices_overwrite": _INSERT_ORDERS,
    "insert_vertices_if_absent": _absent_sql(
        sql.tag("orders"), _order_picked("ASC"), "_vertexId"
    ),
    "update_vertices": f"WITH cur AS ({sql.tag('orders')}), ch AS ({_ORDER_UPDATE})"
    " SELECT cur._vertexId, cur.o_orderstatus, CASE WHEN ch._vertexId IS NOT NULL THEN ch.price"
    " ELSE cur.o_totalprice END AS o_totalprice, cur.o_orderdate, CASE WHEN ch._vertexId IS NOT"
    " NULL THEN ch.o_orderpriority ELSE cur.o_orderpriority END AS o_orderpriority"
    " FROM cur LEFT JOIN ch ON cur._vertexId = ch._vertexId",
    "insert_vertices_overwrite_int": _upsert_sql(_INT_CURRENT, _INT_CHANGES, "_vertexId"),
    "delete_vertices": f"WITH gone AS ({_GONE}) SELECT label, _vertexId FROM ("
    + " UNION ALL ".join(f"SELECT '{n}' AS label, _vertexId FROM ({sql.tag(n, [])})" for n in TAGS)
    + ") WHERE _vertexId NOT IN (SELECT id FROM gone)",
    "delete_vertices_with_edges": f"WITH gone AS ({_GONE}) SELECT * FROM ({sql.edge_union(EDGES)})"
    " WHERE _srcId NOT IN (SELECT id FROM gone) AND _dstId NOT IN (SELECT id FROM gone)",
    "delete_vertices_with_edges_int": "WITH gone AS (SELECT c_custkey AS id FROM customer WHERE"
    " c_acctbal < 0) SELECT o_custkey::VARCHAR AS _srcId, o_orderkey::VARCHAR AS _dstId,"
    " 0::BIGINT AS _rank, o_totalprice FROM orders WHERE o_custkey NOT IN (SELECT id FROM gone)"
    " AND o_orderkey NOT IN (SELECT id FROM gone)",
    "insert_edges_overwrite": _upsert_sql(sql.edge("contains"), _lines_picked("DESC"), _KEY),
    "insert_edges_if_absent": _absent_sql(sql.edge("contains"), _lines_picked("ASC"), _KEY),
    "update_edges": f"WITH cur AS ({sql.edge('contains')}), ch AS (SELECT *, true AS hit FROM"
    f" ({_LINE_UPDATE})) SELECT {_KEY}, CASE WHEN hit THEN q ELSE cur.l_quantity END AS l_quantity,"
    " CASE WHEN hit THEN ch.l_extendedprice ELSE cur.l_extendedprice END AS l_extendedprice,"
    " CASE WHEN hit THEN d ELSE cur.l_discount END AS l_discount, cur.l_shipdate"
    f" FROM cur LEFT JOIN ch USING ({_KEY})",
    "delete_edges": f"SELECT * FROM ({sql.edge('contains')}) ANTI JOIN ({LINE_FEED_SQL}) USING ({_KEY})",
    "mutation_rejects": _REJECTS,
    "mutation_reject_counts": f"SELECT reason, count(*) AS n_rows FROM ({_REJECTS}) GROUP BY reason",
    "mutate_generic": _INSERT_ORDERS,
}
