"""A demonstration graph over the star-schema tables.

Ids carry a letter per label, so that one id is never used by two labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphtables.model import EDGE, INT, VERTEX, Label, Space
from graphtables.operators.mutate import latest_per_key
from graphtables.session import materialize

TAGS = {
    "region": {"r_name": "STRING"},
    "nation": {"n_name": "STRING"},
    "customer": {"c_name": "STRING", "c_acctbal": "DOUBLE", "c_mktsegment": "STRING"},
    "orders": {
        "o_orderstatus": "FIXED_STRING",
        "o_totalprice": "DOUBLE",
        "o_orderdate": "DATETIME",
        "o_orderpriority": "STRING",
    },
    "part": {
        "p_name": "STRING",
        "p_brand": "STRING",
        "p_type": "STRING",
        "p_size": "INT32",
        "p_retailprice": "DOUBLE",
    },
    "supplier": {"s_name": "STRING", "s_acctbal": "DOUBLE"},
}
EDGES = {
    "placed": {"o_totalprice": "DOUBLE"},
    "contains": {
        "l_quantity": "DOUBLE",
        "l_extendedprice": "DOUBLE",
        "l_discount": "DOUBLE",
        "l_shipdate": "DATE",
    },
    "supplied_by": {},
    "in_nation": {},
    "in_region": {},
    "did": {"ts": "DATETIME", "value": "DOUBLE", "props": "STRING"},
}


_SCHEMAS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its schema is looked up in the file once, which saves a job per use."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def prefixed(letter: str, column: str):
    return F.concat(F.lit(letter), F.col(column).cast("string"))


def contains_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a change feed; an (order, part, line number) may occur more than once."""
    return table(spark, sf_dir, "lineitem").select(
        prefixed("o", "l_orderkey").alias("order_id"),
        prefixed("p", "l_partkey").alias("part_id"),
        F.col("l_linenumber"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_shipdate",
        "l_suppkey",
        "l_returnflag",
        "l_linestatus",
    )


# The order that says which of several lines for one key is the latest.
CONTAINS_ORDER = ["l_extendedprice", "l_quantity", "l_shipdate", "l_suppkey"]


_TAG_KEYS = {
    "region": ("r", "r_regionkey"),
    "nation": ("n", "n_nationkey"),
    "customer": ("c", "c_custkey"),
    "orders": ("o", "o_orderkey"),
    "part": ("p", "p_partkey"),
    "supplier": ("s", "s_suppkey"),
}


def _edges(df: DataFrame, src, dst, rank, cols=()) -> DataFrame:
    return df.select(
        src.alias("_srcId"), dst.alias("_dstId"), rank.cast("bigint").alias("_rank"), *cols
    )


def _placed(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    src, dst = prefixed("c", "o_custkey"), prefixed("o", "o_orderkey")
    return _edges(orders, src, dst, F.lit(0), EDGES["placed"])


def _contains(spark, sf_dir) -> DataFrame:
    ids = ["l_orderkey", "l_partkey", "l_linenumber"]
    props = EDGES["contains"]
    lines = table(spark, sf_dir, "lineitem").select(*ids, *props, "l_suppkey")
    latest = latest_per_key(lines, ids, CONTAINS_ORDER)
    src, dst = prefixed("o", "l_orderkey"), prefixed("p", "l_partkey")
    return _edges(latest, src, dst, F.col("l_linenumber"), props)


def _supplied_by(spark, sf_dir) -> DataFrame:
    pairs = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    return _edges(pairs, prefixed("p", "l_partkey"), prefixed("s", "l_suppkey"), F.lit(0))


def _in_nation(spark, sf_dir) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    suppliers = table(spark, sf_dir, "supplier")
    return _edges(
        customers, prefixed("c", "c_custkey"), prefixed("n", "c_nationkey"), F.lit(0)
    ).unionByName(
        _edges(suppliers, prefixed("s", "s_suppkey"), prefixed("n", "s_nationkey"), F.lit(0))
    )


def _in_region(spark, sf_dir) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    return _edges(nations, prefixed("n", "n_nationkey"), prefixed("r", "n_regionkey"), F.lit(0))


def _did(spark, sf_dir) -> DataFrame:
    src, dst = prefixed("u", "user_id"), prefixed("t", "event_type")
    return _edges(table(spark, sf_dir, "events"), src, dst, F.col("event_id"), EDGES["did"])


_EDGE_FRAMES = {
    "placed": _placed,
    "contains": _contains,
    "supplied_by": _supplied_by,
    "in_nation": _in_nation,
    "in_region": _in_region,
    "did": _did,
}


def demo_space(spark: SparkSession, sf_dir: str, *names: str) -> Space:
    """The graph with text ids: the named labels, or all of them."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    space = Space("demo")
    for name, props in TAGS.items():
        if not names or name in names:
            rows = table(spark, sf_dir, name)
            df = rows.select(prefixed(*_TAG_KEYS[name]).alias("_vertexId"), *props)
            space = space.with_table(Label(name, VERTEX, props), df)
    for name, frame in _EDGE_FRAMES.items():
        if not names or name in names:
            space = space.with_table(Label(name, EDGE, EDGES[name]), frame(spark, sf_dir))
    return space


def settled(space: Space, *names: str) -> Space:
    """The space with the named edge labels written out, as a stored graph has them.

    They are derived from the order lines, and a traversal reads its edges at every hop.
    """
    for name in names:
        label = space.label(EDGE, name)
        space = space.with_table(label, materialize(space.frame(EDGE, name), name))
    return space


def int_space(spark: SparkSession, sf_dir: str) -> Space:
    """Customers and what they placed, with integer ids: a space of its own per id range."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("_vertexId"), *TAGS["customer"]
    )
    placed = _edges(
        table(spark, sf_dir, "orders"),
        F.col("o_custkey").cast("string"),
        F.col("o_orderkey").cast("string"),
        F.lit(0),
        EDGES["placed"],
    )
    return (
        Space("demo_int", vid_type=INT)
        .with_table(Label("customer", VERTEX, TAGS["customer"]), customers)
        .with_table(Label("placed", EDGE, EDGES["placed"]), placed)
    )
