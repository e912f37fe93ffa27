"""Scans, sources and profiles over the demonstration graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphtables.model import EDGE, VERTEX, EdgeWrite, Label, Space, VertexWrite
from graphtables.operators.mutate import mutate_edges, mutate_vertices
from graphtables.plans import sql
from graphtables.plans.demo import EDGES, TAGS, demo_space, int_space, table
from graphtables.plans.typed import typed_space, typed_sql
from graphtables.session import scratch_path
from graphtables.sources import profile
from graphtables.sources.files import read_header_csv, read_json_lines
from graphtables.sources.scan import load, scan_edges, scan_vertices
from graphtables.sources.store import Store

N_TASKS = 4


def scan_vertices_all(spark, sf_dir):
    return scan_vertices(demo_space(spark, sf_dir, "orders"), "orders")


def scan_vertices_cols(spark, sf_dir):
    return scan_vertices(demo_space(spark, sf_dir, "orders"), "orders", ["o_totalprice", "o_orderstatus"])


def scan_vertices_nocol(spark, sf_dir):
    return scan_vertices(demo_space(spark, sf_dir, "orders"), "orders", no_column=True)


def scan_edges_all(spark, sf_dir):
    return scan_edges(demo_space(spark, sf_dir, "did"), "did")


def scan_edges_cols(spark, sf_dir):
    return scan_edges(demo_space(spark, sf_dir, "did"), "did", ["value"])


def scan_edges_nocol(spark, sf_dir):
    return scan_edges(demo_space(spark, sf_dir, "did"), "did", no_column=True)


def scan_generic(spark, sf_dir):
    """A stored label read back through text options."""
    space = demo_space(spark, sf_dir, "part")
    store = Store(spark, scratch_path(spark, "space"), space)
    store.write({(VERTEX, "part"): scan_vertices(space, "part")})
    options = {
        "type": "vertex",
        "spaceName": "demo",
        "label": "part",
        "returnCols": "p_name,p_size",
        "partitionNumber": "10",
    }
    return load(store.read(), options)


def scan_count(spark, sf_dir):
    counted = F.count(F.lit(1)).alias("n_rows")
    return scan_edges(demo_space(spark, sf_dir, "did"), "did", no_column=True).agg(counted)


def scan_filter(spark, sf_dir):
    df = scan_vertices(demo_space(spark, sf_dir, "orders"), "orders")
    return df.filter((F.col("o_totalprice") > 250000) & (F.col("o_orderstatus") == "F"))


def scan_pruned(spark, sf_dir):
    return scan_edges(demo_space(spark, sf_dir, "did"), "did").select("_dstId", "value")


def scan_null_values(spark, sf_dir):
    return scan_vertices(typed_space(spark, sf_dir, nulls=True), "reading")


def label_profile(spark, sf_dir):
    return profile.label_profile(demo_space(spark, sf_dir))


def label_kind(spark, sf_dir):
    """The kind of the names found in the data, with the label names themselves among them."""
    names = spark.createDataFrame([(n,) for n in (*TAGS, *EDGES)], "label string")
    asked = (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderpriority").alias("label"))
        .unionByName(table(spark, sf_dir, "events").select(F.col("event_type").alias("label")))
        .distinct()
        .unionByName(names)
    )
    return profile.label_kinds(demo_space(spark, sf_dir), asked)


def vid_type_check(spark, sf_dir):
    return profile.vid_type_check(demo_space(spark, sf_dir)).unionByName(
        profile.vid_type_check(int_space(spark, sf_dir))
    )


def part_counts(spark, sf_dir):
    return profile.part_counts(demo_space(spark, sf_dir, "did"), EDGE, "did")


def scan_part_assignment(spark, sf_dir):
    return profile.scan_part_assignment(demo_space(spark, sf_dir, "orders"), VERTEX, "orders", N_TASKS)


def source_csv(spark, sf_dir):
    """Orders written as CSV, read back as text and inserted into an empty label."""
    space = demo_space(spark, sf_dir, "orders")
    orders = scan_vertices(space, "orders").withColumnRenamed("_vertexId", "id")
    path = scratch_path(spark, "orders.csv")
    orders.write.option("header", True).csv(path)
    empty = Space("csv").with_table(space.label(VERTEX, "orders"), space.frame(VERTEX, "orders").limit(0))
    rows = read_header_csv(spark, path)
    return mutate_vertices(empty, "orders", rows, VertexWrite("id")).table(VERTEX, "orders")


def source_json(spark, sf_dir):
    """Events written as JSON lines, read back and inserted into an empty edge label."""
    space = demo_space(spark, sf_dir, "did")
    did = scan_edges(space, "did").withColumnsRenamed(
        {"_srcId": "who", "_dstId": "what", "_rank": "nth"}
    )
    path = scratch_path(spark, "did.json")
    did.write.json(path)
    empty = Space("json").with_table(space.label(EDGE, "did"), space.frame(EDGE, "did").limit(0))
    rows = read_json_lines(spark, path, did.schema)
    return mutate_edges(empty, "did", rows, EdgeWrite("who", "what", "nth")).table(EDGE, "did")


def rename_props(spark, sf_dir):
    """Columns renamed to the property names before they are inserted."""
    label = Label("person", VERTEX, {"name": "STRING", "balance": "DOUBLE"})
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), "c_name", "c_acctbal"
    )
    renamed = rows.withColumnsRenamed({"c_name": "name", "c_acctbal": "balance"})
    held = renamed.select(F.col("id").cast("string").alias("_vertexId"), "name", "balance")
    empty = Space("renamed").with_table(label, held.limit(0))
    return mutate_vertices(empty, "person", renamed, VertexWrite("id")).table(VERTEX, "person")


QUERIES = {
    f.__name__: f
    for f in (
        scan_vertices_all,
        scan_vertices_cols,
        scan_vertices_nocol,
        scan_edges_all,
        scan_edges_cols,
        scan_edges_nocol,
        scan_generic,
        scan_count,
        scan_filter,
        scan_pruned,
        scan_null_values,
        label_profile,
        label_kind,
        vid_type_check,
        part_counts,
        scan_part_assignment,
        source_csv,
        source_json,
        rename_props,
    )
}


def _profile_sql() -> str:
    parts = []
    for kind, props_of, source in ((VERTEX, TAGS, sql.tag), (EDGE, EDGES, sql.edge)):
        for name, props in props_of.items():
            for p, t in (props or {None: None}).items():
                prop = f"'{p}'" if p else "NULL"
                nulls = f"count(*) - count({p})" if p else "0"
                parts.append(
                    f"SELECT '{kind}' AS kind, '{name}' AS label, {prop}::VARCHAR AS property,"
                    f" {repr(t) if t else 'NULL'}::VARCHAR AS property_type, count(*) AS n_rows,"
                    f" ({nulls})::BIGINT AS n_nulls FROM ({source(name)})"
                )
    return " UNION ALL ".join(parts)


def _kind_sql() -> str:
    names = [(n, VERTEX) for n in TAGS] + [(n, EDGE) for n in EDGES]
    known = ", ".join(f"('{n}', '{k}')" for n, k in names)
    asked = ", ".join(f"('{n}')" for n, _ in names)
    return (
        "SELECT label, kind FROM (SELECT o_orderpriority AS label FROM orders"
        " UNION SELECT event_type FROM events"
        f" UNION ALL SELECT * FROM (VALUES {asked}) a(label))"
        f" LEFT JOIN (VALUES {known}) k(label, kind) USING (label)"
    )


def _vid_type_sql() -> str:
    ids = [f"SELECT _vertexId AS id FROM ({sql.tag(n, [])})" for n in TAGS]
    for n in EDGES:
        ids.append(f"SELECT unnest([_srcId, _dstId]) AS id FROM ({sql.edge(n, [])})")
    int_ids = (
        "SELECT c_custkey::VARCHAR AS id FROM customer"
        " UNION ALL SELECT unnest([o_custkey::VARCHAR, o_orderkey::VARCHAR]) FROM orders"
    )
    checked = (
        "CASE WHEN bool_and(regexp_full_match(id, '-?[0-9]+')) THEN 'INT' ELSE 'STRING' END"
        " AS vid_type, count(*) AS n_ids"
    )
    return (
        f"SELECT 'demo' AS space, {checked} FROM ({' UNION ALL '.join(ids)})"
        f" UNION ALL SELECT 'demo_int' AS space, {checked} FROM ({int_ids})"
    )


_PART = "(" + sql.hash60("{key}") + " % 10 + 1)::BIGINT AS part"

ORACLE = {
    "scan_vertices_all": sql.tag("orders"),
    "scan_vertices_cols": sql.tag("orders", ["o_totalprice", "o_orderstatus"]),
    "scan_vertices_nocol": sql.tag("orders", []),
    "scan_edges_all": sql.edge("did"),
    "scan_edges_cols": sql.edge("did", ["value"]),
    "scan_edges_nocol": sql.edge("did", []),
    "scan_generic": sql.tag("part", ["p_name", "p_size"]),
    "scan_count": "SELECT count(*) AS n_rows FROM events",
    "scan_filter": f"SELECT * FROM ({sql.tag('orders')})"
    " WHERE o_totalprice > 250000 AND o_orderstatus = 'F'",
    "scan_pruned": "SELECT 't' || event_type AS _dstId, value FROM events",
    "scan_null_values": typed_sql("read", nulls=True),
    "label_profile": _profile_sql(),
    "label_kind": _kind_sql(),
    "vid_type_check": _vid_type_sql(),
    "part_counts": "SELECT part, count(*) AS n_rows FROM (SELECT "
    + _PART.format(key="_srcId || '|' || _dstId || '|' || _rank")
    + f" FROM ({sql.edge('did', [])})) GROUP BY part",
    "scan_part_assignment": f"SELECT ((part - 1) % {N_TASKS} + 1)::BIGINT AS task, part,"
    " count(*) AS n_rows FROM (SELECT "
    + _PART.format(key="_vertexId")
    + f" FROM ({sql.tag('orders', [])})) GROUP BY part",
    "source_csv": sql.tag("orders"),
    "source_json": sql.edge("did"),
    "rename_props": "SELECT c_custkey::VARCHAR AS _vertexId, c_name AS name,"
    " c_acctbal AS balance FROM customer",
}
