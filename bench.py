"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run to a sink that keeps nothing, once to warm up and then ``BENCH_RUNS`` times;
the best counts. ``rows_per_sec`` counts the rows of the table a query reads or writes.

``bulk_rows_per_sec`` measures what the published figures measure, on about ``BENCH_BULK_ROWS``
rows made of copies of the orders and events: reading a stored label with no and with all
properties, and inserting a file of rows into it.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from graphtables.model import EDGE, EDGE_KEY, VERTEX, VERTEX_KEY, EdgeWrite, Space, VertexWrite
from graphtables.plans import registry
from graphtables.plans.demo import demo_space
from graphtables.session import scratch_path, session
from graphtables.sources.scan import scan
from graphtables.sources.store import Store

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))
BULK_ROWS = int(os.environ.get("BENCH_BULK_ROWS", "5000000"))

# The queries and the driver table whose rows they are measured by.
HEADLINE = {
    "scan_vertices_nocol": "orders",
    "scan_vertices_all": "orders",
    "scan_edges_nocol": "events",
    "scan_edges_all": "events",
    "scan_filter": "orders",
    "label_profile": "lineitem",
    "escape_text": "documents",
    "property_literal": "events",
    "insert_vertices_overwrite": "lineitem",
    "update_vertices": "lineitem",
    "delete_vertices_with_edges": "lineitem",
    "insert_edges_overwrite": "lineitem",
    "insert_edges_if_absent": "lineitem",
    "update_edges": "lineitem",
    "delete_edges": "lineitem",
    "mutation_rejects": "events",
    "render_insert_vertices": "orders",
    "render_insert_edges": "lineitem",
    "render_delete_vertices": "lineitem",
    "fetch_edges": "lineitem",
    "subgraph_edges": "lineitem",
    "all_paths_edges": "lineitem",
    "flatten_edges": "lineitem",
    "export_edges": "orders",
    "graph_triplets": "orders",
    "stream_insert_edges": "lineitem",
}


def timed(query, spark) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def seconds_of(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def bulk_label(spark, kind: str, name: str, key: list[str], write) -> dict[str, int]:
    """Rows per second of inserting copies of a label into an empty table, of as many rows more into the filled one, and of
    reading it; and the seconds that a change of ten rows takes then."""
    source = demo_space(spark, SF_DIR, name)
    rows = scan(source, kind, name)
    copies = max(1, BULK_ROWS // rows.count())
    first = key[0]
    feed = rows.repartition(4 * int(CPUS)).withColumn(
        first, F.explode(F.transform(F.sequence(F.lit(1), F.lit(copies)), lambda i: F.concat(first, F.lit("-"), i)))
    )
    path = scratch_path(spark, "feed")
    feed.write.parquet(path)
    feed = spark.read.schema(feed.schema).parquet(path)
    label = source.label(kind, name)
    empty = Space("bulk", n_parts=int(CPUS)).with_table(label, rows.limit(0), as_read=True)
    store = Store(spark, scratch_path(spark, "bulk"), empty)
    store.save_space(empty)
    n = feed.count()
    took = {"insert": seconds_of(lambda: store.apply(kind, name, feed, write))}
    for what, no_column in (("no_property", True), ("all_properties", False)):
        df = scan(store.read(), kind, name, no_column=no_column)
        sink = df.write.format("noop").mode("overwrite")
        took[f"read_{what}"] = min(seconds_of(sink.save) for _ in range(2))
    more = feed.withColumn(first, F.concat(F.lit("m"), first))
    took["insert_into_filled"] = seconds_of(lambda: store.apply(kind, name, more, write))
    few = more.limit(10)
    small = seconds_of(lambda: store.apply(kind, name, few, write))
    return {**{f"{kind}_{what}": round(n / t) for what, t in took.items()}, f"{kind}_insert_of_ten_sec": round(small, 3)}


def bulk(spark) -> dict[str, int]:
    if not BULK_ROWS:
        return {}
    return {
        **bulk_label(spark, VERTEX, "orders", VERTEX_KEY, VertexWrite("_vertexId")),
        **bulk_label(spark, EDGE, "did", EDGE_KEY, EdgeWrite(*EDGE_KEY)),
    }


def main() -> None:
    spark = session(
        "graphtables-bench",
        f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    only = sys.argv[1:] or list(HEADLINE)
    counts = {}
    seconds, rates = {}, {}
    for name in only:
        source = HEADLINE.get(name)
        timed(queries[name], spark)
        best = min(timed(queries[name], spark) for _ in range(RUNS))
        seconds[name] = round(best, 3)
        if source:
            if source not in counts:
                counts[source] = spark.read.parquet(f"{SF_DIR}/{source}.parquet").count()
            rates[name] = round(counts[source] / best)
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "bulk_rows_per_sec": {} if sys.argv[1:] else bulk(spark),
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
