"""The streams, run to the end of what has arrived."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphtables.model import EDGE, EDGE_KEY, EdgeWrite
from graphtables.operators.mutate import latest_per_key
from graphtables.plans import mutations, sql, stored
from graphtables.plans.demo import CONTAINS_ORDER, demo_space
from graphtables.session import scratch_path
from graphtables.sources.scan import scan
from graphtables.sources.store import Store
from graphtables.streaming import mutate_from_stream, stream_changes, stream_edges

#: Batches in which the rows of a stream arrive.
N_FILES = 4
#: Rows of an arriving file, about: a batch is as many files as its rows ask for, since one file keeps few tasks busy.
FILE_ROWS = 250_000


def files_per_batch(rows) -> int:
    return max(1, -(-rows.count() // (N_FILES * FILE_ROWS)))


def stream_scan_edges(spark, sf_dir):
    """Events that arrive as files, read as edges in micro-batches."""
    space = demo_space(spark, sf_dir, "did")
    arrivals = scratch_path(spark, "arrivals")
    rows = space.frame(EDGE, "did")
    per_batch = files_per_batch(rows)
    rows.repartition(N_FILES * per_batch, *EDGE_KEY).write.parquet(arrivals)
    stream = stream_edges(
        spark, arrivals, space.label(EDGE, "did"), ["ts", "value"], schema=rows.schema, files_per_batch=per_batch
    )
    out = scratch_path(spark, "out")
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, "progress"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def stream_insert_edges(spark, sf_dir):
    """Order lines that arrive in files, each logged as a batch, then folded into the table."""
    space = demo_space(spark, sf_dir, "contains")
    store = Store(spark, scratch_path(spark, "space"), space)
    store.write({(EDGE, "contains"): scan(space, EDGE, "contains")})
    arrivals = scratch_path(spark, "arrivals")
    feed = mutations.line_feed(spark, sf_dir)
    # All rows of one key arrive in one file, so that the last one does not hang on the files' order.
    per_batch = files_per_batch(feed)
    feed.repartition(N_FILES * per_batch, *mutations.LINE_ID).write.parquet(arrivals)
    changes = (
        spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", per_batch).parquet(arrivals)
    )
    how = EdgeWrite(*mutations.LINE_ID, order_by=tuple(CONTAINS_ORDER))
    query = (
        mutate_from_stream(store, changes, "lines", EDGE, "contains", how)
        .option("checkpointLocation", scratch_path(spark, "progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    store.fold("lines", EDGE, "contains", how)
    return scan(store.read(), EDGE, "contains")


def stream_latest_edges(spark, sf_dir):
    """The same lines as they fall, so that rows of one key arrive in several files: the order of the rows decides, not that of the files."""
    space = demo_space(spark, sf_dir, "contains")
    store = Store(spark, scratch_path(spark, "space"), space)
    store.write({(EDGE, "contains"): scan(space, EDGE, "contains")})
    arrivals = scratch_path(spark, "arrivals")
    feed = mutations.line_feed(spark, sf_dir)
    # files by the columns that order the rows, last ones first
    per_batch = files_per_batch(feed)
    feed.repartitionByRange(N_FILES * per_batch, *[F.col(c).desc() for c in CONTAINS_ORDER]).write.parquet(arrivals)
    changes = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", per_batch).parquet(arrivals)
    how = EdgeWrite(*mutations.LINE_ID, order_by=tuple(CONTAINS_ORDER))
    query = (
        mutate_from_stream(store, changes, "lines", EDGE, "contains", how, across_batches=True)
        .option("checkpointLocation", scratch_path(spark, "progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    store.fold("lines", EDGE, "contains", how)
    return scan(store.read(), EDGE, "contains")


def stream_stored_edges(spark, sf_dir):
    """The changes that three versions of a stored label made, read as a stream, and what they come to."""
    store = stored.changed_lines(spark, sf_dir)
    out = scratch_path(spark, "out")
    query = (
        stream_changes(store, EDGE, "contains", lambda changes, n: changes.write.mode("overwrite").parquet(f"{out}/batch={n}"))
        .option("checkpointLocation", scratch_path(spark, "progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    last = latest_per_key(spark.read.parquet(out), EDGE_KEY, ["_version"], few=True)  # a version has a key once
    return last.filter("NOT _gone").select(*scan(store.read(), EDGE, "contains").columns)


QUERIES = {f.__name__: f for f in (stream_scan_edges, stream_insert_edges, stream_latest_edges, stream_stored_edges)}

ORACLE = {
    "stream_scan_edges": sql.edge("did", ["ts", "value"]),
    "stream_insert_edges": mutations.ORACLE["insert_edges_overwrite"],
    "stream_latest_edges": mutations.ORACLE["insert_edges_overwrite"],
    "stream_stored_edges": stored.ORACLE["stored_edges_deltas"],
}
