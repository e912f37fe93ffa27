"""Micro-batch reads of a label: from the parquet files that arrive in a folder, or from the versions of a store."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from graphtables.model import EDGE, VERTEX, Label, Space
from graphtables.sources.scan import scan
from graphtables.sources.store import Store, Version


def _stream(spark, path, label: Label, cols, no_column, schema, files_per_batch) -> DataFrame:
    reader = spark.readStream.schema(schema or label.scan_schema())
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    space = Space("stream").with_table(label, reader.parquet(path))
    return scan(space, label.kind, label.name, cols, no_column)


def stream_vertices(
    spark: SparkSession,
    path: str,
    label: Label,
    cols=(),
    no_column: bool = False,
    schema: T.StructType | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The rows of a vertex label as they arrive; columns as in a scan."""
    if label.kind != VERTEX:
        raise ValueError(f"{label.name} is no vertex label")
    return _stream(spark, path, label, cols, no_column, schema, files_per_batch)


def stream_edges(
    spark: SparkSession,
    path: str,
    label: Label,
    cols=(),
    no_column: bool = False,
    schema: T.StructType | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The rows of an edge label as they arrive; columns as in a scan."""
    if label.kind != EDGE:
        raise ValueError(f"{label.name} is no edge label")
    return _stream(spark, path, label, cols, no_column, schema, files_per_batch)


def stream_changes(
    store: Store, kind: str, label: str, handle: Callable[[DataFrame, int], None], versions_per_batch: int = 1
) -> DataStreamWriter:
    """A writer that hands each version's changes of a stored label to ``handle(changes, batch number)``, version after version.

    What streams are the version files; which of them were read is kept in the checkpoint of the query, so a restart goes on after the last
    version that was handled. Rows are as :meth:`Store.changes_of` gives them. A version that
    did not change the label, or only merged its deltas, gives nothing. A file that is not whole yet ends the query, and
    the restarted one reads it again.
    """
    text = store.spark.readStream.option("wholetext", True).option("maxFilesPerTrigger", versions_per_batch)
    files = text.text(f"{store.root}/versions")

    def take(batch: DataFrame, batch_id: int) -> None:
        # one line per version, and no more of them than versions_per_batch
        versions = sorted((Version(**json.loads(r[0])) for r in batch.collect()), key=lambda v: v.number)
        changes = [c for c in (store.changes_of(v, kind, label) for v in versions) if c is not None]
        if changes:
            handle(reduce(DataFrame.unionByName, changes), batch_id)

    return files.writeStream.foreachBatch(take)
