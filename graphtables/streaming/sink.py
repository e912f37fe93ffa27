"""A stream of change rows applied to a stored space."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from graphtables.model import VERTEX
from graphtables.operators.mutate import edge_ids, vertex_ids
from graphtables.sources.store import Store

_STORE = "spark.sql.streaming.stateStore."
#: How the state of a stream is kept where the session does not say: on the executors' disks, as one row per key outgrows their
#: heaps; what is in memory is bounded for an executor, a batch adds to a log, and rows are not looked up to be counted.
STATE = {
    f"{_STORE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}rocksdb.trackTotalNumberOfRows": "false",
}


def latest_changes(changes: DataFrame, kind: str, vid_type: str, how) -> DataFrame:
    """Of the rows of a key that a stream has brought so far the last by ``how.order_by``.

    The state of the stream holds that row for every key, so a row that arrives late does not win over a newer one
    of an earlier batch. To be written in update mode: a batch has the keys that it met, each with its winner.
    Ties are decided by the whole row. A row without a usable key stands for itself and its like.

    An insert if absent is refused: its first row would have to be taken back once an earlier one arrives.
    """
    if how.mode == "insert" and not how.overwrite:
        raise ValueError("an insert if absent has no order over batches")
    keys, raw, reason = (vertex_ids if kind == VERTEX else edge_ids)(how, vid_type)
    group = [F.coalesce(c.cast("string"), F.lit("")).alias(f"_key{i}") for i, c in enumerate(keys.values())]
    group += [F.when(reason.isNotNull(), F.coalesce(c.cast("string"), F.lit(""))).alias(f"_raw{i}") for i, c in enumerate(raw.values())]
    row = F.struct(*how.order_by, *[c for c in changes.columns if c not in how.order_by])
    return changes.groupBy(*group).agg(F.max(row).alias("_row")).select("_row.*").select(*changes.columns)


def mutate_from_stream(
    store: Store,
    changes: DataFrame,
    stream: str,
    kind: str,
    label: str | None,
    how,
    fold_every: int = 0,
    across_batches: bool = False,
) -> DataStreamWriter:
    """A writer that logs each micro-batch under its number and folds every ``fold_every``-th.

    Logging costs as much as the batch, whatever the size of the table, and so does a fold, which keeps a delta. A batch that is
    replayed replaces its own log entry, or is skipped when a version holds it already. With 0 the caller
    folds, for example once after ``availableNow``.

    A later batch wins over an earlier one. With ``across_batches`` the order of ``how.order_by`` holds
    over all batches instead (see :func:`latest_changes`), for a state of one row per key. The settings of STATE that the
    session does not have are made in it, as the query takes them from there when it starts.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        # the id of the query lives in its checkpoint: with a new one the batch numbers start anew
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        store.log_changes(stream, batch_id, batch, query)
        if fold_every and (batch_id + 1) % fold_every == 0:
            store.fold(stream, kind, label, how)

    if across_batches:
        for name, value in STATE.items():
            if store.spark.conf.get(name, None) is None:
                store.spark.conf.set(name, value)
        changes = latest_changes(changes, kind, store.space.vid_type, how)
        return changes.writeStream.outputMode("update").foreachBatch(take)
    return changes.writeStream.foreachBatch(take)
