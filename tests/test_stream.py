import pytest

from graphtables.model import EDGE, VERTEX, EdgeWrite, Label, Space
from graphtables.operators.mutate import mutate_edges
from graphtables.plans import streams
from graphtables.sources.scan import scan, scan_edges
from graphtables.sources.store import Store
from graphtables.streaming import mutate_from_stream, stream_changes, stream_edges, stream_vertices
from tests.fixtures import rows

LINK = Label("link", EDGE, {"w": "DOUBLE", "note": "STRING"})
HELD = [("1", "2", 0, 0.5, "a"), ("2", "3", 0, 1.5, "b")]
SCHEMA = "a string, b string, w double, note string, seq int"
FILES = [
    [("1", "2", 9.0, "x", 1), ("5", "6", 1.0, None, 2)],
    [("1", "2", 8.0, "y", 3), ("7", "8", 2.0, "z", 4)],
    [("5", "6", 3.0, "w", 5)],
]


@pytest.fixture
def space(spark):
    table = spark.createDataFrame(
        HELD, "_srcId string, _dstId string, _rank bigint, w double, note string"
    )
    return Space("s").with_table(LINK, table)


def arrivals(spark, tmp_path):
    folder = str(tmp_path / "in")
    for part in FILES:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return folder


def drain(spark, store, folder, how, progress, fold_every=0):
    changes = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    query = (
        mutate_from_stream(store, changes, "feed", EDGE, "link", how, fold_every)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


@pytest.mark.parametrize(
    "more", [{}, {"overwrite": False}, {"mode": "update"}, {"mode": "delete"}], ids=str
)
def test_stream_is_batch(spark, space, tmp_path, more):
    how = EdgeWrite("a", "b", order_by=("seq",), **more)
    store = Store(spark, str(tmp_path / "space"), space)
    store.save_space(space)
    folder = arrivals(spark, tmp_path)
    progress = str(tmp_path / "progress")
    drain(spark, store, folder, how, progress)
    # Nothing is visible before the fold.
    assert rows(scan(store.read(), EDGE, "link")) == HELD
    store.fold("feed", EDGE, "link", how)
    every = spark.createDataFrame([r for part in FILES for r in part], SCHEMA)
    wanted = rows(mutate_edges(space, "link", every, how).table(EDGE, "link"))
    assert rows(scan(store.read(), EDGE, "link")) == wanted
    # A stream that lost its progress counts its batches anew: it is told so, and nothing changes.
    number = store.current().number
    with pytest.raises(Exception, match="belongs to query"):
        drain(spark, store, folder, how, str(tmp_path / "progress2"))
    store.fold("feed", EDGE, "link", how)
    assert rows(scan(store.read(), EDGE, "link")) == wanted and store.current().number == number


def test_fold_as_it_goes(spark, space, tmp_path):
    how = EdgeWrite("a", "b", order_by=("seq",))
    store = Store(spark, str(tmp_path / "space"), space)
    store.save_space(space)
    drain(spark, store, arrivals(spark, tmp_path), how, str(tmp_path / "progress"), fold_every=2)
    assert store.current().number == 2 and store.current().folded == {"feed": 1}
    assert store.pending("feed")[1] == 2


def test_stream_scan(spark, space, tmp_path):
    folder, out = str(tmp_path / "edges"), str(tmp_path / "out")
    scan_edges(space, "link").write.parquet(folder)
    stream = stream_edges(spark, folder, LINK, ["note"])
    assert stream.isStreaming and stream.columns == ["_srcId", "_dstId", "_rank", "note"]
    query = (
        stream.writeStream.option("checkpointLocation", str(tmp_path / "p"))
        .trigger(availableNow=True)
        .start(out, format="parquet")
    )
    query.awaitTermination()
    assert rows(spark.read.schema(stream.schema).parquet(out)) == rows(scan_edges(space, "link", ["note"]))
    with pytest.raises(ValueError):
        stream_vertices(spark, folder, LINK)


def test_stream_of_vertices_as_files_hold_them(spark, tmp_path):
    tag = Label("day", VERTEX, {"at": "DATETIME", "n": "INT8"})
    folder = str(tmp_path / "days")
    held = spark.sql("SELECT 'a' AS _vertexId, timestamp'2021-01-01 12:00:00' AS at, 1 AS n")
    held.write.parquet(folder)
    stream = stream_vertices(spark, folder, tag, ["at"], schema=held.schema, files_per_batch=1)
    query = stream.writeStream.format("memory").queryName("days").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.table("days")) == [("a", "2021-01-01T12:00:00.000")]
    assert stream_vertices(spark, folder, tag, no_column=True, schema=held.schema).columns == ["_vertexId"]


@pytest.mark.parametrize("mode", ["insert", "update"])
def test_order_over_batches(spark, space, tmp_path, mode):
    """Files arrive in the reverse order of their rows; the rows' own order decides."""
    how = EdgeWrite("a", "b", order_by=("seq",), mode=mode)
    store = Store(spark, str(tmp_path / "space"), space)
    store.save_space(space)
    folder = str(tmp_path / "in")
    for part in reversed(FILES):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    changes = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    query = (
        mutate_from_stream(store, changes, "feed", EDGE, "link", how, across_batches=True)
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    store.fold("feed", EDGE, "link", how)
    every = spark.createDataFrame([r for part in FILES for r in part], SCHEMA)
    assert rows(scan(store.read(), EDGE, "link")) == rows(mutate_edges(space, "link", every, how).table(EDGE, "link"))
    absent = EdgeWrite("a", "b", order_by=("seq",), overwrite=False)
    with pytest.raises(ValueError, match="no order over batches"):
        mutate_from_stream(store, changes, "other", EDGE, "link", absent, across_batches=True)


def test_changes_of_a_stored_label_as_a_stream(spark, space, tmp_path):
    store = Store(spark, str(tmp_path / "space"), space)
    store.save_space(space)
    seen = []

    def follow():
        take = lambda df, n: seen.append(sorted((r["_version"], r["_whole"], r["_gone"], r["_srcId"], r["w"]) for r in df.collect()))
        query = stream_changes(store, EDGE, "link", take).option("checkpointLocation", str(tmp_path / "p")).trigger(availableNow=True).start()
        query.awaitTermination()

    follow()
    assert seen == [[(1, True, False, "1", 0.5), (1, True, False, "2", 1.5)]]
    store.apply(EDGE, "link", spark.createDataFrame([("1", "2", 7.0)], "a string, b string, w double"), EdgeWrite("a", "b"))
    store.apply(EDGE, "link", spark.createDataFrame([("2", "3")], "a string, b string"), EdgeWrite("a", "b", mode="delete"))
    store.compact(EDGE, "link")
    follow()
    # after what was read already; a merge of deltas is no change
    assert seen[1:] == [[(2, False, False, "1", 7.0)], [(3, False, True, "2", None)]]
    follow()
    assert len(seen) == 3


def test_batches_are_as_many_files_as_their_rows_ask_for(spark, sf_dir, monkeypatch):
    whole = {name: rows(streams.QUERIES[name](spark, sf_dir)) for name in ("stream_insert_edges", "stream_latest_edges", "stream_scan_edges")}
    per_batch = []
    count = streams.files_per_batch
    monkeypatch.setattr(streams, "FILE_ROWS", 100)
    monkeypatch.setattr(streams, "files_per_batch", lambda df: per_batch.append(count(df)) or per_batch[-1])
    for name, expected in whole.items():
        assert rows(streams.QUERIES[name](spark, sf_dir)) == expected
    assert len(per_batch) == 3 and min(per_batch) > 1


def test_state_over_batches_is_not_held_in_the_heap(spark, space, tmp_path):
    how = EdgeWrite("a", "b", order_by=("seq",))
    store = Store(spark, str(tmp_path / "space"), space)
    changes = spark.readStream.schema(SCHEMA).parquet(arrivals(spark, tmp_path))
    mutate_from_stream(store, changes, "feed", EDGE, "link", how, across_batches=True)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")
