import re

import pyarrow.parquet as pq
import pytest

from graphtables.model import EDGE, VERTEX, EdgeWrite, Label, Space, VertexWrite
from graphtables.operators.mutate import mutate_vertices, part_of_key
from graphtables.sources.profile import label_profile
from graphtables.sources.scan import scan
from graphtables.sources.store import FEW_KEYS, Store, Version, save, write_options
from tests.fixtures import rows

TAG = Label("thing", VERTEX, {"name": "STRING"})
LINK = Label("link", EDGE, {"w": "DOUBLE"})


@pytest.fixture
def store(spark, tmp_path):
    space = (
        Space("s")
        .with_table(TAG, spark.createDataFrame([("1", "a"), ("2", "b")], "_vertexId string, name string"))
        .with_table(
            LINK,
            spark.createDataFrame([("1", "2", 0, 0.5)], "_srcId string, _dstId string, _rank bigint, w double"),
        )
    )
    store = Store(spark, str(tmp_path / "space"), space)
    store.save_space(space)
    return store


def things(store, version=None):
    return rows(scan(store.read(version), VERTEX, "thing"))


def test_empty_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "none"), Space("s"))
    assert store.current() == Version() and not store.read().labels


def test_versions(spark, store):
    first = store.current()
    ch = spark.createDataFrame([("2", "B"), ("3", "c")], "id string, name string")
    store.apply(VERTEX, "thing", ch, VertexWrite("id"))
    assert things(store) == [("1", "a"), ("2", "B"), ("3", "c")]
    # The old version can still be read, and the other label was not written again.
    assert things(store, first) == [("1", "a"), ("2", "b")]
    now = store.current()
    assert now.number == first.number + 1
    assert now.tables["edge/link"] == first.tables["edge/link"]
    assert store.read().label(VERTEX, "thing") == TAG


def test_delete_with_edges_switches_all_labels_at_once(spark, store):
    ch = spark.createDataFrame([("2",)], "id string")
    m = store.apply(VERTEX, None, ch, VertexWrite("id", mode="delete", delete_edge=True))
    assert things(store) == [("1", "a")] and m.rejects.isEmpty()
    assert scan(store.read(), EDGE, "link").isEmpty()
    assert store.current().number == 2


def test_a_run_that_dies_leaves_the_old_version(spark, store, monkeypatch):
    ch = spark.createDataFrame([("3", "c")], "id string, name string")

    def die(version):
        raise KeyboardInterrupt

    monkeypatch.setattr(store, "_commit", die)
    with pytest.raises(KeyboardInterrupt):
        store.apply(VERTEX, "thing", ch, VertexWrite("id"))
    monkeypatch.undo()
    assert things(store) == [("1", "a"), ("2", "b")]
    store.apply(VERTEX, "thing", ch, VertexWrite("id"))
    assert len(things(store)) == 3


def test_two_writers(store):
    old = store.current()
    store._commit(Version(old.number + 1, old.tables))
    with pytest.raises(RuntimeError, match="another writer"):
        store._commit(Version(old.number + 1, old.tables))


def test_a_writer_that_started_earlier_loses_nothing(spark, store, monkeypatch):
    """Another writer commits between the read of a version and the commit upon it."""
    one = Store(spark, store.root, store.space)
    ch = lambda k: spark.createDataFrame([(k, k)], "id string, name string")
    read = one.read

    def read_and_wait(version=None):
        space = read(version)
        store.apply(VERTEX, "thing", ch("3"), VertexWrite("id"))
        return space

    monkeypatch.setattr(one, "read", read_and_wait)
    with pytest.raises(RuntimeError, match="another writer"):
        one.apply(VERTEX, "thing", ch("4"), VertexWrite("id"))
    monkeypatch.undo()
    one.apply(VERTEX, "thing", ch("4"), VertexWrite("id"))
    assert things(store) == [("1", "a"), ("2", "b"), ("3", "3"), ("4", "4")]


def test_a_version_file_that_is_not_whole_is_no_version(spark, store):
    with open(f"{store.root}/versions/{2:012d}.json", "w") as f:
        f.write('{"number": 2, "tab')
    assert store.current().number == 1 and len(things(store)) == 2


def test_batches_with_more_columns(spark, tmp_path):
    label = Label("thing", VERTEX, {"name": "STRING", "size": "INT32"})
    space = Space("s").with_table(label, spark.createDataFrame([("1", "a", 5)], "_vertexId string, name string, size int"))
    for mode, wanted in (("insert", [("1", "b", None), ("2", "c", 7)]), ("update", [("1", "b", 5)])):
        store = Store(spark, str(tmp_path / mode), space)
        store.save_space(space)
        how = VertexWrite("id", mode=mode)
        store.log_changes("feed", 0, spark.createDataFrame([("1", "b")], "id string, name string"))
        store.log_changes("feed", 1, spark.createDataFrame([("2", "c", 7)], "id string, name string, size int"))
        merged = store.merged("feed", VERTEX, "thing", how)
        assert rows(merged.table(VERTEX, "thing")) == wanted
        assert merged.rejects.count() == (mode == "update")
        store.fold("feed", VERTEX, "thing", how)
        assert rows(scan(store.read(), VERTEX, "thing")) == wanted
        # what is folded is cleared away
        assert not [n for n in store._names("changes/feed") if n.startswith("_batch")]


def test_another_query_may_not_go_back(spark, store):
    ch = spark.createDataFrame([("3", "c")], "id string, name string")
    store.log_changes("feed", 0, ch, "q1")
    store.log_changes("feed", 1, ch, "q1")
    with pytest.raises(ValueError, match="belongs to query q1"):
        store.log_changes("feed", 0, ch, "q2")


def test_save_with_options(spark, store):
    ch = spark.createDataFrame([("2", "B"), ("3", "c")], "_vertexId string, name string")
    options = {"type": "vertex", "spaceName": "s", "label": "thing", "vertexField": "_vertexId"}
    save(store, ch, options)
    assert things(store) == [("1", "a"), ("2", "B"), ("3", "c")]
    save(store, ch.select("_vertexId"), {**options, "writeMode": "DELETE", "deleteEdge": "true"})
    assert things(store) == [("1", "a")]
    assert scan(store.read(), EDGE, "link").isEmpty()
    edges = spark.createDataFrame([("a", "b", 1.0)], "x string, y string, w double")
    edge_options = {
        "type": "edge",
        "spaceName": "s",
        "label": "link",
        "srcVertexField": "x",
        "dstVertexField": "y",
        "rankField": "",
        "srcPolicy": "",
        "dstPolicy": "",
        "batch": 100,
    }
    save(store, edges, edge_options)
    assert rows(scan(store.read(), EDGE, "link")) == [("a", "b", 0, 1.0)]
    for wrong in ({"spaceName": "other"}, {"label": ""}, {"type": "tag"}, {"writeMode": "merge"}):
        with pytest.raises(ValueError):
            save(store, edges, {**edge_options, **wrong})


def test_stored_dates_can_be_filtered_in_the_files(spark, tmp_path, int_graph):
    store = Store(spark, str(tmp_path / "people"), int_graph)
    store.save_space(int_graph)
    people = scan(store.read(), VERTEX, "person")
    assert rows(people) == rows(scan(int_graph, VERTEX, "person"))
    late = people.filter("col8 >= '1994-07-14T00:00:00.000'").select("_vertexId")
    text = late._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(col8,1994-07-14T00:00:00.000)" in text
    assert late.count() == 6
    ids = people.filter("_vertexId = '3'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(_vertexId,3)" in ids


def test_write_options():
    how = write_options(
        {
            "type": "edge",
            "srcVertexField": "a",
            "dstVertexField": "b",
            "rankField": "r",
            "rankAsProp": "true",
            "overwrite": "false",
            "srcPolicy": "hash",
            "writeMode": "insert",
        }
    )
    assert how == EdgeWrite(
        "a", "b", "r", rank_as_prop=True, overwrite=False, src_policy="hash", batch=1000
    )
    with pytest.raises(ValueError):
        write_options({"type": "vertex", "vertexField": "id", "writeMode": "update", "batch": "513"})
    with pytest.raises(ValueError):
        write_options({"type": "vertex"})
    assert write_options({"type": "vertex", "vertexField": "id"}).batch == 1000
    assert write_options({"type": "vertex", "vertexField": "id", "writeMode": "update"}).batch == 512


def test_logged_batches(spark, store):
    schema = "id string, name string, seq int"
    how = VertexWrite("id", order_by=("seq",))
    assert store.merged("feed", VERTEX, "thing", how) is None
    store.log_changes("feed", 0, spark.createDataFrame([("2", "old", 9), ("3", "c", 1)], schema))
    store.log_changes("feed", 1, spark.createDataFrame([("2", "new", 1)], schema))
    # A later batch wins whatever the order inside it, and reading merged writes nothing.
    merged = store.merged("feed", VERTEX, "thing", how).table(VERTEX, "thing")
    assert rows(merged) == [("1", "a"), ("2", "new"), ("3", "c")]
    assert store.current().number == 1
    # The same batch once more replaces itself.
    store.log_changes("feed", 1, spark.createDataFrame([("2", "newer", 1)], schema))
    assert store.fold("feed", VERTEX, "thing", how).folded == {"feed": 1}
    assert things(store) == [("1", "a"), ("2", "newer"), ("3", "c")]
    # A replay of a folded batch changes nothing, and neither does another fold.
    store.log_changes("feed", 0, spark.createDataFrame([("2", "old", 9)], schema))
    assert store.fold("feed", VERTEX, "thing", how).number == 2
    store.log_changes("feed", 2, spark.createDataFrame([("1", "z", 0)], schema))
    store.fold("feed", VERTEX, "thing", how)
    assert things(store) == [("1", "z"), ("2", "newer"), ("3", "c")]


# --- parts and deltas -------------------------------------------------------------------------

WIDE = Label("wide", VERTEX, {"name": "STRING", "size": "INT64"})


def filled(spark, tmp_path, n=5000, n_parts=8, **kwargs):
    rows_of = spark.range(n).selectExpr("cast(id AS string) AS _vertexId", "repeat(md5(cast(id AS string)), 4) AS name", "id AS size")
    links = spark.range(n).selectExpr("cast(id AS string) AS _srcId", "cast((id * 7) % 5000 AS string) AS _dstId", "0L AS _rank", "1.5D AS w")
    space = Space("s", n_parts=n_parts).with_table(WIDE, rows_of, as_read=True).with_table(LINK, links, as_read=True)
    store = Store(spark, str(tmp_path / "filled"), space, **kwargs)
    store.save_space(space)
    return store


def written(store, before):
    """The paths that the newest version names and ``before`` did not: of parts, and of deltas."""
    def paths(version, what):
        out = set()
        for entry in version.tables.values():
            held = entry[what]
            out |= {x["path"] for x in (held.values() if isinstance(held, dict) else held)}
        return out

    now = store.current()
    return [paths(now, what) - paths(before, what) for what in ("parts", "deltas")]


def bytes_below(path):
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def table(store, kind, name, version=None):
    return rows(scan(store.read(version), kind, name))


def test_rows_lie_in_the_part_of_their_key(spark, tmp_path):
    store = filled(spark, tmp_path, 300)
    entry = store.current().tables["vertex/wide"]
    for n, part in entry["parts"].items():
        held = spark.read.parquet(f"{store.root}/{part['path']}")
        assert {r[0] for r in held.selectExpr("pmod(hash(_vertexId), 8)").distinct().collect()} == {int(n)}
        # the number of shuffle partitions of the tests does not divide by 8, so rows were dealt out: a file or two per part
        assert len(list((tmp_path / "filled" / part["path"]).glob("*.parquet"))) <= 2
    assert sum(spark.read.parquet(f"{store.root}/{p['path']}").count() for p in entry["parts"].values()) == 300


def test_a_small_change_writes_kilobytes_and_a_merge_writes_its_parts(spark, tmp_path):
    store = filled(spark, tmp_path)
    first, whole = store.current(), bytes_below(tmp_path / "filled" / "vertex" / "wide")
    one = spark.createDataFrame([("17", "new", 1)], "id string, name string, size long")
    store.apply(VERTEX, "wide", one, VertexWrite("id"))
    parts, deltas = written(store, first)
    assert not parts and len(deltas) == 1
    assert bytes_below(tmp_path / "filled" / deltas.pop()) < 4000 < whole / 20
    got = table(store, VERTEX, "wide")
    assert len(got) == 5000 and ("17", "new", 1) in got
    store.compact(VERTEX, "wide")
    parts, deltas = written(store, first)
    assert len(parts) == 1 and not deltas
    assert table(store, VERTEX, "wide") == got
    assert len(table(store, VERTEX, "wide", first)) == 5000 and ("17", "new", 1) not in table(store, VERTEX, "wide", first)


@pytest.mark.parametrize("how", [
    VertexWrite("id"), VertexWrite("id", overwrite=False), VertexWrite("id", mode="update"), VertexWrite("id", mode="delete"),
], ids=lambda h: f"{h.mode}-{h.overwrite}")
def test_deltas_give_what_a_rewrite_gives(spark, tmp_path, how):
    store = filled(spark, tmp_path, 400)
    batches = [[("1", "a", 5), ("900", "b", 6), (None, "c", 7)], [("1", "d", 8), ("901", "e", 9), ("2", None, None)], [("900", "f", 1), ("3", "g", 2)]]
    for batch in batches:
        ch = spark.createDataFrame(batch, "id string, name string, size long")
        ch = ch.select("id") if how.mode == "delete" else ch
        wanted = mutate_vertices(store.read(), "wide", ch, how)
        got = store.apply(VERTEX, "wide", ch, how)
        assert table(store, VERTEX, "wide") == rows(wanted.table(VERTEX, "wide")) == rows(got.table(VERTEX, "wide"))
        assert rows(got.rejects) == rows(wanted.rejects)
    # where all keys are there already, nothing is inserted
    assert len(store.current().tables["vertex/wide"]["deltas"]) == (3 if how.overwrite else 2)
    before = table(store, VERTEX, "wide")
    store.compact(VERTEX, "wide")
    assert table(store, VERTEX, "wide") == before and not store.current().tables["vertex/wide"]["deltas"]


def test_a_deleted_key_can_come_back(spark, tmp_path):
    store = filled(spark, tmp_path, 50)
    ch = spark.createDataFrame([("7", "again", 0)], "id string, name string, size long")
    store.apply(VERTEX, "wide", ch.select("id"), VertexWrite("id", mode="delete"))
    assert len(table(store, VERTEX, "wide")) == 49
    m = store.apply(VERTEX, "wide", ch, VertexWrite("id", mode="update"))
    assert rows(m.rejects) == [("7", "no_such_key")]
    store.apply(VERTEX, "wide", ch, VertexWrite("id", overwrite=False))
    assert ("7", "again", 0) in table(store, VERTEX, "wide")


def test_vertices_go_with_their_edges_as_deltas(spark, tmp_path):
    store = filled(spark, tmp_path)
    first = store.current()
    ch = spark.createDataFrame([("14",), ("2",), ("none",)], "id string")
    wanted = mutate_vertices(store.read(), None, ch, VertexWrite("id", mode="delete", delete_edge=True))
    store.apply(VERTEX, None, ch, VertexWrite("id", mode="delete", delete_edge=True))
    parts, deltas = written(store, first)
    assert not parts and len(deltas) == 2
    for kind, name in ((VERTEX, "wide"), (EDGE, "link")):
        assert table(store, kind, name) == rows(wanted.table(kind, name))


def test_large_changes_and_many_deltas_are_merged(spark, tmp_path):
    store = filled(spark, tmp_path, 400, max_deltas=2)
    many = spark.range(3000).selectExpr("cast(id AS string) AS id", "'x' AS name", "id AS size")
    store.apply(VERTEX, "wide", many, VertexWrite("id"))
    assert not store.current().tables["vertex/wide"]["deltas"] and len(table(store, VERTEX, "wide")) == 3000
    for k in range(3):
        store.apply(VERTEX, "wide", spark.createDataFrame([(str(k), "y", k)], "id string, name string, size long"), VertexWrite("id"))
        assert len(store.current().tables["vertex/wide"]["deltas"]) == (k + 1) % 3
    assert {r for r in table(store, VERTEX, "wide") if r[1] == "y"} == {("0", "y", 0), ("1", "y", 1), ("2", "y", 2)}


def test_nothing_to_change(spark, tmp_path):
    store = filled(spark, tmp_path, 30)
    none = spark.createDataFrame([], "id string, name string, size long")
    for how in (VertexWrite("id"), VertexWrite("id", mode="update"), VertexWrite("id", mode="delete", delete_edge=True)):
        m = store.apply(VERTEX, "wide", none, how)
        assert m.rejects.isEmpty() and len(table(store, VERTEX, "wide")) == 30
    assert not store.current().tables["vertex/wide"]["deltas"]


def test_a_fetch_reads_the_parts_of_its_keys(spark, tmp_path):
    store = filled(spark, tmp_path)
    store.apply(EDGE, "link", spark.createDataFrame([("3", "21", 9.5)], "a string, b string, w double"), EdgeWrite("a", "b"))
    keys = spark.createDataFrame([("3", "21", 0), ("3", "22", 0)], "_srcId string, _dstId string, _rank bigint")
    got = store.fetch(EDGE, "link", keys, ["w"])
    assert rows(got) == [("3", "21", 0, 9.5)]
    every = len(scan(store.read(), EDGE, "link").inputFiles())
    assert len(got.inputFiles()) <= every / 2


def ranges(path, column):
    """First and last value of a column in each row group of the files below a folder, as their footers say."""
    out = []
    for file in sorted(path.rglob("*.parquet")):
        meta = pq.read_metadata(file)
        at = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        out.append([(s.min, s.max) for s in stats])
    return out


def test_files_tell_where_a_key_lies(spark, tmp_path):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", "2048")
    try:
        store = filled(spark, tmp_path)
    finally:
        hadoop.unset("parquet.block.size")
    folders = [tmp_path / "filled" / p["path"] for p in store.current().tables["edge/link"]["parts"].values()]
    groups = [g for f in folders for g in ranges(f, "_srcId")]
    assert max(map(len, groups)) > 1
    for own in groups:
        assert all(a[1] <= b[0] for a, b in zip(own, own[1:], strict=False))
    keys = spark.createDataFrame([("3", "21", 0)], "_srcId string, _dstId string, _rank bigint")
    pushed = store.fetch(EDGE, "link", keys)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^]]*(In|EqualTo)\(_srcId", pushed)
    links = scan(store.read(), EDGE, "link")
    many = links.select("_srcId", "_dstId", "_rank").orderBy("_srcId", "_dstId").limit(FEW_KEYS + 1)
    got = store.fetch(EDGE, "link", many, ["w"])
    assert "GreaterThanOrEqual(_srcId" in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == rows(links.join(many, ["_srcId", "_dstId", "_rank"], "left_semi").select(*got.columns))
    none = store.fetch(EDGE, "link", keys.limit(0))
    assert rows(none) == []


def test_a_profile_reads_no_data_but_parts_with_deltas(spark, tmp_path):
    store = filled(spark, tmp_path)
    assert "Scan parquet" not in store.profile()._jdf.queryExecution().executedPlan().toString()
    assert rows(store.profile()) == rows(label_profile(store.read()))
    store.apply(EDGE, "link", spark.createDataFrame([("3", "21", None)], "a string, b string, w double"), EdgeWrite("a", "b"))
    store.apply(VERTEX, "wide", spark.createDataFrame([("5",)], "id string"), VertexWrite("id", mode="delete"))
    assert store.current().tables["edge/link"]["deltas"] and store.current().tables["vertex/wide"]["deltas"]
    assert rows(store.profile()) == rows(label_profile(store.read()))
    assert 0 < len(store.profile().inputFiles()) < len(scan(store.read(), EDGE, "link").inputFiles())
    store.compact(EDGE, "link")
    store.compact(VERTEX, "wide")
    assert "Scan parquet" not in store.profile()._jdf.queryExecution().executedPlan().toString()
    assert rows(store.profile()) == rows(label_profile(store.read()))


def test_a_profile_without_counts_or_rows(spark, tmp_path):
    store = filled(spark, tmp_path)
    old = store.current()
    for entry in old.tables.values():  # as a version from before parts were counted
        for part in entry["parts"].values():
            del part["rows"], part["nulls"]
    assert rows(store.profile(old)) == rows(label_profile(store.read()))
    bare = Space("bare").with_table(Label("dot", VERTEX, {}), spark.createDataFrame([], "_vertexId string"))
    empty = Store(spark, str(tmp_path / "bare"), bare)
    assert rows(empty.profile()) == []
    empty.save_space(bare)
    assert rows(empty.profile()) == rows(label_profile(empty.read())) == [("vertex", "dot", None, None, 0, 0)]


def test_rows_of_parts_are_those_of_the_layout(spark, tmp_path):
    store = filled(spark, tmp_path)
    store.apply(EDGE, "link", spark.createDataFrame([("new", "21", 1.0)], "a string, b string, w double"), EdgeWrite("a", "b"))
    key = LINK.key
    held = {r[0]: r[1] for r in scan(store.read(), EDGE, "link").groupBy(part_of_key(key, 8)).count().collect()}
    assert {r[0]: r[1] for r in store.part_rows(EDGE, "link").collect()} == {n: held.get(n, 0) for n in range(8)}


def test_old_versions_are_cleared(spark, tmp_path):
    store = filled(spark, tmp_path, 200)
    ch = spark.createDataFrame([("5", "n", 0)], "id string, name string, size long")
    store.apply(VERTEX, "wide", ch, VertexWrite("id"))
    store.compact(VERTEX, "wide")
    now, held = table(store, VERTEX, "wide"), bytes_below(tmp_path)
    removed = store.clear_old()
    # the part before the merge, the delta
    assert len(removed) == 2 and bytes_below(tmp_path) < held
    assert table(store, VERTEX, "wide") == now and store.current().number == 3
    assert store.clear_old() == []
    with pytest.raises(ValueError):
        store.clear_old(0)
