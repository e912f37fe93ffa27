import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from graphtables.model import EDGE, VERTEX, EdgeWrite, Label, Space, VertexWrite
from graphtables.operators.mutate import mutate_edges, mutate_vertices, reject_counts
from graphtables.operators.traverse import fetch_edges
from graphtables.sources.files import read_header_csv
from tests.fixtures import FRIEND, PERSON, edges_frame, rows

TAG = Label("thing", VERTEX, {"name": "STRING", "size": "INT32"})
LINK = Label("link", EDGE, {"weight": "DOUBLE", "note": "STRING"})


def space(spark, vid_type="STRING", things=(), links=()):
    return (
        Space("s", vid_type)
        .with_table(TAG, spark.createDataFrame(list(things), "_vertexId string, name string, size int"))
        .with_table(
            Label("other", VERTEX),
            spark.createDataFrame([(t[0],) for t in things], "_vertexId string"),
        )
        .with_table(
            LINK,
            spark.createDataFrame(
                list(links), "_srcId string, _dstId string, _rank bigint, weight double, note string"
            ),
        )
    )


THINGS = [("1", "one", 1), ("2", "two", 2), ("3", None, None)]
LINKS = [("1", "2", 0, 0.5, "a"), ("2", "3", 0, 1.5, None), ("2", "3", 7, 2.5, "c"), ("9", "8", 0, 0.0, "d")]


def changes(spark, data, schema="id string, name string, size int"):
    return spark.createDataFrame(data, schema)


@pytest.fixture(params=["STRING", "INT"])
def s(spark, request):
    return space(spark, request.param, THINGS, LINKS)


def test_insert_overwrite(spark, s):
    ch = changes(spark, [("2", "zwei", None), ("4", "four", 4)])
    m = mutate_vertices(s, "thing", ch, VertexWrite("id"))
    assert rows(m.table(VERTEX, "thing")) == rows(
        changes(spark, [("1", "one", 1), ("2", "zwei", None), ("3", None, None), ("4", "four", 4)])
    )
    assert m.rejects.isEmpty()


def test_insert_some_properties_leaves_the_rest_null(spark, s):
    m = mutate_vertices(s, "thing", changes(spark, [("1", 5)], "id string, size int"), VertexWrite("id"))
    assert ("1", None, 5) in rows(m.table(VERTEX, "thing"))


def test_insert_if_absent(spark, s):
    ch = changes(spark, [("2", "zwei", 22), ("4", "b", 2), ("4", "a", 1)])
    write = VertexWrite("id", overwrite=False, order_by=("size",))
    got = rows(mutate_vertices(s, "thing", ch, write).table(VERTEX, "thing"))
    # No row that is there changes, and of the new ones the first wins.
    assert got == sorted([*THINGS, ("4", "a", 1)], key=repr)


def test_last_of_several_wins(spark, s):
    ch = changes(spark, [("4", "a", 1), ("4", "c", 3), ("4", "b", 2)])
    write = VertexWrite("id", order_by=("size",))
    assert ("4", "c", 3) in rows(mutate_vertices(s, "thing", ch, write).table(VERTEX, "thing"))


def test_order_column_need_not_be_a_property(spark, s):
    ch = changes(spark, [("4", "a", 2), ("4", "c", 1)], "id string, name string, seen_at int")
    write = VertexWrite("id", order_by=("seen_at",))
    assert ("4", "a", None) in rows(mutate_vertices(s, "thing", ch, write).table(VERTEX, "thing"))


def test_insert_twice_is_insert_once(spark, s):
    ch = changes(spark, [("2", "zwei", None), ("4", "four", 4)])
    once = mutate_vertices(s, "thing", ch, VertexWrite("id")).table(VERTEX, "thing")
    twice = mutate_vertices(s.with_table(TAG, once), "thing", ch, VertexWrite("id"))
    assert rows(twice.table(VERTEX, "thing")) == rows(once)


def test_delete_after_insert(spark, s):
    ch = changes(spark, [("2", "zwei", None), ("4", "four", 4)])
    once = mutate_vertices(s, "thing", ch, VertexWrite("id")).table(VERTEX, "thing")
    gone = mutate_vertices(s.with_table(TAG, once), None, ch, VertexWrite("id", mode="delete"))
    assert rows(gone.table(VERTEX, "thing")) == [t for t in sorted(THINGS, key=repr) if t[0] != "2"]


def test_update(spark, s):
    ch = changes(spark, [("1", None), ("3", "three"), ("7", "seven")], "id string, name string")
    m = mutate_vertices(s, "thing", ch, VertexWrite("id", mode="update"))
    # A null that is given is set, other properties stay, a missing key makes no row.
    assert rows(m.table(VERTEX, "thing")) == [("1", None, 1), ("2", "two", 2), ("3", "three", None)]
    assert rows(m.rejects) == [("7", "no_such_key")]
    with pytest.raises(ValueError, match="at least one"):
        mutate_vertices(s, "thing", ch.select("id"), VertexWrite("id", mode="update"))


def test_delete_spans_all_labels_and_leaves_edges(spark, s):
    m = mutate_vertices(s, None, changes(spark, [("2",)], "id string"), VertexWrite("id", mode="delete"))
    assert [r[0] for r in rows(m.table(VERTEX, "thing"))] == ["1", "3"]
    assert rows(m.table(VERTEX, "other")) == [("1",), ("3",)]
    assert (EDGE, "link") not in m.tables


def test_delete_with_edges(spark, s):
    write = VertexWrite("id", mode="delete", delete_edge=True)
    m = mutate_vertices(s, None, changes(spark, [("2",), ("8",), ("2",)], "id string"), write)
    assert rows(m.table(EDGE, "link")) == []
    m = mutate_vertices(s, None, changes(spark, [("3",)], "id string"), write)
    assert [r[:3] for r in rows(m.table(EDGE, "link"))] == [("1", "2", 0), ("9", "8", 0)]


EDGE_SCHEMA = "a string, b string, r string, weight double, note string"


def test_edges(spark, s):
    ch = changes(spark, [("2", "3", "7", 9.0, "x"), ("2", "3", "8", 8.0, None)], EDGE_SCHEMA)
    ids = ("a", "b", "r")
    got = rows(mutate_edges(s, "link", ch, EdgeWrite(*ids)).table(EDGE, "link"))
    assert ("2", "3", 7, 9.0, "x") in got and ("2", "3", 8, 8.0, None) in got and len(got) == 5
    got = rows(mutate_edges(s, "link", ch, EdgeWrite(*ids, overwrite=False)).table(EDGE, "link"))
    assert ("2", "3", 7, 2.5, "c") in got and len(got) == 5
    m = mutate_edges(s, "link", ch.select(*ids, "note"), EdgeWrite(*ids, mode="update"))
    assert ("2", "3", 7, 2.5, "x") in rows(m.table(EDGE, "link"))
    assert rows(m.rejects) == [("2", "3", "8", "no_such_key")]
    got = rows(mutate_edges(s, "link", ch, EdgeWrite(*ids, mode="delete")).table(EDGE, "link"))
    assert len(got) == 3 and ("2", "3", 0, 1.5, None) in got


def test_rank_is_zero_when_not_given(spark, s):
    ch = changes(spark, [("2", "3")], "a string, b string")
    got = rows(mutate_edges(s, "link", ch, EdgeWrite("a", "b", mode="delete")).table(EDGE, "link"))
    assert [r[:3] for r in got] == [("1", "2", 0), ("2", "3", 7), ("9", "8", 0)]


def test_rejects(spark):
    ch = changes(
        spark,
        [
            ("1", "2", "0", "1.0"),
            (None, "2", "0", "1.0"),
            ("1", "x", "0", "1.0"),
            ("1\n", "2", "0", "1.0"),
            ("1", "9" * 30, "0", "1.0"),
            ("1", "2", "r", "1.0"),
            ("1", "2", None, "1.0"),
            ("1", "2", "9" * 30, "1.0"),
            ("1", "2", "1", "heavy"),
        ],
        "a string, b string, r string, weight string",
    )
    m = mutate_edges(space(spark, "INT", THINGS, LINKS), "link", ch, EdgeWrite("a", "b", "r"))
    assert dict(map(tuple, reject_counts(m.rejects).collect())) == {
        "null_key": 2,
        "vid_not_numeric": 2,
        "vid_out_of_range": 1,
        "rank_not_numeric": 1,
        "rank_out_of_range": 1,
        "bad_value:weight": 1,
    }
    # With text ids the ids are all fine but the null.
    m = mutate_edges(space(spark, "STRING", THINGS, LINKS), "link", ch, EdgeWrite("a", "b", "r"))
    assert m.rejects.filter("reason like 'vid%'").isEmpty()
    assert m.rejects.count() + 4 == ch.count()


def test_numbers_that_do_not_fit(spark):
    label = Label("t", VERTEX, {"a": "INT8", "b": "INT64", "c": "TIMESTAMP"})
    empty = Space("n").with_table(label, spark.createDataFrame([], label.scan_schema()))
    data = [
        ("1", 127.0, 1.0, "5"), ("2", 128.0, 1.0, "5"), ("3", 1.5, 1.0, "5"), ("4", 1.0, 1e30, "5"),
        ("5", -128.0, float("nan"), "5"), ("6", 1.0, 2.0, "x"), ("7", None, None, None),
    ]
    m = mutate_vertices(empty, "t", spark.createDataFrame(data, "id string, a double, b double, c string"), VertexWrite("id"))
    assert rows(m.table(VERTEX, "t")) == [("1", 127, 1, 5), ("7", None, None, None)]
    assert rows(m.rejects) == [("2", "bad_value:a"), ("3", "bad_value:a"), ("4", "bad_value:b"), ("5", "bad_value:b"), ("6", "bad_value:c")]
    text = spark.createDataFrame([("1", "300"), ("2", "-7")], "id string, a string")
    m = mutate_vertices(empty, "t", text, VertexWrite("id"))
    assert rows(m.table(VERTEX, "t")) == [("2", -7, None, None)] and rows(m.rejects) == [("1", "bad_value:a")]


def test_uuid_keys_of_an_integer_space(spark):
    label = Label("t", VERTEX, {"a": "INT8"})
    empty = Space("n", "INT").with_table(label, spark.createDataFrame([], label.scan_schema()))
    m = mutate_vertices(empty, "t", spark.createDataFrame([("x", 1), ("y", 2)], "id string, a int"), VertexWrite("id", policy="uuid"))
    keys = [int(r[0]) for r in rows(m.table(VERTEX, "t"))]
    assert len(set(keys)) == 2 and all(0 <= k < 2**63 for k in keys)


def test_policies_make_keys(spark):
    s = space(spark, "INT", THINGS, LINKS)
    ch = changes(spark, [("a b", "x", 1)])
    m = mutate_vertices(s, "thing", ch, VertexWrite("id", policy="hash"))
    (new,) = [r for r in rows(m.table(VERTEX, "thing")) if r[1] == "x"]
    assert new[0].isdigit() and m.rejects.isEmpty()
    m = mutate_vertices(s, "thing", ch, VertexWrite("id", policy="UUID"))
    (other,) = [r for r in rows(m.table(VERTEX, "thing")) if r[1] == "x"]
    assert other[0].isdigit() and other[0] != new[0]
    text = Space("t").with_table(Label("thing", VERTEX, {"name": "STRING", "size": "INT64"}), spark.createDataFrame([], "_vertexId string, name string, size bigint"))
    m = mutate_vertices(text, "thing", ch, VertexWrite("id", policy="UUID"))
    assert rows(m.table(VERTEX, "thing"))[0][0].count("-") == 4


def test_ids_as_properties(spark):
    label = Label("kept", EDGE, {"a": "STRING", "r": "INT64", "w": "DOUBLE"})
    table = spark.createDataFrame([], "_srcId string, _dstId string, _rank bigint, a string, r bigint, w double")
    s = Space("s").with_table(label, table)
    ch = changes(spark, [("x", "y", 3, 1.0)], "a string, b string, r int, w double")
    write = EdgeWrite("a", "b", "r", src_as_prop=True, rank_as_prop=True)
    assert rows(mutate_edges(s, "kept", ch, write).table(EDGE, "kept")) == [("x", "y", 3, "x", 3, 1.0)]
    with pytest.raises(ValueError, match="b does not exist"):
        mutate_edges(s, "kept", ch, EdgeWrite("a", "b", "r", dst_as_prop=True))


def test_names_are_checked_first(spark, s):
    ch = changes(spark, [("1", "x", 1)], "id string, nam string, size int")
    with pytest.raises(ValueError, match="nam does not exist"):
        mutate_vertices(s, "thing", ch, VertexWrite("id"))
    # Field names are case-sensitive.
    with pytest.raises(ValueError, match="do not exist"):
        mutate_vertices(s, "thing", ch, VertexWrite("ID"))
    with pytest.raises(ValueError, match="do not exist"):
        mutate_vertices(s, None, ch, VertexWrite("ID", mode="delete"))


def test_hostile_ids_and_values(spark):
    odd = ["a|b", 'q"', "n\n", "é", "", " ", "c->d@0"]
    s = space(spark, things=[(o, o, 1) for o in odd])
    m = mutate_vertices(s, "thing", changes(spark, [(o, o * 2, 2) for o in odd[:4]]), VertexWrite("id"))
    assert rows(m.table(VERTEX, "thing")) == sorted(
        [(o, o * 2, 2) for o in odd[:4]] + [(o, o, 1) for o in odd[4:]], key=repr
    )


@pytest.mark.parametrize("seed", range(4))
def test_against_a_dictionary(spark, seed):
    rng = random.Random(seed)
    key = lambda: (str(rng.randrange(4)), str(rng.randrange(4)), rng.randrange(2))
    held = {key(): (float(i), f"n{i}") for i in range(10)}
    feed = [(*key(), rng.choice([None, float(i)]), rng.choice([None, f"m{i}"]), i) for i in range(25)]
    s = space(spark, links=[(*k, *v) for k, v in held.items()])
    ch = changes(spark, feed, "a string, b string, r int, weight double, note string, seq int")
    how = {"order_by": ("seq",)}
    upsert, absent, update, delete = (dict(held) for _ in range(4))
    for a, b, r, weight, note, _ in feed:
        k = (a, b, r)
        upsert[k] = (weight, note)
        absent.setdefault(k, (weight, note))
        if k in update:
            update[k] = (weight, note)
        delete.pop(k, None)
    for wanted, extra in (
        (upsert, {}),
        (absent, {"overwrite": False}),
        (update, {"mode": "update"}),
        (delete, {"mode": "delete"}),
    ):
        m = mutate_edges(s, "link", ch, EdgeWrite("a", "b", "r", **how, **extra))
        assert rows(m.table(EDGE, "link")) == sorted(((*k, *v) for k, v in wanted.items()), key=repr)


STATIONS = """id,col1,col2,col3,col4,col5,col6,col7,col8,col9,col10,col11,col12,col13,geo
501,Øst,N1,3,250,41000,5100000000,1999-12-31,1999-12-31T23:59:59,946684799,true,0.5,0.25,06:15:00,POINT(9.5 55)
502,Σκάλα,N2,8,-17,40,77,1972-02-29,1972-02-29T00:00:01,68169601,false,-3.75,12,23:00:07,"LINESTRING(1 1, 2.5 8, 4 4)"
-4,"Bay, east",N3,-1,0,0,0,2010-06-15,2010-06-15T12:30:45,1276605045,true,1e3,7,00:00:00,"POLYGON((0 0, 6 0, 6 6, 0 0))"
503,Pier,N4,8,1,2,3,2020-01-01,2020-01-01T01:01:01,1577840461,false,2.5,2.5,11:11:11,POINT(0 0)
"""


def test_csv_insert_then_delete(spark, tmp_path):
    (tmp_path / "stations.csv").write_text(STATIONS, encoding="utf-8")
    feed = read_header_csv(spark, str(tmp_path / "stations.csv"))
    person = Label("person", VERTEX, {**PERSON.props, "geo": "GEOGRAPHY"})
    friend = Label("friend", EDGE, FRIEND.props)
    empty = Space("w")
    for label in (person, friend):
        empty = empty.with_table(label, spark.createDataFrame([], label.scan_schema()))
    m = mutate_vertices(empty, "person", feed, VertexWrite("id", batch=3))
    people = m.table(VERTEX, "person")
    assert people.count() == 4 and m.rejects.isEmpty()
    row = people.filter("_vertexId = '502'").first()
    assert (row.col1, row.col8, row.col9, row.geo) == (
        "Σκάλα",
        "1972-02-29T00:00:01.000",
        68169601,
        "LINESTRING(1 1, 2.5 8, 4 4)",
    )
    # The edges: each station to one of them, rank from a column that is a property as well.
    links = feed.drop("geo").withColumnRenamed("id", "id1").withColumn("id2", F.lit("503"))
    write = EdgeWrite("id1", "id2", "col3", rank_as_prop=True, batch=3)
    filled = empty.with_table(person, people)
    m = mutate_edges(filled, "friend", links, write)
    edges = m.table(EDGE, "friend")
    assert edges.count() == 4
    filled = filled.with_table(friend, edges)
    key = edges_frame(spark, [("502", "503", 8)])
    assert fetch_edges(filled, "friend", key).count() == 1
    gone = mutate_vertices(filled, None, feed, VertexWrite("id", mode="delete", delete_edge=True))
    assert gone.table(VERTEX, "person").isEmpty() and gone.table(EDGE, "friend").isEmpty()
    left = mutate_edges(filled, "friend", links, replace(write, mode="delete"))
    assert left.table(EDGE, "friend").isEmpty()
