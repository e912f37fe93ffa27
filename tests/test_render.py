import random
import re
from collections import Counter

import pytest

from graphtables.model import EDGE, VERTEX, EdgeWrite, Label, VertexWrite
from graphtables.operators import render
from tests.fixtures import rows

PROPS = {
    "title": "STRING",
    "shelf": "FIXED_STRING",
    "lent": "BOOL",
    "pages": "INT32",
    "ean": "INT64",
    "price": "DOUBLE",
    "printed": "DATE",
    "place": "GEOGRAPHY",
}
BOOK = Label("book", VERTEX, PROPS)
CITES = Label("cites", EDGE, PROPS)
NAMES = "`title`,`shelf`,`lent`,`pages`,`ean`,`price`,`printed`,`place`"
SCHEMA = (
    "title string, shelf string, lent boolean, pages int, ean bigint,"
    " price double, printed string, place string"
)
ATLAS = ("Atlas", "A7", False, 312, 9780000000019, 24.5, "1987-03-09", "POINT(12.5 -4)")
FLORA = ("Flora", "B2", True, 77, 9780000000026, 8.25, "2002-10-30", "LINESTRING(0 0, 5 6, 7 7)")
ATLAS_VALUES = (
    '"Atlas", "A7", false, 312, 9780000000019, 24.5, date("1987-03-09"), ST_GeogFromText("POINT(12.5 -4)")'
)
FLORA_VALUES = (
    '"Flora", "B2", true, 77, 9780000000026, 8.25, date("2002-10-30"),'
    ' ST_GeogFromText("LINESTRING(0 0, 5 6, 7 7)")'
)
ATLAS_SET = (
    '`title`="Atlas",`shelf`="A7",`lent`=false,`pages`=312,`ean`=9780000000019,`price`=24.5,'
    '`printed`=date("1987-03-09"),`place`=ST_GeogFromText("POINT(12.5 -4)")'
)
FLORA_SET = (
    '`title`="Flora",`shelf`="B2",`lent`=true,`pages`=77,`ean`=9780000000026,`price`=8.25,'
    '`printed`=date("2002-10-30"),`place`=ST_GeogFromText("LINESTRING(0 0, 5 6, 7 7)")'
)


@pytest.fixture(scope="module")
def vertices(spark):
    return spark.createDataFrame([("k20", *ATLAS), ("k31", *FLORA)], f"id string, {SCHEMA}")


@pytest.fixture(scope="module")
def edges(spark):
    data = [("k20", "k31", 1, *ATLAS), ("k31", "k20", 2, *FLORA)]
    return spark.createDataFrame(data, f"a string, b string, r bigint, {SCHEMA}")


def only(df):
    (row,) = df.collect()
    assert row.part == 1 and row.batch_no == 0 and row.n_rows == 2
    return row.statement


def vertex(df, **how):
    return only(render.render_vertices(df, BOOK, VertexWrite("id", **how), "STRING"))


def edge(df, *ids, **how):
    return only(render.render_edges(df, CITES, EdgeWrite(*ids, **how), "STRING"))


def test_insert_vertex(vertices):
    values = f'"k20": ({ATLAS_VALUES}), "k31": ({FLORA_VALUES})'
    assert vertex(vertices) == f"INSERT vertex `book`({NAMES}) VALUES {values}"
    assert vertex(vertices, overwrite=False) == (
        f"INSERT vertex IF NOT EXISTS `book`({NAMES}) VALUES {values}"
    )
    assert vertex(vertices, policy="hash") == (
        f'INSERT vertex `book`({NAMES}) VALUES hash("k20"): ({ATLAS_VALUES}), hash("k31"): ({FLORA_VALUES})'
    )


def test_insert_edge(edges):
    values = f'"k20"->"k31"@1: ({ATLAS_VALUES}), "k31"->"k20"@2: ({FLORA_VALUES})'
    assert edge(edges, "a", "b", "r") == f"INSERT edge `cites`({NAMES}) VALUES {values}"
    assert edge(edges, "a", "b", "r", overwrite=False) == (
        f"INSERT edge IF NOT EXISTS `cites`({NAMES}) VALUES {values}"
    )
    assert edge(edges.drop("r"), "a", "b") == (
        f'INSERT edge `cites`({NAMES}) VALUES "k20"->"k31": ({ATLAS_VALUES}), "k31"->"k20": ({FLORA_VALUES})'
    )


def test_update_vertex(vertices):
    assert vertex(vertices, mode="update") == (
        f'UPDATE VERTEX ON `book` "k20" SET {ATLAS_SET};UPDATE VERTEX ON `book` "k31" SET {FLORA_SET}'
    )
    assert vertex(vertices, mode="update", policy="hash") == (
        f'UPDATE VERTEX ON `book` hash("k20") SET {ATLAS_SET};'
        f'UPDATE VERTEX ON `book` hash("k31") SET {FLORA_SET}'
    )


def test_update_edge(edges):
    assert edge(edges, "a", "b", "r", mode="update") == (
        f'UPDATE EDGE ON `cites` "k20"->"k31"@1 SET {ATLAS_SET};'
        f'UPDATE EDGE ON `cites` "k31"->"k20"@2 SET {FLORA_SET}'
    )
    both = {"src_policy": "hash", "dst_policy": "hash"}
    assert edge(edges, "a", "b", "r", mode="update", **both) == (
        f'UPDATE EDGE ON `cites` hash("k20")->hash("k31")@1 SET {ATLAS_SET};'
        f'UPDATE EDGE ON `cites` hash("k31")->hash("k20")@2 SET {FLORA_SET}'
    )
    assert "@0 SET" in edge(edges.drop("r"), "a", "b", mode="update")


def test_delete_vertex(vertices):
    assert vertex(vertices, mode="delete") == 'DELETE VERTEX "k20","k31"'
    assert vertex(vertices, mode="delete", delete_edge=True) == 'DELETE VERTEX "k20","k31" WITH EDGE'
    assert vertex(vertices, mode="delete", policy="hash") == 'DELETE VERTEX hash("k20"),hash("k31")'
    assert vertex(vertices, mode="delete", policy="hash", delete_edge=True) == (
        'DELETE VERTEX hash("k20"),hash("k31") WITH EDGE'
    )


def test_delete_edge(edges):
    ids = ("a", "b", "r")
    assert edge(edges, *ids, mode="delete") == 'DELETE EDGE `cites` "k20"->"k31"@1,"k31"->"k20"@2'
    assert edge(edges, "a", "b", mode="delete") == (
        'DELETE EDGE `cites` "k20"->"k31"@0,"k31"->"k20"@0'
    )
    assert edge(edges, *ids, mode="delete", src_policy="hash") == (
        'DELETE EDGE `cites` hash("k20")->"k31"@1,hash("k31")->"k20"@2'
    )
    assert edge(edges, *ids, mode="delete", src_policy="hash", dst_policy="hash") == (
        'DELETE EDGE `cites` hash("k20")->hash("k31")@1,hash("k31")->hash("k20")@2'
    )


def test_ids_as_properties(spark):
    label = Label("t", VERTEX, {"col1": "STRING", "col2": "BOOL", "col3": "INT64"})
    df = spark.createDataFrame([("aaa", True, 1)], "col1 string, col2 boolean, col3 bigint")
    write = VertexWrite("col1", vid_as_prop=True)
    (r,) = render.render_vertices(df, label, write, "STRING").collect()
    assert r.statement == 'INSERT vertex `t`(`col1`,`col2`,`col3`) VALUES "aaa": ("aaa", true, 1)'
    (r,) = render.render_vertices(df, label, VertexWrite("col1"), "STRING").collect()
    assert r.statement == 'INSERT vertex `t`(`col2`,`col3`) VALUES "aaa": (true, 1)'
    edge_label = Label("e", EDGE, label.props)
    ids = ("col1", "col2", "col3")
    every = EdgeWrite(*ids, src_as_prop=True, dst_as_prop=True, rank_as_prop=True)
    (r,) = render.render_edges(df, edge_label, every, "STRING").collect()
    assert r.statement == 'INSERT edge `e`(`col1`,`col2`,`col3`) VALUES "aaa"->"true"@1: ("aaa", true, 1)'
    (r,) = render.render_edges(df, edge_label, EdgeWrite(*ids), "STRING").collect()
    assert r.statement == 'INSERT edge `e`() VALUES "aaa"->"true"@1: ()'


def test_integer_ids_and_rejects(spark):
    df = spark.createDataFrame([("12", 1), ("x", 2), (None, 3), ("-3", 4)], "id string, n int")
    label = Label("t", VERTEX, {"n": "INT8"})
    (r,) = render.render_vertices(df, label, VertexWrite("id"), "INT").collect()
    assert r.statement == "INSERT vertex `t`(`n`) VALUES -3: (4), 12: (1)"
    rejects = render.id_rejects(df, VertexWrite("id"), "INT")
    assert rows(rejects) == sorted([("x", "vid_not_numeric"), (None, "null_key")], key=repr)


def test_nulls_are_spelled(spark):
    df = spark.createDataFrame([("a", None, None)], "id string, n int, s string")
    label = Label("t", VERTEX, {"n": "INT8", "s": "STRING"})
    (r,) = render.render_vertices(df, label, VertexWrite("id"), "STRING").collect()
    assert r.statement.endswith('"a": (null, null)')


@pytest.mark.parametrize("batch, n_parts", [(1, 1), (3, 1), (5, 4), (512, 3)])
def test_every_row_is_in_one_batch(spark, batch, n_parts):
    rng = random.Random(batch)
    # A third of all rows are copies of one row.
    ids = [f"v{rng.randrange(60)}" for _ in range(200)] + ["hot"] * 100
    rng.shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    write = VertexWrite("id", mode="delete", batch=batch)
    got = render.render_vertices(df, Label("t", VERTEX), write, "STRING", n_parts).collect()
    seen = Counter()
    per_part = {}
    for r in got:
        found = re.findall(r'"(\w+)"', r.statement)
        assert len(found) == r.n_rows <= batch
        seen.update(found)
        per_part.setdefault(r.part, {})[r.batch_no] = r.n_rows
    assert seen == Counter(ids)
    for sizes in per_part.values():
        # All batches of a part but the last are full.
        assert sorted(sizes) == list(range(len(sizes)))
        assert all(sizes[b] == batch for b in range(len(sizes) - 1))


def test_copies_are_spread_over_parts(spark):
    df = spark.range(20_000).selectExpr("'hot' AS id")
    write = VertexWrite("id", mode="delete", batch=10)
    pieces = render.vertex_pieces(df, Label("t", VERTEX), write, "STRING")
    sizes = render.render_batches(pieces, 10, 20).groupBy("part").sum("n_rows").collect()
    assert len(sizes) == 20 and sum(r[1] for r in sizes) == 20_000
    assert max(r[1] for r in sizes) < 3_000


def test_layout_does_not_hang_on_the_partitions(spark):
    df = spark.range(500).selectExpr("cast(id % 90 as string) AS id")
    write = VertexWrite("id", mode="delete", batch=7)
    one = render.render_vertices(df.repartition(1), Label("t", VERTEX), write, "STRING", 3)
    many = render.render_vertices(df.repartition(9), Label("t", VERTEX), write, "STRING", 3)
    assert rows(one) == rows(many)


def test_part_count(spark):
    assert render.part_count(spark.range(0), 10) == 1
    assert render.part_count(spark.range(21), 10) == 3


def test_changes_of_a_key_stay_in_order(spark):
    """Replaying every part from its first batch on ends at the last change of each key."""
    rng = random.Random(5)
    data = [(f"k{rng.randrange(12)}", rng.randrange(10_000), rng.randrange(5)) for _ in range(300)]
    df = spark.createDataFrame(data, "id string, seq int, n int").repartition(7)
    write = VertexWrite("id", mode="update", batch=8, order_by=("seq",))
    label = Label("t", VERTEX, {"n": "INT8"})
    got = render.render_vertices(df, label, write, "STRING", 4).orderBy("part", "batch_no").collect()
    part_of, last = {}, {}
    for r in got:
        for key, n in re.findall(r'"(k[0-9]+)" SET `n`=([0-9])', r.statement):
            assert part_of.setdefault(key, r.part) == r.part
            last[key] = int(n)
    assert sum(r.n_rows for r in got) == 300 and len(set(part_of.values())) > 1
    wanted = {k: max((s, n) for i, s, n in data if i == k)[1] for k in part_of}
    assert last == wanted
