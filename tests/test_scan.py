import pytest
from pyspark.sql import functions as F

from graphtables.sources import profile
from graphtables.sources.scan import edge_keys, load, scan_edges, scan_vertices


def test_vertex_scans(int_graph):
    for df, width in (
        (scan_vertices(int_graph, "person", no_column=True), 1),
        (scan_vertices(int_graph, "person", ["col1"]), 2),
        (scan_vertices(int_graph, "person"), 14),
    ):
        assert (df.count(), len(df.columns)) == (18, width)


def test_edge_scans(int_graph, string_graph):
    for df, width in (
        (scan_edges(int_graph, "friend", no_column=True), 3),
        (scan_edges(int_graph, "friend", ["col1"]), 4),
        (scan_edges(int_graph, "friend"), 16),
    ):
        assert (df.count(), len(df.columns)) == (12, width)
    assert scan_edges(string_graph, "friend").count() == 14
    assert scan_vertices(string_graph, "person").count() == 17


def test_values(int_graph):
    row = scan_vertices(int_graph, "person").filter("_vertexId = '1'").first().asDict()
    assert row == {
        "_vertexId": "1",
        "col1": "person no. 1",
        "col2": "p-007",
        "col3": -35,
        "col4": 1,
        "col5": 70000,
        "col6": 3000000001,
        "col7": "1994-07-03",
        "col8": "1994-07-03T05:40:03.125",
        "col9": 1057210803,
        "col10": False,
        "col11": 0.25,
        "col12": 0.125,
        "col13": "01:30:59",
    }
    edge = scan_edges(int_graph, "friend", ["col8"]).filter("_srcId = '12'").first()
    assert tuple(edge) == ("12", "1", 0, "1994-07-14T05:40:36.125")


def test_null_row(int_graph):
    row = scan_vertices(int_graph, "person").filter("_vertexId = '0'").first()
    assert all(v is None for v in row[1:])


def test_geography_and_duration(int_graph):
    shapes = dict(map(tuple, scan_vertices(int_graph, "geo_shape").collect()))
    assert shapes == {
        "81": "POINT(-7.5 40)",
        "82": "LINESTRING(0 0, 2 5, 9 1)",
        "83": "POLYGON((0 0, 4 0, 4 3, 0 0))",
    }
    lasting = scan_vertices(int_graph, "tag_duration").collect()
    assert [tuple(r) for r in lasting] == [("90", "duration({months:7, seconds:42, microseconds:5})")]


def test_scan_schema_is_what_comes_out(int_graph):
    for kind, name in int_graph.labels:
        df = load(int_graph, options(kind, name))
        wanted = int_graph.label(kind, name).scan_schema()
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in wanted]


def options(kind, label, **more):
    return {
        "type": kind,
        "spaceName": "test_int",
        "label": label,
        "returnCols": "",
        "partitionNumber": "10",
        **more,
    }


def test_options(int_graph):
    assert len(load(int_graph, options("VERTEX", "person", returnCols="col1,col2")).columns) == 3
    assert len(load(int_graph, options("edge", "friend", noColumn="true", returnCols="x")).columns) == 3
    for wrong in (
        {"returnCols": "col1, col2"},
        {"type": "tag"},
        {"label": "nobody"},
        {"spaceName": "other"},
        {"partitionNumber": "0"},
        {"limit": "0"},
    ):
        with pytest.raises(ValueError):
            load(int_graph, {**options("vertex", "person"), **wrong})
    for name in ("type", "label", "returnCols", "partitionNumber"):
        with pytest.raises(ValueError, match="required"):
            load(int_graph, {k: v for k, v in options("vertex", "person").items() if k != name})


def test_edge_keys(string_graph):
    df = edge_keys(string_graph)
    assert df.columns == ["label", "_srcId", "_dstId", "_rank"]
    assert df.count() == 14


def test_part_assignment():
    assert [profile.scan_parts(i, 10, 10) for i in range(1, 11)] == [[i] for i in range(1, 11)]
    assert [profile.scan_parts(i, 20, 10) for i in range(1, 11)] == [[i, i + 10] for i in range(1, 11)]
    assert [profile.scan_parts(i, 5, 10) for i in range(1, 11)] == [[i] for i in range(1, 6)] + [[]] * 5


@pytest.mark.parametrize("n_tasks", [1, 3, 10, 15])
def test_every_part_has_the_task_that_deals_it(int_graph, n_tasks):
    df = profile.scan_part_assignment(int_graph, "vertex", "person", n_tasks)
    dealt = {p: t for t in range(1, n_tasks + 1) for p in profile.scan_parts(t, 10, n_tasks)}
    got = df.collect()
    assert all(dealt[r.part] == r.task for r in got)
    assert sum(r.n_rows for r in got) == 18


def test_profile(int_graph):
    rows = {(r.label, r.property): r for r in profile.label_profile(int_graph).collect()}
    assert rows["person", "col3"].n_rows == 18 and rows["person", "col3"].n_nulls == 1
    assert rows["friend", "col9"].property_type == "TIMESTAMP"


def test_kinds(spark, int_graph):
    asked = spark.createDataFrame([("person",), ("friend",), ("nobody",)], "label string")
    got = dict(map(tuple, profile.label_kinds(int_graph, asked).collect()))
    assert got == {"person": "vertex", "friend": "edge", "nobody": None}
    # A name that is both a vertex and an edge label counts as the vertex label.
    from graphtables.model import Label

    both = int_graph.with_table(Label("friend", "vertex"), int_graph.frame("vertex", "person"))
    assert profile.label_kind(both, "friend") == "vertex"
    assert dict(map(tuple, profile.label_kinds(both, asked).collect()))["friend"] == "vertex"


def test_vid_type(int_graph, string_graph):
    assert profile.vid_type_check(int_graph).first().vid_type == "INT"
    named = string_graph.with_table(
        string_graph.label("vertex", "geo_shape"),
        string_graph.frame("vertex", "geo_shape").withColumn("_vertexId", F.lit("x1")),
    )
    assert profile.vid_type_check(named).first().vid_type == "STRING"


def test_options_that_are_not_known_are_refused(int_graph):
    with pytest.raises(ValueError, match="ngql"):
        load(int_graph, options("vertex", "person", ngql="MATCH (v) RETURN v"))
    with pytest.raises(ValueError, match="unknown options: returnCol"):
        load(int_graph, options("vertex", "person", returnCol="col1"))
