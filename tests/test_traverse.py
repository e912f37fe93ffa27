import itertools
import random

import pytest
from pyspark.sql import functions as F

from graphtables.model import EDGE, Label, Space
from graphtables.operators import traverse
from tests.fixtures import edges_frame, rows


def vids(spark, *ids):
    return spark.createDataFrame([(str(i),) for i in ids], "vid string")


def graph(spark, **labels):
    space = Space("g")
    for name, edges in labels.items():
        frame = edges_frame(spark, [(str(a), str(b), r) for a, b, r in edges])
        space = space.with_table(Label(name, EDGE), frame)
    return space


def test_match_edges(int_graph):
    df = traverse.match_edges(int_graph, "friend", ["col1"], limit=1000)
    assert df.count() == 12 and len(df.columns) == 4
    assert tuple(df.filter("_srcId = '1'").first()) == ("1", "2", 0, "friend no. 1")
    limited = [r[:2] for r in rows(traverse.match_edges(int_graph, "friend", ["col1"], limit=3))]
    assert limited == [("1", "2"), ("10", "11"), ("11", "12")]


def test_match_from_tag_and_vertices(int_graph, string_graph):
    assert traverse.match_edges_from_tag(int_graph, "friend", "person").count() == 12
    assert traverse.match_edges_from_tag(int_graph, "friend", "geo_shape").isEmpty()
    assert traverse.match_edges_from_tag(string_graph, "friend", "person").count() == 14
    assert traverse.match_vertices(int_graph, "person").count() == 18


def test_fetch(spark, int_graph):
    keys = edges_frame(spark, [("1", "2", 0), ("1", "2", 0), ("1", "2", 1), ("2", "1", 0)])
    assert rows(traverse.fetch_edges(int_graph, "friend", keys, ["col1"])) == [("1", "2", 0, "friend no. 1")]


def test_subgraph_on_the_cycle(spark, int_graph):
    met = traverse.subgraph_edges(int_graph, vids(spark, 2), 3)
    with_col1 = traverse.with_props(int_graph, "friend", met, ["col1"])
    assert met.count() == 6
    assert {r[3] for r in rows(with_col1)} == {"friend no. 11", "friend no. 12", *(f"friend no. {i}" for i in range(1, 5))}
    assert traverse.subgraph_edges(int_graph, vids(spark, 2), 1).count() == 2
    assert traverse.subgraph_edges(int_graph, vids(spark, 2), 50).count() == 12
    assert traverse.subgraph_edges(int_graph, vids(spark, "nobody"), 3).isEmpty()
    with pytest.raises(ValueError):
        traverse.subgraph_edges(int_graph, vids(spark, 2), 0)


def test_all_paths_on_the_cycle(spark, int_graph):
    paths = traverse.all_paths(int_graph, vids(spark, 2), vids(spark, 4), 5)
    assert paths.count() == 1
    edges = traverse.path_edges(paths, "friend")
    assert [r[1:] for r in rows(edges)] == [("2", "3", 0), ("3", "4", 0)]
    with_col1 = traverse.with_props(int_graph, "friend", edges, ["col1"])
    assert {r[3] for r in rows(with_col1)} == {"friend no. 2", "friend no. 3"}
    assert traverse.all_paths(int_graph, vids(spark, 2), vids(spark, 4), 1).isEmpty()
    with pytest.raises(ValueError):
        traverse.all_paths(int_graph, vids(spark, 2), vids(spark, 4), 0)


def test_paths_end_where_an_edge_would_repeat(spark):
    triangle = graph(spark, e=[(1, 2, 0), (2, 3, 0), (3, 1, 0)])
    assert traverse.all_paths(triangle, vids(spark, 1), vids(spark, 3), 6).count() == 1
    assert traverse.all_paths(triangle, vids(spark, 1), vids(spark, 1), 3).count() == 1
    # Two edges between the same vertices make two paths.
    double = graph(spark, e=[(1, 2, 0), (1, 2, 1), (2, 3, 0)])
    assert traverse.all_paths(double, vids(spark, 1), vids(spark, 3), 2).count() == 2


def random_edges(seed):
    rng = random.Random(seed)
    return sorted({(rng.randrange(6), rng.randrange(6), rng.randrange(2)) for _ in range(11)})


def brute_subgraph(edges, starts, steps):
    reached, met = set(starts), set()
    for _ in range(steps):
        touched = {e for e in edges if e[1] in reached or e[2] in reached}
        met |= touched
        reached |= {v for e in touched for v in e[1:3]}
    return met


def brute_paths(edges, starts, targets, hops):
    found = []
    grow = [((), s) for s in starts]
    for _ in range(hops):
        grow = [(p + (e,), e[2]) for p, at in grow for e in edges if e[1] == at and e not in p]
        found += [p for p, at in grow if at in targets]
    return sorted(found)


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    near, far = random_edges(seed), random_edges(seed + 100)
    space = graph(spark, near=near, far=far)
    labelled = [("near", str(a), str(b), r) for a, b, r in near]
    labelled += [("far", str(a), str(b), r) for a, b, r in far]
    for steps in (1, 3):
        got = traverse.subgraph_edges(space, vids(spark, 0, 0, 5), steps)
        assert {tuple(r) for r in got.collect()} == brute_subgraph(labelled, {"0", "5"}, steps)
        assert got.count() == got.distinct().count()
    got = traverse.all_paths(space, vids(spark, 0, 1), vids(spark, 4, 0), 4)
    paths = sorted(tuple(tuple(e) for e in r.path) for r in got.collect())
    assert paths == brute_paths(labelled, ["0", "1"], {"4", "0"}, 4)
    only_near = traverse.all_paths(space, vids(spark, 0), vids(spark, 4), 4, labels=["near"])
    paths = sorted(tuple(tuple(e) for e in r.path) for r in only_near.collect())
    assert paths == brute_paths([e for e in labelled if e[0] == "near"], ["0"], {"4"}, 4)


def test_hub(spark):
    """A third of all edges meet in one vertex; every edge is still met once."""
    edges = [("hub", i, 0) for i in range(400)] + [(i, i + 1, 0) for i in range(800)]
    space = graph(spark, e=edges)
    two = traverse.subgraph_edges(space, vids(spark, 3), 2)
    # 3's own edges, then those at 2, 4 and the hub.
    wanted = brute_subgraph([("e", str(a), str(b), r) for a, b, r in edges], {"3"}, 2)
    assert {tuple(r) for r in two.collect()} == wanted and two.count() == len(wanted)


def edge(src, dst, label="likes", props=None):
    return (src, dst, 0, label, props or {})


def test_flatten(spark):
    likes = Label("likes", EDGE, {"since": "INT64", "day": "DATE"})
    kind = traverse.EDGE_STRUCT.simpleString()
    a = edge("1", "2", props={"since": "7", "day": "2021-01-01"})
    other = edge("1", "2", "hates")
    data = [
        (a, [a, None, other, edge("3", "4")], [edge("5", "6"), a]),
        (None, [], None),
        (other, None, [other]),
    ]
    df = spark.createDataFrame(data, f"e {kind}, l array<{kind}>, p array<{kind}>")
    got = rows(traverse.flatten_edges(df, likes, ["since"]))
    full = ("1", "2", 0, 7)
    # Nothing is made distinct; nulls and other labels are left out.
    assert got == sorted([full, full, full, ("3", "4", 0, None), ("5", "6", 0, None)], key=repr)
    assert traverse.flatten_edges(df, likes).columns == ["_srcId", "_dstId", "_rank", "since", "day"]
    with pytest.raises(ValueError, match="no edge"):
        traverse.flatten_edges(df.withColumn("n", F.lit(1)), likes)
    with pytest.raises(ValueError, match="does not exist"):
        traverse.flatten_edges(df, likes, ["until"])
    with_null = df.withColumn("nothing", F.lit(None))
    assert traverse.flatten_edges(with_null, likes).count() == 5


def test_props_of_repeated_edges(spark, int_graph):
    keys = [("friend", "1", "2", 0)] * 3 + [("other", "1", "2", 0)]
    df = spark.createDataFrame(keys, "label string, _srcId string, _dstId string, _rank bigint")
    assert rows(traverse.with_props(int_graph, "friend", df, ["col1"])) == list(
        itertools.repeat(("1", "2", 0, "friend no. 1"), 3)
    )
