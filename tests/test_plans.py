"""What the plans look like at scale: pushed filters, narrow reads, no pairs, split hubs."""

import random

import pytest
from pyspark.sql import functions as F

from graphtables.model import EDGE, VERTEX, EdgeWrite, Label, Space, VertexWrite
from graphtables.operators.adjacency import SALTS, adjacency, beside
from graphtables.operators.export import graph_triplets
from graphtables.operators.mutate import latest_per_key, mutate_edges, mutate_vertices
from graphtables.operators.traverse import _neighbours, all_paths, match_edges_from_tag, subgraph_edges
from graphtables.plans import registry
from graphtables.plans.demo import demo_space
from graphtables.session import join_side, materialize, measure
from graphtables.sources.scan import edge_keys, scan_edges, scan_vertices
from graphtables.sources.store import Store


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_files(spark, sf_dir):
    orders = scan_vertices(demo_space(spark, sf_dir, "orders"), "orders")
    text = plan(orders.filter("o_totalprice > 250000").select("o_orderstatus"))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,250000.0)]" in text
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in text
    ids = plan(scan_vertices(demo_space(spark, sf_dir, "orders"), "orders", no_column=True))
    assert "ReadSchema: struct<o_orderkey:bigint>" in ids


def test_one_row_per_key_is_kept_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    text = plan(latest_per_key(df, ["k"], ["v"]))
    before, after = text.split("Exchange", 1)
    assert "Final" in before and "Partial" in after and "WindowGroupLimit" in after


@pytest.mark.parametrize(
    "name", [n for n in registry.queries() if not n.startswith(("stream", "subgraph", "all_paths"))]
)
def test_no_pairs_and_no_single_task(spark, sf_dir, name):
    text = plan(registry.queries()[name](spark, sf_dir))
    for wrong in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert wrong not in text, wrong
    if name not in ("scan_count", "label_profile", "vid_type_check"):
        assert "SinglePartition" not in text
    for line in text.splitlines():
        if "FileScan" in line:
            assert "ReadSchema" in line


@pytest.fixture
def shuffled_joins(spark):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hub_edges(spark):
    """Half of all edges start at one vertex."""
    n = 40_000
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 2 == 0, "hub").otherwise(F.concat(F.lit("v"), "id")).alias("_srcId"),
        F.concat(F.lit("w"), "id").alias("_dstId"),
        F.lit(0).cast("bigint").alias("_rank"),
        F.md5(F.col("id").cast("string")).alias("note"),
    )


def hub_space(spark) -> Space:
    return Space("s").with_table(Label("e", EDGE, {"note": "STRING"}), hub_edges(spark))


def test_hub_is_split_in_a_cascading_delete(spark, shuffled_joins):
    # Ids that are deleted over and over do not get in the way.
    gone = spark.range(0, 4000, 1, 2).select(F.concat(F.lit("v"), F.col("id") % 2000).alias("id"))
    write = VertexWrite("id", mode="delete", delete_edge=True)
    left = mutate_vertices(hub_space(spark), None, gone, write).table(EDGE, "e")
    assert len(left.collect()) == 40_000 - 1_000
    assert "skew=true" in plan(left)


def test_hub_is_split_in_a_traversal(spark, shuffled_joins):
    edges = materialize(edge_keys(hub_space(spark)), "edges")
    frontier = edges.select(F.col("_srcId").alias("vid")).distinct()
    frontier = materialize(frontier, "frontier")
    found = _neighbours(edges, frontier, measure(frontier)[1])
    assert len(found.collect()) == 40_000
    assert "skew=true" in plan(found)
    met = subgraph_edges(hub_space(spark), frontier, 1)
    assert len(met.collect()) == 40_000
    assert "skew=true" in plan(met)
    met = match_edges_from_tag(
        hub_space(spark).with_table(
            Label("t", VERTEX), frontier.select(F.col("vid").alias("_vertexId"))
        ),
        "e",
        "t",
    )
    assert len(met.collect()) == 40_000
    assert "skew=true" in plan(met)


def test_later_hops_do_not_move_the_edges(spark, shuffled_joins):
    edges = materialize(edge_keys(hub_space(spark)), "edges")
    table = adjacency(edges)
    frontier = materialize(edges.select(F.col("_srcId").alias("vid")).distinct(), "frontier")
    met = beside(table, frontier)
    assert met.count() == 40_000
    # one exchange, and it is that of the frontier
    text = plan(met)
    assert text.count("Exchange") == 1 and "Bucketed: true" in text
    # the hub lies in as many buckets as there are salts, or buckets at all
    hub = table.filter("here = 'hub'").groupBy("salt").count().collect()
    assert len(hub) == SALTS and max(r["count"] for r in hub) < 20_000 / SALTS * 1.3


def test_subgraphs_of_cyclic_graphs_by_layout(spark, shuffled_joins):
    draw = random.Random(4)
    pairs = {(draw.randrange(60), draw.randrange(60), draw.randrange(2)) for _ in range(90)} | {(5, 5, 0), (0, 1, 0), (1, 2, 0), (2, 0, 0)}
    frame = spark.createDataFrame([(str(a), str(b), r) for a, b, r in pairs], "_srcId string, _dstId string, _rank bigint")
    space = Space("g").with_table(Label("e", EDGE), frame)
    for start, steps in ((0, 2), (5, 3), (17, 9)):
        near = {start}
        for _ in range(steps - 1):
            near |= {b for a, b, _ in pairs if a in near} | {a for a, b, _ in pairs if b in near}
        want = sorted((str(a), str(b), r) for a, b, r in pairs if a in near or b in near)
        met = subgraph_edges(space, spark.createDataFrame([(str(start),), (None,), (str(start),)], "vid string"), steps)
        assert sorted(tuple(r)[1:] for r in met.collect()) == want
        assert "Bucketed: true" in plan(met)


def test_a_feed_is_read_once(spark, tmp_path):
    """Table and rejects come from one copy of the feed, even if it gives other rows each time."""
    space = Space("s").with_table(Label("t", VERTEX, {"v": "INT64"}), spark.createDataFrame([("0", 1)], "_vertexId string, v bigint"))
    feed = spark.range(2000).select(F.when(F.rand() < 0.5, F.col("id").cast("string")).alias("id"), F.col("id").alias("v"))
    m = mutate_vertices(space, "t", feed, VertexWrite("id"))
    assert m.table(VERTEX, "t").filter("_vertexId <> '0'").count() + m.rejects.count() in (1999, 2000)
    for df in (m.table(VERTEX, "t"), m.rejects):
        assert "rand" not in plan(df) and "Range" not in plan(df)


def test_hub_is_split_in_triplets(spark, shuffled_joins):
    edges = hub_edges(spark).select(
        F.xxhash64("_srcId").alias("src"),
        F.xxhash64("_dstId").alias("dst"),
        F.struct(F.col("_rank").alias("rank"), F.array("note").alias("props")).alias("attr"),
    )
    vertices = edges.select(F.col("src").alias("id")).distinct().withColumn("props", F.array(F.lit("x")))
    triplets = graph_triplets(materialize(vertices, "vertices"), edges)
    assert len(triplets.collect()) == 40_000
    assert "skew=true" in plan(triplets)


def test_a_side_is_broadcast_by_its_measured_size(spark):
    # Compressed to next to nothing in the file, and far above the limit in memory.
    wide = materialize(spark.range(0, 300_000, 1, 2).select(F.lit("same").alias("k")), "wide")
    rows, size = measure(wide)
    assert rows == 300_000 and size > 10 * 1024 * 1024
    left = spark.range(10).selectExpr("cast(id as string) AS k")
    assert "BroadcastHashJoin" not in plan(left.join(join_side(wide, size), "k", "left_semi"))
    few = wide.limit(3)
    rows, size = measure(few)
    assert rows == 3 and "BroadcastHashJoin" in plan(left.join(join_side(few, size), "k", "left_semi"))
    assert measure(wide.filter("false")) == (0, 0)


def test_hot_key_in_the_changes(spark, shuffled_joins):
    """A third of all changes are for one key: one row of it per task is shuffled."""
    label = Label("e", EDGE, {"note": "STRING"})
    space = Space("s").with_table(label, hub_edges(spark).filter("_srcId <> 'hub'"))
    n = 30_000
    changes = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("x"), "id")).alias("a"),
        F.lit("w1").alias("b"),
        F.col("id").alias("seq"),
        F.lit("new").alias("note"),
    )
    write = EdgeWrite("a", "b", order_by=("seq",))
    table = mutate_edges(space, "e", changes, write).table(EDGE, "e")
    assert table.count() == 20_000 + 20_000 + 1
    assert scan_edges(space, "e").count() == 20_000


def test_few_rows_of_a_key_are_sorted_once(spark):
    df = spark.range(100).selectExpr("id % 50 AS k", "id AS v")
    last = latest_per_key(df, ["k"], ["v"], few=True)
    assert plan(last).count("Sort ") == 1 and plan(last).count("Exchange") == 1
    assert sorted(map(tuple, last.collect())) == [(k, k + 50) for k in range(50)]


def test_many_changes_of_a_store_are_read_and_shuffled_once(spark, tmp_path, shuffled_joins):
    label = Label("t", VERTEX, {"v": "INT64"})
    held = spark.createDataFrame([("0", 0), ("0", 1), (None, 2), ("1", 3), ("2", 4)], "_vertexId string, v bigint")
    store = Store(spark, str(tmp_path / "s"), Space("s").with_table(label, held), delta_share=float("inf"))
    store.save_space(store.space)
    store.apply(VERTEX, "t", spark.createDataFrame([("1", 30), ("3", 50)], "id string, v bigint"), VertexWrite("id"))
    store.apply(VERTEX, "t", spark.createDataFrame([("3", 60), ("2", 70)], "id string, v bigint"), VertexWrite("id", mode="update"))
    store.apply(VERTEX, "t", spark.createDataFrame([("2",)], "id string"), VertexWrite("id", mode="delete"))
    # repeated and missing keys that were written whole stay
    after = [(None, 2), ("0", 0), ("0", 1), ("1", 30), ("3", 60)]
    table = scan_vertices(store.read(), "t")
    text = plan(table)
    assert "Join" not in text and text.count("Exchange") == 1 and text.count("Scan parquet") == 2, text
    assert sorted(map(tuple, table.collect()), key=str) == sorted(after, key=str)
    store.compact(VERTEX, "t")
    assert sorted(map(tuple, scan_vertices(store.read(), "t").collect()), key=str) == sorted(after, key=str)
    assert store.profile().select("n_rows", "n_nulls").collect() == [(5, 0)]


def test_changes_that_come_dealt_are_not_dealt_again(spark, tmp_path, monkeypatch):
    label = Label("t", VERTEX, {"v": "INT64"})
    space = Space("s").with_table(label, spark.createDataFrame([("0", 0), ("1", 1)], "_vertexId string, v bigint"))
    store = Store(spark, str(tmp_path / "s"), space, delta_share=float("inf"))
    store.save_space(space)
    hints = []  # of what to deal by; parts are dealt by their number
    hint = type(space.frame(VERTEX, "t")).hint
    monkeypatch.setattr(type(space.frame(VERTEX, "t")), "hint", lambda df, *how: hints.append(how) or hint(df, *how))
    store.apply(VERTEX, "t", spark.createDataFrame([("1", 5)], "id string, v bigint"), VertexWrite("id"))
    assert ("rebalance",) not in hints
    assert sorted(map(tuple, scan_vertices(store.read(), "t").collect())) == [("0", 0), ("1", 5)]


def test_few_edges_of_a_hop_leave_the_paths_where_they_are(spark):
    """Many paths meet in one vertex, and few edges lead on from it."""
    wide = spark.range(0, 3000, 1, 2).selectExpr("'m' || id AS _srcId", "'hub' AS _dstId", "0L AS _rank")
    on = spark.createDataFrame([("hub", "end", 0)], "_srcId string, _dstId string, _rank bigint")
    space = Space("s").with_table(Label("wide", EDGE), wide).with_table(Label("on", EDGE), on)
    starts = wide.selectExpr("_srcId AS vid")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10000")
    try:
        paths = all_paths(space, starts, spark.createDataFrame([("end",)], "vid string"), 2)
        text = plan(paths)
        assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text, text
        assert paths.count() == 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
