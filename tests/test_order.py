from pyspark.sql import functions as F

from graphtables.operators.order import numbered


def test_positions_follow_the_order_and_have_no_gap(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000 % 13).alias("a"), (F.col("id") * 31 % 5000).alias("b"))
    got = numbered(df, [F.col("a").desc(), F.col("b")]).collect()
    assert sorted(r["position"] for r in got) == list(range(5000))
    by_place = [(-r["a"], r["b"]) for r in sorted(got, key=lambda r: r["position"])]
    assert by_place == sorted(by_place)


def test_a_hot_value_is_split_over_ranges(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("a"), "id")
    order = [F.col("a"), F.col("id")]
    hot = df.repartitionByRange(4, *order).where("a = 1").groupBy(F.spark_partition_id()).count()
    assert hot.count() > 1
    assert numbered(df, order).where("a = 1").agg(F.min("position"), F.max("position")).first() == (0, 2000)


def test_equal_rows_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(None,), ("x",), ("x",), (None,), ("a",)], "a string")
    got = numbered(df, [F.col("a").asc_nulls_first()], "n").orderBy("n").collect()
    assert [tuple(r) for r in got] == [(None, 0), (None, 1), ("a", 2), ("x", 3), ("x", 4)]
    assert numbered(df.where("a = 'q'"), [F.col("a")]).isEmpty()
