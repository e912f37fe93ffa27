import pytest
from pyspark.sql import types as T

from graphtables.model import PROPERTY_TYPES, EdgeWrite, Label, Space, VertexWrite, spark_type
from tests.fixtures import FRIEND, PERSON

LONG = ["VID", "INT8", "INT16", "INT32", "INT64", "TIMESTAMP"]
TEXT = ["STRING", "FIXED_STRING", "DATE", "DATETIME", "TIME", "GEOGRAPHY", "DURATION"]


def test_property_types():
    assert all(spark_type(t) == T.LongType() for t in LONG)
    assert all(spark_type(t) == T.StringType() for t in TEXT)
    assert spark_type("BOOL") == T.BooleanType()
    assert spark_type("FLOAT") == spark_type("DOUBLE") == T.DoubleType()
    assert len(PROPERTY_TYPES) == len(LONG) + len(TEXT) + 3
    with pytest.raises(ValueError):
        spark_type("UNKNOWN")


def test_unknown_property():
    assert PERSON.prop_type("col7") == "DATE"
    with pytest.raises(ValueError, match="does not exist"):
        PERSON.prop_type("col99")
    with pytest.raises(ValueError):
        Label("broken", "vertex", {"a": "UNKNOWN"})


def test_scan_schema():
    assert PERSON.scan_schema(no_column=True).fieldNames() == ["_vertexId"]
    assert FRIEND.scan_schema(["col1"]).simpleString() == (
        "struct<_srcId:string,_dstId:string,_rank:bigint,col1:string>"
    )
    full = PERSON.scan_schema()
    assert len(full) == 14 and not full["_vertexId"].nullable and full["col3"].nullable
    # The list order holds, and no_column beats it.
    assert PERSON.scan_schema(["col6", "col1"]).fieldNames()[1:] == ["col6", "col1"]
    assert len(PERSON.scan_schema(["col1"], no_column=True)) == 1


@pytest.mark.parametrize("write", [lambda **o: VertexWrite("id", **o), lambda **o: EdgeWrite("a", "b", **o)])
def test_write_options(write):
    assert write(mode="UPDATE", batch=512).mode == "update"
    for wrong in ({"mode": "update", "batch": 513}, {"batch": -1}, {"batch": 0}, {"mode": "merge"}):
        with pytest.raises(ValueError):
            write(**wrong)
    assert write(batch=513).batch == 513


def test_policies():
    assert VertexWrite("id", policy="HASH").policy == "hash"
    assert VertexWrite("id", policy="").policy is None
    assert EdgeWrite("a", "b", src_policy="uuid", dst_policy="Hash").dst_policy == "hash"
    with pytest.raises(ValueError):
        VertexWrite("id", policy="md5")
    with pytest.raises(ValueError):
        EdgeWrite("a", "b", dst_policy="crc")


def test_required_names():
    for make in (
        lambda: VertexWrite(""),
        lambda: EdgeWrite("", "b"),
        lambda: EdgeWrite("a", ""),
        lambda: Label(" ", "vertex"),
        lambda: Label("a", "tag"),
        lambda: Space(""),
        lambda: Space("a", vid_type="UUID"),
        lambda: Space("a", n_parts=0),
    ):
        with pytest.raises(ValueError):
            make()
    assert EdgeWrite("a", "b", "").rank_field is None


def test_as_read_is_kept_per_table(spark):
    df = spark.createDataFrame([], PERSON.scan_schema())
    held = Space("s").with_table(PERSON, df, as_read=True)
    assert held.as_read == {("vertex", "person")}
    assert held.with_table(PERSON, df).as_read == frozenset()


def test_table_must_hold_its_label(spark):
    with pytest.raises(ValueError, match="lacks"):
        Space("s").with_table(PERSON, spark.createDataFrame([("1",)], "_vertexId string"))
