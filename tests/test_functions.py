import hashlib
import re
import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphtables import functions as G

TEXT = st.text(st.characters(exclude_categories=["Cs"]), max_size=20)
HOSTILE = st.text(st.sampled_from("\\\t\n\"'\r\bab1-é"), max_size=12)


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


def many(spark, column, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    return [r[1] for r in sorted(df.select("i", column(F.col("v"))).collect())]


def test_integer_text(spark):
    good = ["123", "-123", "0", "-0", "007", "9" * 40]
    bad = ["", "-", "1.0", "a123", "123b", "12\n", "\n12", "+1", " 1", "١٢"]
    assert many(spark, G.is_integer_text, good) == [True] * len(good)
    assert many(spark, G.is_integer_text, bad) == [False] * len(bad)


@pytest.mark.parametrize(
    "plain, escaped",
    [
        ("123", "123"),
        ("a\\c", "a\\\\c"),
        ("a\tb", "a\\tb"),
        ("a\nb", "a\\nb"),
        ('a"b', 'a\\"b'),
        ("a'b", "a\\'b"),
        ("a\rb", "a\\rb"),
        ("a\bb", "a\\bb"),
        ("\\n", "\\\\n"),
        ("\\\n", "\\\\\\n"),
    ],
)
def test_escape(spark, plain, escaped):
    assert one(spark, G.escape_text, plain) == escaped


def unescape(text: str) -> str:
    back = {"t": "\t", "n": "\n", "r": "\r", "b": "\b"}
    return re.sub(r"\\(.)", lambda m: back.get(m[1], m[1]), text, flags=re.S)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(TEXT, HOSTILE), min_size=5, max_size=30))
def test_escape_can_be_undone(spark, texts):
    escaped = many(spark, G.escape_text, texts)
    assert [unescape(t) for t in escaped] == texts
    assert not any(c in t for t in escaped for c in "\t\n\r\b")


def test_policies(spark):
    ids = ["c1", "", "é", "a" * 100]
    digests = [hashlib.md5(i.encode()).hexdigest() for i in ids]
    assert many(spark, G.hash_id, ids) == [int(d[:15], 16) for d in digests]
    assert many(spark, G.uuid_id, ids) == [str(uuid.UUID(d)) for d in digests]


def test_vid_key(spark):
    assert one(spark, lambda c: G.vid_key(c, None, "STRING"), "a b") == "a b"
    assert one(spark, lambda c: G.vid_key(c, None, "INT"), "-007") == "-7"
    assert one(spark, lambda c: G.vid_key(c, None, "INT"), "x") is None
    assert one(spark, lambda c: G.vid_key(c, None, "INT"), "9" * 30) is None
    assert one(spark, lambda c: G.vid_key(c, "hash", "INT"), "x").isdigit()


def test_vid_text(spark):
    assert one(spark, lambda c: G.vid_text(c, None, "STRING"), True, "boolean") == '"true"'
    assert one(spark, lambda c: G.vid_text(c, "hash", "INT"), True, "boolean") == 'hash("true")'
    assert one(spark, lambda c: G.vid_text(c, None, "STRING"), 'a"b') == '"a\\"b"'
    assert one(spark, lambda c: G.vid_text(c, "uuid", "STRING"), 'a"b') == 'uuid("a"b")'
    assert one(spark, lambda c: G.vid_text(c, None, "INT"), "12") == "12"
    assert one(spark, lambda c: G.vid_text(c, None, "INT"), "1x") is None


def test_rank(spark):
    assert one(spark, G.rank_value, "1") == 1
    assert one(spark, G.rank_value, "-3") == -3
    assert one(spark, G.rank_value, "true") is None
    assert one(spark, G.rank_value, "9" * 30) is None
    assert spark.range(1).select(G.rank_value(None)).first()[0] == 0


STRING = T.StringType()


@pytest.mark.parametrize(
    "kind, text, value",
    [
        ("INT8", "7", 7),
        ("INT64", "x", None),
        ("BOOL", "true", True),
        ("BOOL", "maybe", None),
        ("DOUBLE", "1.5", 1.5),
        ("TIMESTAMP", "987654321", 987654321),
        ("TIMESTAMP", "2018-05-06T07:08:09", 1525590489),
        ("TIMESTAMP", "noon", None),
        ("DATE", "2018-05-06", "2018-05-06"),
        ("DATE", "first of May", None),
        ("DATETIME", "2018-05-06T07:08:09", "2018-05-06T07:08:09.000"),
        ("DATETIME", "2018-05-06T07:08:09.123456", "2018-05-06T07:08:09.123"),
        ("TIME", "05:06:07", "05:06:07"),
        ("GEOGRAPHY", "POINT(1 2)", "POINT(1 2)"),
        ("STRING", "", ""),
        ("STRING", None, None),
    ],
)
def test_read_from_text(spark, kind, text, value):
    assert one(spark, lambda c: G.read_property(c, kind, STRING), text) == value


@pytest.mark.parametrize(
    "kind, text, literal",
    [
        ("STRING", 'a"b', '"a\\"b"'),
        ("FIXED_STRING", "Ash", '"Ash"'),
        ("DATE", "2016-08-19", 'date("2016-08-19")'),
        ("DATETIME", "2018-05-06T07:08:09", 'datetime("2018-05-06T07:08:09")'),
        ("TIME", "10:10:10", 'time("10:10:10")'),
        ("TIMESTAMP", "987654321", "987654321"),
        ("TIMESTAMP", "2018-05-06T07:08:09", 'timestamp("2018-05-06T07:08:09")'),
        ("GEOGRAPHY", "POINT(1 2)", 'ST_GeogFromText("POINT(1 2)")'),
        ("DURATION", "duration({years:1})", "duration({years:1})"),
        ("INT8", "10", "10"),
        ("BOOL", "true", "true"),
        ("DOUBLE", "1.0", "1.0"),
        ("STRING", None, "null"),
        ("DATE", None, "null"),
    ],
)
def test_literal_from_text(spark, kind, text, literal):
    assert one(spark, lambda c: G.property_literal(c, kind, STRING), text) == literal


def test_literal_from_native_types(spark):
    df = spark.sql(
        "SELECT 1.0D AS d, 100L AS l, true AS b, date'2016-08-19' AS day,"
        " timestamp_ntz'2016-08-19 10:00:00.5' AS t"
    )
    held = {f.name: f.dataType for f in df.schema.fields}

    def literal(name, kind):
        return df.select(G.property_literal(F.col(name), kind, held[name])).first()[0]

    assert literal("d", "DOUBLE") == "1.0"
    assert literal("l", "INT64") == "100"
    assert literal("b", "BOOL") == "true"
    assert literal("day", "DATE") == 'date("2016-08-19")'
    assert literal("t", "DATETIME") == 'datetime("2016-08-19T10:00:00.500")'
    assert literal("t", "TIMESTAMP") == 'timestamp("2016-08-19T10:00:00.500")'
    assert literal("t", "TIME") == 'time("10:00:00")'
