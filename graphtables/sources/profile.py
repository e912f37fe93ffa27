"""What the labels of a space hold: profiles, kinds, id type, parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphtables.functions import hash_id, is_integer_text
from graphtables.model import EDGE, INT, STRING, VERTEX, Space

#: The columns of a profile.
PROFILE = "kind string, label string, property string, property_type string, n_rows bigint, n_nulls bigint"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def label_profile(space: Space, n_parts: int | None = None) -> DataFrame:
    """Per label and property: the type, the row count and the null count.

    One aggregate per label table; only counts leave the map side. With ``n_parts`` a row for each part of the keys that has rows.
    """
    profiles = []
    for (kind, name), label in space.labels.items():
        df = space.frame(kind, name)
        counts = [F.count_if(F.col(p).isNull()).alias(f"nulls_{i}") for i, p in enumerate(label.props)]
        totals = (df.groupBy(F.pmod(F.hash(*label.key), F.lit(n_parts))) if n_parts else df).agg(F.count(F.lit(1)).alias("n_rows"), *counts)
        entries = [
            F.struct(
                F.lit(p).alias("property"),
                F.lit(t).alias("property_type"),
                F.col(f"nulls_{i}").alias("n_nulls"),
            )
            for i, (p, t) in enumerate(label.props.items())
        ] or [
            F.struct(
                F.lit(None).cast("string").alias("property"),
                F.lit(None).cast("string").alias("property_type"),
                F.lit(0).cast("bigint").alias("n_nulls"),
            )
        ]
        profiles.append(
            totals.select("n_rows", F.inline(F.array(*entries))).select(
                F.lit(kind).alias("kind"),
                F.lit(name).alias("label"),
                "property",
                "property_type",
                "n_rows",
                "n_nulls",
            )
        )
    return _union(profiles)


def label_kind(space: Space, label: str) -> str | None:
    """``vertex`` or ``edge``, the vertex label first; None when there is no such label."""
    return next((k for k, n in sorted(space.labels, reverse=True) if n == label), None)


def label_kinds(space: Space, requested: DataFrame) -> DataFrame:
    """The kind of each requested label (column ``label``), null when unknown."""
    name = F.col("label")
    kind = F.when(name.isin(space.names(VERTEX)), VERTEX).when(name.isin(space.names(EDGE)), EDGE)
    return requested.withColumn("kind", kind)


def _ids(space: Space) -> DataFrame:
    parts = []
    for (kind, name), label in space.labels.items():
        df = space.frame(kind, name)
        parts += [df.select(F.col(k).cast("string").alias("id")) for k in label.key if k != "_rank"]
    return _union(parts)


def vid_type_check(space: Space) -> DataFrame:
    """INT when every id found in the tables is integer text, else STRING."""
    return (
        _ids(space)
        .agg(
            F.bool_and(is_integer_text(F.col("id"))).alias("all_integers"),
            F.count(F.lit(1)).alias("n_ids"),
        )
        .select(
            F.lit(space.name).alias("space"),
            F.when(F.col("all_integers"), INT).otherwise(STRING).alias("vid_type"),
            "n_ids",
        )
    )


def part_of(key: Column, n_parts: int) -> Column:
    """Part 1..n of a key text."""
    return (F.pmod(hash_id(key), F.lit(n_parts)) + 1).cast("bigint")


def task_of(part: Column, n_tasks: int) -> Column:
    """Task 1..n that reads a part when the parts are dealt out in turn."""
    return (F.pmod(part - 1, F.lit(n_tasks)) + 1).cast("bigint")


def scan_parts(index: int, n_parts: int, n_tasks: int) -> list[int]:
    """The parts that task ``index`` (from 1) reads; none when there are more tasks than parts."""
    return list(range(index, n_parts + 1, n_tasks))


def _key_text(df: DataFrame, key: list[str]) -> Column:
    return F.concat_ws("|", *[F.col(k).cast("string") for k in key])


def laid_out(space: Space, kind: str, name: str) -> DataFrame:
    """The label table with the part of each row. Edges lie by their whole key, so that a
    vertex with very many edges is spread over all parts."""
    label = space.label(kind, name)
    df = space.frame(kind, name)
    return df.withColumn("part", part_of(_key_text(df, label.key), space.n_parts))


def part_counts(space: Space, kind: str, name: str) -> DataFrame:
    return laid_out(space, kind, name).groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"))


def scan_part_assignment(space: Space, kind: str, name: str, n_tasks: int) -> DataFrame:
    """Rows of each part and the task that reads it."""
    return part_counts(space, kind, name).select(
        task_of(F.col("part"), n_tasks).alias("task"), "part", "n_rows"
    )
