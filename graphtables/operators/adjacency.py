"""Edges laid out at both of their ends, so that hop after hop joins them without moving them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphtables.model import EDGE_KEY
from graphtables.session import scratch_path

#: The edges of a vertex lie in so many buckets at most: what spreads a hub, and the times a frontier is sent.
SALTS = 8
_AT = ["here", "salt"]


def adjacency(edges: DataFrame) -> DataFrame:
    """``edges`` (label and key) twice, at their source and at their target, as a table in buckets of ``here, salt``.

    Columns: here, there, salt, label, _rank, out (whether the edge starts here). The edges are shuffled once, for this table; a join
    on ``here, salt`` then reads each bucket where it lies. The salt comes from the rest of the edge, so the edges of a hub are dealt to
    SALTS buckets. The files lie in the shared folder; the name in the catalog is needed for writing only.
    """
    spark = edges.sparkSession

    def end(here: str, there: str, out: bool) -> DataFrame:
        salt = F.pmod(F.xxhash64(there, "_rank", "label"), F.lit(SALTS)).cast("int")
        return edges.select(F.col(here).alias("here"), F.col(there).alias("there"), salt.alias("salt"), "label", "_rank", F.lit(out).alias("out"))

    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"adjacency_{uuid.uuid4().hex}"
    both = end("_srcId", "_dstId", True).unionByName(end("_dstId", "_srcId", False)).repartition(n, *_AT)
    both.write.bucketBy(n, *_AT).sortBy(*_AT).option("path", scratch_path(spark, name)).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files of a table with a path of its own stay
    return table


def beside(table: DataFrame, vertices: DataFrame) -> DataFrame:
    """The rows of an adjacency whose ``here`` is one of ``vertices`` (unique, column ``vid``); only the vertices are shuffled."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    side = vertices.select(F.col("vid").alias("here"), salts.alias("salt"))
    return table.join(side.hint("merge"), _AT, "left_semi")


def edges_of(table: DataFrame) -> DataFrame:
    """The edges of adjacency rows, each once, as ``label, _srcId, _dstId, _rank``."""
    source, target = F.when(F.col("out"), F.col("here")).otherwise(F.col("there")), F.when(F.col("out"), F.col("there")).otherwise(F.col("here"))
    ends: list[Column] = [source.alias("_srcId"), target.alias("_dstId")]
    return table.select("label", *ends, "_rank").distinct().select("label", *EDGE_KEY)
