"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What a row takes in a broadcast besides the bytes of its values.
ROW_BYTES = 48


def session(app: str = "graphtables", master: str | None = None, **conf) -> SparkSession:
    """A session set for graph tables: UTC, adaptive execution and skew-join splitting on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="graphtables-")
    sc.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; never used twice."""
    return f"{shared_dir(spark)}/graphtables/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage of iterative work and survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _width(cols) -> Column:
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in cols]
    return reduce(lambda a, b: a + b, sizes, F.lit(ROW_BYTES)).cast("bigint")


def materialize_measured(df: DataFrame, name: str, cols=None) -> tuple[DataFrame, int, int]:
    """``df`` as in :func:`materialize`, its rows, and a bound of the bytes that ``cols`` (all by default) take.

    Both are found in what was written: the rows in the files' footers, and bytes are looked at only where the rows are few.
    """
    kept = materialize(df, name)
    rows = kept.count()
    few = is_small(df.sparkSession, rows * ROW_BYTES)
    return kept, rows, measure(kept, cols)[1] if few else rows * ROW_BYTES


def measure(df: DataFrame, cols=None) -> tuple[int, int]:
    """Rows of ``df`` and an upper bound of the bytes that ``cols`` (all by default) take."""
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_width(cols or df.columns)), F.lit(0))).first()
    return rows, size


def size_of(df: DataFrame, cols=None) -> int:
    """A bound of the bytes of ``df``, found by its row count alone where that is large already."""
    rows = df.count()
    return measure(df, cols)[1] if is_small(df.sparkSession, rows * ROW_BYTES) else rows * ROW_BYTES


def is_small(spark: SparkSession, size: int) -> bool:
    """Whether ``size`` bytes are within what the session may broadcast."""
    return size <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def join_side(df: DataFrame, size: int) -> DataFrame:
    """``df`` as the right side of a join, given a measured bound of its size.

    The size of a file says little about the rows that come out of it, so the choice is not left
    to the estimate: a side is broadcast only when it was measured to be small, and any other is
    joined by sorted shuffle, which adaptive execution can split when a key is hot.
    """
    return F.broadcast(df) if is_small(df.sparkSession, size) else df.hint("merge")
