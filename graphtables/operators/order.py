"""Positions in a total order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphtables.session import materialize

#: ``monotonically_increasing_id`` keeps the number of the partition above these bits, and that of the row below.
_ROW_BITS = 33


def numbered(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with a column ``name``: 0, 1, 2, ... along ``order``, one number for each row.

    Rows are dealt to ranges of the order and sorted there, so a value that a large share of all rows has is split
    over as many ranges as the rest of ``order`` allows. The numbers of a range start after the rows of the ranges
    before it; what is summed for that is one count per range. The ranges are written to the shared folder first: a
    range that is computed again lies between the same bounds, as the rows are not read from the source again.

    Rows that are equal in all of ``order`` take their numbers in no particular order.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    dealt = materialize(dealt, "ranges")
    spread = F.shiftright("_at", _ROW_BITS).cast("int")
    counts = dealt.groupBy(spread.alias("_range")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    # one row per range, and there are no more ranges than spark.sql.shuffle.partitions
    placed = dealt.withColumn("_range", spread).join(F.broadcast(starts), "_range")
    within = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.select(*df.columns, (F.col("_start") + within).alias(name))
