"""What the operators share: reading tables, checking columns, normalising text, tables on disk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphtables.session import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


#: Rows of a batch that goes to Python. Rows are whole texts here, and a batch is held several times over.
ARROW_ROWS = 1000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of ``sf_dir``. Sessions that send more than ARROW_ROWS rows to Python at once are set to that number."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **named: str) -> DataFrame:
    """The named columns under the operators' own names; whatever else ``df`` has cannot clash."""
    return df.select(*[df[column].alias(own) for own, column in named.items()])


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: it is computed once, and lost executors don't matter."""
    return materialize(df, f"llm_{name}")


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of an ASCII text: eight shifts for each of its bytes."""
    # fixed value: the reversed polynomial of CRC-32
    shift = "list_reduce(list_prepend(xor(a, c), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, c: {shift}))"
