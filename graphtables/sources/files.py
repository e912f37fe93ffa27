"""Files that feed a mutation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_header_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line; every column arrives as text, with no pass to infer types."""
    return spark.read.option("header", True).csv(path)


def read_json_lines(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """One JSON object per line. Give the schema where it is known: it saves a whole pass."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)
