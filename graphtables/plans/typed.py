"""A label with a property of every type, derived from the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphtables.model import VERTEX, Label, Space
from graphtables.plans import sql
from graphtables.plans.demo import prefixed, table

TYPED = {
    "p_string": "STRING",
    "p_fixed": "FIXED_STRING",
    "p_int8": "INT8",
    "p_int16": "INT16",
    "p_int32": "INT32",
    "p_int64": "INT64",
    "p_bool": "BOOL",
    "p_float": "FLOAT",
    "p_double": "DOUBLE",
    "p_date": "DATE",
    "p_datetime": "DATETIME",
    "p_timestamp": "TIMESTAMP",
    "p_time": "TIME",
    "p_geo": "GEOGRAPHY",
    "p_duration": "DURATION",
}


def typed_rows(spark, sf_dir, nulls: bool = False):
    """Event rows with native types; with ``nulls`` an error event has no values at all."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    values = {
        "p_string": F.col("props"),
        "p_fixed": F.substring("event_type", 1, 8),
        "p_int8": F.pmod("user_id", F.lit(100)).cast("tinyint"),
        "p_int16": F.pmod("event_id", F.lit(30000)).cast("smallint"),
        "p_int32": F.col("user_id").cast("int"),
        "p_int64": F.col("event_id"),
        "p_bool": F.col("value") > 50,
        "p_float": F.floor("value").cast("float"),
        "p_double": F.col("value"),
        "p_date": F.col("ts").cast("date"),
        "p_datetime": F.col("ts"),
        "p_timestamp": F.col("ts"),
        "p_time": F.date_format("ts", "HH:mm:ss"),
        "p_geo": F.concat(F.lit("POINT("), "user_id", F.lit(" "), "event_id", F.lit(")")),
        "p_duration": F.concat(F.lit("duration({seconds:"), "user_id", F.lit("})")),
    }
    present = F.col("event_type") != "error"
    return table(spark, sf_dir, "events").select(
        prefixed("t", "event_id").alias("_vertexId"),
        *[(F.when(present, c) if nulls else c).alias(n) for n, c in values.items()],
    )


def typed_space(spark, sf_dir, nulls: bool = False) -> Space:
    label = Label("reading", VERTEX, TYPED)
    return Space("typed").with_table(label, typed_rows(spark, sf_dir, nulls))


_READ = {
    "p_string": "props",
    "p_fixed": "substr(event_type, 1, 8)",
    "p_int8": "(user_id % 100)::BIGINT",
    "p_int16": "(event_id % 30000)::BIGINT",
    "p_int32": "user_id",
    "p_int64": "event_id",
    "p_bool": "value > 50",
    "p_float": "floor(value)::DOUBLE",
    "p_double": "value",
    "p_date": sql.as_date("ts"),
    "p_datetime": sql.as_datetime("ts"),
    "p_timestamp": "epoch_us(ts) // 1000000",
    "p_time": "strftime(ts, '%H:%M:%S')",
    "p_geo": "'POINT(' || user_id || ' ' || event_id || ')'",
    "p_duration": "'duration({seconds:' || user_id || '})'",
}


def sql_escape(text: str) -> str:
    for plain, escaped in (
        (r"'\'", r"'\\'"),
        ("chr(9)", r"'\t'"),
        ("chr(10)", r"'\n'"),
        ("'\"'", "'\\\"'"),
        ("''''", "'\\'''"),
        ("chr(13)", r"'\r'"),
        ("chr(8)", r"'\b'"),
    ):
        text = f"replace({text}, {plain}, {escaped})"
    return text


def _literal(name: str, value: str) -> str:
    kind = TYPED[name]
    if kind in ("STRING", "FIXED_STRING"):
        return f"'\"' || {sql_escape(value)} || '\"'"
    wrap = {"DATE": "date", "DATETIME": "datetime", "TIME": "time", "GEOGRAPHY": "ST_GeogFromText"}
    if kind in wrap:
        return f"'{wrap[kind]}(\"' || {value} || '\")'"
    if kind == "TIMESTAMP":
        return f"'timestamp(\"' || {sql.as_datetime('ts')} || '\")'"
    return f"({value})::VARCHAR"


def typed_sql(form: str, nulls: bool = False) -> str:
    """The label in SQL as it is read, as text, or as literals."""
    cols = []
    for name, value in _READ.items():
        if form == "text":
            value = f"({value})::VARCHAR"
        elif form == "literal":
            value = _literal(name, value)
        if nulls:
            value = f"CASE WHEN event_type <> 'error' THEN {value} END"
            if form == "literal":
                value = f"coalesce({value}, 'null')"
        cols.append(f"{value} AS {name}")
    return f"SELECT 't' || event_id AS _vertexId, {', '.join(cols)} FROM events"
