"""Expressions that read property values and spell them as statement literals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphtables.functions.text import escape_text, is_integer_text
from graphtables.model import spark_type

# Text forms of dates and times.
DATE_FORM = "yyyy-MM-dd"
DATETIME_FORM = "yyyy-MM-dd'T'HH:mm:ss.SSS"
TIME_FORM = "HH:mm:ss"
# Functions that wrap the text of a literal.
LITERAL_FUNCTIONS = {
    "DATE": "date",
    "DATETIME": "datetime",
    "TIME": "time",
    "GEOGRAPHY": "ST_GeogFromText",
}

# Bits of the whole numbers.
_INT_BITS = {"INT8": 8, "INT16": 16, "INT32": 32, "INT64": 64}
_CLOCK = (T.TimestampType, T.TimestampNTZType, T.DateType)
_FORMS = {"DATE": DATE_FORM, "DATETIME": DATETIME_FORM, "TIME": TIME_FORM}


def read_property(value: Column, property_type: str, held_as: T.DataType) -> Column:
    """A property as a scan returns it. Text that does not fit the type becomes null.

    Dates and times are UTC text; a TIMESTAMP is its epoch second. The session runs in UTC.
    """
    target = spark_type(property_type)
    if property_type == "TIMESTAMP":
        if isinstance(held_as, _CLOCK):
            return F.unix_timestamp(value.cast("timestamp"))
        if isinstance(held_as, T.StringType):
            return F.coalesce(
                value.try_cast("bigint"), F.unix_timestamp(value.try_cast("timestamp"))
            )
        return value.try_cast("bigint")
    if property_type in _FORMS:
        if isinstance(held_as, _CLOCK):
            return F.date_format(value, _FORMS[property_type])
        if property_type == "DATE":
            return F.date_format(value.try_cast("date"), DATE_FORM)
        if property_type == "DATETIME":
            return F.date_format(value.try_cast("timestamp"), DATETIME_FORM)
        return value.cast("string")
    if type(held_as) is type(target):
        return value
    return value.try_cast(target)


def fitting_property(value: Column, property_type: str, held_as: T.DataType) -> Column:
    """A property as it may be stored: null where the value does not fit its declared type.

    Whole numbers must lie in the range of their type, and a number with a fraction is none.
    """
    read = read_property(value, property_type, held_as)
    if property_type in _INT_BITS:
        top = 2 ** (_INT_BITS[property_type] - 1)
        read = F.when(read.between(-top, top - 1), read)
    if isinstance(held_as, (T.FloatType, T.DoubleType, T.DecimalType)) and (
        property_type in _INT_BITS or property_type == "TIMESTAMP"
    ):
        read = F.when(value == F.floor(value), read)
    return read


def property_text(value: Column, property_type: str, held_as: T.DataType) -> Column:
    """The value of any property type as text; null stays null."""
    return read_property(value, property_type, held_as).cast("string")


def _raw_text(value: Column, property_type: str, held_as: T.DataType) -> Column:
    if isinstance(held_as, _CLOCK):
        return F.date_format(value, _FORMS.get(property_type, DATETIME_FORM))
    return value.cast("string")


def property_literal(value: Column, property_type: str, held_as: T.DataType) -> Column:
    """The value as it is spelled in a statement; a null cell is the word ``null``."""
    spark_type(property_type)
    text = _raw_text(value, property_type, held_as)
    if property_type in ("STRING", "FIXED_STRING"):
        text = F.concat(F.lit('"'), escape_text(text), F.lit('"'))
    elif property_type in LITERAL_FUNCTIONS:
        text = F.concat(F.lit(LITERAL_FUNCTIONS[property_type] + '("'), text, F.lit('")'))
    elif property_type == "TIMESTAMP":
        text = F.when(is_integer_text(text), text).otherwise(
            F.concat(F.lit('timestamp("'), text, F.lit('")'))
        )
    return F.coalesce(text, F.lit("null"))
