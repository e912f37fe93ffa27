"""Expressions for vertex ids and edge ranks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphtables.functions.text import escape_text, is_integer_text
from graphtables.model import INT


def hash_id(text: Column) -> Column:
    """Key of the ``hash`` policy: the first 60 bits of the md5, as a non-negative bigint."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def uuid_id(text: Column) -> Column:
    """Key of the ``uuid`` policy: the md5 laid out 8-4-4-4-12, so equal ids give equal keys."""
    digest = F.md5(text)
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.substring(digest, 13, 4),
        F.substring(digest, 17, 4),
        F.substring(digest, 21, 12),
    )


def vid_key(value: Column, policy: str | None, vid_type: str) -> Column:
    """The id as it is kept in a table: always text; null when it is no id of the space."""
    text = value.cast("string")
    if policy == "hash":
        return hash_id(text).cast("string")
    if policy == "uuid" and vid_type == INT:  # an INT space holds no text: other bits of the same md5
        return F.conv(F.substring(F.md5(text), 17, 15), 16, 10).cast("bigint").cast("string")
    if policy == "uuid":
        return uuid_id(text)
    if vid_type == INT:
        return F.when(is_integer_text(text), text.try_cast("bigint").cast("string"))
    return text


def vid_text(value: Column, policy: str | None, vid_type: str) -> Column:
    """The id as it is spelled in a statement. Under a policy the id is not escaped."""
    text = value.cast("string")
    if policy:
        return F.concat(F.lit(f'{policy}("'), text, F.lit('")'))
    if vid_type == INT:
        return F.when(is_integer_text(text), text)
    return F.concat(F.lit('"'), escape_text(text), F.lit('"'))


def rank_value(value: Column | None) -> Column:
    """Rank as bigint: 0 when no rank is given, null when the text is no integer."""
    if value is None:
        return F.lit(0).cast("bigint")
    text = value.cast("string")
    return F.when(is_integer_text(text), text.try_cast("bigint"))
