"""Expressions on plain text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What is escaped in a string literal, in the order it is done.
ESCAPES = [
    ("\\", "\\\\"),
    ("\t", "\\t"),
    ("\n", "\\n"),
    ('"', '\\"'),
    ("'", "\\'"),
    ("\r", "\\r"),
    ("\b", "\\b"),
]


def is_integer_text(text: Column) -> Column:
    """True for an optional minus and digits only. ``\\z`` (not ``$``) refuses a last newline."""
    return text.rlike(r"\A-?[0-9]+\z")


def escape_text(text: Column) -> Column:
    for plain, escaped in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text
