"""Column expressions; all of them are built-in Spark functions put together."""

from graphtables.functions.ids import (
    hash_id,
    rank_value,
    uuid_id,
    vid_key,
    vid_text,
)
from graphtables.functions.properties import (
    fitting_property,
    property_literal,
    property_text,
    read_property,
)
from graphtables.functions.text import escape_text, is_integer_text

__all__ = [
    "escape_text",
    "fitting_property",
    "hash_id",
    "is_integer_text",
    "property_literal",
    "property_text",
    "rank_value",
    "read_property",
    "uuid_id",
    "vid_key",
    "vid_text",
]
