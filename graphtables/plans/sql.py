"""The label tables of the demonstration graph in SQL, for the checks."""

from __future__ import annotations

from graphtables.plans.demo import EDGES, TAGS

DATETIME = "%Y-%m-%dT%H:%M:%S.%g"


def as_datetime(column: str) -> str:
    return f"strftime({column}, '{DATETIME}')"


def as_date(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def hash60(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


_KEYS = {
    "region": "'r' || r_regionkey",
    "nation": "'n' || n_nationkey",
    "customer": "'c' || c_custkey",
    "orders": "'o' || o_orderkey",
    "part": "'p' || p_partkey",
    "supplier": "'s' || s_suppkey",
}


def _prop(name: str, kind: str) -> str:
    if kind == "DATETIME":
        return f"{as_datetime(name)} AS {name}"
    if kind == "DATE":
        return f"{as_date(name)} AS {name}"
    if kind == "INT32":
        return f"{name}::BIGINT AS {name}"
    return name


def tag(name: str, cols=None) -> str:
    props = TAGS[name]
    picked = [_prop(c, props[c]) for c in (props if cols is None else cols)]
    return f"SELECT {', '.join([_KEYS[name] + ' AS _vertexId', *picked])} FROM {name}"


CONTAINS_TIES = (
    "l_extendedprice DESC, l_quantity DESC, l_shipdate DESC, l_suppkey DESC, l_discount DESC"
)
_EDGE_FROM = {
    "placed": ("'c' || o_custkey", "'o' || o_orderkey", "0", "orders"),
    "contains": (
        "'o' || l_orderkey",
        "'p' || l_partkey",
        "l_linenumber",
        "(SELECT * FROM lineitem QUALIFY row_number() OVER ("
        f"PARTITION BY l_orderkey, l_partkey, l_linenumber ORDER BY {CONTAINS_TIES}) = 1)",
    ),
    "supplied_by": (
        "'p' || l_partkey",
        "'s' || l_suppkey",
        "0",
        "(SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)",
    ),
    "in_nation": (
        "id",
        "'n' || nk",
        "0",
        "(SELECT 'c' || c_custkey AS id, c_nationkey AS nk FROM customer"
        " UNION ALL SELECT 's' || s_suppkey, s_nationkey FROM supplier)",
    ),
    "in_region": ("'n' || n_nationkey", "'r' || n_regionkey", "0", "nation"),
    "did": ("'u' || user_id", "'t' || event_type", "event_id", "events"),
}


def edge(name: str, cols=None) -> str:
    src, dst, rank, source = _EDGE_FROM[name]
    props = EDGES[name]
    picked = [_prop(c, props[c]) for c in (props if cols is None else cols)]
    ids = [f"{src} AS _srcId", f"{dst} AS _dstId", f"({rank})::BIGINT AS _rank"]
    return f"SELECT {', '.join([*ids, *picked])} FROM {source}"


def edge_union(names) -> str:
    """``label, _srcId, _dstId, _rank`` of several edge labels."""
    return " UNION ALL ".join(
        f"SELECT '{n}' AS label, _srcId, _dstId, _rank FROM ({edge(n, [])})" for n in names
    )
