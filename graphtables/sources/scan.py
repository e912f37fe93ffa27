"""Scans of one vertex or edge label, with no, some or all of its properties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphtables.functions import read_property
from graphtables.model import EDGE, VERTEX, Space


def scan(space: Space, kind: str, label: str, cols=(), no_column: bool = False) -> DataFrame:
    """One row per vertex or edge. A plain projection, so Catalyst prunes and pushes down."""
    described = space.label(kind, label)
    df = space.frame(kind, label)
    names = described.selected(cols, no_column)
    if (kind, label) in space.as_read:
        return df.select(*described.key, *names)
    held = {f.name: f.dataType for f in df.schema.fields}
    ids = [F.col(k).cast("bigint" if k == "_rank" else "string").alias(k) for k in described.key]
    props = [
        read_property(F.col(c), described.prop_type(c), held[c]).alias(c)
        for c in names
    ]
    return df.select(*ids, *props)


def scan_vertices(space: Space, label: str, cols=(), no_column: bool = False) -> DataFrame:
    return scan(space, VERTEX, label, cols, no_column)


def scan_edges(space: Space, label: str, cols=(), no_column: bool = False) -> DataFrame:
    return scan(space, EDGE, label, cols, no_column)


def edge_keys(space: Space, labels=None) -> DataFrame:
    """The keys of several edge labels (all by default) as ``label, _srcId, _dstId, _rank``."""
    parts = [
        scan_edges(space, name, no_column=True).select(
            F.lit(name).alias("label"), "_srcId", "_dstId", "_rank"
        )
        for name in (labels or space.names(EDGE))
    ]
    if not parts:
        raise ValueError(f"space {space.name} has no edge labels")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _flag(value) -> bool:
    return str(value).strip().lower() == "true"


# Options that a scan knows; the last line is accepted for the sake of callers that pass one set of options
# to every scan, and has no effect here.
_OPTIONS = {
    "type", "spaceName", "label", "returnCols", "noColumn", "partitionNumber", "limit",
    "operateType", "metaAddress", "timeout", "connectionRetry", "executionRetry",
}


def load(space: Space, options: dict) -> DataFrame:
    """Scan described by text options: ``type, spaceName, label, returnCols, noColumn, ...``.

    ``returnCols`` is split at commas and its entries are taken as they are. The file splits
    decide the read tasks, so ``partitionNumber`` and ``limit`` (a page size) are only checked.
    """
    for name in ("type", "spaceName", "label", "returnCols", "partitionNumber"):
        if name not in options:
            raise ValueError(f"option {name} is required")
    if str(options.get("ngql", "")).strip():
        raise ValueError("option ngql is not supported: queries are typed functions (operators.traverse)")
    unknown = sorted(set(options) - _OPTIONS - {"ngql"})
    if unknown:
        raise ValueError(f"unknown options: {', '.join(unknown)}")
    if options["spaceName"] != space.name:
        raise ValueError(f"space {options['spaceName']} is not {space.name}")
    for name in ("partitionNumber", "limit"):
        if int(options.get(name, 1)) <= 0:
            raise ValueError(f"option {name} must be positive")
    kind = str(options["type"]).lower()
    cols = options["returnCols"].split(",") if options["returnCols"].strip() else []
    return scan(space, kind, options["label"], cols, _flag(options.get("noColumn", False)))
