"""Mutations spelled as a table of batched statements.

Every change row becomes one piece of text; the pieces are dealt to parts, ordered inside the
part and joined, ``batch`` at a time. Nothing is numbered across the whole table.

Equal pieces are first counted (partly on the map side) and carried as one row with its count,
cut into runs of at most one batch. A part is found from the text of the piece and the number of
its run, so a row that occurs very many times is spread over all parts, and one task never holds
more than its share. The layout depends on the rows only: a recomputed task gives the same result.

When a write says ``order_by``, the order of the changes of a key matters: a part is then found from
the key alone, and rows stand in the order of key, ``order_by`` and text, so that whoever runs a
part from its first batch to its last ends at the last change of every key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphtables.functions import hash_id, property_literal, rank_value, vid_text
from graphtables.model import EDGE, VERTEX, EdgeWrite, Label, VertexWrite, require_columns
from graphtables.operators.mutate import REASON, edge_ids, vertex_ids

# Rows of a part, about, when the number of parts is not given.
ROWS_PER_PART = 10_000

_KEY = "_key"

# How the statements are spelled, and what separates their rows.
INSERT_HEAD = "INSERT {kind} `{label}`({names}) VALUES "
INSERT_ABSENT_HEAD = "INSERT {kind} IF NOT EXISTS `{label}`({names}) VALUES "
UPDATE_HEAD = "UPDATE {kind} ON `{label}` "
DELETE_VERTEX_HEAD = "DELETE VERTEX "
DELETE_VERTEX_TAIL = " WITH EDGE"
DELETE_EDGE_HEAD = "DELETE EDGE `{label}` "
INSERT_SEPARATOR = ", "
UPDATE_SEPARATOR = ";"
DELETE_SEPARATOR = ","
VALUE_SEPARATOR = ", "
ASSIGNMENT_SEPARATOR = ","


def quoted(name: str) -> str:
    return f"`{name}`"


def _values(literals: dict[str, Column]) -> Column:
    return F.concat_ws(VALUE_SEPARATOR, *literals.values())


def _assignments(literals: dict[str, Column]) -> Column:
    pairs = [F.concat(F.lit(f"{quoted(n)}="), text) for n, text in literals.items()]
    return F.concat_ws(ASSIGNMENT_SEPARATOR, *pairs)


def _literals(changes: DataFrame, label: Label, write) -> dict[str, Column]:
    if write.mode == "delete":
        return {}
    held = {f.name: f.dataType for f in changes.schema.fields}
    return {
        n: property_literal(F.col(n), label.prop_type(n), held[n])
        for n in write.prop_columns(changes, label)
    }


def _piece(identity: Column, literals: dict[str, Column], kind: str, label: str, write) -> Column:
    """The text one row adds to a statement."""
    if write.mode == "insert":
        return F.concat(identity, F.lit(": ("), _values(literals), F.lit(")"))
    if write.mode == "update":
        if not literals:
            raise ValueError("an update needs at least one property")
        head = UPDATE_HEAD.format(kind=kind.upper(), label=label)
        return F.concat(F.lit(head), identity, F.lit(" SET "), _assignments(literals))
    return identity


def _frame(kind: str, label: str, names, write) -> tuple[str, str, str]:
    """What stands before, between and after the pieces of a statement."""
    if write.mode == "insert":
        head = INSERT_HEAD if write.overwrite else INSERT_ABSENT_HEAD
        names = ",".join(quoted(n) for n in names)
        return head.format(kind=kind, label=label, names=names), INSERT_SEPARATOR, ""
    if write.mode == "update":
        return "", UPDATE_SEPARATOR, ""
    if kind == VERTEX:
        tail = DELETE_VERTEX_TAIL if write.delete_edge else ""
        return DELETE_VERTEX_HEAD, DELETE_SEPARATOR, tail
    return DELETE_EDGE_HEAD.format(label=label), DELETE_SEPARATOR, ""


def _order(identity: Column, write) -> list[Column]:
    """The key and the ordering columns of a write that keeps the order of its changes."""
    if write.mode == "delete" or not write.order_by:
        return []
    return [identity.alias(_KEY), *[F.col(c).alias(f"_order_{i}") for i, c in enumerate(write.order_by)]]


def vertex_pieces(changes: DataFrame, label: Label, write: VertexWrite, vid_type: str) -> DataFrame:
    """One text ``piece`` per usable row; rows without a usable id are left to ``id_rejects``."""
    require_columns(changes, write.id_fields)
    _, _, reason = vertex_ids(write, vid_type)
    identity = vid_text(F.col(write.vid_field), write.policy, vid_type)
    piece = _piece(identity, _literals(changes, label, write), VERTEX, label.name, write)
    return changes.filter(reason.isNull()).select(*_order(identity, write), piece.alias("piece"))


def edge_pieces(changes: DataFrame, label: Label, write: EdgeWrite, vid_type: str) -> DataFrame:
    require_columns(changes, write.id_fields)
    _, _, reason = edge_ids(write, vid_type)
    identity = F.concat(
        vid_text(F.col(write.src_field), write.src_policy, vid_type),
        F.lit("->"),
        vid_text(F.col(write.dst_field), write.dst_policy, vid_type),
    )
    if write.rank_field or write.mode != "insert":
        rank = rank_value(F.col(write.rank_field) if write.rank_field else None)
        identity = F.concat(identity, F.lit("@"), rank.cast("string"))
    piece = _piece(identity, _literals(changes, label, write), EDGE, label.name, write)
    return changes.filter(reason.isNull()).select(*_order(identity, write), piece.alias("piece"))


def id_rejects(changes: DataFrame, write, vid_type: str) -> DataFrame:
    """The rows a rendering leaves out, as ``raw ids (text), reason``."""
    ids = vertex_ids if isinstance(write, VertexWrite) else edge_ids
    _, raw, reason = ids(write, vid_type)
    return changes.select(
        *[c.cast("string").alias(n) for n, c in raw.items()], reason.alias(REASON)
    ).filter(F.col(REASON).isNotNull())


def part_count(changes: DataFrame, rows_per_part: int = ROWS_PER_PART) -> int:
    """As many parts as keep each at about ``rows_per_part`` rows."""
    return max(1, math.ceil(changes.count() / rows_per_part))


def batched(pieces: DataFrame, batch: int, n_parts: int) -> DataFrame:
    """Pieces dealt to parts and batches: ``part, batch_no, start, piece, copies``, in the order of start."""
    order = [c for c in pieces.columns if c != "piece"]
    counted = pieces.groupBy(*order, "piece").agg(F.count(F.lit(1)).alias("n"))
    dealt_by = F.col(_KEY) if _KEY in order else F.concat_ws("#", "piece", F.col("run").cast("string"))
    runs = counted.select(
        *order, "piece", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / batch))).alias("run")
    ).select(
        *order,
        "piece",
        F.least(F.lit(batch), F.col("n") - F.col("run") * batch).alias("k"),
        "run",
        (F.pmod(hash_id(dealt_by), F.lit(n_parts)) + 1).alias("part"),
    )
    w = Window.partitionBy("part").orderBy(*order, "piece", "run")
    placed = runs.withColumn(
        "end", F.sum("k").over(w.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("start", F.col("end") - F.col("k"))
    # A run is at most one batch long, so it lies in one batch or in two.
    cut = placed.select(
        "part",
        "piece",
        "start",
        "end",
        F.explode(
            F.sequence(F.floor(F.col("start") / batch), F.floor((F.col("end") - 1) / batch))
        ).alias("batch_no"),
    )
    copies = F.least("end", (F.col("batch_no") + 1) * batch) - F.greatest(
        "start", F.col("batch_no") * batch
    )
    return cut.select("part", "batch_no", "start", "piece", copies.cast("int").alias("copies"))


def render_batches(pieces: DataFrame, batch: int, n_parts: int) -> DataFrame:
    """The rows in each batch: ``part, batch_no, n_rows``."""
    return (
        batched(pieces, batch, n_parts)
        .groupBy("part", "batch_no")
        .agg(F.sum("copies").alias("n_rows"))
    )


def statements(pieces: DataFrame, frame: tuple[str, str, str], batch: int, n_parts: int) -> DataFrame:
    """The statements: ``part, batch_no, n_rows, statement``. A group is one batch, never more."""
    head, separator, tail = frame
    grouped = (
        batched(pieces, batch, n_parts)
        .groupBy("part", "batch_no")
        .agg(
            F.sum("copies").alias("n_rows"),
            F.sort_array(F.collect_list(F.struct("start", "piece", "copies"))).alias("pieces"),
        )
    )
    repeated = F.flatten(
        F.transform("pieces", lambda p: F.array_repeat(p["piece"], p["copies"]))
    )
    return grouped.select(
        "part",
        "batch_no",
        "n_rows",
        F.concat(F.lit(head), F.array_join(repeated, separator), F.lit(tail)).alias("statement"),
    )


def render_vertices(
    changes: DataFrame,
    label: Label,
    write: VertexWrite,
    vid_type: str,
    n_parts: int | None = None,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Statements that write ``changes`` as vertices. All rows are kept, repeated ones too.

    There are ``n_parts`` parts, or as many as hold about ``rows_per_part`` rows each.
    """
    names = [] if write.mode == "delete" else write.prop_columns(changes, label)
    pieces = vertex_pieces(changes, label, write, vid_type)
    frame = _frame(VERTEX, label.name, names, write)
    return statements(pieces, frame, write.batch, n_parts or part_count(changes, rows_per_part))


def render_edges(
    changes: DataFrame,
    label: Label,
    write: EdgeWrite,
    vid_type: str,
    n_parts: int | None = None,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Statements that write ``changes`` as edges, in parts like those of ``render_vertices``."""
    names = [] if write.mode == "delete" else write.prop_columns(changes, label)
    pieces = edge_pieces(changes, label, write, vid_type)
    frame = _frame(EDGE, label.name, names, write)
    return statements(pieces, frame, write.batch, n_parts or part_count(changes, rows_per_part))
