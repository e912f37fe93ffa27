"""Mutations as DataFrame functions: (label table, change rows) -> (new table, rejected rows).

Keys are unique in a label table and are made unique in the changes first, so the joins on a
whole key cannot be skewed. The changes are shuffled once for that; the join with the label table
and the rows that are added read the same shuffle. Only a cascading delete joins on one end of an edge; there the edge
table is the left side of the anti join, which adaptive execution splits when one vertex holds
very many edges. The changes are written to the shared folder once, with their keys, and measured there; the new table
and the rejected rows both come from that copy, so a feed that gives other rows when it is read again can not
make them disagree. Few changes are broadcast, so that the label table is not shuffled, and many are joined by shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphtables.functions import fitting_property, is_integer_text, rank_value, vid_key
from graphtables.model import (
    EDGE,
    EDGE_KEY,
    INT,
    VERTEX,
    VERTEX_KEY,
    EdgeWrite,
    Label,
    Space,
    VertexWrite,
    require_columns,
    spark_type,
)
from graphtables.session import join_side, materialize_measured
from graphtables.sources.scan import scan

REASON = "reason"
_REASON = "_reason"
_PART = "_part"
#: Marks the rows of a delta whose key is deleted.
GONE = "_gone"


@dataclass(frozen=True)
class Mutation:
    """The changed label tables and the rows that could not be applied."""

    tables: dict[tuple[str, str], DataFrame]
    rejects: DataFrame

    def table(self, kind: str, label: str) -> DataFrame:
        return self.tables[(kind, label)]


def latest_per_key(df: DataFrame, key: list[str], order_by=(), first: bool = False, few: bool = False) -> DataFrame:
    """One row per key: the last (or first) by ``order_by``, ties broken by the whole row.

    ``row_number() = 1`` lets Spark keep one row per key in each map task before the shuffle,
    so a key that holds a large share of all rows does not reach one task whole. That sorts all that a map task
    reads. Where a key has ``few`` rows by construction (one per version) they are dealt by key first, and sorted once.
    """
    df = df.repartition(*key) if few else df
    ties = [c for c in df.columns if c not in key and c not in order_by]
    order = [
        F.col(c).asc_nulls_first() if first else F.col(c).desc_nulls_last()
        for c in [*order_by, *ties]
    ] or [F.lit(1)]
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


# --- from change rows to keyed rows -----------------------------------------------------------


def _id_reason(value: Column, key: Column, policy: str | None, vid_type: str) -> Column:
    reason = F.when(value.isNull(), "null_key")
    if vid_type == INT and not policy:
        reason = reason.when(
            ~is_integer_text(value.cast("string")), "vid_not_numeric"
        ).when(key.isNull(), "vid_out_of_range")
    return reason


def _rank_reason(value: Column | None) -> Column:
    if value is None:
        return F.lit(None).cast("string")
    return (
        F.when(value.isNull(), "null_key")
        .when(~is_integer_text(value.cast("string")), "rank_not_numeric")
        .when(rank_value(value).isNull(), "rank_out_of_range")
    )


def _prop_columns(changes: DataFrame, label: Label | None, write) -> dict[str, Column]:
    require_columns(changes, write.id_fields)
    if write.mode == "delete":
        return {}
    held = {f.name: f.dataType for f in changes.schema.fields}
    return {
        n: fitting_property(F.col(n), label.prop_type(n), held[n])
        for n in write.prop_columns(changes, label)
    }


def _ordering(write) -> list[Column]:
    """The ordering columns as they came, under names that no property has."""
    if write.mode == "delete":
        return []
    return [F.col(c).alias(f"_order_{i}") for i, c in enumerate(write.order_by)]


def vertex_ids(write: VertexWrite, vid_type: str):
    """Key columns, the raw id columns, and why a row has no usable key (null when it has)."""
    vid = F.col(write.vid_field)
    key = vid_key(vid, write.policy, vid_type)
    return {"_vertexId": key}, {"_vertexId": vid}, _id_reason(vid, key, write.policy, vid_type)


def edge_ids(write: EdgeWrite, vid_type: str, whole_rank: bool = False):
    """As :func:`vertex_ids`. ``whole_rank`` says that the rank column is of an integer type, so its text needs no look."""
    src, dst = F.col(write.src_field), F.col(write.dst_field)
    rank = F.col(write.rank_field) if write.rank_field else None
    keys = {
        "_srcId": vid_key(src, write.src_policy, vid_type),
        "_dstId": vid_key(dst, write.dst_policy, vid_type),
        "_rank": rank.cast("bigint") if whole_rank else rank_value(rank),
    }
    raw = {"_srcId": src, "_dstId": dst, "_rank": F.lit(0) if rank is None else rank}
    reason = F.coalesce(
        _id_reason(src, keys["_srcId"], write.src_policy, vid_type),
        _id_reason(dst, keys["_dstId"], write.dst_policy, vid_type),
        F.when(rank.isNull(), "null_key") if whole_rank else _rank_reason(rank),
    )
    return keys, raw, reason


def _is_text(property_type: str) -> bool:
    return isinstance(spark_type(property_type), T.StringType)


def _keyed(changes: DataFrame, label: Label | None, write, ids) -> tuple[DataFrame, list[str]]:
    """Rows ``key, properties, _order_*, raw ids, _reason``; a reason marks a bad row, and only bad rows have raw ids."""
    props = _prop_columns(changes, label, write)
    keys, raw, reason = ids
    held = {f.name: f.dataType for f in changes.schema.fields}
    # Anything fits a text; text and numbers can fail to fit any other type.
    bad = [
        F.when(F.col(n).isNotNull() & c.isNull(), f"bad_value:{n}")
        for n, c in props.items()
        if isinstance(held[n], (T.StringType, T.NumericType))
        and (label.prop_type(n) in ("DATE", "DATETIME") or not _is_text(label.prop_type(n)))
    ]
    why = F.coalesce(reason, *bad)
    keyed = changes.select(
        *[c.alias(n) for n, c in keys.items()],
        *[c.alias(n) for n, c in props.items()],
        *_ordering(write),
        *[F.when(why.isNotNull(), c.cast("string")).alias(f"_raw{n}") for n, c in raw.items()],
        why.alias(_REASON),
    )
    return keyed, list(props)


def rejected(keyed: DataFrame, key: list[str]) -> DataFrame:
    """The bad rows as ``raw ids (text), reason``."""
    return keyed.filter(F.col(_REASON).isNotNull()).select(
        *[F.col(f"_raw{k}").alias(k) for k in key], F.col(_REASON).alias(REASON)
    )


def _good(keyed: DataFrame, key: list[str]) -> DataFrame:
    """The rows without a reason. Their keys are never null, but saying so keeps Spark from adding
    the same filter to one use of the changes only, which would shuffle them once per use."""
    good = keyed.filter(F.col(_REASON).isNull())
    return good.filter(" AND ".join(f"{k} IS NOT NULL" for k in key))


def accepted(keyed: DataFrame, key: list[str], props: list[str], write) -> DataFrame:
    """The good rows, one per key: the last one, or the first for an insert-if-absent."""
    order = [f"_order_{i}" for i in range(len(write.order_by))]
    good = _good(keyed, key).select(*key, *props, *order)
    first = write.mode == "insert" and not write.overwrite
    return latest_per_key(good, key, order, first).select(*key, *props)


# --- the four changes of a label table --------------------------------------------------------


def _complete(changes: DataFrame, current: DataFrame) -> DataFrame:
    """The columns of the label table; a property that is not given is null."""
    return changes.select(
        *[
            F.col(f.name) if f.name in changes.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in current.schema.fields
        ]
    )


def upsert(current: DataFrame, changes: DataFrame, key: list[str], size: int) -> DataFrame:
    """Whole rows replaced or added. ``size`` bounds the bytes of the changes."""
    kept = current.join(join_side(changes.select(*key), size), key, "left_anti")
    return kept.unionByName(_complete(changes, current))


def _held(current: DataFrame, keys: DataFrame, key: list[str], size: int) -> DataFrame:
    """Those of ``keys`` that the table holds. The table is the left side of the semi join, so
    it is not shuffled when the keys are few."""
    return current.select(*key).join(join_side(keys, size), key, "left_semi")


def insert_absent(current: DataFrame, changes: DataFrame, key: list[str], size: int) -> DataFrame:
    """Rows added for keys the table does not hold yet."""
    held = _held(current, changes.select(*key), key, size)
    new = changes.join(join_side(held, size), key, "left_anti")
    return current.unionByName(_complete(new, current))


def update(
    current: DataFrame, changes: DataFrame, key: list[str], props: list[str], size: int
) -> DataFrame:
    """Only the given properties change; a null that is given is set."""
    hits = changes.select(
        *key, *[F.col(p).alias(f"_new_{p}") for p in props], F.lit(True).alias("_hit")
    )
    return current.join(join_side(hits, size), key, "left").select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in props
            else F.col(c)
            for c in current.columns
        ]
    )


def delete(current: DataFrame, keys: DataFrame, key: list[str], size: int) -> DataFrame:
    return current.join(join_side(keys, size), key, "left_anti")


def _missing(current: DataFrame, keys: DataFrame, key: list[str], size: int) -> DataFrame:
    held = _held(current, keys, key, size)
    return keys.join(join_side(held, size), key, "left_anti").select(
        *[F.col(k).cast("string").alias(k) for k in key], F.lit("no_such_key").alias(REASON)
    )


# --- changes as they are kept ------------------------------------------------------------------


@dataclass(frozen=True)
class Feed:
    """Change rows with their keys, written once: ``size`` bounds the bytes of what a join needs of them, ``parts`` are the parts
    of a stored table that the good rows lie in (where a number of parts was given)."""

    keyed: DataFrame
    key: list[str]
    props: list[str]
    write: VertexWrite | EdgeWrite
    size: int
    parts: list[int]

    @property
    def rejects(self) -> DataFrame:
        return rejected(self.keyed, self.key)

    def accepted(self) -> DataFrame:
        return accepted(self.keyed, self.key, self.props, self.write)

    def keys(self) -> DataFrame:
        return _good(self.keyed, self.key).select(*self.key).distinct()


def part_of_key(key: list[str], n_parts: int) -> Column:
    """The part of a key, from 0. It is the hash by which Spark deals rows to tasks, so where the number of shuffle
    partitions is a multiple of the number of parts, the rows of a shuffle by key lie in one part per task."""
    return F.pmod(F.hash(*key), F.lit(n_parts))


def settled_feed(space: Space, kind: str, label: str | None, changes: DataFrame, write, n_parts: int = 1) -> Feed:
    """The changes, written to the shared folder and measured there."""
    described = None if label is None else space.label(kind, label)
    if kind == VERTEX:
        ids = vertex_ids(write, space.vid_type)
    else:
        types = {f.name: f.dataType for f in changes.schema.fields}
        ids = edge_ids(write, space.vid_type, isinstance(types.get(write.rank_field), T.IntegralType))
    keyed, props = _keyed(changes, described, write, ids)
    key = VERTEX_KEY if kind == VERTEX else EDGE_KEY
    void = {f.name: F.col(f.name).cast("string") for f in keyed.schema.fields if isinstance(f.dataType, T.NullType)}
    # An update carries its properties into the join, any other change only its keys.
    needed = [*key, *(props if write.mode == "update" else [])]
    part = F.when(F.col(_REASON).isNull(), part_of_key(key, n_parts))
    keyed, _, size = materialize_measured(keyed.withColumns({**void, _PART: part}), "feed", needed)
    parts = [] if n_parts == 1 else keyed.agg(F.sort_array(F.collect_set(_PART))).first()[0]
    return Feed(keyed, key, props, write, size, parts)


def _change(current: DataFrame, feed: Feed) -> tuple[DataFrame, DataFrame]:
    key, props, size = feed.key, feed.props, feed.size
    if feed.write.mode == "insert":
        change = upsert if feed.write.overwrite else insert_absent
        return change(current, feed.accepted(), key, size), feed.rejects
    if feed.write.mode == "delete":
        return delete(current, feed.keys(), key, size), feed.rejects
    if not props:
        raise ValueError("an update needs at least one property")
    table = update(current, feed.accepted(), key, props, size)
    return table, feed.rejects.unionByName(_missing(current, feed.keys(), key, size))


def _marked(rows: DataFrame, gone: bool) -> DataFrame:
    return rows.withColumn(GONE, F.lit(gone))


def delta(current: DataFrame, feed: Feed) -> tuple[DataFrame, DataFrame]:
    """What a change leaves behind: whole new rows, and keys that are gone (``_gone``); one row per key. And the rejects.

    An insert that overwrites and a delete do not look at the table at all.
    """
    key, size = feed.key, feed.size
    if feed.write.mode == "delete":
        return _marked(_complete(feed.keys(), current), True), feed.rejects
    if feed.write.mode == "update":
        if not feed.props:
            raise ValueError("an update needs at least one property")
        # only rows that an update hits are looked at, so the join is an inner one
        found = current.join(join_side(feed.keys(), size), key, "left_semi")
        rejects = feed.rejects.unionByName(_missing(current, feed.keys(), key, size))
        return _marked(update(found, feed.accepted(), key, feed.props, size), False), rejects
    new = feed.accepted()
    if not feed.write.overwrite:
        new = new.join(join_side(_held(current, new.select(*key), key, size), size), key, "left_anti")
    return _marked(_complete(new, current), False), feed.rejects


def merged(current: DataFrame, changed: DataFrame, key: list[str], size: int) -> DataFrame:
    """``current`` with a delta (one row per key) applied. ``size`` bounds the bytes of the delta's keys."""
    kept = current.join(join_side(changed.select(*key), size), key, "left_anti")
    return kept.unionByName(changed.filter(~F.col(GONE)).select(*current.columns))


def newest(current: DataFrame, changed: DataFrame, key: list[str], seq: str, by=()) -> DataFrame:
    """``current`` with many changes applied: rows of one key differ in ``seq`` (one row per key and number), and the last one counts.

    All rows are dealt by key once and sorted once, and no row is kept back: nothing is grown by a join of two sorted sides, and the
    changes are read once. Keys that ``current`` repeats or lacks stay as they are. ``by`` are columns that hang on the key; rows come in
    the order of ``by`` and the key.
    """
    usable = changed.filter(" AND ".join(f"{k} IS NOT NULL" for k in key))
    first = current.withColumns({GONE: F.lit(False), seq: F.lit(0).cast("bigint")})
    late = F.rank().over(Window.partitionBy(*by, *key).orderBy(F.col(seq).desc()))
    rows = first.unionByName(usable).repartition(*key).withColumn("_late", late).filter(f"_late = 1 AND NOT {GONE}")
    return rows.select(*current.columns)


def incident(edges: DataFrame, vertices: DataFrame, size: int) -> DataFrame:
    """The keys of the edges that start or end at one of ``vertices`` (column ``_vertexId``), each once."""
    ends = [
        edges.select(*EDGE_KEY).join(join_side(vertices.select(F.col("_vertexId").alias(end)), size), end, "left_semi").select(*EDGE_KEY)
        for end in ("_srcId", "_dstId")
    ]
    return ends[0].unionByName(ends[1]).distinct()


# --- entry points -----------------------------------------------------------------------------


def mutate_vertices(
    space: Space, label: str | None, changes: DataFrame, write: VertexWrite
) -> Mutation:
    """Insert or update rows of one vertex label, or delete vertices from every vertex label.

    A delete takes no label. With ``delete_edge`` it also removes every edge at either end.
    """
    feed = settled_feed(space, VERTEX, None if write.mode == "delete" else label, changes, write)
    if write.mode == "delete":
        # The ids meet every table of the space, so they are worked out once. Read back, they lie
        # under no aggregation, which would keep Spark from splitting hubs.
        gone, _, size = materialize_measured(feed.keys(), "gone")
        tables = {
            (VERTEX, name): delete(scan(space, VERTEX, name), gone, VERTEX_KEY, size)
            for name in space.names(VERTEX)
        }
        if write.delete_edge:
            for name in space.names(EDGE):
                tables[(EDGE, name)] = drop_incident(scan(space, EDGE, name), gone, size)
        return Mutation(tables, feed.rejects)
    table, rejects = _change(scan(space, VERTEX, label), feed)
    return Mutation({(VERTEX, label): table}, rejects)


def drop_incident(edges: DataFrame, vertices: DataFrame, size: int) -> DataFrame:
    """Edges without those that start or end at one of ``vertices`` (column ``_vertexId``)."""
    out = edges
    for end in ("_srcId", "_dstId"):
        gone = vertices.select(F.col("_vertexId").alias(end))
        out = out.join(join_side(gone, size), end, "left_anti")
    return out.select(*edges.columns)


def mutate_edges(space: Space, label: str, changes: DataFrame, write: EdgeWrite) -> Mutation:
    """Insert, update or delete rows of one edge label, keyed by source, target and rank."""
    table, rejects = _change(scan(space, EDGE, label), settled_feed(space, EDGE, label, changes, write))
    return Mutation({(EDGE, label): table}, rejects)


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy(REASON).agg(F.count(F.lit(1)).alias("n_rows"))
