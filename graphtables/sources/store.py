"""A space kept as parquet tables, with versions that switch in one step.

The rows of a label lie in parts by the hash of their key. A version is a small file that names, for each label, the folder of each
part and the deltas that came after: few changes on a large label are kept as a delta (whole new rows, and keys that
are gone), which costs what the changes cost, and is merged when the label is read. Deltas that have grown are merged into the
parts that they touch; other parts stay the files they are. Rows lie in their files in the order of their keys, so the ranges in
the files tell a reader of few keys what to leave out, and the version names the rows and nulls of each part, so what a label
holds is known without a look at it. Nothing that is written is ever changed, so every version can be
read until it is cleared away.

The name of a version's file can be created once only,
so of two writers that start from one version the second is told so and changes nothing; a file that
is not whole (its writer died) counts as no version, and the next writer replaces it. Changes may be logged first,
batch by batch, and folded into a new version later.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphtables.model import EDGE, MAX_UPDATE_BATCH, VERTEX, EdgeWrite, Label, Space, VertexWrite
from graphtables.operators.mutate import (
    GONE,
    Mutation,
    delta,
    incident,
    latest_per_key,
    merged,
    mutate_edges,
    mutate_vertices,
    newest,
    part_of_key,
    settled_feed,
)
from graphtables.session import ROW_BYTES, is_small, join_side, materialize_measured, size_of
from graphtables.sources.profile import PROFILE, label_profile
from graphtables.sources.scan import scan

BATCH = "_batch"
PART = "_part"
SEQ = "_seq"
VERSION = "_version"
#: What a version did to a label that it wrote whole; otherwise the path of its delta, or nothing where it only merged deltas.
WHOLE = "whole"
#: Keys of a fetch that are named one by one to the files; of more keys only the range is.
FEW_KEYS = 200
# Fixed value: rows of a batch where text options don't say.
RAW_BATCH = 1000


@dataclass(frozen=True)
class Version:
    number: int = 0
    tables: dict[str, dict] = field(default_factory=dict)
    folded: dict[str, int] = field(default_factory=dict)


class Store:
    """The versions of one space below ``root``, on any Hadoop file system that can rename.

    A label lies in ``space.n_parts`` parts; a number that divides spark.sql.shuffle.partitions saves a shuffle at writing.
    Deltas of a label are merged into its parts when they take more than ``delta_share`` of the bytes of the parts, or are more
    than ``max_deltas``.
    """

    def __init__(self, spark: SparkSession, root: str, space: Space, delta_share: float = 0.25, max_deltas: int = 32):
        self.spark = spark
        self.root = root.rstrip("/")
        self.space = space
        self.delta_share = delta_share
        self.max_deltas = max_deltas

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs(), self._path(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def current(self) -> Version:
        """The newest version; version 0, which has no tables, when nothing is committed."""
        names = sorted((n for n in self._names("versions") if n.endswith(".json")), reverse=True)
        found = (self._version(name) for name in names)
        return next((v for v in found if v is not None), Version())

    def _version(self, name: str) -> Version | None:
        """A version from its file; None when that is not whole. The file has one line: the parts of the labels of a space."""
        line = self.spark.read.text(f"{self.root}/versions/{name}", wholetext=True).first()
        try:
            return Version(**json.loads(line[0] if line else ""))
        except ValueError:
            return None

    def _commit(self, version: Version) -> Version:
        fs = self._fs()
        fs.mkdirs(self._path("versions"))
        final = self._path("versions", f"{version.number:012d}.json")
        lost = f"version {version.number} was committed by another writer"
        try:
            out = fs.create(final, False)
        except Py4JJavaError as error:
            if not fs.exists(final):
                raise
            raise RuntimeError(lost) from error
        try:
            out.write(bytearray(json.dumps(version.__dict__).encode()))
        finally:
            out.close()
        return version

    # --- tables of a version --------------------------------------------------------------------

    def _bytes(self, path: str) -> int:
        return self._fs().getContentSummary(self._path(path)).getLength()

    def _write_parts(self, kind: str, name: str, df: DataFrame, key: list[str], n_parts: int) -> dict[str, dict]:
        """Rows as parts in a new folder: number of the part -> its path below the root, its bytes, rows and nulls of each property.

        Rows that come with their part, in the order of part and key, are not sorted again.
        """
        folder = f"{kind}/{name}/{uuid.uuid4().hex}"
        dealt = df if PART in df.columns else df.withColumn(PART, part_of_key(key, n_parts))
        df = dealt.drop(PART)
        if int(self.spark.conf.get("spark.sql.shuffle.partitions")) % n_parts:
            dealt = dealt.hint("rebalance", PART)  # tasks would hold rows of all parts, each in a file of its own
        # the writer sorts by part anyway, and takes a longer order as it is
        dealt.sortWithinPartitions(PART, *key).write.partitionBy(PART).parquet(f"{self.root}/{folder}")
        names = [n for n in self._names(folder) if n.startswith(f"{PART}=")]
        counts = self._counts(folder, df.schema, [c for c in df.columns if c not in key]) if names else {}
        return {
            number: {"path": f"{folder}/{PART}={number}", "bytes": self._bytes(f"{folder}/{PART}={number}"), **counts[number]}
            for number in (n.split("=")[1] for n in names)
        }

    def _counts(self, folder: str, schema: T.StructType, props: list[str]) -> dict[str, dict]:
        """Rows and nulls of each part in a folder that was written; one row per part comes back."""
        written = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(PART, T.IntegerType())])).parquet(f"{self.root}/{folder}")
        nulls = [F.count_if(F.col(p).isNull()).alias(f"nulls_{i}") for i, p in enumerate(props)]
        found = written.groupBy(PART).agg(F.count(F.lit(1)).alias("n_rows"), *nulls).collect()
        return {str(r[PART]): {"rows": r["n_rows"], "nulls": {p: r[f"nulls_{i}"] for i, p in enumerate(props)}} for r in found}

    def _entry(self, kind: str, name: str, df: DataFrame) -> dict:
        """A label's table, written whole."""
        label, n_parts = self.space.label(kind, name), self.space.n_parts
        parts = self._write_parts(kind, name, df, label.key, n_parts)
        return {"schema": df.schema.json(), "props": label.props, "n_parts": n_parts, "parts": parts, "deltas": [], "change": WHOLE}

    def _base(self, entry: dict, parts=None) -> DataFrame:
        """The rows of the parts as they were written, all or some."""
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        paths = [f"{self.root}/{p['path']}" for n, p in entry["parts"].items() if parts is None or int(n) in parts]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _deltas(self, entry: dict, key: list[str], parts=None) -> tuple[DataFrame, int, int] | None:
        """The rows of a table's deltas with their numbers, a bound of the bytes of their keys, and how many deltas they are."""
        some = [d for d in entry["deltas"] if parts is None or set(parts) & set(d["parts"])]
        if not some:
            return None
        schema = T.StructType.fromJson(json.loads(entry["schema"])).add(GONE, T.BooleanType()).add(SEQ, T.LongType())
        rows = self.spark.read.schema(schema).parquet(*[f"{self.root}/{d['path']}" for d in some])
        if parts is not None and any(set(d["parts"]) - set(parts) for d in some):
            rows = rows.filter(part_of_key(key, entry["n_parts"]).isin(list(parts)))
        return rows, sum(d["key_bytes"] for d in some), len(some)

    def _table(self, entry: dict, key: list[str], parts=None, with_part: bool = False) -> DataFrame:
        """The rows of a table, or of some of its parts; ``with_part`` asks for their part, and for the order in which they are written."""
        base, later = self._base(entry, parts), self._deltas(entry, key, parts)
        if with_part:
            base = base.withColumn(PART, part_of_key(key, entry["n_parts"]))
        if later is None:
            return base
        rows, size, n = later
        if with_part:
            rows = rows.withColumn(PART, part_of_key(key, entry["n_parts"]))
        if not is_small(self.spark, size):
            return newest(base, rows, key, SEQ, [PART] if with_part else [])
        return merged(base, (latest_per_key(rows, key, [SEQ]) if n > 1 else rows).drop(SEQ), key, size)

    def _with_delta(self, entry: dict, kind: str, name: str, rows: DataFrame, size: int, dealt: bool = False) -> dict:
        """A table's entry with a delta more. ``size`` bounds the bytes of the rows that lead to it; ``dealt`` rows come out of a
        shuffle by key, whose tasks are as many as their bytes ask for.

        A table without rows takes them as its parts, and a change that is larger than the table is merged as it is written. Deltas
        that are large against the table by now are merged into the parts that they touch.
        """
        key, n_parts = self.space.label(kind, name).key, entry["n_parts"]
        base = sum(p["bytes"] for p in entry["parts"].values())
        if not base and not entry["deltas"]:
            parts = self._write_parts(kind, name, rows.filter(~F.col(GONE)).drop(GONE), key, n_parts)
            return {**entry, "parts": parts, "change": WHOLE}
        if size > base * max(1.0, self.delta_share):  # it would be merged at once: its rows are not written twice
            new = merged(self._table(entry, key), rows, key, size)
            return {**entry, "parts": self._write_parts(kind, name, new, key, n_parts), "deltas": [], "change": WHOLE}
        seq = 1 + max([d["seq"] for d in entry["deltas"]], default=0)
        folder = f"{kind}/{name}/delta-{uuid.uuid4().hex}"
        # few rows: as many files as bytes ask for, not as tasks made them
        packed = rows.withColumn(SEQ, F.lit(seq).cast("bigint"))
        (packed if dealt else packed.hint("rebalance")).write.parquet(f"{self.root}/{folder}")
        written = self.spark.read.schema(packed.schema).parquet(f"{self.root}/{folder}").select(*key)
        parts = written.agg(F.sort_array(F.collect_set(part_of_key(key, n_parts)))).first()[0]
        if not parts:
            return entry
        new = {"path": folder, "seq": seq, "bytes": self._bytes(folder), "key_bytes": size_of(written), "parts": parts}
        entry = {**entry, "deltas": [*entry["deltas"], new], "change": folder}
        grown = sum(d["bytes"] for d in entry["deltas"]) > self.delta_share * base and size > ROW_BYTES * self.max_deltas
        return self._compacted(entry, kind, name) if grown or len(entry["deltas"]) > self.max_deltas else entry

    def _compacted(self, entry: dict, kind: str, name: str) -> dict:
        """The deltas of a table merged into the parts that they touch; the other parts stay as they are."""
        touched = {p for d in entry["deltas"] for p in d["parts"]}
        if not touched:
            return entry
        key = self.space.label(kind, name).key
        new = self._write_parts(kind, name, self._table(entry, key, touched, with_part=True), key, entry["n_parts"])
        stay = {n: p for n, p in entry["parts"].items() if int(n) not in touched}
        return {**entry, "parts": {**stay, **new}, "deltas": []}

    # --- versions -------------------------------------------------------------------------------

    def write(
        self, tables: dict[tuple[str, str], DataFrame], folded=None, base: Version | None = None
    ) -> Version:
        """Write the given label tables whole and switch to a version that holds them.

        The tables come out of a scan or a mutation of ``base``, by default the newest version; when another
        writer has committed since, this raises and nothing changes. Labels that are not given keep
        the files they have.
        """
        old = base or self.current()
        entries = {f"{kind}/{name}": self._entry(kind, name, df) for (kind, name), df in tables.items()}
        return self._switch(old, entries, folded)

    def _switch(self, old: Version, entries: dict[str, dict], folded=None) -> Version:
        number = old.number + 1
        new = {key: {**entry, "version": number} for key, entry in entries.items()}
        return self._commit(Version(number, {**old.tables, **new}, {**old.folded, **(folded or {})}))

    def changes_of(self, version: Version, kind: str, label: str) -> DataFrame | None:
        """What a version changed in a label: its columns, ``_gone`` (the key was deleted), ``_whole`` (the rows replace all that was
        there) and ``_version``; None when it changed nothing."""
        entry = version.tables.get(f"{kind}/{label}")
        if entry is None or entry["version"] != version.number or entry["change"] is None:
            return None
        whole = entry["change"] == WHOLE
        if whole:
            rows = self._base(entry).withColumn(GONE, F.lit(False))
        else:
            schema = T.StructType.fromJson(json.loads(entry["schema"])).add(GONE, T.BooleanType())
            rows = self.spark.read.schema(schema).parquet(f"{self.root}/{entry['change']}")
        return rows.withColumns({"_whole": F.lit(whole), VERSION: F.lit(version.number).cast("bigint")})

    def read(self, version: Version | None = None) -> Space:
        """The space with the tables of a version, by default the newest."""
        return self._space((version or self.current()).tables)

    def _space(self, tables: dict[str, dict], parts: dict[str, list[int]] | None = None) -> Space:
        """The space with the given tables, of some only the parts that are named."""
        space = Space(self.space.name, self.space.vid_type, self.space.n_parts)
        for key, entry in tables.items():
            kind, name = key.split("/", 1)
            label = Label(name, kind, entry["props"])
            df = self._table(entry, label.key, (parts or {}).get(key))
            space = space.with_table(label, df, as_read=True)
        return space

    def save_space(self, space: Space) -> Version:
        """Write every label of ``space`` as a first or a whole new version."""
        return self.write({key: scan(space, *key) for key in space.labels})

    def apply(self, kind: str, label: str | None, changes: DataFrame, how) -> Mutation:
        """Apply changes to the newest version and switch; the new tables and the rejects come back."""
        base = self.current()
        entries, rejects = self._changed(self.read(base), base.tables, kind, label, changes, how)
        space = self._space(self._switch(base, entries).tables)
        keys = [tuple(k.split("/", 1)) for k in entries]
        return Mutation({k: scan(space, *k) for k in keys}, rejects)

    def _changed(self, space: Space, tables: dict, kind: str, label: str | None, changes: DataFrame, how) -> tuple[dict, DataFrame]:
        """The entries of the tables that the changes touch, written, and the rejects.

        ``space`` has the labels of ``tables``. Only parts that the keys of the changes lie in are read, and only where the rows
        that are there matter; edges at deleted vertices are looked for among the keys of all edges.
        """
        if kind != VERTEX or how.mode != "delete":
            entry = tables[f"{kind}/{label}"]
            feed = settled_feed(space, kind, label, changes, how, entry["n_parts"])
            rows, rejects = delta(scan(self._space({f"{kind}/{label}": entry}, {f"{kind}/{label}": feed.parts}), kind, label), feed)
            return {f"{kind}/{label}": self._with_delta(entry, kind, label, rows, feed.size, dealt=how.mode != "update")}, rejects
        # vertices are deleted from all labels
        feed = settled_feed(space, VERTEX, None, changes, how)
        gone, _, size = materialize_measured(feed.keys(), "gone")
        entries = {}
        for a_kind, name in space.labels:
            key = f"{a_kind}/{name}"
            table = scan(space, a_kind, name)
            if a_kind == VERTEX:
                found = table.select("_vertexId").join(join_side(gone, size), "_vertexId", "left_semi")
            elif how.delete_edge:
                found = incident(table, gone, size)
            else:
                continue
            rows = found.select(
                *[F.col(c) if c in found.columns else F.lit(None).cast(table.schema[c].dataType).alias(c) for c in table.columns],
                F.lit(True).alias(GONE),
            )
            new = self._with_delta(tables[key], a_kind, name, rows, size)
            if new is not tables[key]:
                entries[key] = new
        return entries, feed.rejects

    def compact(self, kind: str, label: str) -> Version:
        """A version in which the deltas of a label are merged into its parts."""
        base = self.current()
        entry = base.tables[f"{kind}/{label}"]
        if not entry["deltas"]:
            return base
        return self._switch(base, {f"{kind}/{label}": {**self._compacted(entry, kind, label), "change": None}})

    def fetch(self, kind: str, label: str, keys: DataFrame, cols=()) -> DataFrame:
        """The rows of a label whose keys are listed in ``keys``.

        Only files of the parts of those keys are read. Their rows are in the order of the keys, so of these files only the pages
        are read whose range holds one of few keys, or meets the range of many.
        """
        base = self.current()
        entry, own = base.tables[f"{kind}/{label}"], self.space.label(kind, label)
        n_parts = entry["n_parts"]
        keys = keys.select(*[F.col(k).cast("bigint" if k == "_rank" else "string").alias(k) for k in own.key])
        wanted, n_keys, size = materialize_measured(keys.distinct(), "wanted")
        parts = wanted.agg(F.collect_set(part_of_key(own.key, n_parts))).first()[0]
        space = self._space({f"{kind}/{label}": entry}, {f"{kind}/{label}": parts})
        first = own.key[0]
        if n_keys <= FEW_KEYS:
            near = F.col(first).isin([r[0] for r in wanted.select(first).distinct().collect()])
        else:
            near = F.col(first).between(*wanted.agg(F.min(first), F.max(first)).first())
        return scan(space, kind, label, cols).filter(near).join(join_side(wanted, size), own.key, "left_semi")

    def _uncounted(self, entry: dict) -> set[int]:
        """The parts whose rows are not those that were counted: a delta touches them, or a version from before counts wrote them."""
        return {p for d in entry["deltas"] for p in d["parts"]} | {int(n) for n, p in entry["parts"].items() if "rows" not in p}

    def profile(self, version: Version | None = None) -> DataFrame:
        """What :func:`label_profile` says of a version, by default the newest, from the counts of its parts.

        Only the parts that deltas touch are read.
        """
        tables = (version or self.current()).tables
        counted, open_parts = [], {}
        for key, entry in tables.items():
            kind, name = key.split("/", 1)
            unknown = self._uncounted(entry)
            if unknown:
                open_parts[key] = sorted(unknown)
            known = [p for n, p in entry["parts"].items() if int(n) not in unknown]
            n_rows = sum(p["rows"] for p in known)
            for prop, kind_of in (entry["props"] or {None: None}).items():
                counted.append((kind, name, prop, kind_of, n_rows, sum(p["nulls"][prop] for p in known) if prop else 0))
        known = self.spark.createDataFrame(counted, PROFILE)
        if not open_parts:
            return known
        read = label_profile(self._space({key: tables[key] for key in open_parts}, open_parts), self.space.n_parts)
        names = ["kind", "label", "property", "property_type"]
        return known.unionByName(read).groupBy(*names).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"))

    def part_rows(self, kind: str, label: str) -> DataFrame:
        """The rows of each part (from 0) that a label's newest version lies in; only parts that deltas touch are read."""
        entry, own = self.current().tables[f"{kind}/{label}"], self.space.label(kind, label)
        unknown = self._uncounted(entry)
        known = [(n, entry["parts"].get(str(n), {"rows": 0})["rows"]) for n in range(entry["n_parts"]) if n not in unknown]
        counted = self.spark.createDataFrame(known, "part int, n_rows bigint")
        if not unknown:
            return counted
        rows = self._table(entry, own.key, sorted(unknown)).select(part_of_key(own.key, entry["n_parts"]).alias("part"))
        asked = self.spark.createDataFrame([(n,) for n in sorted(unknown)], "part int")
        found = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"))
        return counted.unionByName(asked.join(found, "part", "left").select("part", F.coalesce("n_rows", F.lit(0)).alias("n_rows")))

    def clear_old(self, keep: int = 1) -> list[str]:
        """Remove versions but the newest ``keep``, and files that none of these names. Not while a writer is at work, as what it
        has written is not named yet. Returns the folders removed."""
        if keep < 1:
            raise ValueError("the newest version has to stay")
        fs = self._fs()
        names = sorted(n for n in self._names("versions") if n.endswith(".json"))
        kept = [v for v in map(self._version, names) if v is not None][-keep:]
        tables = [e for v in kept for e in v.tables.values()]
        used = {p["path"] for e in tables for p in [*e["parts"].values(), *e["deltas"]]} | {e["change"] for e in tables}
        used |= {path.rsplit("/", 1)[0] for path in used if path and f"/{PART}=" in path}
        removed = []
        for name in names:
            if kept and int(name.split(".")[0]) < kept[0].number:
                fs.delete(self._path("versions", name), False)
        for kind in (VERTEX, EDGE):
            for label in self._names(kind):
                for folder in self._names(f"{kind}/{label}"):
                    inner = [f"{kind}/{label}/{folder}/{p}" for p in self._names(f"{kind}/{label}/{folder}") if p.startswith(f"{PART}=")]
                    outer = f"{kind}/{label}/{folder}"
                    unused = [p for p in inner if p not in used] if outer in used else [outer]
                    for path in unused:
                        fs.delete(self._path(path), True)
                    removed += unused
        return removed

    # --- logged changes -----------------------------------------------------------------------

    def _log(self, stream: str) -> str:
        return f"{self.root}/changes/{stream}"

    def log_changes(self, stream: str, batch_id: int, changes: DataFrame, query: str = "") -> None:
        """Keep one batch of changes. Logging a batch again replaces it, so a replay is harmless.

        Batch numbers have a meaning within one query only. The first ``query`` that logs under the name
        of a stream owns it; another one, whose numbers start anew, is refused.
        """
        owner = self._owner(stream, query)
        if owner != query:
            raise ValueError(
                f"stream {stream} belongs to query {owner or 'without a name'}: continue it from its checkpoint,"
                " or log under another name"
            )
        if batch_id > self.current().folded.get(stream, -1):
            changes.write.mode("overwrite").parquet(f"{self._log(stream)}/{BATCH}={batch_id}")

    def _owner(self, stream: str, query: str) -> str:
        """The query that owns a stream; ``query`` becomes it when there is none."""
        fs, path = self._fs(), self._path("changes", stream, "owner.txt")
        if not fs.exists(path):
            out = fs.create(path, False)
            try:
                out.write(bytearray(query.encode()))
            finally:
                out.close()
        line = self.spark.read.text(path.toString(), wholetext=True).first()
        return line[0] if line else ""

    def pending(self, stream: str) -> tuple[list[DataFrame], int]:
        """The logged changes that no version holds yet, and the last batch number.

        Batches in a row that have the same columns are one table, each row with its batch number. A column
        that a batch does not have is not given by it, so batches that differ are tables of their own.
        """
        done = self.current().folded.get(stream, -1)
        names = self._names(f"changes/{stream}")
        batches = sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BATCH}="))
        batches = [b for b in batches if b > done]
        runs: list[tuple[T.StructType, list[str]]] = []
        for b in batches:
            path = f"{self._log(stream)}/{BATCH}={b}"
            schema = self.spark.read.parquet(path).schema
            if runs and runs[-1][0] == schema:
                runs[-1][1].append(path)
            else:
                runs.append((schema, [path]))
        number = F.regexp_extract(F.col("_metadata.file_path"), f"/{BATCH}=([0-9]+)/", 1).cast("bigint")
        frames = [self.spark.read.schema(schema).parquet(*paths).withColumn(BATCH, number) for schema, paths in runs]
        return frames, batches[-1] if batches else done

    def _with_pending(self, base: Version, frames, kind: str, label: str | None, how) -> Mutation:
        """The tables of ``base`` with the frames applied one after another, and all rejects."""
        space, tables, rejects = self.read(base), {}, []
        for changes in frames:
            mutation = _mutate(space, kind, label, changes, _batch_first(how))
            for (a_kind, name), df in mutation.tables.items():
                space = space.with_table(space.label(a_kind, name), df, as_read=True)
            tables.update(mutation.tables)
            rejects.append(mutation.rejects)
        return Mutation(tables, reduce(DataFrame.unionByName, rejects))

    def merged(self, stream: str, kind: str, label: str | None, how) -> Mutation | None:
        """The newest version with the pending changes applied, nothing written.

        Later batches win over earlier ones, inside a batch ``how.order_by`` decides.
        """
        base = self.current()
        frames, _ = self.pending(stream)
        return self._with_pending(base, frames, kind, label, how) if frames else None

    def fold(self, stream: str, kind: str, label: str | None, how) -> Version:
        """A version that holds the pending changes of a stream, as deltas; the batches it holds are cleared away."""
        base = self.current()
        frames, last = self.pending(stream)
        if frames:
            for i, changes in enumerate(frames):
                # frames differ in their columns: a version for each, and the last one says which batches are held
                new, _ = self._changed(self.read(base), base.tables, kind, label, changes, _batch_first(how))
                done = {stream: last if i + 1 == len(frames) else changes.agg(F.max(BATCH)).first()[0]}
                base = self._switch(base, new, done)
        self._clear(stream, base)
        return base

    def _clear(self, stream: str, version: Version) -> None:
        """Remove the logged batches that ``version`` holds."""
        fs, done = self._fs(), version.folded.get(stream, -1)
        for name in self._names(f"changes/{stream}"):
            if name.startswith(f"{BATCH}=") and int(name.split("=")[1]) <= done:
                fs.delete(self._path("changes", stream, name), True)


def _batch_first(how):
    return type(how)(**{**how.__dict__, "order_by": (BATCH, *how.order_by)})


def _mutate(space: Space, kind: str, label: str | None, changes: DataFrame, how) -> Mutation:
    if kind == VERTEX:
        return mutate_vertices(space, label, changes, how)
    return mutate_edges(space, label, changes, how)


def _text(options: dict, name: str, default: str = "") -> str:
    value = options.get(name, default)
    return "" if value is None else str(value)


def write_options(options: dict) -> VertexWrite | EdgeWrite:
    """The write described by text options: ``type, vertexField, writeMode, batch, ...``."""
    kind = _text(options, "type").lower()
    mode = _text(options, "writeMode", "insert")
    default = MAX_UPDATE_BATCH if mode.lower() == "update" else RAW_BATCH
    common = {
        "mode": mode,
        "overwrite": _text(options, "overwrite", "true").lower() == "true",
        "batch": int(options.get("batch", default)),
        "order_by": tuple(c for c in _text(options, "orderBy").split(",") if c),
    }

    def flag(name: str) -> bool:
        return _text(options, name, "false").lower() == "true"

    if kind == VERTEX:
        return VertexWrite(
            _text(options, "vertexField"),
            policy=_text(options, "vidPolicy"),
            vid_as_prop=flag("vidAsProp"),
            delete_edge=flag("deleteEdge"),
            **common,
        )
    if kind == "edge":
        return EdgeWrite(
            _text(options, "srcVertexField"),
            _text(options, "dstVertexField"),
            _text(options, "rankField"),
            src_policy=_text(options, "srcPolicy"),
            dst_policy=_text(options, "dstPolicy"),
            src_as_prop=flag("srcAsProp"),
            dst_as_prop=flag("dstAsProp"),
            rank_as_prop=flag("rankAsProp"),
            **common,
        )
    raise ValueError("option type must be vertex or edge")


def save(store: Store, changes: DataFrame, options: dict) -> Mutation:
    """Write ``changes`` as text options say, and switch the store to the new version."""
    for name in ("type", "spaceName", "label"):
        if not _text(options, name).strip():
            raise ValueError(f"option {name} is required and can not be blank")
    if options["spaceName"] != store.space.name:
        raise ValueError(f"space {options['spaceName']} is not {store.space.name}")
    how = write_options(options)
    return store.apply(_text(options, "type").lower(), options["label"], changes, how)
