"""Labels, spaces and write options, with the argument checks that go with them."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

VERTEX = "vertex"
EDGE = "edge"
INT = "INT"
STRING = "STRING"

VERTEX_KEY = ["_vertexId"]
EDGE_KEY = ["_srcId", "_dstId", "_rank"]

# The property types of the graph model and the Spark type each is read as.
PROPERTY_TYPES: dict[str, T.DataType] = {
    "VID": T.LongType(),
    "INT8": T.LongType(),
    "INT16": T.LongType(),
    "INT32": T.LongType(),
    "INT64": T.LongType(),
    "BOOL": T.BooleanType(),
    "FLOAT": T.DoubleType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.LongType(),
    "STRING": T.StringType(),
    "FIXED_STRING": T.StringType(),
    "DATE": T.StringType(),
    "DATETIME": T.StringType(),
    "TIME": T.StringType(),
    "GEOGRAPHY": T.StringType(),
    "DURATION": T.StringType(),
}

# Id policies, write modes and the largest batch an UPDATE may carry.
POLICIES = ("hash", "uuid")
WRITE_MODES = ("insert", "update", "delete")
MAX_UPDATE_BATCH = 512


def spark_type(property_type: str) -> T.DataType:
    if property_type not in PROPERTY_TYPES:
        raise ValueError(f"unsupported data type {property_type}")
    return PROPERTY_TYPES[property_type]


@dataclass(frozen=True)
class Label:
    """One vertex label ("tag") or edge label: its name, kind and typed properties in order."""

    name: str
    kind: str
    props: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if not self.name or not self.name.strip():
            raise ValueError("label is required and can not be blank")
        if self.kind not in (VERTEX, EDGE):
            raise ValueError(f"kind must be vertex or edge, not {self.kind}")
        for property_type in self.props.values():
            spark_type(property_type)

    @property
    def key(self) -> list[str]:
        return VERTEX_KEY if self.kind == VERTEX else EDGE_KEY

    def prop_type(self, name: str) -> str:
        if name not in self.props:
            raise ValueError(f"column {name} does not exist in schema")
        return self.props[name]

    def selected(self, cols=(), no_column: bool = False) -> list[str]:
        """The properties a scan returns: none, the listed ones in list order, or all."""
        if no_column:
            return []
        for name in cols:
            self.prop_type(name)
        return list(cols) or list(self.props)

    def scan_schema(self, cols=(), no_column: bool = False) -> T.StructType:
        """Identity columns first (ids are text in every space), then the selected properties."""
        fields = [
            T.StructField(k, T.LongType() if k == "_rank" else T.StringType(), False)
            for k in self.key
        ]
        fields += [
            T.StructField(c, spark_type(self.prop_type(c)), True)
            for c in self.selected(cols, no_column)
        ]
        return T.StructType(fields)


@dataclass(frozen=True)
class Space:
    """A named graph: its id type, part count, labels and one DataFrame per label."""

    name: str
    vid_type: str = STRING
    n_parts: int = 10
    labels: dict[tuple[str, str], Label] = field(default_factory=dict)
    frames: dict[tuple[str, str], DataFrame] = field(default_factory=dict)
    # The tables that hold their properties as a scan returns them.
    as_read: frozenset[tuple[str, str]] = frozenset()

    def __post_init__(self):
        if not self.name or not self.name.strip():
            raise ValueError("space name is required and can not be blank")
        if self.vid_type not in (INT, STRING):
            raise ValueError(f"vid type must be INT or STRING, not {self.vid_type}")
        if self.n_parts <= 0:
            raise ValueError("part count must be positive")

    def with_table(self, label: Label, df: DataFrame, as_read: bool = False) -> Space:
        """A copy of the space that holds ``df`` as the table of ``label``.

        ``as_read`` says that ``df`` came out of a scan or a mutation. Its columns are then
        returned as they are, so that filters on dates and times reach the files too.
        """
        missing = [k for k in label.key if k not in df.columns]
        missing += [p for p in label.props if p not in df.columns]
        if missing:
            raise ValueError(f"table of {label.kind} {label.name} lacks columns {missing}")
        key = (label.kind, label.name)
        return replace(
            self,
            labels={**self.labels, key: label},
            frames={**self.frames, key: df},
            as_read=self.as_read | {key} if as_read else self.as_read - {key},
        )

    def label(self, kind: str, name: str) -> Label:
        if (kind, name) not in self.labels:
            raise ValueError(f"space {self.name} has no {kind} label {name}")
        return self.labels[(kind, name)]

    def frame(self, kind: str, name: str) -> DataFrame:
        self.label(kind, name)
        return self.frames[(kind, name)]

    def names(self, kind: str) -> list[str]:
        return [name for k, name in self.labels if k == kind]


def _check_policy(policy: str | None) -> str | None:
    """Lower-cased policy, or None for no policy (blank counts as none)."""
    if policy is None or policy == "":
        return None
    if policy.lower() not in POLICIES:
        raise ValueError(f"id policy must be one of {POLICIES}, not {policy}")
    return policy.lower()


def _check_write(mode: str, batch: int) -> str:
    if mode.lower() not in WRITE_MODES:
        raise ValueError(f"write mode must be one of {WRITE_MODES}, not {mode}")
    if batch <= 0:
        raise ValueError(f"batch must be positive, not {batch}")
    if mode.lower() == "update" and batch > MAX_UPDATE_BATCH:
        raise ValueError(f"an update batch holds at most {MAX_UPDATE_BATCH} rows, not {batch}")
    return mode.lower()


def require_columns(df: DataFrame, names) -> None:
    """Field names are matched exactly, case included."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"fields {missing} do not exist in {df.columns}")


@dataclass(frozen=True)
class VertexWrite:
    """How the rows of a DataFrame are written as vertices.

    ``order_by`` names the columns that say which of several rows for one key is the latest.
    """

    vid_field: str
    mode: str = "insert"
    policy: str | None = None
    vid_as_prop: bool = False
    overwrite: bool = True
    delete_edge: bool = False
    batch: int = 512
    order_by: tuple[str, ...] = ()

    def __post_init__(self):
        if not self.vid_field:
            raise ValueError("vid_field is empty")
        object.__setattr__(self, "mode", _check_write(self.mode, self.batch))
        object.__setattr__(self, "policy", _check_policy(self.policy))

    @property
    def id_fields(self) -> list[str]:
        return [self.vid_field]

    def prop_columns(self, df: DataFrame, label: Label) -> list[str]:
        """Property columns of ``df`` in its own order; the id only if asked for."""
        require_columns(df, [*self.id_fields, *self.order_by])
        hidden = set() if self.vid_as_prop else {self.vid_field}
        return _named_props(df, label, hidden, self.order_by)


@dataclass(frozen=True)
class EdgeWrite:
    """How the rows of a DataFrame are written as edges; without ``rank_field`` the rank is 0."""

    src_field: str
    dst_field: str
    rank_field: str | None = None
    mode: str = "insert"
    src_policy: str | None = None
    dst_policy: str | None = None
    src_as_prop: bool = False
    dst_as_prop: bool = False
    rank_as_prop: bool = False
    overwrite: bool = True
    batch: int = 512
    order_by: tuple[str, ...] = ()

    def __post_init__(self):
        if not self.src_field or not self.dst_field:
            raise ValueError("src_field or dst_field is empty")
        object.__setattr__(self, "rank_field", self.rank_field or None)
        object.__setattr__(self, "mode", _check_write(self.mode, self.batch))
        object.__setattr__(self, "src_policy", _check_policy(self.src_policy))
        object.__setattr__(self, "dst_policy", _check_policy(self.dst_policy))

    @property
    def id_fields(self) -> list[str]:
        return [f for f in (self.src_field, self.dst_field, self.rank_field) if f]

    def prop_columns(self, df: DataFrame, label: Label) -> list[str]:
        """Property columns of ``df`` in its own order; source, target, rank only if asked for."""
        require_columns(df, [*self.id_fields, *self.order_by])
        hidden = set()
        if not self.src_as_prop:
            hidden.add(self.src_field)
        if not self.dst_as_prop:
            hidden.add(self.dst_field)
        if self.rank_field and not self.rank_as_prop:
            hidden.add(self.rank_field)
        return _named_props(df, label, hidden, self.order_by)


def _named_props(df: DataFrame, label: Label, hidden: set[str], order_by) -> list[str]:
    """Columns that are properties by name. Ordering columns need not be properties."""
    names = [
        c
        for c in df.columns
        if c not in hidden and not (c in order_by and c not in label.props)
    ]
    for name in names:
        label.prop_type(name)
    return names
