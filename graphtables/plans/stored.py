"""Changes of a stored space: kept as deltas, merged into parts, and rows fetched from few parts."""

from __future__ import annotations

from graphtables.model import EDGE, EDGE_KEY, EdgeWrite
from graphtables.plans import mutations, traversals
from graphtables.plans.demo import CONTAINS_ORDER, EDGES, demo_space
from graphtables.session import scratch_path
from graphtables.sources.scan import scan
from graphtables.sources.store import Store


def _stored_lines(spark, sf_dir, **settings) -> Store:
    space = demo_space(spark, sf_dir, "contains")
    store = Store(spark, scratch_path(spark, "space"), space, **settings)
    store.write({(EDGE, "contains"): scan(space, EDGE, "contains")})
    return store


def changed_lines(spark, sf_dir) -> Store:
    """Lines inserted, then those that came back deleted, each kept as a delta."""
    store = _stored_lines(spark, sf_dir, delta_share=float("inf"))
    feed = mutations.line_feed(spark, sf_dir)
    store.apply(EDGE, "contains", feed, EdgeWrite(*mutations.LINE_ID, order_by=tuple(CONTAINS_ORDER)))
    back = feed.filter(f"{mutations.LINE_ID[2]} <= 10").select(*mutations.LINE_ID)
    store.apply(EDGE, "contains", back, EdgeWrite(*mutations.LINE_ID, mode="delete"))
    return store


def stored_edges_deltas(spark, sf_dir):
    """The lines as they are read through two deltas."""
    return scan(changed_lines(spark, sf_dir).read(), EDGE, "contains")


def stored_edges_compacted(spark, sf_dir):
    """The same once the deltas are merged into their parts and old versions are cleared away."""
    store = changed_lines(spark, sf_dir)
    store.compact(EDGE, "contains")
    store.clear_old()
    return scan(store.read(), EDGE, "contains")


def stored_fetch_edges(spark, sf_dir):
    """The returned lines by key, from a stored label."""
    return _stored_lines(spark, sf_dir).fetch(EDGE, "contains", traversals.line_keys(spark, sf_dir), ["l_quantity"])


def stored_label_profile(spark, sf_dir):
    """What the stored lines hold, read off their counts; the parts that the two deltas touch are read."""
    return changed_lines(spark, sf_dir).profile()


def stored_profile_compacted(spark, sf_dir):
    """The same from counts alone, once the deltas are merged."""
    store = changed_lines(spark, sf_dir)
    store.compact(EDGE, "contains")
    return store.profile()


QUERIES = {
    f.__name__: f
    for f in (stored_edges_deltas, stored_edges_compacted, stored_fetch_edges, stored_label_profile, stored_profile_compacted)
}

_CHANGED = (
    f"SELECT * FROM ({mutations.ORACLE['insert_edges_overwrite']}) ANTI JOIN"
    f" (SELECT * FROM ({mutations.LINE_FEED_SQL}) WHERE _rank <= 10) USING ({', '.join(EDGE_KEY)})"
)
_PROFILE = " UNION ALL ".join(
    f"SELECT 'edge' AS kind, 'contains' AS label, '{p}' AS property, '{t}' AS property_type, count(*) AS n_rows,"
    f" count(*) - count({p}) AS n_nulls FROM changed"
    for p, t in EDGES["contains"].items()
)
_PROFILE = f"WITH changed AS ({_CHANGED}) {_PROFILE}"
ORACLE = {
    "stored_edges_deltas": _CHANGED,
    "stored_edges_compacted": _CHANGED,
    "stored_label_profile": _PROFILE,
    "stored_profile_compacted": _PROFILE,
    "stored_fetch_edges": traversals.ORACLE["fetch_edges"],
}
