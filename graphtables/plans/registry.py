"""All registered queries and their check SQL, by key."""

from __future__ import annotations

from graphtables.plans import (
    exports,
    expressions,
    mutations,
    scans,
    statements,
    stored,
    streams,
    traversals,
)

GROUPS = (scans, expressions, mutations, statements, traversals, exports, stored, streams)


def queries() -> dict:
    return {name: query for group in GROUPS for name, query in group.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for group in GROUPS for name, text in group.ORACLE.items()}
