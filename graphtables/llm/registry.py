"""The corpus queries and their check SQL, by key."""

from __future__ import annotations

from graphtables.llm import conversations, decontaminate, exact_dedup, langid, merkle, mixing, near_dedup, passages, pii, quality, simhash, suffixes, toxicity

GROUPS = (langid, decontaminate, toxicity, exact_dedup, pii, suffixes, mixing, near_dedup, quality, passages, merkle, simhash, conversations)


def queries() -> dict:
    return {name: query for group in GROUPS for name, query in group.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for group in GROUPS for name, text in group.ORACLE.items()}
