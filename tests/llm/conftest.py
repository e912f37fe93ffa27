from __future__ import annotations

import random

import duckdb
import pytest

DOCS = "doc_id long, text string, lang string, source string, n long, id string, key string, h long, spans string, score double"


@pytest.fixture(scope="session")
def table(spark):
    """Documents from (id, text, lang, source), with columns whose names the operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(*r, 1, "x", "k", 2, "s", 0.5) for r in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, a long text, equal texts, rows that are there twice."""
    long = " ".join(f"w{k % 977} {k}" for k in range(30_000))
    return [
        (1, None, "en", "a"), (2, "", None, None), (3, " \t\n", "de", "a"), (4, "Same text HERE", "en", "b"),
        (5, "same text here", "en", "b"), (5, "same text here", "en", "b"), (6, long, "en", None), (7, long + " end", "fr", "b"),
        (None, "no id at all", "en", "a"), (None, None, None, None), (8, "12345 !!", "de", "c"), (9, "ä", "de", "c"),
    ]


@pytest.fixture(scope="session")
def noisy():
    """Random texts of few words with shared passages and periodic stretches, as (id, text)."""
    draw = random.Random(7)
    words = [draw.choice("abcdeé") * draw.randint(1, 4) for _ in range(40)]
    passages = [" ".join(draw.choices(words, k=draw.randint(8, 60))) for _ in range(6)]
    out = []
    for i in range(60):
        parts = [" ".join(draw.choices(words, k=draw.randint(0, 30))) for _ in range(draw.randint(0, 4))]
        parts += draw.sample(passages, draw.randint(0, 2))
        if i % 9 == 0:
            parts.append("ab cd " * draw.randint(1, 40))
        draw.shuffle(parts)
        out.append((i, " ".join(parts)))
    for i in range(60, 90):  # copies with a change here and there
        text = out[i - 60][1].split(" ")
        for _ in range(draw.randint(0, 2)):
            text[draw.randrange(len(text))] = "new"
        out.append((i, " ".join(text)))
    return out


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con
