"""Language ID: first the family, then one-versus-one linear SVMs between the languages of it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphtables.llm.common import crc_of_id, pick, read
from graphtables.llm.training import fit_svm, sigmoid, texts_of

#: Hashed features: counts of 1, 2 and 3 characters in a row.
DIM = 4096
#: The families of common languages. A language that is not here is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be bg mk sr hr bs sl cs sk pl",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tt",
    "indic": "hi bn ur mr pa gu ne si",
    "dravidian": "ta te kn ml",
    "semitic": "ar he mt am",
    "malayic": "id ms jv su tl",
    "sinitic": "zh yue",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
LETTER = re.compile(r"[^\W\d_]")


def profile(text: str) -> np.ndarray:
    """The hashed n-grams of a whole text: square roots of counts, length 1."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    c = np.concatenate([np.array([32], "<u4"), c, np.array([32], "<u4")])
    grams = [c, c[:-1] * np.uint32(0x85EBCA6B) + c[1:]]
    grams.append(grams[1][:-1] * np.uint32(0xC2B2AE35) + c[2:])
    out = np.zeros(DIM, np.int64)
    for g in grams:
        out += np.bincount((g * np.uint32(0x9E3779B1)) >> np.uint32(20), minlength=DIM)
    root = np.sqrt(out.astype(np.float32))
    return root / max(1e-9, float(np.sqrt((root * root).sum())))


class Model:
    """Margins of families against the rest, and of every pair of languages inside a family."""

    def __init__(self, x: np.ndarray, langs: np.ndarray):
        self.langs = sorted(set(langs))
        family = np.array([FAMILY_OF.get(v, v) for v in langs], dtype=object)
        self.families = sorted(set(family))
        self.of = {f: [v for v in self.langs if FAMILY_OF.get(v, v) == f] for f in self.families}
        one = len(self.families) < 2
        self.outer = [np.zeros(DIM + 1, np.float32) if one else _svm(x, family == f) for f in self.families]
        self.inner = {}
        for members in self.of.values():
            for a, b in combinations(members, 2):
                at = (langs == a) | (langs == b)
                self.inner[a, b] = _svm(x[at], langs[at] == a)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        margins = x @ np.stack(self.outer)[:, :-1].T + np.stack(self.outer)[:, -1]
        p = sigmoid(4.0 * margins)
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        pairs = {k: sigmoid(4.0 * (x @ w[:-1] + w[-1])) for k, w in self.inner.items()}
        names, scores = [], np.zeros(len(x))
        for i, f in enumerate(best):
            members = self.of[self.families[f]]
            wins = {a: 0.0 for a in members}
            for a, b in combinations(members, 2):
                wins[a] += pairs[a, b][i]
                wins[b] += 1.0 - pairs[a, b][i]
            name = max(members, key=lambda v: wins[v])
            share = wins[name] / (len(members) - 1) if len(members) > 1 else 1.0
            names.append(name)
            scores[i] = float(p[i, f]) * share
        return names, np.clip(scores, 0.0, 1.0)


#: Texts that a model is learned from at most; a profile takes 16 KB of the driver.
MAX_ROWS = 20_000


def _svm(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
    return fit_svm(x, np.where(positive, 1.0, -1.0).astype(np.float32)).astype(np.float32)


def _profiles(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([profile(t or "").tobytes() for t in batch])


def train(docs: DataFrame, per_lang: int = 400, max_rows: int = MAX_ROWS) -> Model | None:
    """A model of every language of ``docs`` (id, text, lang), from at most ``per_lang`` texts of each.

    Where languages are so many that those were more than ``max_rows`` texts, each has an equal share of that number, one text at
    least. The sample is chosen by the hash of the ids. ``docs`` must hold nothing that is held out.
    """
    usable = docs.where("lang IS NOT NULL AND text IS NOT NULL AND id IS NOT NULL")
    n_langs = usable.select("lang").distinct().count()
    per_lang = max(1, min(per_lang, max_rows // max(1, n_langs)))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    keys = usable.select("id", F.row_number().over(order).alias("rn")).where(F.col("rn") <= per_lang).select("id").distinct()
    to_profile = F.pandas_udf(_profiles, "binary")
    sample = texts_of(usable, keys).select("id", "lang", to_profile("text").alias("x"))
    rows = sample.orderBy("id", "lang", "x").toPandas()
    if rows.empty:
        return None
    x = np.stack([np.frombuffer(b, np.float32) for b in rows["x"]])
    return Model(x, rows["lang"].to_numpy(dtype=object))


def language_id(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 5,
    per_lang: int = 400,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score.

    Rows whose crc32(id as text) mod ``folds`` is 0 are held out; the model is learned from a bounded sample
    (``per_lang`` documents of each language, ``max_rows`` in all) of the others that have text, language and id. Only the
    text goes into a prediction, all of it. The family with the largest margin is chosen first; inside it each
    pair of languages has its own machine, and the language that wins most against the others is predicted
    (of equal ones the first by name).

    ``und`` with score 0 where the text is null or has no letter, or where there is nothing to learn from.
    """
    rows = pick(docs, id=id_col, text=text_col, lang=lang_col)
    held = (crc_of_id(F.col("id")) % folds == 0).alias("held_out")
    model = train(rows.where(crc_of_id(F.col("id")) % folds != 0), per_lang, max_rows)

    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            names, scores = [], []
            for start in range(0, len(batch), 256):
                part = [t or "" for t in batch.iloc[start : start + 256]]
                letters = [model is not None and LETTER.search(t) is not None for t in part]
                known, p = model.predict(np.stack([profile(t) for t in part])) if model else ([""] * len(part), np.zeros(len(part)))
                names += [n if ok else "und" for n, ok in zip(known, letters, strict=True)]
                scores += [float(s) if ok else 0.0 for s, ok in zip(p, letters, strict=True)]
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    to_lang = F.pandas_udf(predict, "lang_pred string, score double")
    return rows.select(F.col("id"), held, to_lang("text").alias("p")).select(
        F.col("id").alias(id_col), "held_out", "p.lang_pred", "p.score"
    )


def op1_language_id(spark, sf_dir):
    return language_id(read(spark, sf_dir, "documents"))


QUERIES = {"op1_language_id": op1_language_id}
ORACLE: dict[str, str] = {}
