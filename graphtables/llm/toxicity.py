"""Toxicity: a chain of linear classifiers, each fed with the probabilities of those before it."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphtables.llm.common import crc_of_id, pick, read, settled
from graphtables.llm.training import Rows, chosen_by_lasso, fit_logistic, sigmoid, some, texts_of

#: Hashed words and n-grams.
DIM = 1 << 18
#: Characters of an n-gram; the ends of the word count.
GRAM = 5
#: The penalty that a feature must overcome, and the rows that it is thought to be in besides.
SURE, PRIOR = 3.0, 3.0
WORD = re.compile(r"[^\W\d_]+")


@lru_cache(1 << 16)
def _of_word(word: str) -> tuple[int, ...]:
    whole = f"^{word}$"
    parts = {whole, *(whole[i : i + GRAM] for i in range(len(whole) - GRAM + 1))}
    return tuple(zlib.crc32(p.encode("utf-8", "surrogatepass")) % DIM for p in parts)


def features_of(text: str) -> np.ndarray:
    """The numbers of the distinct words (runs of letters, lower case) of a whole text and of their n-grams, sorted.

    Words over 100 letters are not kept for the next text, as nothing bounds their length.
    """
    found = set()
    for word in set(WORD.findall(text.lower())):
        found.update(_of_word(word) if len(word) <= 100 else _of_word.__wrapped__(word))
    return np.array(sorted(found), np.int32)


def _sets(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([features_of(t or "").tobytes() for t in batch])


class Chain:
    """Linear models in the order of their categories."""

    def __init__(self, sets: list[np.ndarray], labels: np.ndarray, fold: np.ndarray, l2: float, rounds: int, weight: np.ndarray | None = None):
        """``labels``: a column per category. A model is trained on what the models before it say about documents
        that they were not trained on: each category is fitted once per fold without that fold, and
        once on everything for use. ``weight`` says how many rows each row stands for."""
        rows = Rows(sets)
        weight = np.ones(rows.n) if weight is None else weight
        earlier = np.zeros((rows.n, 0))
        self.models = []
        for y in labels.T.astype(float):
            unseen = np.zeros(rows.n)
            for k in np.unique(fold):
                w = self._fit(rows, earlier, y, weight * (fold != k), l2, rounds)
                z = rows.dot(w[:DIM]) + earlier @ w[DIM:-1] + w[-1]
                unseen[fold == k] = sigmoid(z[fold == k])
            w = self._fit(rows, earlier, y, weight, l2, rounds)
            self.models.append((w[:DIM].astype(np.float32), w[DIM:]))
            earlier = np.column_stack([earlier, unseen])

    @staticmethod
    def _fit(rows, earlier, y, use, l2, rounds):
        """Features without use next to the others are left out first: they would only learn the sample by heart."""
        chosen = chosen_by_lasso(rows, earlier, y, use, DIM, SURE, PRIOR)
        size = int(chosen.sum())
        fitted = fit_logistic(rows.only(chosen), earlier, y, use, size, l2, rounds)
        w = np.zeros(DIM)
        w[chosen] = fitted[:size]
        return np.concatenate([w, fitted[size:]])

    def predict(self, numbers: np.ndarray) -> list[float]:
        said: list[float] = []
        for w, rest in self.models:
            z = float(w[numbers].sum()) + float(np.dot(rest[:-1], said)) + float(rest[-1])
            said.append(float(sigmoid(z)))
        return said


def train(
    docs: DataFrame, labels: DataFrame, names: list[str], max_docs: int, max_chars: int, folds: int = 3, l2: float = 1e-4, rounds: int = 120
) -> Chain | None:
    """A chain from at most ``max_docs`` labelled documents, of which those over ``max_chars`` are left out.

    The sample is chosen per category (``balanced``). Both bounds hold for training alone. ``docs`` has id, text; ``labels`` has id and a column of 0 or 1 per
    category; ids with several rows count as 1 where any says so.
    """
    known = labels.where("id IS NOT NULL").groupBy("id").agg(*[F.max(n).alias(n) for n in names]).dropna()
    ids = docs.where(F.length("text") <= max_chars).select("id").join(known, "id").dropDuplicates(["id"])
    keys = balanced(ids, names, max_docs)
    if keys is None:
        return None
    to_set = F.pandas_udf(_sets, "binary")
    sample = texts_of(docs, keys).select("id", *names, "weight", to_set("text").alias("x")).orderBy("id", "x").toPandas()
    sets = [np.frombuffer(b, np.int32) for b in sample.pop("x")]
    fold = np.arange(len(sample)) % folds
    return Chain(sets, sample[names].to_numpy(), fold, l2, rounds, sample["weight"].to_numpy(float))


def balanced(ids: DataFrame, names: list[str], n: int) -> DataFrame | None:
    """At most ``n`` rows of ``ids`` (id, names), with the weight of each: how many rows it stands for.

    A row belongs to its rarest category, or to none. These share ``n`` equally; what one does not need goes to the
    others, so a rare category gives all its positive rows while they fit. None if there is no row.
    """
    rows = settled(ids, "labelled")
    sums = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first()
    rarest_first = sorted(names, key=lambda c: (sums[c], names.index(c)))
    of = F.coalesce(*[F.when(F.col(c) > 0, F.lit(c)) for c in rarest_first], F.lit(""))
    sizes = {r[0]: r[1] for r in rows.groupBy(of).count().collect()}
    parts, left = [], n
    for k, (name, size) in enumerate(sorted(sizes.items(), key=lambda kv: (kv[1], kv[0]))):
        take = min(size, left // (len(sizes) - k))
        left -= take
        if take:
            parts.append(some(rows.where(of == name), take).withColumn("weight", F.lit(size / take)))
    return reduce(DataFrame.unionAll, parts) if parts else None


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    folds: int = 5,
    max_docs: int = 12_000,
    max_chars: int = 50_000,
    threshold: float = 0.5,
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, p_<category> for each, and <category> (p >= threshold).

    ``categories`` maps the names, in the order of the chain, to expressions over ``labels`` that give 0, 1 or
    null. Rows whose crc32(id as text) mod ``folds`` is 0 are held out of the bounded training sample. The
    features are the words of the whole text and their n-grams; null and empty texts have none, and so the same low score
    each. Without any label all probabilities are null and nothing is marked.
    """
    names = list(categories)
    rows = pick(docs, id=id_col, text=text_col)
    truth = labels.select(F.col(label_id).alias("id"), *[c.cast("int").alias(n) for n, c in categories.items()])
    learn = rows.where((crc_of_id(F.col("id")) % folds != 0) & F.col("text").isNotNull())
    chain = train(learn, truth, names, max_docs, max_chars)

    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            said = [chain.predict(features_of(t or "")) if chain else [None] * len(names) for t in batch]
            yield pd.DataFrame(said, columns=[f"p_{n}" for n in names], dtype="float64")

    to_p = F.pandas_udf(predict, ", ".join(f"p_{n} double" for n in names))
    return rows.select("id", (crc_of_id(F.col("id")) % folds == 0).alias("held_out"), to_p("text").alias("p")).select(
        F.col("id").alias(id_col),
        "held_out",
        *[f"p.p_{n}" for n in names],
        *[F.coalesce(F.col(f"p.p_{n}") >= threshold, F.lit(False)).alias(n) for n in names],
    )


def op3_toxicity(spark, sf_dir):
    """The chain low_quality, toxic, toxic_junk: what `labels` says, and both at once."""
    low, toxic = 1 - F.col("quality"), F.col("toxic")
    chain = {"low_quality": low, "toxic": toxic, "toxic_junk": low * toxic}
    out = toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), chain)
    return out.withColumn("score", F.col("p_toxic"))


QUERIES = {"op3_toxicity": op3_toxicity}
ORACLE: dict[str, str] = {}
