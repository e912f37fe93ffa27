"""Quality classifier: attention-based multiple-instance learning over the passages of a document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphtables.llm.common import crc_of_id, pick, read
from graphtables.llm.training import sigmoid, some, texts_of

#: Characters of a passage.
PASSAGE = 600
#: Hashed features: three characters in a row.
GRAMS = 128
N_CLASSES = 12
N_PLAIN = N_CLASSES + 6
N_FEATURES = N_PLAIN + GRAMS
HIDDEN, GATE = 32, 16


def _class_table() -> np.ndarray:
    """The class of each ASCII character; the last class is all others."""
    table = np.full(129, 9, np.int64)
    for k, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r\x0b\x0c", ".", ",;:", "!?", "|")):
        for c in chars:
            table[ord(c)] = k
    for c in "#$%&*+=<>@^~_\\/":
        table[ord(c)] = 10
    table[128] = 11
    return table


CLASS = _class_table()


def passages(text: str) -> np.ndarray:
    """Features of every passage of a whole text, one row each; an empty text is one empty passage.

    Shares of the character classes, word length, shares of words that are new in the passage, new in
    the document, equal to the word before, and wholly upper case, the words, and hashed trigrams.
    """
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    n = max(1, -(-len(c) // PASSAGE))
    out = np.zeros((n, N_FEATURES), np.float32)
    if not len(c):
        return out
    where = np.arange(len(c)) // PASSAGE
    sizes = np.bincount(where, minlength=n)[:, None]
    kind = CLASS[np.minimum(c, 128)]
    out[:, :N_CLASSES] = np.bincount(where * N_CLASSES + kind, minlength=n * N_CLASSES).reshape(n, -1) / sizes

    solid = np.concatenate([[False], (kind != 3) & (kind != 4), [False]])
    starts, ends = np.flatnonzero(~solid[:-1] & solid[1:]), np.flatnonzero(solid[:-1] & ~solid[1:])
    if len(starts):
        low = c | np.where((c >= 65) & (c <= 90), np.uint32(32), np.uint32(0))
        begin = np.zeros(len(c), np.int64)
        begin[starts] = starts
        place = np.arange(len(c)) - np.maximum.accumulate(begin)
        weights = (low.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        weights ^= weights >> np.uint64(29)
        weights *= (2 * place.astype(np.uint64) + np.uint64(0xBF58476D1CE4E5B9))
        word = np.add.reduceat(np.where(solid[1:-1], weights, np.uint64(0)), starts)
        at = where[starts]
        count = np.bincount(at, minlength=n)
        per = np.maximum(1, count)
        first = np.zeros(len(word), bool)
        first[np.unique(word, return_index=True)[1]] = True
        own = np.zeros(len(word), bool)
        own[np.unique(word ^ (at.astype(np.uint64) << np.uint64(40)), return_index=True)[1]] = True
        again = np.concatenate([[False], word[1:] == word[:-1]])
        upper = np.add.reduceat((kind == 1).astype(np.int64), starts) * 2 > (ends - starts)
        plain = [ends - starts, own, first, again, upper]
        for k, values in enumerate(plain):
            out[:, N_CLASSES + k] = np.bincount(at, weights=values, minlength=n) / per
        out[:, N_CLASSES] /= 10.0
        out[:, N_CLASSES + 5] = np.log1p(count) / 5.0
    if len(c) > 2:
        g = (c[:-2] * np.uint32(0x85EBCA6B) + c[1:-1]) * np.uint32(0xC2B2AE35) + c[2:]
        g = (g * np.uint32(0x9E3779B1)) >> np.uint32(25)
        grams = np.bincount(where[2:] * GRAMS + g, minlength=n * GRAMS).reshape(n, -1)
        out[:, N_PLAIN:] = np.sqrt(grams / sizes)
    return out


def spread(n: int, most: int) -> np.ndarray:
    """At most ``most`` of ``n`` places, all over them: those of the smallest hash, in their order."""
    place = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return np.sort(np.argsort(place, kind="stable")[:most])


class Attention:
    """Passages are encoded, weighed by a gated attention over the document, and summed; the sum is scored."""

    def __init__(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray, rounds: int = 25, batch: int = 64, seed: int = 3):
        """``x``: passages; ``bag``: the number of the document of each, ascending; ``y``: label of each document."""
        draw = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        shapes = {"e": (x.shape[1], HIDDEN), "eb": (HIDDEN,), "v": (HIDDEN, GATE), "u": (HIDDEN, GATE), "a": (GATE,), "c": (HIDDEN,), "cb": (1,)}
        self.w = {k: (draw.normal(0, s[0] ** -0.5, s) if len(s) > 1 else np.zeros(s)) for k, s in shapes.items()}
        self.w["a"], self.w["c"] = draw.normal(0, 0.2, GATE), draw.normal(0, 0.2, HIDDEN)
        first = np.searchsorted(bag, np.arange(len(y) + 1))
        x = (x - self.mean) / self.scale
        m = {k: np.zeros_like(w) for k, w in self.w.items()}
        s = {k: np.zeros_like(w) for k, w in self.w.items()}
        step = 0
        for turn in range(rounds):
            order = draw.permutation(len(y))
            rate = 0.01 * (1 - turn / rounds) + 0.0005
            for i in range(0, len(order), batch):
                docs = order[i : i + batch]
                sizes = first[docs + 1] - first[docs]
                rows = np.repeat(first[docs] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
                step += 1
                for k, g in self._slopes(x[rows], sizes, y[docs]).items():
                    g = g + 1e-4 * self.w[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    self.w[k] = self.w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)

    def _forward(self, x: np.ndarray, sizes: np.ndarray):
        w, first = self.w, np.concatenate([[0], np.cumsum(sizes)[:-1]])
        h = np.tanh(x @ w["e"] + w["eb"])
        tv, su = np.tanh(h @ w["v"]), sigmoid(h @ w["u"])
        z = (tv * su) @ w["a"]
        z = np.exp(z - np.repeat(np.maximum.reduceat(z, first), sizes))
        attention = z / np.repeat(np.add.reduceat(z, first), sizes)
        bag = np.add.reduceat(h * attention[:, None], first)
        return h, tv, su, attention, bag, sigmoid(bag @ w["c"] + w["cb"][0])

    def _slopes(self, x, sizes, y):
        w = self.w
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        h, tv, su, attention, bag, p = self._forward(x, sizes)
        r = (p - y) / len(y)
        d_bag = r[:, None] * w["c"]
        d_h = np.repeat(d_bag, sizes, axis=0) * attention[:, None]
        d_a = (np.repeat(d_bag, sizes, axis=0) * h).sum(1)
        d_z = attention * (d_a - np.repeat(np.add.reduceat(attention * d_a, first), sizes))
        d_t = d_z[:, None] * w["a"] * su * (1 - tv * tv)
        d_s = d_z[:, None] * w["a"] * tv * su * (1 - su)
        d_h += d_t @ w["v"].T + d_s @ w["u"].T
        d_e = d_h * (1 - h * h)
        return {
            "e": x.T @ d_e, "eb": d_e.sum(0), "v": h.T @ d_t, "u": h.T @ d_s,
            "a": ((tv * su) * d_z[:, None]).sum(0), "c": bag.T @ r, "cb": np.array([r.sum()]),
        }

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        x = (np.concatenate(bags) - self.mean) / self.scale
        return self._forward(x, np.array([len(b) for b in bags]))[-1]


def train(docs: DataFrame, labels: DataFrame, max_docs: int, max_passages: int) -> Attention | None:
    """A model from at most ``max_docs`` labelled documents and of each ``max_passages`` passages, spread over the whole text.

    Both bounds hold for training alone. ``docs`` has id, text; ``labels`` has id, y (0 or 1); an id with
    several labels counts as 1 where most of them say so.
    """

    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            every = (passages(t or "") for t in batch)
            yield pd.Series([x[spread(len(x), max_passages)].astype(np.float16).tobytes() for x in every])

    known = labels.where("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg((F.avg("y") > 0.5).cast("int").alias("y"))
    keys = some(docs.select("id").distinct().join(known, "id"), max_docs)
    to_bytes = F.pandas_udf(encode, "binary")
    sample = texts_of(docs, keys).select("id", "y", to_bytes("text").alias("x")).orderBy("id", "x").toPandas()
    if sample.empty:
        return None
    bags = [np.frombuffer(b, np.float16).reshape(-1, N_FEATURES).astype(np.float32) for b in sample["x"]]
    bag = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    return Attention(np.concatenate(bags), bag, sample["y"].to_numpy(float))


def scorer(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "quality",
    folds: int = 3,
    held: int = 1,
    max_docs: int = 4000,
    max_passages: int = 48,
):
    """A function of the text column that gives its score, learned as ``quality`` says."""
    rows = pick(docs, id=id_col, text=text_col)
    learn = rows.where(crc_of_id(F.col("id")) % folds != held)
    model = train(learn, pick(labels, id=label_id, y=label_col), max_docs, max_passages)

    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            scores: list[float] = []
            for i in range(0, len(batch), 64):
                bags = [passages(t or "") for t in batch.iloc[i : i + 64]]
                scores += list(model.score(bags)) if model else [0.5] * len(bags)
            yield pd.Series(scores, dtype="float64")

    return F.pandas_udf(predict, "double")


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 3, held: int = 1, **more) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted.

    Rows whose crc32(id as text) mod ``folds`` is ``held`` are held out; the model is learned from a bounded
    sample (max_docs, and max_passages of each, spread over the whole text) of the other labelled ones. A score is made of
    the text alone, all passages of it, however long it is. Null counts as empty, an empty text is one empty passage. Without
    any label the score is 0.5. Repeated rows get a row each; an empty table gives none. Labels that tie count as 0. Other
    columns are not looked at, whatever their names.
    """
    score = scorer(docs, labels, id_col, text_col, folds=folds, held=held, **more)
    rows = pick(docs, id=id_col, text=text_col)
    held_out = (crc_of_id(F.col("id")) % folds == held).alias("held_out")
    return rows.select("id", held_out, score("text").alias("score")).select(
        F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op9_quality(spark, sf_dir):
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {"op9_quality": op9_quality}
ORACLE: dict[str, str] = {}
