"""Language identification with string kernels.

A text is the set of its letter n-grams, n from 1 to 3 (the blended spectrum), words marked at both ends. The presence
kernel of two texts is the number of n-grams both have over the geometric mean of the numbers either has, so lengths do not
matter. Nyström landmarks, some training texts of each language, stand for the rest: a text is its kernel values with
them, computed for a batch of texts as one matrix product. One ridge regression per language (one versus rest) on those
values is the classifier; the largest output wins.

n-grams that no landmark has count on neither side of the kernel. Fitted on a bounded sample, ``LANDMARKS`` and ``TRAIN``
texts per language, chosen by a hash of doc_id; scoring reads every whole text.

Defined results: null, empty or letterless text gives ``und`` with score 0; rows repeat as given; a null doc_id is scored
but never learned from (held_out false); equal outputs go to the language first in order; with nothing to learn from all
is ``und``; extra columns are ignored.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflume.llm.common import arrow_map, code_points, fold, in_steps, spread, texts

LANDMARKS = 32  # per language
TRAIN = 500  # per language
SYMBOLS = 128  # letters told apart, as powers of 7 bits
RIDGE = 1e-3
UNKNOWN = "und"


@functools.cache
def letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is no letter."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


@dataclass
class Model:
    langs: list[str]
    symbol: np.ndarray  # code point of a folded letter -> 0 .. SYMBOLS - 1
    column: np.ndarray  # packed n-gram -> column of the presence matrix; the last column is for the rest
    landmarks: np.ndarray  # presence rows, scaled to unit length, transposed
    weights: np.ndarray | None = None  # landmarks x langs

    def kernel(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Kernel values with the landmarks, and whether a text has a letter."""
        folded = letters()
        width = self.landmarks.shape[0]
        values = np.zeros((len(strings), self.landmarks.shape[1]), dtype=np.float32)
        lettered = np.zeros(len(strings), dtype=bool)
        for lo, hi in in_steps(strings):
            points, owner = code_points(strings[lo:hi])
            low = folded[points]
            lettered[lo:hi] = np.bincount(owner, weights=low > 0, minlength=hi - lo) > 0
            sym = self.symbol[low].astype(np.int32)
            pair = (sym[:-1] << 7) | sym[1:]
            grams = ((sym, owner), (pair | 1 << 14, owner[:-1]), (((pair[:-1] << 7) | sym[2:]) | 1 << 21, owner[:-2]))
            for a, b in blocks(hi - lo, 400):
                there = np.zeros((b - a) * (width + 1), dtype=np.float32)
                for codes, of in grams:
                    i, j = np.searchsorted(of, [a, b])
                    there[(of[i:j] - a) * (width + 1) + self.column[codes[i:j]]] = 1
                there = there.reshape(b - a, width + 1)[:, :width]
                size = np.sqrt(np.maximum(there.sum(axis=1, keepdims=True), 1))
                values[lo + a : lo + b] = (there @ self.landmarks) / size
        return values, lettered


def blocks(n: int, size: int):
    return [(a, min(a + size, n)) for a in range(0, n, size)]


def grams_of(strings: list[str]) -> list[np.ndarray]:
    """The distinct n-grams of each text as packed code points, 21 bits each; the next to last code says n."""
    out = []
    for s in strings:
        low = letters()[code_points([s])[0]].astype(np.uint64)
        found = [low, low[:-1] << np.uint64(21) | low[1:], low[:-2] << np.uint64(42) | low[1:-1] << np.uint64(21) | low[2:]]
        out.append(np.unique(np.concatenate([np.unique(found[0]), *(np.unique(x) for x in found[1:])])).astype(np.int64))
    return out


def sample(train: DataFrame, per_lang: int, salt: str) -> DataFrame:
    """About ``per_lang`` rows of each language, by a hash of doc_id; twice that many at most."""
    counts = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return train.limit(0)
    share: Column = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(per_lang / n)).otherwise(share)
    order = spread(F.concat(F.col("doc_id").cast("string"), F.lit(salt)))
    return train.where(order < share).orderBy(order).limit(2 * per_lang * len(counts))


def fit(docs: DataFrame, folds: int = 5, landmarks: int = LANDMARKS, per_lang: int = TRAIN) -> Model | None:
    """Learn from text and lang of rows outside fold 0; None if no such row has a letter."""
    train = texts(docs, "lang").where(F.col("lang").isNotNull() & (fold("doc_id", folds) != 0))

    def step(batch: pa.RecordBatch) -> dict:
        made = grams_of(batch.column("text").to_pylist())
        return {"lang": batch.column("lang"), "grams": pa.array([g.tolist() for g in made], pa.list_(pa.int64()))}

    chosen = arrow_map(sample(train, landmarks, "landmark"), step, "lang string, grams array<long>").collect()
    chosen = [(r["lang"], np.array(r["grams"], dtype=np.uint64)) for r in chosen if len(r["grams"]) > 1]
    if not chosen:
        return None
    # letters told apart: those that most landmarks have; the rest share one symbol
    single, seen = np.unique(np.concatenate([g[(g > 0) & (g < 1 << 21)] for _, g in chosen]), return_counts=True)
    kept = single[np.argsort(-seen, kind="stable")][: SYMBOLS - 2]
    symbol = np.ones(0x110000, dtype=np.uint8)
    symbol[0] = 0
    symbol[kept.astype(np.int64)] = np.arange(2, 2 + len(kept), dtype=np.uint8)
    packed = []
    mask = np.uint64((1 << 21) - 1)
    for _, g in chosen:
        parts = [symbol[((g >> np.uint64(s)) & mask).astype(np.int64)].astype(np.int64) for s in (42, 21, 0)]
        # a gram's n: the highest used code, word ends included
        one = parts[2][g < 1 << 21]
        two = ((parts[1] << 7) | parts[2])[g < 1 << 42] | 1 << 14
        three = ((parts[0] << 14) | (parts[1] << 7) | parts[2]) | 1 << 21
        packed.append(np.unique(np.concatenate([one[one > 0], two, three])))
    every = np.unique(np.concatenate(packed))
    inner = every[(every < 1 << 21) | ((every >> 7) & 127 > 0)]  # no gram is about a gap alone
    inner = inner[~np.isin(inner, [1 << 14, 1 << 21])]
    column = np.full(1 << 22, len(inner), dtype=np.int32)
    column[inner] = np.arange(len(inner), dtype=np.int32)
    marks = np.zeros((len(inner) + 1, len(packed)), dtype=np.float32)
    for j, codes in enumerate(packed):
        marks[column[codes], j] = 1
    marks = marks[:-1] / np.sqrt(np.maximum(marks[:-1].sum(axis=0), 1))
    langs = sorted({lang for lang, _ in chosen})
    model = Model(langs, symbol, column, marks)

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batch: pa.RecordBatch) -> dict:
        values, _ = shared.value.kernel(batch.column("text").to_pylist())
        return {"lang": batch.column("lang"), "k": pa.array(values.tolist(), pa.list_(pa.float32()))}

    got = arrow_map(sample(train, per_lang, "train"), rows, "lang string, k array<float>").collect()
    got = [r for r in got if r["lang"] in langs]
    k = np.array([r["k"] for r in got], dtype=np.float64).reshape(len(got), marks.shape[1])
    y = np.array([[float(r["lang"] == x) for x in langs] for r in got]).reshape(len(got), len(langs))
    own = (marks.T @ marks).astype(np.float64)
    balance = 1 / np.maximum(y.sum(axis=0), 1) @ y.T if len(got) else np.zeros(0)
    left = k.T @ (k * balance[:, None]) + RIDGE * own + 1e-9 * np.eye(len(own))
    model.weights = np.linalg.solve(left, k.T @ (y * balance[:, None]))
    return model


def predict(docs: DataFrame, model: Model | None, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score (share of the best output) and support (the best output itself)."""
    rows = texts(docs).select("doc_id", "text", F.coalesce(fold("doc_id", folds) == 0, F.lit(False)).alias("held_out"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> dict:
        return {k: batch.column(k) for k in ("doc_id", "held_out")} | classify(shared.value, batch.column("text").to_pylist())

    return arrow_map(rows, step, "doc_id long, held_out boolean, lang_pred string, score double, support double")


def classify(model: Model | None, strings: list[str]) -> dict:
    if model is None:
        return {"lang_pred": pa.array([UNKNOWN] * len(strings)), "score": np.zeros(len(strings)), "support": np.zeros(len(strings))}
    values, lettered = model.kernel(strings)
    out = np.clip(values.astype(np.float64) @ model.weights, 0, None)
    best, total = out.argmax(axis=1), out.sum(axis=1)
    top = out[np.arange(len(out)), best]
    score = np.where(total > 0, top / np.where(total > 0, total, 1), 1 / len(model.langs))
    names = np.where(lettered, np.array(model.langs, dtype=object)[best], UNKNOWN)
    return {"lang_pred": pa.array(names.tolist(), pa.string()), "score": np.where(lettered, score, 0.0), "support": np.where(lettered, np.minimum(top, 1), 0.0)}


def keep_known(docs: DataFrame, least_support: float = 0.05) -> DataFrame:
    """Documents whose language is known; those without letters, or like no language learned, go.

    A document is like a language if its score there, before the scores are made to add up to one, is at least
    ``least_support`` (a document of that language has about one, one that shares nothing with the landmarks zero).
    Where no row has a language there is nothing to learn and nothing to judge by: all rows stay.
    """
    model = fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            strings = [t or "" for t in batch.column("text").to_pylist()]
            found = classify(shared.value, strings)
            known = np.array([x != UNKNOWN for x in found["lang_pred"].to_pylist()], dtype=bool) & (found["support"] >= least_support)
            yield batch.filter(pa.array(known))

    return docs.mapInArrow(run, docs.schema) if model else docs
