"""Toxicity as an ordered severity, by cumulative-link regression.

Grades: 0 is clean; documents labelled toxic are graded 1 to 3 by thirds of how many marker words they hold (words whose
labelled documents are nearly all toxic). The model is P(grade > j) = sigmoid(w . x - t_j): one weight per word, shared by
all thresholds, and ordered thresholds t_0 < t_1 < t_2. x is sparse: log(1 + count) of vocabulary features, which are
whole words and word beginnings of 4 to 6 letters (so that other endings of a learned stem count). The score is the
expected severity, the sum of P(grade > j).

Vocabulary (``WORDS`` features of at least ``LEAST_DOCUMENTS`` labelled documents, those most uneven between the labels) and
weights are learned on a bounded sample (``PER_CLASS`` documents of either label); scoring reads every whole text.

Defined results: null or empty text has no words and severity as the thresholds say (clean, if most are); rows repeat as
given; a null doc_id is scored, never learned from; without both labels severity is 0; an empty table gives none; extra
columns are ignored by ``severity`` and kept by ``keep_clean``.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflume.llm.common import arrow_map, stage, texts
from orderflume.llm.labelled import sample

PER_CLASS = 1500
WORDS = 2000
LEAST_DOCUMENTS = 4
LONGEST_WORD = 40
GRADES = 3
RIDGE = 2e-3
TURNS, RATE = 400, 0.1
FOUND = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    """A word and, marked by a caret, its beginnings."""
    return [word, *(f"^{word[:n]}" for n in (4, 5, 6) if len(word) > n)] if len(word) <= LONGEST_WORD else []


class Indexed(dict):
    """The vocabulary features of each word seen, by position; forgets all when ``most`` words are held."""

    def __init__(self, index: dict[str, int], most: int = 100_000):
        self.index, self.most = index, most

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= self.most:
            self.clear()
        self[word] = found = tuple(self.index[f] for f in features(word) if f in self.index)
        return found


@dataclass
class Model:
    index: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, strings: list[str]) -> np.ndarray:
        """P(grade > j) for each text and threshold."""
        known, scores = self.__dict__.setdefault("known", Indexed(self.index)), np.zeros(len(strings))
        for i, s in enumerate(strings):
            seen = Counter(chain.from_iterable(map(known.__getitem__, FOUND.findall(s.lower()))))
            if seen:
                at = np.fromiter(seen, dtype=np.int64, count=len(seen))
                scores[i] = self.weights[at] @ np.log1p(np.fromiter(seen.values(), dtype=float, count=len(seen)))
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -60, 60)))


def regress(owner: np.ndarray, word: np.ndarray, value: np.ndarray, grade: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood with a ridge: shared weights and increasing thresholds (a first one and positive steps)."""
    levels = max(int(grade.max()), 1)
    w, first, step = np.zeros(words), 1.0, np.zeros(levels - 1)
    over = (grade[:, None] > np.arange(levels)).astype(float)
    share = np.where(grade > 0, 0.5 / max((grade > 0).mean(), 1e-9), 0.5 / max((grade == 0).mean(), 1e-9)) / len(grade)
    state = [np.zeros(words + levels), np.zeros(words + levels)]
    for turn in range(1, TURNS + 1):
        t = first + np.concatenate([[0], np.cumsum(np.exp(step))])
        x = np.bincount(owner, weights=w[word] * value, minlength=len(grade))
        cum = np.concatenate([np.ones((len(grade), 1)), 1 / (1 + np.exp(-np.clip(x[:, None] - t, -60, 60))), np.zeros((len(grade), 1))], axis=1)
        slope = cum * (1 - cum)
        rows = np.arange(len(grade))
        p = np.maximum(cum[rows, grade] - cum[rows, grade + 1], 1e-12)
        dx = -(slope[rows, grade] - slope[rows, grade + 1]) / p * share
        dt = np.zeros((len(grade), levels + 2))
        dt[rows, grade] += slope[rows, grade] / p * share
        dt[rows, grade + 1] -= slope[rows, grade + 1] / p * share
        dt = dt[:, 1:-1].sum(axis=0)
        grad = np.concatenate([np.bincount(word, weights=dx[owner] * value, minlength=words) + RIDGE * w, [dt.sum()], [dt[j + 1 :].sum() * np.exp(step[j]) for j in range(levels - 1)]])
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.999 * state[1] + 0.001 * grad * grad
        move = RATE * (1 - turn / (TURNS + 1)) * (state[0] / (1 - 0.9**turn)) / (np.sqrt(state[1] / (1 - 0.999**turn)) + 1e-10)
        w, first, step = w - move[:words], first - move[words], step - move[words + 1 :]
    return w, first + np.concatenate([[0], np.cumsum(np.exp(step))])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model | None:
    def step(batch: pa.RecordBatch) -> dict:
        seen = [Counter(f for w in FOUND.findall(s.lower()) for f in features(w)) for s in batch.column("text").to_pylist()]
        owner = pa.array(np.repeat(np.arange(len(seen)), [len(c) for c in seen]))
        return {"doc_id": batch.column("doc_id").take(owner), "label": batch.column("label").take(owner), "word": pa.array([w for c in seen for w in c], pa.string()), "n": pa.array([n for c in seen for n in c.values()], pa.int64())}

    rows = stage(arrow_map(sample(docs, labels, "toxic", per_class, None), step, "doc_id long, label int, word string, n long"), "words")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.countDistinct("doc_id").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    toxic, clean = F.col("toxic") / sizes[1], F.col("clean") / sizes[0]
    counts = rows.groupBy("word").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")).where(F.col("toxic") + F.col("clean") >= LEAST_DOCUMENTS)
    uneven = F.abs(toxic - clean) * F.abs(F.ln((toxic + 1e-4) / (clean + 1e-4)))
    vocabulary = counts.orderBy(uneven.desc(), "word").limit(WORDS).collect()
    index = {r["word"]: i for i, r in enumerate(vocabulary)}
    marker = np.array([r["toxic"] / sizes[1] > 19 * r["clean"] / sizes[0] and r["toxic"] >= 3 * LEAST_DOCUMENTS for r in vocabulary])
    chosen = docs.sparkSession.createDataFrame(list(index.items()), "word string, at int")
    got = rows.join(F.broadcast(chosen), "word").groupBy("doc_id", "label").agg(F.collect_list("at").alias("at"), F.collect_list("n").alias("n")).orderBy("doc_id").collect()
    owner = np.repeat(np.arange(len(got)), [len(r["at"]) for r in got])
    word = np.array([a for r in got for a in r["at"]], dtype=np.int64)
    count = np.array([n for r in got for n in r["n"]], dtype=float)
    label = np.array([r["label"] for r in got])
    marks = np.bincount(owner, weights=count * marker[word], minlength=len(got))
    cuts = np.unique(np.quantile(marks[label == 1], [1 / GRADES, 2 / GRADES]))
    grade = np.where(label == 1, 1 + np.searchsorted(cuts, marks, side="left"), 0)
    _, grade = np.unique(grade, return_inverse=True)  # no empty grade between
    return Model(index, *regress(owner, word, np.log1p(count), grade, len(index)))


def judge(model: Model | None, strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected severity, most likely side of each threshold as a grade, and whether the grade is over 0."""
    if model is None:
        return np.zeros(len(strings)), np.zeros(len(strings), dtype=np.int32), np.zeros(len(strings), dtype=bool)
    above = model.above(strings)
    grade = (above >= 0.5).sum(axis=1).astype(np.int32)
    return above.sum(axis=1), grade, grade > 0


def severity(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, severity (expected), grade and toxic of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id")} | dict(zip(("severity", "grade", "toxic"), judge(shared.value, batch.column("text").to_pylist())))

    return arrow_map(texts(docs), step, "doc_id long, severity double, grade int, toxic boolean")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not judged toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches):
        for batch in batches:
            toxic = judge(shared.value, [t or "" for t in batch.column("text").to_pylist()])[2]
            yield batch.filter(pa.array(~toxic))

    return docs.mapInArrow(run, docs.schema)
