"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` code points; only the bag is labelled. Each passage becomes shares of
symbols and hashed symbol pairs and a few ratios, then a hidden vector h. Gated attention gives it the weight
softmax(w . (tanh(V h) * sigmoid(U h))) within its bag, and the bag's score is a logistic function of the weighted sum of
its passages. Everything is learned from document labels by gradient descent on a bounded sample (``PER_CLASS`` documents
of either label); scoring reads all passages of all texts.

Defined results: a null or empty text is one passage without symbols and gets the score of that; very long texts have
as many passages as they need; rows repeat as given; a null doc_id is scored, never learned from, held_out false; without
labels every score is 0.5; an empty table gives none; extra columns, lang and source are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflume.llm.common import arrow_map, code_points, fold, in_steps, texts
from orderflume.llm.labelled import sample

PASSAGE = 512
PER_CLASS = 1500
PAIRS = 256
RATIOS = 4
WIDTH = 64 + PAIRS + RATIOS
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY = 30, 128, 5e-3, 1e-4


@functools.cache
def symbols() -> np.ndarray:
    """Symbol of a code point: 26 letters, other letters, digits, spaces, ASCII marks, the rest."""
    table = np.full(0x110000, 62, dtype=np.uint8)
    for point in range(128):
        c = chr(point)
        if c.isalpha():
            table[point] = ord(c.lower()) - 97
        elif c.isdigit():
            table[point] = 27
        elif c.isspace():
            table[point] = 29 if c == "\n" else 28
    marks = [p for p in range(33, 127) if not chr(p).isalnum()]
    table[marks] = 30 + np.arange(len(marks)) % 32
    table[[p for p in range(128, 0x3000) if chr(p).isalpha()]] = 26
    table[0x3000:0x110000] = 26
    table[0] = 63
    return table


def passages(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages and the number of passages of each text."""
    table = symbols()
    rows, number = [], []
    for lo, hi in in_steps(strings):
        part = strings[lo:hi]
        points, owner = code_points(part)
        size = np.fromiter((len(s) + 1 for s in part), dtype=np.int64, count=len(part))  # with the closing 0
        many = -(-size // PASSAGE)
        first = np.cumsum(many) - many
        place = np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size)
        of = first[owner] + place // PASSAGE
        total = int(many.sum())
        sym = table[points].astype(np.int64)
        single = np.bincount(of * 64 + sym, minlength=total * 64).reshape(total, 64)
        pair = (sym[:-1] * 37 + sym[1:] * 101) % PAIRS
        double = np.bincount(of[:-1] * PAIRS + pair, minlength=total * PAIRS).reshape(total, PAIRS)
        length = np.maximum(single[:, :63].sum(axis=1, keepdims=True), 1)
        upper = np.bincount(of, weights=(points >= 65) & (points <= 90), minlength=total)[:, None] / length
        lines = [s.split("\n") for s in part]
        repeated = np.array([1 - len(set(x)) / len(x) for x in lines])
        words = single[:, 28] + single[:, 29] + 1
        ratios = np.concatenate([upper * 3, repeated[np.repeat(np.arange(len(part)), many)][:, None] * 3, np.log1p(length) / 6, (length[:, 0] / words)[:, None] / 10], axis=1)
        rows.append(np.concatenate([np.sqrt(single / length), np.sqrt(double / length), ratios], axis=1).astype(np.float32))
        number.append(many)
    return np.concatenate(rows), np.concatenate(number)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def forward(model: dict, rows: np.ndarray, number: np.ndarray) -> tuple:
    """Scores of the bags, and what their gradients need."""
    start = np.cumsum(number) - number
    h = np.tanh(rows @ model["W"] + model["b"])
    t, g = np.tanh(h @ model["V"]), sigmoid(h @ model["U"])
    raw = (t * g) @ model["w"]
    top = np.maximum.reduceat(raw, start)
    e = np.exp(raw - np.repeat(top, number))
    a = e / np.repeat(np.add.reduceat(e, start), number)
    z = np.add.reduceat(h * a[:, None], start, axis=0)
    return sigmoid(z @ model["c"] + model["d"]), h, t, g, a, z, start


def train(rows: np.ndarray, number: np.ndarray, label: np.ndarray, seed: int = 7) -> dict:
    rng = np.random.default_rng(seed)
    model = {"W": rng.normal(0, 0.3, (WIDTH, HIDDEN)), "b": np.zeros(HIDDEN), "V": rng.normal(0, 0.3, (HIDDEN, GATE)), "U": rng.normal(0, 0.3, (HIDDEN, GATE)), "w": rng.normal(0, 0.3, GATE), "c": rng.normal(0, 0.3, HIDDEN), "d": np.zeros(1)}
    model = {k: v.astype(np.float32) for k, v in model.items()}
    m, s = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    turn = 0
    share = np.where(label == 1, 0.5 / max(label.mean(), 1e-9), 0.5 / max(1 - label.mean(), 1e-9))
    begin = np.cumsum(number) - number
    for epoch in range(EPOCHS):
        order = rng.permutation(len(label))
        for i in range(0, len(order), BATCH):
            bags = order[i : i + BATCH]
            n = number[bags]
            at = np.repeat(begin[bags], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            x = rows[at]
            p, h, t, g, a, z, start = forward(model, x, n)
            miss = ((p - label[bags]) * share[bags] / len(bags)).astype(np.float32)  # gradient of the logit
            grad = {"c": z.T @ miss, "d": np.array([miss.sum()], dtype=np.float32)}
            dz = np.repeat(miss[:, None] * model["c"], n, axis=0)
            da = (dz * h).sum(axis=1)
            draw = a * (da - np.repeat(np.add.reduceat(a * da, start), n))
            grad["w"] = (t * g).T @ draw
            dgate = draw[:, None] * model["w"]
            dt, dg = dgate * g * (1 - t * t), dgate * t * g * (1 - g)
            grad["V"], grad["U"] = h.T @ dt, h.T @ dg
            dh = (dz * a[:, None] + dt @ model["V"].T + dg @ model["U"].T) * (1 - h * h)
            grad["W"], grad["b"] = x.T @ dh, dh.sum(axis=0)
            turn += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k, v in model.items():
                d = grad[k].astype(np.float32) + DECAY * v
                m[k] = 0.9 * m[k] + 0.1 * d
                s[k] = 0.999 * s[k] + 0.001 * d * d
                model[k] = v - rate * (m[k] / (1 - 0.9**turn)) / (np.sqrt(s[k] / (1 - 0.999**turn)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in model.items()}


def fit(docs: DataFrame, labels: DataFrame, folds: int | None = 5, per_class: int = PER_CLASS) -> dict | None:
    def step(batch: pa.RecordBatch) -> dict:
        made = [passages([s]) for s in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "label": batch.column("label"), "rows": pa.array([r.astype(np.float16).tobytes() for r, _ in made], pa.binary())}

    got = arrow_map(sample(docs, labels, "quality", per_class, folds), step, "doc_id long, label int, rows binary").orderBy("doc_id").toArrow()
    label = np.array(got.column("label").to_pylist(), dtype=np.float32)
    if len(set(label.tolist())) < 2:
        return None
    bags = [np.frombuffer(b, dtype=np.float16).reshape(-1, WIDTH) for b in got.column("rows").to_pylist()]
    return train(np.concatenate(bags).astype(np.float32), np.array([len(b) for b in bags]), label)


def score(docs: DataFrame, model: dict | None, folds: int = 5, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score (higher: label 1 likelier) and predicted (1 from ``least`` on) of every whole text."""
    rows = texts(docs).select("doc_id", "text", F.coalesce(fold("doc_id", folds) == 0, F.lit(False)).alias("held_out"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> dict:
        strings = batch.column("text").to_pylist()
        if shared.value is None:
            found = np.full(len(strings), 0.5)
        else:
            found = np.concatenate([forward(shared.value, *passages(strings[a:b]))[0] for a, b in in_steps(strings)]).astype(np.float64)
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": found, "predicted": (found >= least).astype(np.int32)}

    return arrow_map(rows, step, "doc_id long, held_out boolean, score double, predicted int")
