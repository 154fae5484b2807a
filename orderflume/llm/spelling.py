"""Grouping of spelling variants through blocked Gram matrices of letter counts.

Two words one edit apart have letter-count vectors whose squared distance is 1 (a letter more) or 2 (another letter). The
words lie in blocks of one length each, and only blocks of equal or adjacent length meet. The same holds for sums of the
counts: the letters are dealt into ``GROUPS`` groups of about equal use, and a length block is cut into cells by its
counts per group. Two cells meet only if their own squared distance is at most two, which leaves each cell a dozen
neighbours and loses no pair. Cells meet in groups of bounded size: a large one is dealt into salts, and what it meets
into slots, every salt and slot being a group of their own.

In a group, NumPy products of blocks of count vectors give all squared distances; pairs of at most two are verified code
point by code point. What leaves a group is, for each word, how many near words it saw and the best one, never the pairs.
Forms are then followed by pointer doubling over a table of the words that have one.

Defined results: null text has no words; texts are read whole; in the key of a row without doc_id the id is empty; the
occurrences of repeated rows all count; ties between near words go to the smaller one in code-point order; only A-Z is
lower-cased; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflume.llm.common import settle, texts

LEAST_LENGTH = 6
LEAST_TIMES = 5
OUT_OF = 199  # one in so many keys loses a letter
DOMINANT = 5  # a form occurs at least so many times as often
GROUPS = 4
LEFT, RIGHT = 8192, 16384  # words of a group at most, about; a word of over 16 letters counts as several
ROWS, COLUMNS = 1024, 4096  # of a product
OWN, OTHER, SAME = 0, 1, 2  # of the home cell; of another cell; of the home cell, as partner
HELD = 200_000  # distinct words that a task counts before it passes them on


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_times: int = LEAST_TIMES, out_of: int = OUT_OF) -> DataFrame:
    """word, n: distinct results of the letter runs of all texts."""
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least_length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def passed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                key = "" if doc_id is None else str(doc_id)
                lower = text.as_buffer().to_pybytes().lower().decode() if text.is_valid else ""  # bytes lower-case A-Z only
                for word, n in Counter(runs.findall(lower)).items():
                    h = zlib.crc32(f"{key}:{word}".encode())
                    if h % out_of == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    held[word] += n
                if len(held) >= HELD:
                    yield passed_on()
        if held:
            yield passed_on()

    counted = texts(docs).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_times)


def letter_groups(words: DataFrame, groups: int) -> list[str]:
    """The letters of the words (a few dozen), dealt out so that every group is about as frequent."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter"), "n").where("letter <> ''").groupBy("letter").agg(F.count(F.lit(1)).alias("uses"))
    dealt, total = [""] * groups, [0] * groups
    for r in sorted(letters.collect(), key=lambda r: (-r["uses"], r["letter"])):
        least = total.index(min(total))
        dealt[least] += r["letter"]
        total[least] += r["uses"]
    return dealt


def name(counts: list[Column]) -> Column:
    return F.concat_ws(",", *[c.cast("string") for c in counts])


def homes(counts: list[Column]) -> Column:
    """Cells that the words of a cell come to: itself, the lesser of equal length, those one letter shorter."""
    out = [name(counts)]
    for i in range(len(counts)):
        less = counts[:i] + [counts[i] - 1] + counts[i + 1 :]
        out.append(F.when(counts[i] > 0, name(less)))
        for j in range(i + 1, len(counts)):
            out.append(F.when(counts[i] > 0, name(less[:j] + [counts[j] + 1] + less[j + 1 :])))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def groups_of_words(words: DataFrame, groups: int = GROUPS) -> DataFrame:
    """(home, salt, slot, kind, word, n): the groups that are compared, a salt of the home cell and a slot of what comes."""
    dealt = letter_groups(words, groups)
    length = F.length("word")
    counts = [length - F.length(F.translate("word", letters, "")) if letters else F.lit(0) for letters in dealt]
    named = words.select("word", "n", *[c.alias(f"c{i}") for i, c in enumerate(counts)])
    own_counts = [F.col(f"c{i}") for i in range(groups)]
    celled = named.select("word", "n", F.ceil(F.length("word") / 16).alias("weight"), name(own_counts).alias("cell"), homes(own_counts).alias("homes"))
    cells = celled.groupBy("cell").agg(F.sum("weight").alias("size"), F.first("homes").alias("homes"))
    coming = cells.select(F.explode("homes").alias("cell"), "size").groupBy("cell").agg(F.sum("size").alias("coming"))
    plan = settle(cells.join(coming, "cell").select(F.col("cell").alias("home"), F.ceil(F.col("size") / LEFT).alias("salts"), F.ceil(F.col("coming") / RIGHT).alias("slots")), "cells")
    left = celled.join(plan, F.col("cell") == F.col("home")).select("home", F.pmod(F.xxhash64("word"), "salts").alias("salt"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("slot"), F.lit(OWN).alias("kind"), "word", "n")
    right = celled.select("word", "n", "cell", F.explode("homes").alias("home")).join(plan, "home").select("home", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.pmod(F.xxhash64("word", F.lit("slot")), "slots").alias("slot"), F.when(F.col("home") == F.col("cell"), SAME).otherwise(OTHER).alias("kind"), "word", "n")
    return left.unionByName(right)


class Block:
    """Words of one length: their code points and count vectors."""

    def __init__(self, words: list[str]):
        joined = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.points = joined.reshape(len(words), -1) if words else np.zeros((0, 0), np.uint32)

    def counts(self, letters: np.ndarray) -> np.ndarray:
        n, length = self.points.shape
        cell = np.searchsorted(letters, self.points) + np.arange(n)[:, None] * len(letters)
        return np.bincount(cell.ravel(), minlength=n * len(letters)).reshape(n, len(letters))


def within_two(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of squared distance at most two, from products of blocks."""
    norm_l, norm_r = (left * left).sum(axis=1), (right * right).sum(axis=1)
    exact = np.float32 if max(norm_l.max(initial=0), norm_r.max(initial=0)) < 1 << 21 else np.float64
    a = np.column_stack([left, norm_l, np.ones(len(left))]).astype(exact)
    b = np.column_stack([-2 * right, np.ones(len(right)), norm_r]).astype(exact).T
    for i in range(0, len(left), ROWS):
        for j in range(0, right.shape[0], COLUMNS):
            near = np.flatnonzero((a[i : i + ROWS] @ b[:, j : j + COLUMNS]).ravel() < 2.5)
            if len(near):
                wide = min(COLUMNS, right.shape[0] - j)
                yield near // wide + i, near % wide + j


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_more(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether deleting one code point of the longer word gives the shorter one."""
    n = short.shape[1]
    same = short == long[:, :n]
    first = np.where(same.all(axis=1), n, same.argmin(axis=1))
    return ((short == long[:, 1:]) | (np.arange(n) < first[:, None])).all(axis=1)


def near_words(group: pa.Table) -> pa.Table:
    """For each word of a group: how many near words it has here and the best of them."""
    words, n, kind = group.column("word").to_pylist(), group.column("n").to_numpy(), group.column("kind").to_numpy()
    home = np.flatnonzero(kind == OWN)
    size = np.fromiter(map(len, words), np.int64, len(words))
    found_i, found_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(home):
        length = int(size[home[0]])
        left = Block([words[i] for i in home.tolist()])
        for wide in (length, length + 1):
            other = np.flatnonzero((kind != OWN) & (size == wide))
            if not len(other):
                continue
            right = Block([words[j] for j in other.tolist()])
            letters = np.unique(np.concatenate([left.points.ravel(), right.points.ravel()]))
            for i, j in within_two(left.counts(letters), right.counts(letters)):
                for at in range(0, len(i), 1 << 16):
                    p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
                    fit = one_replaced(left.points[p], right.points[q]) if wide == length else one_more(left.points[p], right.points[q])
                    found_i.append(home[p[fit]])
                    found_j.append(other[q[fit]])
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    once = (kind[j] == OTHER) | (rank[i] < rank[j])  # words of one cell meet twice
    return summed(words, n, rank, i[once], j[once])


def summed(words: list[str], n: np.ndarray, rank: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.Table:
    word, near = np.concatenate([i, j]), np.concatenate([j, i])
    order = np.lexsort((rank[near], -n[near], word))
    word, near = word[order], near[order]
    at = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
    return pa.table(
        {
            "word": pa.array([words[x] for x in word[at].tolist()], pa.string()),
            "n_near": pa.array(np.diff(np.append(at, len(word))), pa.int64()),
            "near_n": pa.array(n[near[at]], pa.int64()),
            "near": pa.array([words[x] for x in near[at].tolist()], pa.string()),
        }
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form: pointers are doubled until none moves; a form is more frequent, so none circles."""
    now = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("ahead"))
        moved = settle(now.join(ahead, F.col("root") == F.col("at"), "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("on")), "roots")
        now = moved.select("word", "root")
        if moved.where("on").isEmpty():
            return now


def spelling_groups(docs: DataFrame, least_length: int = LEAST_LENGTH, least_times: int = LEAST_TIMES, out_of: int = OUT_OF, dominant: int = DOMINANT) -> DataFrame:
    """word, n, n_near, form, form_n and root of every frequent word."""
    words = settle(word_counts(docs, least_length, least_times, out_of), "words")
    seen = groups_of_words(words).groupBy("home", "salt", "slot").applyInArrow(near_words, "word string, n_near long, near_n long, near string")
    best = seen.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    formed = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near"))
    has_form = F.col("near_n") >= dominant * F.col("n")
    formed = settle(formed.select("word", "n", "n_near", F.when(has_form, F.col("near")).alias("form"), F.when(has_form, F.col("near_n")).alias("form_n")), "forms")
    rooted = roots(formed.where("form is not null"))
    return formed.join(rooted, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
