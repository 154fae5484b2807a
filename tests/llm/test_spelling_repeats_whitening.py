"""Spelling groups, repeated passages and whitening against brute force, with odd tables and forced skew."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from orderflume.llm import bwtmerge, spelling, whitening

SCHEMA = "doc_id long, text string, lang string, source string, spans string, pack long, word string, n int, size string"
SMALL = "/root/testdata/sf0.001"


def documents(spark, rows):
    return spark.createDataFrame([(d, t, "en", None, "x", 1, "w", 2, "s") for d, t in rows], SCHEMA)


# --- spelling ---------------------------------------------------------------------------


def spelled(rows, out_of=spelling.OUT_OF, least_times=5):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            seen[run if h % out_of else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in seen.items() if len(w) >= 6 and n >= least_times}
    near, masked = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            masked[w[:i], w[i + 1 :]].add(w)
    for (a, b), group in masked.items():
        for w in group:
            near[w] |= group - {w}
            if a + b in words:
                near[w].add(a + b)
                near[a + b].add(w)
    best = {w: min(near[w], key=lambda x: (-words[x], x)) for w in words if near[w]}
    form = {w: b for w, b in best.items() if words[b] >= 5 * words[w]}
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    return sorted(out)


def spelling_rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_spelling_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = spelled(rows, out_of=7)
    assert any(x[1] for x in want) and spelling_rows(spelling.spelling_groups(docs, out_of=7)) == want


def test_spelling_salted_groups_and_chains(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LEFT", 5)
    monkeypatch.setattr(spelling, "RIGHT", 7)
    monkeypatch.setattr(spelling, "HELD", 3)
    chain = [("abcdef" + "g" * i, 5**i) for i in range(5)]
    letters = np.random.default_rng(1).choice(list("abcé"), (150, 7))
    rows = [(i, " ".join([w] * (5 * n))) for i, (w, n) in enumerate(chain)] + [(100 + i, " ".join(["".join(x)] * (5 + i % 40))) for i, x in enumerate(letters)]
    want = spelled(rows)
    got = spelling_rows(spelling.spelling_groups(documents(spark, rows)))
    assert got == want and {x[2] for x in got if x[0].startswith("abcdef")} == {chain[-1][0]}


def test_spelling_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "Wörter wörter WÖRTER " * 5), (3, "wörter÷ " * 9), (3, "wörter÷ " * 9), (4, "мир and short x" * 9), (5, "Ab×cdef " * 6 + "z" * 50_000)]
    assert spelling_rows(spelling.spelling_groups(documents(spark, rows))) == spelled(rows)
    assert spelling_rows(spelling.spelling_groups(documents(spark, rows).limit(0))) == []


def test_spelling_pairs_one_edit():
    short, long = (np.array([list(map(ord, x)) for x in words]) for words in (["abcabc"] * 5, ["abcabcd", "xabcabc", "abxcabc", "abcacbx", "bacabcd"]))
    assert spelling.one_more(short, long).tolist() == [True, True, True, False, False]


# --- repeated passages ------------------------------------------------------------------


def without_repeats(rows, length=bwtmerge.LENGTH):
    first = {}
    encoded = [(d, (t or "").encode()) for d, t in rows]
    for d, x in encoded:
        for i in range(len(x) - length + 1 if d is not None else 0):
            first[x[i : i + length]] = min(d, first.get(x[i : i + length], d))
    out = []
    for d, x in encoded:
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - length + 1 if d is not None else 0):
            gone[i : i + length] |= first[x[i : i + length]] < d
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(x), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(x, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


def repeat_rows(df):
    return sorted((tuple(r) for r in bwtmerge.digest(df).collect()), key=str)


def passage(seed, n):
    return "".join(np.random.default_rng(seed).choice(list("abcdé \n"), n))


def odd_documents():
    shared, line = passage(1, 300), passage(2, 60)
    rows = [(i, passage(100 + i, 40) + shared[i * 5 : i * 5 + 120] + passage(200 + i, 30) + line + passage(300 + i, 20)) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "a" * 500), (53, "a" * 130 + "b"), (54, "\0" * 70), (55, "\0" * 70), (None, shared), (None, None)]
    rows += [(60, shared), (60, shared), (61, shared[:49]), (62, shared[:50]), (-5, line * 3), (63, line * 40), (64, passage(9, 3000)), (65, passage(9, 3000))]
    return rows


def test_repeats_odd_rows(spark):
    rows = odd_documents()
    assert repeat_rows(bwtmerge.remove_repeats(documents(spark, rows))) == without_repeats(rows)
    assert repeat_rows(bwtmerge.remove_repeats(documents(spark, rows).limit(0))) == []


@pytest.mark.parametrize("length", [50, 16, 7])
def test_repeats_hot_anchors_small_packs(spark, monkeypatch, length):
    for name, value in {"HOT": 3, "PACK_BYTES": 700, "BUCKET_BYTES": 1500, "CHUNK": 64}.items():
        monkeypatch.setattr(bwtmerge, name, value)
    rows = odd_documents()
    assert repeat_rows(bwtmerge.remove_repeats(documents(spark, rows).repartition(3), length)) == without_repeats(rows, length)


def test_shard_transforms_merge_to_the_order_of_all_suffixes():
    shards = [[passage(i * 10 + j, 60 + 5 * j).encode() for j in range(4)] for i in range(3)]
    shards[2][0] = shards[0][1]
    symbols = [bwtmerge.transform(s) for s in shards]
    lf = [bwtmerge.last_to_first(x) for x in symbols]
    placed = [bwtmerge.places(x, y) for x, y in zip(symbols, lf)]
    base = np.cumsum([0] + [len(x) for x in symbols])
    suffix = [strings[s][len(strings[s]) - left :] for strings, (string, lefts, _) in zip(shards, placed) for s, left in zip(string, lefts)]
    rows = np.concatenate([b + np.flatnonzero(left <= size[string] - 50) for b, (string, left, size) in zip(base, placed)])
    row, block = bwtmerge.merge(np.concatenate(symbols), np.concatenate([x + b for x, b in zip(lf, base)]), rows, 50)
    heads = [suffix[x][:50] for x in row]
    assert len(heads) == sum(len(x) - 49 for s in shards for x in s) and heads == sorted(heads)
    assert [a == b for a, b in zip(heads, heads[1:])] == (block[1:] == block[:-1]).tolist()
    assert all([strings[s][len(strings[s]) - left - 1 : len(strings[s]) - left] if left < len(strings[s]) else b"" for s, left in zip(string, lefts)] == [bytes([c - 1]) if c else b"" for c in x] for strings, (string, lefts, _), x in zip(shards, placed, symbols))


# --- whitening --------------------------------------------------------------------------


def matrices():
    rng = np.random.default_rng(0)
    return {
        "plain": np.cov(rng.standard_normal((300, 40)).T),
        "equal values": np.diag([3.0, 3, 3, 2, 2, 1, 1e-20]),
        "low rank": np.cov((rng.standard_normal((300, 5)) @ rng.standard_normal((5, 40))).T),
        "close pairs": np.diag(np.r_[20:0:-1, np.arange(21)].astype(float) + 30) + np.diag(np.ones(40), 1) + np.diag(np.ones(40), -1),
        "one": np.array([[4.0]]),
        "graded": np.cov((rng.standard_normal((200, 30)) * np.logspace(0, -5, 30)).T),
    }


@pytest.mark.parametrize("name", matrices())
def test_leading_components(name):
    m = matrices()[name]
    values, x = whitening.leading_components(m, 32)
    want = np.linalg.eigvalsh(m)[::-1][: len(values)]
    assert len(values) == min(32, int((np.linalg.eigvalsh(m) > whitening.NOISE * np.trace(m)).sum()))
    assert np.abs(values - want).max() < 1e-13 * np.trace(m) and np.abs(x.T @ x - np.eye(len(values))).max() < 1e-12
    assert np.abs(m @ x - x * values).max() < 1e-13 * np.trace(m)


def test_sturm_count():
    d, e = np.array([1.0, 2, 3]), np.array([0.5, 0.0])
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    assert whitening.below(d, e, np.array([-9, *(values[:2] + 1e-9), 9])).tolist() == [0, 1, 2, 3]


def check_white(df, vectors):
    got = whitening.digest(df).toPandas()
    x = np.floor(64 * np.array([v for _, v in vectors])) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    cov = np.cov(x.T, bias=True).reshape(x.shape[1], -1)
    values, directions = np.linalg.eigh(cov)
    values, directions = values[::-1], directions[:, ::-1]
    k = min(32, int((values > whitening.NOISE * values.sum()).sum()))
    assert len(got) == n * k and (got.n == n).all() and (got.identity_error < 1e-9).all() and got.identity_error.nunique() == 1
    assert sorted(got[got.component == 1].deviation) == sorted(((n * x - total) ** 2).sum(axis=1).astype(int).tolist())
    for c in range(k):
        own = got[got.component == c + 1].sort_values(["vec_id", "whitened"])
        assert np.allclose(own.explained, values[c] / values.sum(), rtol=1e-9)
        want = (x - total / n) @ directions[:, c] / np.sqrt(values[c])
        ours = own.whitened.to_numpy()
        assert min(np.abs(np.sort(ours) - np.sort(sign * want)).max() for sign in (1, -1)) < 1e-6


def test_whitening_against_numpy(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    check_white(whitening.whiten(table), [(r["vec_id"], r["embedding"]) for r in table.collect()])


VECTORS = "vec_id long, embedding array<double>, n string, whitened int, component string"


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i if i % 9 else None, [*rng.standard_normal(4).tolist(), 7.0]) for i in range(60)]
    good += [good[1], good[1]]
    bad = [(90, None), (91, [1.0, None, 1.0, 1.0, 1.0]), (92, [float("nan")] * 5), (93, [float("inf")] * 5), (94, [])]
    frame = spark.createDataFrame([(a, b, "x", 1, "c") for a, b in good + bad], VECTORS)
    check_white(whitening.whiten(frame), good)
    assert whitening.whiten(frame.limit(0)).collect() == []
    assert whitening.whiten(frame.where("vec_id = 1").limit(1)).collect() == []  # nothing varies
    two = whitening.whiten(frame.unionByName(spark.createDataFrame([(200 + i, [float(i), 1.0], "x", 1, "c") for i in range(5)], VECTORS))).where("vec_id >= 200").collect()
    assert [len(r["whitened"]) for r in two] == [1] * 5 and {r["n"] for r in two} == {5}


def test_whitening_large_numbers(spark):
    rows = [(i, [1e12 * i, float(-i)], "x", 1, "c") for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    x = [[64 * 10**12 * i + 1_000_000, -64 * i + 1_000_000] for i in range(40)]
    total = [sum(c) for c in zip(*x)]
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == {i: sum((40 * a - s) ** 2 for a, s in zip(v, total)) for i, v in enumerate(x)}
    assert whitening.digest(whitening.whiten(spark.createDataFrame(rows, VECTORS))).where("deviation is null").count() > 0
    with pytest.raises(Exception, match="62 bits"):
        whitening.whiten(spark.createDataFrame([(1, [1e300], "x", 1, "c"), (2, [0.0], "x", 1, "c")], VECTORS)).collect()
