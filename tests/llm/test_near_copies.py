"""Near copies of the pipeline against all pairs compared in plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest

from orderflume.llm import nearcopies, simhash

SMALL = "/root/testdata/sf0.001"


def plain_shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(texts):
    """{doc_id: least doc_id reachable} by pairs of similarity 0.8 or more; no words equal no words."""
    sets, root = {i: plain_shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if min(len(a), len(b)) * 10 < max(len(a), len(b)) * 8:
                continue
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def edited(words, times, draw):
    words = list(words)
    for _ in range(times):
        at = draw.randrange(len(words))
        words[at : at + 1] = draw.choice(([f"new{draw.random()}"], [], [words[at], "more"]))
    return words


def planted(seed):
    """Texts with copies of several degrees, and a passage that half of them share."""
    draw = random.Random(seed)
    passage = [f"shared{i}" for i in range(40)]
    made = []
    for _ in range(40):
        base = [f"w{draw.randrange(3000)}" for _ in range(draw.choice((8, 60, 200, 700)))]
        base += passage if draw.random() < 0.5 else []
        made.append(base)
        made += [edited(base, int(len(base) * rate), draw) for rate in (0, 0.005, 0.01, 0.015, 0.02, 0.03)]
    draw.shuffle(made)
    return {i: " ".join(w) for i, w in enumerate(made)}


@pytest.mark.parametrize("dense, most", [(nearcopies.DENSE, nearcopies.MOST_BYTES), (3, 4000)])
def test_components_equal_all_pairs(spark, dense, most):
    texts = planted(1) | {1000: None, 1001: " \n", 1002: "one two", 1003: "ONE two", 1004: "one three"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = nearcopies.near_copies(docs, dense, most).collect()
    names, expected = {}, brute_components(texts)
    for r in found:
        names[r.root] = min(r.least, names.get(r.root, r.least))
    own = {i: names[next(r.root for r in found if r.node == nearcopies.class_of(nearcopies.shingles((t or "").encode())))] for i, t in texts.items()}
    assert len(set(expected.values())) > 40
    assert all(expected[a] == a for a in set(own.values()))  # nothing is linked that is not similar
    assert sum(own[i] == expected[i] for i in texts) >= 0.98 * len(texts)


def test_pairs_at_the_threshold_are_caught():
    draw, caught, pairs = random.Random(7), 0, 0
    while pairs < 400:
        base = [f"w{draw.randrange(3000)}" for _ in range(draw.choice((100, 400)))]
        one, two = (nearcopies.shingles(" ".join(w).encode()) for w in (base, edited(base, round(len(base) * 0.023), draw)))
        both = len(np.intersect1d(one, two))
        if not 0.8 <= both / (len(one) + len(two) - both) < 0.84:
            continue
        (f, a), (g, b) = nearcopies.sketch(one), nearcopies.sketch(two)
        (k, there), (l, here) = (nearcopies.cell_keys(x[None], y[None]) for x, y in ((f, a), (g, b)))
        caught += bool(set(k[there].tolist()) & set(l[here].tolist())) and int(np.bitwise_count(f ^ g).sum()) <= nearcopies.FAR
        pairs += 1
    print(caught / pairs)
    assert caught >= 0.9 * pairs


def test_kept_documents_of_a_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    expected = brute_components({r.doc_id: r.text for r in docs.collect()})
    assert {r.doc_id for r in simhash.keep_first(docs).collect()} == set(expected.values())
    assert simhash.keep_first(docs.limit(0)).collect() == []


def test_edges_of_a_chain_start_at_its_least():
    assert nearcopies.forest(4, lambda p, left: np.abs(left - p) == 1) == ([0, 0, 0], [1, 2, 3])


def test_a_group_in_many_cells_is_about_one_edge_a_text(spark):
    """A hundred texts that have an edge to each of three least ones, as from cells of one large group."""
    edges = spark.createDataFrame([(m, x) for m in range(3) for x in range(3, 103)] * 2, "u long, v long")
    found = {(r.u, r.v) for r in nearcopies.contracted(edges).collect()}
    assert found == {(x, 0) for x in range(1, 103)}
