"""Near-duplicate vectors through a pivot-permutation index.

Vectors are compared with pivots by their direction from a centre, the mean of the candidates for pivots: where all of a
table crowds around one direction, directions from its middle still differ. Pivots are some of the vectors, chosen by a
hash, their number growing with the square root of the table, no two of them with a cosine above ``APART`` there. So a dense group gets few pivots, however many vectors it holds, and its members share
them; only their lists grow. A vector is described by its ``PREFIX`` nearest pivots, in order, and entered in the inverted list of each. Two vectors that have at
least ``SHARED`` pivots in common are compared; all pairs with a cosine of at least 0.95 among them link. A pair is
counted in the list of its least common pivot alone. Within a list, pairs are compared as matrix products and leave as
link counts per vector and a spanning forest, never as pairs; blocks of vectors that have one lesser pivot in common are
passed over, as they meet in its list. Long lists are dealt over a grid of salts, every two salts
being a group of their own.

Equal vectors are first put into one class with a count, so that groups of copies cost one vector.

The index may miss links, none below the threshold is made. Recall against brute force is tested (README).

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without vec_id, link
with nothing and are their own component; vectors of different length do not link; repeated rows link with each other;
an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflume.llm.common import arrow_map, spread, stage
from orderflume.llm.components import components
from orderflume.llm.topk import finite

THRESHOLD = 0.95
PREFIX = 10
SHARED = 1
PIVOTS_PER_ROOT = 2
MOST_PIVOTS = 4096
APART = 0.5
CANDIDATES = 4  # for each pivot wanted
LONG_LIST = 4096
BLOCK = 1024


def unit(column: pa.ListArray | pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # else squares may overflow
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def keep_apart(candidates: np.ndarray, want: int, apart: float = APART) -> np.ndarray:
    """The first ``want`` unit vectors of which none has a cosine above ``apart`` to one before it."""
    kept = candidates[:0]
    for a in range(0, len(candidates), BLOCK):
        rows = candidates[a : a + BLOCK]
        rows = rows[(rows @ kept.T <= apart).all(axis=1)]
        near = rows @ rows.T > apart
        fit = np.ones(len(rows), dtype=bool)
        for i in range(len(rows)):
            if fit[i]:
                fit[i + 1 :] &= ~near[i, i + 1 :]
        kept = np.concatenate([kept, rows[fit]])[:want]
        if len(kept) == want:
            break
    return kept


def seen_from(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Directions of unit vectors from ``centre``; none for one that lies there."""
    moved = rows - centre
    length = np.sqrt((moved * moved).sum(axis=1, keepdims=True))
    return np.divide(moved, length, out=np.zeros_like(moved), where=length > 1e-9)


def choose(candidates: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
    """Pivots and the centre that they are seen from."""
    centre = candidates.mean(axis=0)
    if len(candidates) < 2 * want or np.linalg.norm(centre) < 1e-9:  # a few rows say little about the middle
        centre = np.zeros(candidates.shape[1])
    return keep_apart(seen_from(candidates, centre), want), centre


def nearest(rows: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    return np.concatenate([np.argsort(-(rows[a : a + BLOCK] @ pivots.T), axis=1, kind="stable")[:, :prefix] for a in range(0, len(rows), BLOCK)]).astype(np.int32)


def entries(classes: DataFrame, pivots: np.ndarray, centre: np.ndarray, width: int, prefix: int) -> DataFrame:
    """(pivot, node, weight, near, embedding) for each of a vector's nearest pivots; near lists all of them."""
    shared = classes.sparkSession.sparkContext.broadcast((pivots, centre))
    fields = "pivot int, node long, weight long, near array<int>, embedding array<double>"

    def step(batch: pa.RecordBatch) -> dict:
        rows = unit(batch.column("embedding"), width)
        pivots, centre = shared.value
        near = nearest(seen_from(rows, centre), pivots, prefix)
        own = pa.array(np.repeat(np.arange(len(rows)), near.shape[1]))
        lists = pa.array(list(near), pa.list_(pa.int32()))
        return {"pivot": near.ravel()} | {k: (lists if k == "near" else batch.column(k)).take(own) for k in ("node", "weight", "near", "embedding")}

    return arrow_map(classes.select("node", "weight", "embedding"), step, fields)


def compare(width: int, threshold: float, shared: int):
    """What is done with one list, or with two salts of one: link counts and forest edges of its vectors."""

    def run(group: pa.Table) -> pa.Table:
        pivot, lo, hi = (group.column(c)[0].as_py() for c in ("pivot", "lo", "hi"))
        salt, node, weight = (group.column(c).to_numpy() for c in ("salt", "node", "weight"))
        near = group.column("near").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        first = near.min(axis=1)
        rows = unit(group.column("embedding"), width)
        links, root = np.zeros(len(node), dtype=np.int64), np.arange(len(node))
        order = np.argsort(first, kind="stable")
        left, right = order[salt[order] == lo], order[salt[order] == hi]

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for a in range(0, len(left), BLOCK):
            own = left[a : a + BLOCK]
            for b in range(a if lo == hi else 0, len(right), BLOCK):
                other = right[b : b + BLOCK]
                if shared == 1 and first[own[0]] == first[own[-1]] == first[other[0]] == first[other[-1]] < pivot:
                    continue
                i, j = np.nonzero(rows[own] @ rows[other].T >= threshold)
                if lo == hi:
                    i, j = i[a + i < b + j], j[a + i < b + j]
                i, j = own[i], other[j]
                for c in range(0, len(i), 100_000):
                    u, v = i[c : c + 100_000], j[c : c + 100_000]
                    same = near[u][:, :, None] == near[v][:, None, :]
                    common = same.any(axis=2)
                    least = np.where(common, near[u], np.iinfo(np.int32).max).min(axis=1)
                    fit = (common.sum(axis=1) >= shared) & (least == pivot)
                    u, v = u[fit], v[fit]
                    links += np.bincount(u, weights=weight[v], minlength=len(node)).astype(np.int64)
                    links += np.bincount(v, weights=weight[u], minlength=len(node)).astype(np.int64)
                    apart = root[u] != root[v]
                    for x, y in zip(u[apart].tolist(), v[apart].tolist()):
                        p, q = top(x), top(y)
                        if p != q:
                            root[max(p, q)] = min(p, q)
                    for x in np.unique(np.concatenate([u, v])).tolist():
                        root[x] = top(x)
        some = np.flatnonzero(links)
        return pa.table({"u": node[some], "v": node[root[some]], "links": links[some]})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, prefix: int = PREFIX, shared: int = SHARED, long_list: int = LONG_LIST) -> DataFrame:
    """vec_id, n_links and component_id of every row, and whether it is the one of its component that is kept."""
    spark = vectors.sparkSession
    usable = finite(vectors).where(F.exists("embedding", lambda x: x != 0)).withColumn("node", F.xxhash64("embedding"))
    rows = stage(usable, "vectors")
    classes = stage(rows.groupBy("node").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"), F.min("embedding").alias("embedding")), "classes")
    found = None
    for r in classes.groupBy(F.size("embedding").alias("width")).count().collect():  # vectors of one length as a rule
        width, n = r["width"], r["count"]
        own = classes.where(F.size("embedding") == width)
        want = min(MOST_PIVOTS, n, max(32, math.ceil(PIVOTS_PER_ROOT * math.sqrt(n))))
        chosen = own.where(spread(F.col("node")) < CANDIDATES * want / n).select("node", "embedding").toArrow().sort_by("node")
        pivots, centre = choose(unit(chosen.column("embedding"), width), want)
        lists = entries(own, pivots, centre, width, prefix)
        sizes = {x["pivot"]: x["count"] for x in lists.groupBy("pivot").count().collect()}  # one row per pivot
        salts = np.ones(len(pivots), dtype=np.int64)
        for pivot, size in sizes.items():
            salts[pivot] = -(-size // long_list)
        few = spark.sparkContext.broadcast(salts)

        def deal(batches: Iterator[pa.RecordBatch], few=few) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                times = few.value[batch.column("pivot").to_numpy()]
                own = (batch.column("node").to_numpy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % times
                take = np.repeat(np.arange(len(times)), times)
                other = np.concatenate([np.arange(t) for t in times.tolist()])
                salt = np.repeat(own, times)
                out = batch.take(pa.array(take))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(salt), pa.array(np.minimum(salt, other)), pa.array(np.maximum(salt, other))], [*out.schema.names, "salt", "lo", "hi"])

        dealt = lists.mapInArrow(deal, "pivot int, node long, weight long, near array<int>, embedding array<double>, salt long, lo long, hi long")
        made = dealt.groupBy("pivot", "lo", "hi").applyInArrow(compare(width, threshold, min(shared, len(pivots))), "u long, v long, links long")
        found = made if found is None else found.unionByName(made)
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    if found is None:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    found = stage(found, "links")
    counts = found.groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(found.select("u", "v"))
    rooted = classes.select("node", "least", "weight").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    full = rooted.join(named, "root").join(counts, "node", "left").select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    linked = rows.select("vec_id", "node").join(full, "node").select("vec_id", "n_links", "component_id")
    takes_part = F.coalesce(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rest = vectors.where(~takes_part).select(F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    return linked.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
