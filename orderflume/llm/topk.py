"""Exact top-k inner products by a three-phase uniform threshold.

A vector's score is the sum of ``SLICES`` partial scores, one per slice of its components.

1. Every task makes local score lists: for each query and slice its k best partial scores; what is on a list is resolved,
   and the k best of a task go on. The k-th best over all tasks is a score that k candidates do reach.
2. That cutoff is broadcast. A total of at least the cutoff needs one slice with at least cutoff / SLICES, whatever the
   signs, so every task collects all entries with such a slice.
3. Their remaining slices are added and totals below the cutoff dropped. Of what is left, a task passes on its own k best
   by score and vec_id, so that a vector with very many copies leaves k rows a task; these are ranked.

Queries come in blocks of ``QUERY_BLOCK``, each broadcast to one pass over the candidates, which are never shuffled.

Defined results: vectors that are null, empty or hold null or non-finite components take no part, nor do rows without
vec_id; vectors meet only vectors of their own length; a query's vec_id names it, so no row with that vec_id is a
candidate of it, and a repeated query row counts once (the least vector); repeated candidate rows count as often as they
come; ties go to the smaller vec_id; with no query or no candidate there is no row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflume.llm.common import stage

SLICES = 4
QUERY_BLOCK = 8192
STEP_QUERIES = 256
STEP_ROWS = 4096
SCALE = 1024
NONE = np.iinfo(np.int64).min


def finite(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & usable)


def matrices(ids: np.ndarray, column: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length: ids and whole-number components, as doubles."""
    size = np.diff(column.offsets.to_numpy())
    flat = np.floor(column.flatten().to_numpy() * SCALE)
    start = column.offsets.to_numpy()[:-1] - column.offsets.to_numpy()[0]
    out = {}
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        out[n] = ids[at], flat[start[at][:, None] + np.arange(n)]
    return out


def partials(queries: np.ndarray, rows: np.ndarray, slices: int) -> np.ndarray:
    """slices x queries x rows: exact in doubles below 2^53, else as Python numbers."""
    cuts = np.array_split(np.arange(queries.shape[1]), slices)
    if np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * queries.shape[1] >= 2**53:
        whole = np.frompyfunc(int, 1, 1)
        queries, rows = whole(queries), whole(rows)
    return np.stack([queries[:, c] @ rows[:, c].T for c in cuts])


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest entries of each row, all if fewer."""
    if scores.shape[1] <= k:
        return np.tile(np.arange(scores.shape[1]), (len(scores), 1))
    return np.argpartition(-scores, k - 1, axis=1)[:, :k]


def steps(queries: dict, batch: pa.RecordBatch) -> Iterator[tuple]:
    """Blocks of queries and rows of one length: positions and ids of the queries, ids of the rows, partial scores."""
    for n, (ids, rows) in matrices(batch.column("vec_id").to_numpy(), batch.column("embedding")).items():
        if n in queries:
            at, own, values = queries[n]
            for a in range(0, len(own), STEP_QUERIES):
                for b in range(0, len(ids), STEP_ROWS):
                    part = partials(values[a : a + STEP_QUERIES], rows[b : b + STEP_ROWS], SLICES)
                    yield at[a : a + STEP_QUERIES], own[a : a + STEP_QUERIES], ids[b : b + STEP_ROWS], part


def block_top_k(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame | None:
    """The three phases for one block of queries, small enough to broadcast."""
    context = rows.sparkSession.sparkContext
    got = queries.toArrow().combine_chunks()
    if not got.num_rows:
        return None
    column = got.column("embedding").chunk(0)
    names = got.column("vec_id").to_numpy()
    made = matrices(np.arange(len(names)), column)
    shared = context.broadcast({n: (at, names[at], values) for n, (at, values) in made.items()})

    def local_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: dict[int, np.ndarray] = {}  # best totals so far, by position of the query
        for batch in batches:
            for at, own, ids, part in steps(shared.value, batch):
                listed = np.concatenate([best(p, k + 1) for p in part], axis=1)
                totals = np.take_along_axis(part, listed[None], axis=2).sum(axis=0)
                for i, q in enumerate(at.tolist()):
                    seen, first = np.unique(listed[i], return_index=True)
                    fresh = totals[i][first][ids[seen] != own[i]]
                    top[q] = np.sort(np.concatenate([top.get(q, fresh[:0]), fresh]))[-k:]
        if top:
            position = np.repeat(list(top), [len(x) for x in top.values()])
            yield pa.RecordBatch.from_arrays([pa.array(position), pa.array([int(x) for t in top.values() for x in t], pa.int64())], ["query", "score"])

    order = Window.partitionBy("query").orderBy(F.desc("score"))
    lists = rows.mapInArrow(local_lists, "query long, score long").withColumn("rank", F.row_number().over(order))
    cutoff = np.full(len(names), -np.inf)
    for r in lists.where(F.col("rank") <= k).groupBy("query").agg(F.min("score").alias("cutoff"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k).collect():
        cutoff[r["query"]] = r["cutoff"]
    safe = context.broadcast(cutoff)

    def sufficient(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = np.full((len(names), k), NONE)
        vec_id = np.full((len(names), k), np.iinfo(np.int64).max)
        held = np.zeros(len(names), dtype=np.int64)
        for batch in batches:
            for at, own, ids, part in steps(shared.value, batch):
                low = safe.value[at]
                i, j = np.nonzero((part.max(axis=0) * SLICES >= low[:, None]) & (ids[None] != own[:, None]))
                totals = part[:, i, j].sum(axis=0)
                kept = totals >= low[i]
                i, j, totals = i[kept], j[kept], totals[kept].astype(np.int64)
                if len(i):
                    q = np.unique(at[i])
                    old = np.repeat(q, held[q]), score[q][np.arange(k) < held[q][:, None]], vec_id[q][np.arange(k) < held[q][:, None]]
                    query, total, name = (np.concatenate(x) for x in zip(old, (at[i], totals, ids[j])))
                    order = np.lexsort((name, -total, query))
                    query, total, name = query[order], total[order], name[order]
                    place = np.arange(len(query)) - np.searchsorted(query, query)
                    best_k = place < k
                    query, total, name, place = query[best_k], total[best_k], name[best_k], place[best_k]
                    score[query, place], vec_id[query, place] = total, name
                    held[q] = np.bincount(query, minlength=len(names))[q]
        full = np.arange(k) < held[:, None]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(names, held)), pa.array(vec_id[full]), pa.array(score[full])], ["query_id", "vec_id", "score"])

    return rows.mapInArrow(sufficient, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: str, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score; ``is_query`` is an SQL condition on vec_id."""
    rows = stage(finite(vectors), "vectors")
    queries = stage(rows.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "queries")
    blocks = -(-queries.count() // QUERY_BLOCK)
    block = F.pmod(F.xxhash64("vec_id"), F.lit(max(blocks, 1)))
    found = [x for b in range(blocks) if (x := block_top_k(rows, queries.where(block == b), k)) is not None]
    if not found:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0)
    every = reduce(DataFrame.unionByName, found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
