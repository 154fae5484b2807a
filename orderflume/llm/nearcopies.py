"""Near copies by Golay-code fuzzy hashing of wide fingerprints: five words, a similarity of 0.8 or more.

What is compared are sets of distinct shingles (five words, lower-cased A-Z); texts with equal sets are one class. At a
similarity of 0.8 a bit of a SimHash fingerprint differs with a probability of 0.15, too many for the exact keys of
``simhash``. The fingerprint here has 192 bits in eight segments of 24, of which 23 are decoded to Golay codewords. A key
is an anchor, the shingle that hashes least by the segment's own permutation, with the index of a codeword within 4 errors
of the segment: two texts at 0.8 share an anchor with that probability, and nearby segments share a codeword. An anchor
that many texts hold, from a passage they share, is so split by what the rest of the texts says. Cells that stay dense are
dealt over a grid of salts.

Within a cell, texts whose fingerprints differ in at most ``FAR`` bits are candidates, whose components go on as stars.
Their components hold every set once, and there all are compared exactly; again the components of true links go on so.
Components too large for one task are dealt over a grid as well. Nothing is written per pair.

Defined results: null text counts as empty; texts without words are one class; texts of one to four words have one
shingle; texts are read whole; rows without doc_id take no part; repeated rows change nothing; an empty table gives none;
extra columns are ignored. Sets are told apart by 64 bits of a hash, for classes as for shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflume.llm import golay
from orderflume.llm.common import arrow_map, stage, texts
from orderflume.llm.components import components, star

WORDS = 5
LEAST = 0.8
SEED = 42
SEGMENTS = 8
FAR = 56  # of 192 bits: at a similarity of 0.8, 29 differ with a deviation of 5; of unrelated texts, 96
DENSE = 20_000  # texts of an anchor above which its cells are salted
MOST_BYTES = 32_000_000  # shingles of a component above which it is salted
BLOCK = 1 << 15
STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers that scatters them."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Hashes of the distinct shingles of a whole text, rising."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    clean = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(clean, SEED)], dtype=np.uint64)
    starts = [0, *accumulate(len(w) + 1 for w in found)]
    cut = map(clean.__getitem__, map(slice, starts, (x - 1 for x in starts[words:])))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(SEED)), dtype=np.uint64, count=len(found) - words + 1))


def class_of(own: np.ndarray) -> int:
    """The name of a set, as a signed long."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(own.tobytes())).astype(np.int64))


def sketch(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprint as three numbers of 64 bits, and the anchor of each segment."""
    ones, least = np.zeros(192, dtype=np.int64), np.full(SEGMENTS, np.iinfo(np.uint64).max, dtype=np.uint64)
    turns = np.arange(1, 4 + SEGMENTS, dtype=np.uint64) * STEP
    for a in range(0, len(own), BLOCK):
        mixed = mix(own[a : a + BLOCK, None] + turns)
        bits = np.unpackbits(np.ascontiguousarray(mixed[:, :3]).view(np.uint8).reshape(-1, 24), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint32)
        least = np.minimum(least, mixed[:, 3:].min(axis=0))
    return np.packbits(2 * ones > len(own), bitorder="little").view(np.uint64), least


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, node (the class), the fingerprint f0 to f2 and the anchors, none for texts without words."""

    def step(batch: pa.RecordBatch) -> dict:
        node, parts, anchors = [], [], []
        for t in batch.column("text"):
            own = shingles(t.as_py())
            bits, least = sketch(own)
            node.append(class_of(own))
            parts.append(bits)
            anchors.append(least.view(np.int64) if len(own) else np.empty(0, np.int64))
        f = np.array(parts).view(np.int64)
        out = {"doc_id": batch.column("doc_id"), "node": np.array(node, dtype=np.int64)}
        return out | {f"f{i}": f[:, i].copy() for i in range(3)} | {"anchors": pa.array(anchors, pa.list_(pa.int64()))}

    rows = texts(docs).where("doc_id is not null").withColumn("text", F.col("text").cast("binary"))
    return arrow_map(rows, step, "doc_id long, node long, f0 long, f1 long, f2 long, anchors array<long>")


def bits_of(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(f"f{i}").to_numpy() for i in range(3)], axis=1)


def cell_keys(bits: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts, segments, 6) keys and which of them are there; ``anchors`` has a row for each text."""
    octets = np.ascontiguousarray(bits).view(np.uint8).reshape(-1, SEGMENTS, 3).astype(np.int64)
    parts = (octets[:, :, 0] | octets[:, :, 1] << 8 | octets[:, :, 2] << 16) & (1 << 23) - 1
    near = golay.nearby(parts.ravel()).reshape(-1, SEGMENTS, 6)
    places = np.arange(SEGMENTS)[None, :, None] << 12
    return mix(anchors.view(np.uint64)[:, :, None] + mix((near + places).astype(np.uint64) + STEP)), near >= 0


def cells(nodes: DataFrame, dense: int = DENSE) -> DataFrame:
    """(key, node, f0, f1, f2) for every cell that a text is in."""
    # more than ``dense`` texts each, so at most eight for every ``dense`` texts of the table
    held = nodes.select(F.explode("anchors").alias("anchor")).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    heavy = sorted((r["anchor"], r["n"]) for r in held.where(F.col("n") > dense).collect())
    heavy_anchors = np.array([a for a, _ in heavy], dtype=np.int64)
    salts = np.array([-(-n // dense) for _, n in heavy], dtype=np.int64)

    def step(batch: pa.RecordBatch) -> dict:
        node, bits = batch.column("node").to_numpy(), bits_of(batch)
        anchors = batch.column("anchors").flatten().to_numpy().reshape(-1, SEGMENTS)
        keys, there = cell_keys(bits, anchors)
        owner, segment, _ = np.nonzero(there)
        keys = keys[there]
        if len(heavy_anchors):
            anchor = anchors[owner, segment]
            at = np.minimum(np.searchsorted(heavy_anchors, anchor), len(heavy_anchors) - 1)
            times = np.where(heavy_anchors[at] == anchor, salts[at], 1)
            own = (mix(node[owner].view(np.uint64)) >> np.uint64(24)).astype(np.int64) % times
            other = np.concatenate([np.arange(n) for n in times.tolist()])
            own, keys, owner = np.repeat(own, times), np.repeat(keys, times), np.repeat(owner, times)
            keys = mix(keys + (np.minimum(own, other) << 32 | np.maximum(own, other)).astype(np.uint64))
        return {"key": keys.view(np.int64), "node": node[owner]} | {f"f{i}": bits[owner, i] for i in range(3)}

    worded = nodes.where(F.size("anchors") > 0).select("node", "f0", "f1", "f2", "anchors")
    return arrow_map(worded, step, "key long, node long, f0 long, f1 long, f2 long")


def forest(count: int, near: Callable[[int, np.ndarray], np.ndarray]) -> tuple[list[int], list[int]]:
    """The components of 0 to count - 1, an edge from the least of each to every other: near(p, others) tells which of the others p links with."""
    u, v, left = [], [], np.arange(count)
    while len(left):
        first, left = int(left[0]), left[1:]
        todo = [first]
        while todo and len(left):
            hit = near(todo.pop(), left)
            new = left[hit].tolist()
            left = left[~hit]
            u += [first] * len(new)
            v += new
            todo += new
    return u, v


def candidates(cell_rows: DataFrame, far: int = FAR) -> DataFrame:
    """What is joined in each cell, as edges (u, v) from the least node to the others."""

    def solve(keys: np.ndarray, nodes: np.ndarray, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.append(first, len(keys)))
        two = first[size == 2]
        near = np.bitwise_count(bits[two] ^ bits[two + 1]).sum(axis=1) <= far
        found = [(nodes[two][near], nodes[two + 1][near])]
        for a, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
            part = bits[a : a + n]
            u, v = forest(n, lambda p, left: np.bitwise_count(part[left] ^ part[p]).sum(axis=1) <= far)
            found.append((nodes[a : a + n][u], nodes[a : a + n][v]))
        u, v = (np.concatenate(z) for z in zip(*found))
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 3), np.uint64)
        for batch in batches:
            given = batch.column("key").to_numpy(), batch.column("node").to_numpy(), bits_of(batch).view(np.uint64)
            rest = tuple(np.concatenate(z) for z in zip(rest, given))
            if len(rest[0]):
                last = np.searchsorted(rest[0], rest[0][-1])  # the last cell may go on in the next batch
                if last:
                    yield from solve(*(z[:last] for z in rest))
                rest = tuple(z[last:] for z in rest)
        if len(rest[0]):
            yield from solve(*rest)

    return cell_rows.repartition("key").sortWithinPartitions("key", "node").mapInArrow(run, "u long, v long")


def contracted(edges: DataFrame) -> DataFrame:
    """Edges with the same components: each node with the least it has an edge to, and the others it has one to with that.

    A text is in up to 48 cells, a salt each, and has an edge from nearly all of them; the cells of a large group have few
    least nodes. So what goes round after round is about an edge a text, however many cells it is in.
    """
    apart = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    return star(stage(apart, "joined"), small=True)


def similar(sets: list[np.ndarray], least: float = LEAST) -> tuple[list[int], list[int]]:
    """Stars over the components of sets, none empty, that link if their Jaccard similarity is at least ``least``."""
    size = np.array([len(s) for s in sets])
    words, ids = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum(size)])
    mark = np.zeros(len(words), dtype=bool)
    held = {"which": np.arange(len(sets)), "ids": ids}  # the sets still looked at, shrunk as they are linked

    def near(p: int, left: np.ndarray) -> np.ndarray:
        if 2 * len(left) < len(held["which"]):
            held["which"], held["ids"] = left, np.concatenate([ids[bounds[x] : bounds[x + 1]] for x in left.tolist()])
        own = ids[bounds[p] : bounds[p + 1]]
        mark[own] = True
        starts = np.concatenate([[0], np.cumsum(size[held["which"]])[:-1]])
        both = np.add.reduceat(mark[held["ids"]], starts, dtype=np.int64)[np.searchsorted(held["which"], left)]
        mark[own] = False
        return both >= least * (size[left] + size[p] - both) - 1e-9

    return forest(len(sets), near)


def exact_links(grouped: DataFrame, most: int = MOST_BYTES) -> DataFrame:
    """Edges (u, v) that join what is similar within each root; ``grouped`` (root, node, own) is a written table."""
    bytes_of = grouped.groupBy("root").agg(F.sum(F.octet_length("own")).alias("n")).where(F.col("n") > most)
    heavy = {r["root"]: -(-r["n"] // most) for r in bytes_of.collect()}  # one at most for every ``most`` bytes
    rows = grouped.select(F.col("root").alias("a"), F.lit(0).alias("b"), F.lit(0).alias("c"), "node", "own")
    if heavy:
        spark = grouped.sparkSession
        times = F.broadcast(spark.createDataFrame([(k, int(n)) for k, n in heavy.items()], "root long, times int"))
        salted = grouped.join(times, "root", "left").withColumn("times", F.coalesce("times", F.lit(1)))
        salted = salted.withColumn("salt", F.pmod(F.xxhash64("node"), F.col("times")).cast("int"))
        salted = salted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
        rows = salted.select(F.col("root").alias("a"), F.least("salt", "other").alias("b"), F.greatest("salt", "other").alias("c"), "node", "own")

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("node").sort_values("node")
        nodes = group["node"].to_numpy()
        u, v = similar([np.frombuffer(x, np.uint64) for x in group["own"]])
        return pd.DataFrame({"u": nodes[u], "v": nodes[v]})

    return rows.groupBy("a", "b", "c").applyInPandas(solve, "u long, v long")


def near_copies(docs: DataFrame, dense: int = DENSE, most: int = MOST_BYTES) -> DataFrame:
    """node (a class of equal sets), least (its least doc_id) and root, which names the component of the class."""
    rows = stage(sketches(docs), "sketches")
    kept = [F.first(c).alias(c) for c in ("f0", "f1", "f2", "anchors")]  # the same in all of a class
    nodes = stage(rows.groupBy("node").agg(F.min("doc_id").alias("least"), *kept), "classes")
    maybe = components(contracted(candidates(cells(nodes, dense))))
    chosen = nodes.join(maybe, "node").select("node", "root", F.col("least").alias("doc_id"))
    given = texts(docs).join(chosen, "doc_id").select("node", "root", F.col("text").cast("binary").alias("text"))

    def step(batch: pa.RecordBatch) -> dict:
        own = [shingles(t.as_py()) for t in batch.column("text")]
        same = [n == class_of(s) for n, s in zip(batch.column("node").to_pylist(), own)]  # a doc_id may have several texts
        out = {c: batch.column(c).filter(pa.array(same, pa.bool_())) for c in ("root", "node")}
        return out | {"own": pa.array([s.tobytes() for s, x in zip(own, same) if x], pa.binary())}

    sets = stage(arrow_map(given, step, "root long, node long, own binary"), "sets")
    found = components(exact_links(sets, most))
    return nodes.select("node", "least").join(found, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
