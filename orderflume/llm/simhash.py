"""SimHash near-duplicates through Golay-code fuzzy hashing.

A fingerprint has 64 bits, in three segments of 22, 21 and 21. If two fingerprints differ in at most 4 bits, the two
segments that differ least together differ in at most 2, so that either each of the two differs in at most one bit or one
is equal. For the first case a segment is decoded to Golay codewords: c is the index of its nearest one, K the indices of
all within 4 errors, and the c of a segment is in the K of any segment one bit away. Each pair of segments gives the keys
(c, each of K) and (each of K, c), which meet if both segments are one bit apart at most. For the second case each whole
segment is a key. That is complete: every link meets in a cell. Within a cell all pairs are verified in numpy blocks, and
only a spanning forest of the links goes on, never the pairs. Cells that hold many fingerprints are dealt over a grid of
salts, each pair of salts being a cell of its own, so one dense region is spread over many tasks.

Only distinct fingerprints are compared, so copies cost nothing beyond the first aggregate.

Defined results: null text counts as empty; texts without words have fingerprint zero and link like any other; texts of
one to three words have one shingle; texts are read whole; repeated rows appear as often as given; a null doc_id is kept
and never names a component; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflume.llm import golay
from orderflume.llm.common import arrow_map, stage, texts, unused
from orderflume.llm.components import components
from orderflume.llm.nearcopies import class_of, near_copies, shingles

WORDS = 4
SEED = 42
MOST_BITS = 4
DENSE = 20_000  # fingerprints of a key above which its cell is salted
BLOCK = 2048
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, number of bits


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The 64-bit fingerprint of a whole text, unsigned."""
    found = text.lower().split()
    if not found:
        return 0
    clean = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(clean, SEED)
    starts = [0, *accumulate(len(w) + 1 for w in found)]
    cut = map(clean.__getitem__, map(slice, starts, (x - 1 for x in starts[words:])))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(SEED)), dtype=np.uint64, count=len(found) - words + 1)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    most = 2 * np.add.reduce(bits, axis=0, dtype=np.uint32) > len(hashes)
    return int(np.packbits(most, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and fp, the fingerprint's bits as a signed long."""

    def step(batch: pa.RecordBatch) -> dict:
        found = np.array([fingerprint(t.as_py(), words) for t in batch.column("text")], dtype=np.uint64)
        return {"doc_id": batch.column("doc_id"), "fp": found.view(np.int64)}

    return arrow_map(texts(docs).withColumn("text", F.col("text").cast("binary")), step, "doc_id long, fp long")


def segments(fps: np.ndarray) -> list[np.ndarray]:
    bits = fps.view(np.uint64)
    return [(bits >> np.uint64(a) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]


def plain_keys(fps: np.ndarray) -> np.ndarray:
    """Six keys each: the nearest codewords of each two segments, and each whole segment."""
    parts = segments(fps)
    near = [golay.nearest(p) for p in parts]
    two = [np.int64(t) << 24 | near[i] << 12 | near[j] for t, (i, j) in enumerate(((0, 1), (0, 2), (1, 2)))]
    return np.stack([*two, *(np.int64(3 + i) << 24 | p for i, p in enumerate(parts))], axis=1)


def cell_keys(fps: np.ndarray) -> np.ndarray:
    """All keys of each fingerprint, -1 for none: what plain_keys has, and nearby codewords on either side."""
    near = [golay.nearby(p) for p in segments(fps)]
    more = []
    for t, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        for a, b in ((near[i][:, :1], near[j][:, 1:]), (near[i][:, 1:], near[j][:, :1])):
            more.append(np.where((a >= 0) & (b >= 0), np.int64(t) << 24 | a << 12 | b, -1))
    return np.concatenate([plain_keys(fps), *more], axis=1)


def cells(nodes: DataFrame, dense: int = DENSE) -> DataFrame:
    """(key, fp) for every cell that a fingerprint is in."""

    def plain(batch: pa.RecordBatch) -> dict:
        return {"key": plain_keys(batch.column("fp").to_numpy()).ravel()}

    # more than ``dense`` fingerprints each, so at most six for every ``dense`` fingerprints of the table
    heavy = arrow_map(nodes.select("fp"), plain, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > dense).collect()
    heavy_keys = np.array(sorted(r["key"] for r in heavy), dtype=np.int64)
    size = {r["key"]: r["n"] for r in heavy}
    salts = np.array([-(-size[k] // dense) for k in heavy_keys.tolist()], dtype=np.int64)

    def step(batch: pa.RecordBatch) -> dict:
        fps = batch.column("fp").to_numpy()
        keys = cell_keys(fps)
        of = np.repeat(fps, keys.shape[1])
        keys = keys.ravel()
        there = keys >= 0
        keys, of = keys[there], of[there]
        if len(heavy_keys):
            at = np.minimum(np.searchsorted(heavy_keys, keys), len(heavy_keys) - 1)
            times = np.where(heavy_keys[at] == keys, salts[at], 1)
            own = (of.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % times
            other = np.concatenate([np.arange(n) for n in times.tolist()])
            own, keys, of = np.repeat(own, times), np.repeat(keys, times), np.repeat(of, times)
            keys = keys | np.minimum(own, other) << 28 | np.maximum(own, other) << 44
        return {"key": keys, "fp": of}

    return arrow_map(nodes.select("fp"), step, "key long, fp long")


def forest(fps: np.ndarray, most_bits: int = MOST_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what links within one cell, one per fingerprint at most, by merging block after block."""
    fps = np.unique(fps)
    bits, label = fps.view(np.uint64), np.arange(len(fps))

    def root(x: int) -> int:
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    for a in range(0, len(fps), BLOCK):
        for b in range(a, len(fps), BLOCK):
            i, j = np.nonzero(np.bitwise_count(bits[a : a + BLOCK, None] ^ bits[None, b : b + BLOCK]) <= most_bits)
            i, j = i + a, j + b
            up = (i < j) & (label[i] != label[j])
            for x, y in zip(i[up].tolist(), j[up].tolist()):
                p, q = root(x), root(y)
                if p != q:
                    label[max(p, q)] = min(p, q)
            for x in range(a, min(a + BLOCK, len(fps))):
                label[x] = root(x)
    moved = np.array([root(x) for x in range(len(fps))], dtype=np.int64)
    out = moved != np.arange(len(fps))
    return fps[out], fps[moved[out]]


def links(cell_rows: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """A spanning forest of each cell's links, as edges (u, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_keys, rest = np.empty(0, np.int64), np.empty(0, np.int64)

        def solve(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            size = np.diff(np.append(first, len(keys)))
            found = []
            two = first[size == 2]  # most cells that matter hold two fingerprints
            x, y = fps[two], fps[two + 1]
            near = (np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)) <= most_bits) & (x != y)
            found.append((x[near], y[near]))
            for a, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
                found.append(forest(fps[a : a + n], most_bits))
            u, v = (np.concatenate(z) for z in zip(*found))
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            keys = np.concatenate([rest_keys, batch.column("key").to_numpy()])
            fps = np.concatenate([rest, batch.column("fp").to_numpy()])
            if len(keys):
                last = np.searchsorted(keys, keys[-1])  # the last cell may go on in the next batch
                if last:
                    yield from solve(keys[:last], fps[:last])
                rest_keys, rest = keys[last:], fps[last:]
        if len(rest_keys):
            yield from solve(rest_keys, rest)

    return cell_rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, words: int = WORDS, most_bits: int = MOST_BITS, dense: int = DENSE) -> DataFrame:
    """doc_id, fp, component_id, the least doc_id that links reach, and root, which names the component."""
    if most_bits > MOST_BITS:
        raise ValueError(f"the keys are complete up to {MOST_BITS} bits")
    rows = stage(fingerprints(docs, words), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    found = components(links(cells(nodes, dense), most_bits))
    rooted = nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = rooted.select("fp", "root").join(named, "root").select(F.col("fp").alias("node"), "root", "component_id")
    return rows.join(of_fp, rows["fp"] == of_fp["node"]).select("doc_id", "fp", "component_id", "root")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies (five words, 0.8): the one with the least doc_id, its row once.

    Different texts of one doc_id are told apart by their shingles. Documents without a doc_id stay, as nothing can
    name them.
    """
    of_root = near_copies(docs).groupBy("root").agg(F.min("least").alias("kept_id"), F.min_by("node", "least").alias("kept_node"))
    found = stage(of_root.drop("root"), "first")
    # Reserved names that the table does not use, and the schema as types: any column name comes through.
    own_node, kept_id, kept_node = (unused(name, docs.columns) for name in ("own_node", "kept_id", "kept_node"))
    found = found.toDF(kept_id, kept_node)
    columns = docs.columns
    own = docs.join(found.select(kept_id), docs["doc_id"].cast("long") == found[kept_id], "left_semi")

    def step(batch: pa.RecordBatch) -> dict:
        found = [class_of(shingles(t.as_py() or b"")) for t in batch.column("text").cast(pa.binary())]
        return {c: batch.column(c) for c in columns} | {own_node: np.array(found, dtype=np.int64)}

    fields = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema] + [T.StructField(own_node, T.LongType())])
    own = arrow_map(own, step, fields)
    kept = own.join(found, (own["doc_id"].cast("long") == found[kept_id]) & (own[own_node] == found[kept_node]), "left_semi")
    return kept.dropDuplicates(["doc_id", own_node]).drop(own_node).unionByName(docs.where("doc_id is null"))


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
