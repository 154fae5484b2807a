"""Removal of passages that repeat across documents, by merging shard Burrows-Wheeler transforms.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller doc_id.

1. Texts are put into packs of a few megabytes (zstd). Of texts that are equal as a whole only those of the least doc_id go
   on; the rest is theirs from the first byte. Every window of ``length`` bytes has an anchor, the least hash
   among its ``ANCHOR``-byte strings, which depends on the window alone; neighbouring windows mostly share theirs, so a
   run of them is one short string. Equal windows have equal anchors: an anchor that occurs in one document only cannot
   belong to a repeat, and its windows are passed over. That loses nothing and leaves the transforms a small part.
2. The remaining runs are dealt by anchor into buckets, and by their content into ``SHARDS`` shards of each. Equal
   strings meet there and become one, with the least doc_id of each pack. A task sorts the suffixes of its shard once, by
   doubling ranks, and hands on the shard's multi-string Burrows-Wheeler transform.
3. Per bucket the shard transforms are merged by interleave refinement: beginning with one shard after the other, each
   step moves every row along its own shard's LF mapping and sorts stably by the symbols passed over, so that after
   steps of m symbols the interleave is right in that many symbols more, and rows part into blocks where they differ.
   After ``length`` symbols a block is an interval of suffixes with a common prefix of ``length`` bytes. No suffix is
   sorted again. Which string and offset a row stands for is read off by walking LF from the end rows.
4. The least doc_id of an interval goes back to the packs, which mark the covered bytes of documents above it.

Anchors that occur more than ``HOT`` times (frequent lines and passages) are dealt window by window, by the window's
content, so that no anchor fills a bucket; equal windows of a pack count once before the shuffle. Packs, buckets and
shards hold bounded amounts, and their number grows with the text.

Defined results: null text counts as empty; texts are read whole, as UTF-8 bytes; a row without doc_id neither loses
bytes nor makes others lose any; rows with the same doc_id (repeated rows too) do not act on each other and appear as
often as given; removed runs that touch are one span; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflume.llm.common import settle, texts

LENGTH = 50
ANCHOR = 22
PACK_BYTES = 8 << 20
BUCKET_BYTES = 1 << 20  # of text for each bucket
SHARDS = 4
HOT = 1 << 14
HOT_TEXTS = 5_000
RUN = 31  # windows in a string at most
CHUNK = 1 << 16
SYMBOL_BITS = 8  # UTF-8 never uses the byte 255, so byte + 1 fits and 0 ends a string
STEP = 5  # symbols sorted at a time
PACK_FIELDS = "size long, ids binary, missing binary, copies binary, lengths binary, body binary"
PART_FIELDS = "bucket long, shard int, pack long, sid int, lengths binary, strings binary, least binary"
BACK_FIELDS = "pack long, sids binary, lengths binary, strings binary, least binary"

_mixed = np.random.default_rng(20240501).integers(0, 2**64, 256, dtype=np.uint64)


def joined(column: pa.ChunkedArray, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype)


def packs(docs: DataFrame) -> DataFrame:
    """Documents as rows of several megabytes: ids, lengths and the compressed bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in slices(batch.column("size").to_numpy(), PACK_BYTES):
                part = batch.slice(start, end - start)
                ids = part.column("doc_id")
                body = b"".join(part.column("body").to_pylist())
                yield pa.RecordBatch.from_pydict(
                    {
                        "size": pa.array([len(body)], pa.int64()),
                        "ids": [ids.fill_null(0).to_numpy().tobytes()],
                        "missing": [ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()],
                        "copies": [part.column("copy").to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()],
                        "lengths": [part.column("size").to_numpy().astype(np.int64).tobytes()],
                        "body": [pa.compress(body, codec="zstd", asbytes=True)],
                    }
                )

    rows = texts(docs).select("doc_id", F.encode("text", "utf-8").alias("body")).withColumn("size", F.octet_length("body").cast("long"))
    rows = rows.withColumn("text_key", F.unhex(F.sha2("body", 256)))
    classes = rows.groupBy("text_key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
    classes = settle(classes.where("first < last").select("text_key", "first", "n"), "classes")
    # By counting, fewer than HOT_TEXTS texts can hold more than that share of the rows: their rows meet a broadcast and
    # go on by a key of their own; the rest is a plain shuffle join at every size.
    share = docs.count() / HOT_TEXTS
    hot = classes.where(F.col("n") > share).select("text_key", F.col("first").alias("hot_first"))
    rest = classes.where(F.col("n") <= share).select(F.col("text_key").alias("join_key"), "first")
    own_key = F.unhex(F.md5(F.coalesce(F.col("doc_id"), F.lit(0)).cast("string").cast("binary")))
    dealt_rows = rows.join(F.broadcast(hot), "text_key", "left").withColumn("join_key", F.when(F.col("hot_first").isNull(), F.col("text_key")).otherwise(own_key))
    first = F.coalesce("hot_first", "first")
    marked = dealt_rows.join(rest.hint("merge"), "join_key", "left").select("doc_id", "body", "size", F.coalesce(first < F.col("doc_id"), F.lit(False)).alias("copy"))
    return settle(marked.mapInArrow(run, PACK_FIELDS).withColumn("pack", F.monotonically_increasing_id()), "packs")


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes together, one row at least."""
    ends = np.cumsum(sizes)
    start, n = 0, len(sizes)
    while start < n:
        end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right")))
        yield start, end
        start = end


class Pack:
    """One pack's documents and its runs of windows."""

    def __init__(self, row: dict):
        self.pack = row["pack"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.missing = np.frombuffer(row["missing"], np.uint8).astype(bool)
        self.copies = np.frombuffer(row["copies"], np.uint8).astype(bool)  # of a text with a lesser doc_id
        self.lengths = np.frombuffer(row["lengths"], np.int64)
        self.body = pa.decompress(row["body"], decompressed_size=row["size"], codec="zstd", asbytes=True) if row["size"] else b""
        self.ends = np.cumsum(self.lengths)

    def runs(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, number of windows and anchor (48 bits, shifted up by 16) of each run."""
        found = [anchors(self, a, min(a + CHUNK, len(self.body) - length + 1), length) for a in range(0, max(len(self.body) - length + 1, 0), CHUNK)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return tuple(np.concatenate(x) for x in zip(*found))

    def doc(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, "right")


def anchors(pack: Pack, a: int, b: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs among the windows that start in [a, b)."""
    anchor = min(ANCHOR, length)
    h = _mixed[np.frombuffer(pack.body, np.uint8, b - a + length - 1, a)]
    have, power, rest, done = 1, 0x9E3779B97F4A7C15, None, 0
    left = anchor
    while left:  # the hash of 2^i bytes from those of 2^(i-1); the powers in anchor are put together
        if left & 1:
            rest = h if rest is None else rest[: len(h) - done] * np.uint64(power) + h[done:]
            done += have
        left >>= 1
        if left:
            h = h[:-have] * np.uint64(power) + h[have:]
            have, power = have * 2, power * power & 0xFFFFFFFFFFFFFFFF
    h = rest ^ (rest >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    span, wide = 1, length - anchor + 1
    while span * 2 <= wide:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    least = np.minimum(h[: b - a], h[wide - span : wide - span + b - a]) & np.uint64(0xFFFFFFFFFFFF0000)
    first, last = int(np.searchsorted(pack.ends, a, "right")), int(np.searchsorted(pack.ends, b, "left")) + 1
    ends = pack.ends[first:last]
    usable = np.zeros(b - a + 1, dtype=np.int8)  # difference array over windows inside one document that has an id
    lo = np.maximum(ends - pack.lengths[first:last], a)
    hi = np.minimum(ends - length + 1, b)
    fit = (lo < hi) & ~(pack.missing | pack.copies)[first:last]
    usable[lo[fit] - a] += 1
    usable[hi[fit] - a] -= 1
    inside = np.cumsum(usable[:-1]).astype(bool)
    cut = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (inside[1:] != inside[:-1]) | (usable[1:-1] != 0)]))
    size = np.diff(np.append(cut, b - a))
    cut, size = cut[inside[cut]], size[inside[cut]]
    pieces = -(-size // RUN)
    own = np.repeat(np.arange(len(cut)), pieces)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return cut[own] + nth * RUN + a, np.minimum(size[own] - nth * RUN, RUN), least[cut][own]


def dealt(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(16)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) % np.uint64(buckets)


def grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal keys together, and where each key starts in it."""
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    return order, np.flatnonzero(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])) if len(key) else np.zeros(0, np.int64)


def anchor_lists(made: DataFrame, length: int, buckets: int) -> DataFrame:
    """Per pack and bucket: its anchors, each with 15 bits of how often it comes and one if in several documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pack = Pack(row)
                start, _, anchor = pack.runs(length)
                if not len(start):
                    continue
                order, at = grouped(anchor)
                doc = pack.ids[pack.doc(start)][order]
                several = np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at)
                times = np.minimum(np.diff(np.append(at, len(order))), 0x7FFF)
                values = anchor[order][at] | (times | several.astype(np.int64) << 15).astype(np.uint64)
                bucket = dealt(values, buckets)
                order, at = grouped(bucket)
                values, bucket, end = values[order], bucket[order], np.append(at[1:], len(order))
                yield pa.RecordBatch.from_pydict({"bucket": pa.array(bucket[at].astype(np.int64)), "pack": pa.array(np.full(len(at), pack.pack)), "anchors": pa.array([values[i:j].tobytes() for i, j in zip(at, end)], pa.binary())})

    return made.mapInArrow(run, "bucket long, pack long, anchors binary")


def shared_anchors(group: pa.Table) -> pa.Table:
    """Back to each pack: those of its anchors that several documents have, marked if hot."""
    blobs = group.column("anchors").to_pylist()
    values = np.frombuffer(b"".join(blobs), np.uint64)
    own = np.repeat(np.arange(len(blobs)), [len(x) // 8 for x in blobs])
    order, at = grouped(values >> np.uint64(16))
    values = values[order]
    size = np.diff(np.append(at, len(values)))
    several = (size > 1) | np.maximum.reduceat((values & np.uint64(0x8000)) > 0, at)
    hot = np.add.reduceat((values & np.uint64(0x7FFF)).astype(np.int64), at) > HOT
    marked = (values >> np.uint64(16) << np.uint64(16)) | np.repeat(hot, size).astype(np.uint64)
    kept = np.repeat(several, size)
    marked, own = marked[kept], own[order][kept]
    order, at = grouped(own)
    marked, own, end = marked[order], own[order], np.append(at[1:], len(order))
    pack = group.column("pack").to_numpy()
    return pa.table({"pack": pa.array(pack[own[at]], pa.int64()), "anchors": pa.array([marked[i:j].tobytes() for i, j in zip(at, end)], pa.binary())})


def strings_of_pack(length: int, buckets: int):
    """Distinct strings of a pack that may repeat elsewhere, by bucket and shard; bucket -1: where each occurs."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {name.split()[0]: [] for name in PART_FIELDS.split(", ")}
        wanted = np.sort(joined(right.column("anchors"), np.uint64))
        for row in left.to_pylist():
            if not len(wanted):
                break
            pack = Pack(row)
            start, size, anchor = pack.runs(length)
            at = np.minimum(np.searchsorted(wanted, anchor), len(wanted) - 1)
            found = wanted[at] >> np.uint64(16) == anchor >> np.uint64(16)
            start, size, anchor, hot = start[found], size[found], anchor[found], (wanted[at] & np.uint64(1)).astype(bool)[found]
            times = np.where(hot, size, 1)  # hot anchors go window by window
            own = np.repeat(np.arange(len(start)), times)
            nth = np.arange(len(own)) - np.repeat(np.cumsum(times) - times, times)
            start, size, anchor, hot = start[own] + nth, np.where(hot, 1, size)[own], anchor[own], hot[own]
            body, seen = pack.body, {}
            sid = np.fromiter((seen.setdefault(body[i:j], len(seen)) for i, j in zip(start.tolist(), (start + size + length - 1).tolist())), np.int32, len(start))
            doc = pack.ids[pack.doc(start)]
            order, first = grouped(sid)
            least = np.minimum.reduceat(doc[order], first)
            several = (least < np.maximum.reduceat(doc[order], first)).astype(np.uint8)
            strings = list(seen)
            content = np.fromiter(map(zlib.crc32, strings), np.uint64, len(strings))
            anchor, hot = anchor[order[first]], hot[order[first]]
            bucket = np.where(hot, content // np.uint64(SHARDS) % np.uint64(buckets), dealt(anchor, buckets)).astype(np.int64)
            shard = (content % np.uint64(SHARDS)).astype(np.int64)
            order, first = grouped(bucket * SHARDS + shard)
            lengths = np.fromiter(map(len, strings), np.uint8, len(strings)) | several << 7
            new = np.empty(len(order), np.int32)  # strings are numbered as they leave
            new[order] = np.arange(len(order), dtype=np.int32)
            for i, j in zip(first.tolist(), np.append(first[1:], len(order)).tolist()):
                these = order[i:j]
                values = int(bucket[these[0]]), int(shard[these[0]]), pack.pack, i, lengths[these].tobytes(), b"".join([strings[x] for x in these.tolist()]), least[these].tobytes()
                for name, value in zip(out, values):
                    out[name].append(value)
            for name, value in zip(out, (-1, 0, pack.pack, 0, new[sid].tobytes(), start.tobytes(), None)):
                out[name].append(value)
        types = {"bucket": pa.int64(), "shard": pa.int32(), "pack": pa.int64(), "sid": pa.int32()}
        return pa.table({name: pa.array(values, types.get(name, pa.binary())) for name, values in out.items()})

    return run


def transform(strings: list[bytes]) -> np.ndarray:
    """Multi-string Burrows-Wheeler transform (0 ends a string); ties of equal suffixes go by string."""
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    ends = np.cumsum(lengths + 1) - 1
    n = int(ends[-1]) + 1
    filled = np.ones(n, bool)
    filled[ends] = False
    text = np.zeros(n + STEP, np.uint64)
    text[:n][filled] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint64) + np.uint64(1)
    left = (np.repeat(ends, lengths + 1) - np.arange(n)).astype(np.int32)  # symbols before the end
    key = np.zeros(n, np.uint64)
    for i in range(STEP):
        key = (key << np.uint64(SYMBOL_BITS)) | np.where(left > i, text[i : n + i], np.uint64(0))
    bits = np.uint64(n.bit_length())
    row, rank = np.arange(n, dtype=np.int32), np.zeros(n, np.int32)  # rank: rows that are less; a text of a shard is short
    have, most = 0, int(lengths.max()) + 1
    while True:
        if have:
            behind = np.where(left[row] >= have, rank[np.minimum(row + have, n - 1)] + 1, 0)
            key = (rank[row].astype(np.uint64) << bits) | behind.astype(np.uint64)
        order = np.argsort(key, kind="stable") if have == 0 and SYMBOL_BITS * STEP + int(bits) > 64 else stable_order(key, len(key).bit_length())
        key, row = key[order], row[order]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        was = rank[row]
        group = np.flatnonzero(np.concatenate([[True], was[1:] != was[:-1]]))
        at = np.flatnonzero(fresh)
        within = np.repeat(at.astype(np.int32), np.diff(np.append(at, len(row)))) - np.repeat(group.astype(np.int32), np.diff(np.append(group, len(row))))
        rank[row] = was + within
        have = have * 2 or STEP
        if have >= most:
            break
        open_rows = ~(fresh & np.append(fresh[1:], True))
        row = np.sort(row[open_rows])
        if not len(row):
            break
    before = np.concatenate([text[n - 1 : n], text[: n - 1]])
    before[ends - lengths] = 0
    order = np.sort((rank.astype(np.uint64) << bits) | np.arange(n, dtype=np.uint64)) & np.uint64((1 << int(bits)) - 1)
    return before[order.astype(np.int64)].astype(np.uint8)


def stable_order(key: np.ndarray, bits: int) -> np.ndarray:
    """Stable order of the keys; one sort of numbers if key and position fit into 64 bits."""
    if int(key.max(initial=0)).bit_length() + bits > 64:
        return np.argsort(key, kind="stable")
    return (np.sort((key << np.uint64(bits)) | np.arange(len(key), dtype=np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.int64)


def shard_transform(group: pa.Table) -> pa.Table:
    """One shard: equal strings of its packs become one; its transform, and who has each string."""
    flags, strings = joined(group.column("lengths"), np.uint8), b"".join(group.column("strings").to_pylist())
    lengths = (flags & 0x7F).astype(np.int64)
    distinct: dict[bytes, int] = {}
    own = np.fromiter((distinct.setdefault(strings[j - n : j], len(distinct)) for j, n in zip(np.cumsum(lengths).tolist(), lengths.tolist())), np.int32, len(lengths))
    sources = np.stack([group.column("pack").to_numpy(), group.column("sid").to_numpy(), [len(x) for x in group.column("lengths").to_pylist()]]).astype(np.int64)
    blobs = {"symbols": transform(list(distinct)), "own": own, "several": flags >> 7, "sources": sources, "least": joined(group.column("least"), np.int64)}
    return pa.table({"bucket": group.column("bucket").slice(0, 1), **{name: pa.array([x.tobytes()], pa.binary()) for name, x in blobs.items()}})


def last_to_first(symbols: np.ndarray) -> np.ndarray:
    lf = np.empty(len(symbols), np.int32)
    lf[np.argsort(symbols, kind="stable")] = np.arange(len(symbols), dtype=np.int32)
    return lf


def places(symbols: np.ndarray, lf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String of each row, symbols from the row to the string's end, and length by string: a walk back from the end rows."""
    string, left = np.zeros(len(symbols), np.int32), np.zeros(len(symbols), np.int32)
    row = np.arange(int((symbols == 0).sum()))
    own, lengths = np.arange(len(row), dtype=np.int32), np.zeros(len(row), np.int32)
    far = 0
    while len(row):
        string[row], left[row] = own, far
        on = symbols[row] != 0
        lengths[own[~on]] = far
        row, own, far = lf[row[on]], own[on], far + 1
    return string, left, lengths


def merge(symbols: np.ndarray, lf: np.ndarray, row: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleaves the shards of ``symbols`` (one after the other, as is ``lf``) as far as ``row`` leads.

    ``row``: in shard order, rows that have ``length`` symbols of their string before them. Each step moves them back by
    some symbols. Returns the rows that they end at, in merged order, and their blocks of equal first ``length`` symbols.
    """
    bits = len(row).bit_length()
    step = min(STEP, (64 - bits) // SYMBOL_BITS)
    block = np.zeros(len(row), np.int32)
    done, have = 0, 0
    while done < length:
        take = min(step, length - done)
        if have != take:  # the symbols before each row, the farthest first, and the row that they lead to
            passed, moved, have = symbols.astype(np.uint64), lf, 1
            while have < take:
                passed = passed | (symbols[moved].astype(np.uint64) << np.uint64(SYMBOL_BITS * have))
                moved = lf[moved]
                have += 1
        both = np.sort((passed[row] << np.uint64(bits)) | np.arange(len(row), dtype=np.uint64))
        order = (both & np.uint64((1 << bits) - 1)).astype(np.int64)
        both >>= np.uint64(bits)
        was = block[order]
        block = np.cumsum(np.concatenate([[0], (both[1:] != both[:-1]) | (was[1:] != was[:-1])]), dtype=np.int32)
        row = moved[row[order]]
        done += take
    return row, block


def merge_bucket(length: int):
    """The merge of a bucket's shards; back to each pack: (string, first and last window, least doc_id of the interval)."""

    def run(group: pa.Table) -> pa.Table:
        shards = [np.frombuffer(x, np.uint8) for x in group.column("symbols").to_pylist()]
        strings, lefts, spans, links, owners, packs_, sids, base, rows = [], [], [], [], [], [], [], 0, 0
        for symbols, own, source in zip(shards, group.column("own").to_pylist(), group.column("sources").to_pylist()):
            lf = last_to_first(symbols)
            string, left, lengths = places(symbols, lf)
            strings.append(string.astype(np.int64) + base)
            lefts.append(left)
            spans.append(lengths)
            links.append(lf + rows)
            owners.append(np.frombuffer(own, np.int32).astype(np.int64) + base)
            base, rows = base + len(lengths), rows + len(symbols)
            pack, sid, times = np.frombuffer(source, np.int64).reshape(3, -1)
            packs_.append(np.repeat(pack, times))
            sids.append(np.repeat(sid - np.cumsum(times) + times, times) + np.arange(times.sum()))
        string, left, lengths, own, pack, sid = (np.concatenate(x) for x in (strings, lefts, spans, owners, packs_, sids))
        least, several = joined(group.column("least"), np.int64), joined(group.column("several"), np.uint8).astype(bool)
        order, at = grouped(own)
        first = np.minimum.reduceat(least[order], at)  # by string; every string has someone
        row, block = merge(np.concatenate(shards), np.concatenate(links), np.flatnonzero(left <= lengths[string] - length), length)
        at = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        lowest = np.repeat(np.minimum.reduceat(first[string[row]], at), np.diff(np.append(at, len(row))))
        s, o = string[row], lengths[string[row]] - left[row]  # the window's string and offset
        order = stable_order((s * 1024 + o).astype(np.uint64), len(s).bit_length())
        s, o, low = s[order], o[order], lowest[order]
        cut = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (low[1:] != low[:-1])])) if len(s) else np.zeros(0, np.int64)
        run_string, run_from, run_low = s[cut], o[cut], low[cut]
        run_to = o[np.append(cut[1:], len(s)) - 1] if len(cut) else run_from
        begin, end = np.searchsorted(run_string, own), np.searchsorted(run_string, own, "right")
        times = end - begin
        member = np.repeat(np.arange(len(own)), times)
        which = np.arange(len(member)) - np.repeat(np.cumsum(times) - times, times) + begin[member]
        kept = (run_low[which] < least[member]) | several[member]
        member, which = member[kept], which[kept]
        order, at = grouped(pack[member])
        member, which = member[order], which[order]
        cells = [(pack[member[i]], *(x.tobytes() for x in (sid[member[i:j]].astype(np.int32), run_from[which[i:j]].astype(np.int32), run_to[which[i:j]].astype(np.int32), run_low[which[i:j]]))) for i, j in zip(at.tolist(), np.append(at[1:], len(member)).tolist())]
        names = ("pack", "sids", "lengths", "strings", "least")
        return pa.table({name: pa.array([c[i] for c in cells], pa.int64() if not i else pa.binary()) for i, name in enumerate(names)})

    return run


def cut_pack(length: int):
    """Marks the covered bytes of a pack: per document its removed spans and what is kept."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []
        for row in left.to_pylist():
            pack = Pack(row)
            n = len(pack.body)
            sid, low, high, least, start, at = (np.zeros(0, np.int64) for _ in range(6))
            parts = [x for x in right.to_pylist() if x["found"]]
            if parts:
                sid, low, high = (np.frombuffer(b"".join(x[c] for x in parts), np.int32) for c in ("sids", "lengths", "strings"))
                least = np.frombuffer(b"".join(x["least"] for x in parts), np.int64)
                for x in right.to_pylist():
                    if not x["found"]:
                        at, start = np.frombuffer(x["lengths"], np.int32), np.frombuffer(x["strings"], np.int64)
            order = np.argsort(sid, kind="stable")
            sid, low, high, least = sid[order], low[order], high[order], least[order]
            begin, end = np.searchsorted(sid, at), np.searchsorted(sid, at, "right")
            edge = np.zeros(n + 1, np.int32)
            for a in range(0, len(at), 1 << 18):
                times = (end - begin)[a : a + (1 << 18)]
                occ = np.repeat(np.arange(a, a + len(times)), times)
                which = np.arange(len(occ)) - np.repeat(np.cumsum(times) - times, times) + begin[occ]
                goes = least[which] < pack.ids[pack.doc(start[occ])]
                occ, which = occ[goes], which[goes]
                np.add.at(edge, start[occ] + low[which], 1)
                np.subtract.at(edge, start[occ] + high[which] + length, 1)
            whole = np.flatnonzero(pack.copies & (pack.lengths >= length))
            edge += np.bincount(pack.ends[whole] - pack.lengths[whole], minlength=n + 1).astype(np.int32)
            edge -= np.bincount(pack.ends[whole], minlength=n + 1).astype(np.int32)
            gone = np.cumsum(edge[:-1], dtype=np.int32) > 0
            offsets = np.concatenate([[0], pack.ends])
            first = np.zeros(n + 1, bool)
            first[offsets[:-1]] = True
            opens = np.flatnonzero(gone & (np.concatenate([[True], ~gone[:-1]]) | first[:-1])) if n else np.zeros(0, np.int64)
            closes = np.flatnonzero(gone & (np.concatenate([~gone[1:], [True]]) | first[1:])) + 1 if n else opens
            doc = pack.doc(opens)
            before = offsets[doc]
            lost = closes - opens
            kept = offsets - np.concatenate([[0], np.cumsum(lost)])[np.searchsorted(opens, offsets)]
            body = np.frombuffer(pack.body, np.uint8)[~gone].tobytes()
            spans = pa.StructArray.from_arrays([pa.array(opens - before), pa.array(closes - before)], ["start", "end"])
            tables.append(
                pa.table(
                    {
                        "doc_id": pa.array(pack.ids, mask=pack.missing),
                        "n_bytes": pa.array(pack.lengths),
                        "spans": pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(pack.ids) + 1)).astype(np.int32)), spans),
                        "kept": pa.array([body[i:j] for i, j in zip(kept[:-1].tolist(), kept[1:].tolist())], pa.binary()),
                    }
                )
            )
        return pa.concat_tables(tables) if tables else pa.table({"doc_id": pa.array([], pa.int64()), "n_bytes": pa.array([], pa.int64()), "spans": pa.array([], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "kept": pa.array([], pa.binary())})

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, removed spans (byte offsets, end exclusive) and kept bytes of every document."""
    made = packs(docs)
    total = made.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, math.ceil(total / BUCKET_BYTES))
    lists = anchor_lists(made, length, buckets)
    shared = lists.groupBy("bucket").applyInArrow(shared_anchors, "pack long, anchors binary")
    parts = settle(made.groupBy("pack").cogroup(shared.groupBy("pack")).applyInArrow(strings_of_pack(length, buckets), PART_FIELDS), "strings")
    shards = parts.where("bucket >= 0").groupBy("bucket", "shard").applyInArrow(shard_transform, "bucket long, symbols binary, own binary, several binary, sources binary, least binary")
    found = settle(shards.groupBy("bucket").applyInArrow(merge_bucket(length), BACK_FIELDS), "found")
    occurs = parts.where("bucket < 0").select("pack", F.lit(None).cast("binary").alias("sids"), "lengths", "strings", "least", F.lit(False).alias("found"))
    back = found.withColumn("found", F.lit(True)).unionByName(occurs)
    return made.groupBy("pack").cogroup(back.groupBy("pack")).applyInArrow(cut_pack(length), "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def digest(cut: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
