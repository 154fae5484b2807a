"""Packing documents into fixed-length sequences as a cutting-stock problem.

Each document's ids (its tokens and an end id) are cut into pieces of ``LENGTH`` and a remainder. Sequences are filled in
units of ``GRID`` tokens. A piece alone is charged whole units, which would waste much on short ones, so pieces of one
exact length up to ``SHORT`` go in bundles that fill their units as nearly as can be (16 pieces of 5 tokens are 5 units);
the few that make no whole bundle go alone. The histogram of lengths, exact up to ``SHORT`` and in units above, is of
bounded size and all that the driver sees. There, column generation
solves the linear program that covers the histogram with patterns (how many pieces of each class share a sequence): the
basis gives a price per class, a knapsack dynamic program finds the pattern worth most at these prices, and it enters the
basis until the bound shows that the rest is below ``GAP`` (or for 3000 rounds: any basis is a valid cover). Patterns are
rounded down; the pieces left over, a few per class, are packed first-fit decreasing into patterns used once. Pieces are
ranked within their class, and a pattern's share of a class is a range of ranks, so each piece finds its sequence by
binary search in a small table.

Ranks come from (class, salt) counts and a window within each, so that one very frequent length is spread over
``SALTS`` groups, with or without doc_ids; only rows that are equal throughout share a place in the order. A sequence's pieces are at most LENGTH, and offsets are a running sum over them.

Defined results: null text is empty (its document is the end id alone); very long texts give as many pieces as needed;
repeated rows are packed as often as they come; null doc_ids are packed too; an empty table gives none; extra columns are
ignored.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflume.llm.common import arrow_map, in_steps, stage, texts

LENGTH = 4096
END_ID = 2
GRID = 16
SHORT = 512  # tokens up to which pieces of one length are bundled
BUNDLE = 1024  # tokens of a bundle at most
GAP = 1e-3
SALTS = 256
CACHED_WORDS = 350_000
STEP = 2_000_000


#: Ends of words that are split off before the rest is looked up.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class Coder:
    """A tokenizer and the packed ids of words it has seen, at most ``CACHED_WORDS`` of them; one per Python worker."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.closes[i] = token.endswith("</w>")

    def encode(self, new: list[str]) -> dict[str, bytes]:
        """Packed ids of distinct words."""
        letters = [w for w in new if w.isalpha() and w.lower().isalpha()]  # one run of letters is one unit, whose last token closes it
        groups = [" ".join(letters[i : i + 200]) for i in range(0, len(letters), 200)]
        got = [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(groups, add_special_tokens=False)]
        flat = np.concatenate(got) if got else np.empty(0, "<u4")
        ends = ((np.flatnonzero(self.closes[flat]) + 1) * 4).tolist()
        made = {}
        if len(ends) == len(letters):
            data = flat.tobytes()
            made = {w: data[a:b] for w, a, b in zip(letters, [0, *ends], ends)}
        others = [w for w in new if w not in made]  # with letters that a change of case takes apart, all of them
        for w, e in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False)):
            made[w] = np.array(e.ids, dtype="<u4").tobytes()
        return made

    def words(self, new: set[str]) -> dict[str, bytes]:
        """Packed ids of words that are not known: of letters and the marks after them, each known or encoded."""
        parts = {}
        for w in new:
            core = w.rstrip(MARKS)
            if core.isalpha() and core.lower().isalpha():
                parts[w] = (core.lower() if core.isascii() else core, w[len(core) :])
            else:
                parts[w] = (w, "")
        made = self.encode(list({x for pair in parts.values() for x in pair} - self.known.keys()))
        if len(self.known) + len(made) <= CACHED_WORDS:
            self.known.update((w, b) for w, b in made.items() if len(w) <= 64)

        def of(x: str) -> bytes:
            got = made.get(x)
            return self.known[x] if got is None else got

        whole = {w: of(core) + of(marks) for w, (core, marks) in parts.items()}
        if len(self.known) + len(whole) <= CACHED_WORDS:
            self.known.update((w, b) for w, b in whole.items() if len(w) <= 64)
        return whole


@functools.cache
def coder(path: str) -> Coder:
    return Coder(path)


def token_bytes(strings: list[str], path: str) -> Iterator[bytes]:
    """The ids of each text and the end id, as little-endian unsigned 32-bit numbers.

    The tokenizer ignores case, never joins across white space or from letters to marks, and drops white space, so each
    distinct run is tokenized once.
    """
    own = coder(path)
    for lo, hi in in_steps(strings, STEP):
        found, missing, new = [], [], set()
        for s in strings[lo:hi]:
            words = s.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            ids = list(map(own.known.get, words))
            gaps = [(i, words[i]) for i, b in enumerate(ids) if b is None] if None in ids else ()
            new.update(w for _, w in gaps)
            found.append(ids)
            missing.append(gaps)
        made = own.words(new) if new else {}
        for ids, gaps in zip(found, missing):
            for i, w in gaps:
                ids[i] = made[w]
            yield b"".join(ids) + END_ID.to_bytes(4, "little")


def cut(docs: DataFrame, path: str, length: int = LENGTH, keep_ids: bool = False) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens and, if asked for, the ids themselves."""

    def step(batch: pa.RecordBatch) -> dict:
        owner, start, size, crc, total, ids = [], [], [], [], [], []
        for i, data in enumerate(token_bytes(batch.column("text").to_pylist(), path)):
            n = len(data) // 4
            for a in range(0, n, length):
                part = data[4 * a : 4 * (a + length)]
                owner.append(i)
                start.append(a)
                size.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                total.append(n)
                if keep_ids:
                    ids.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
        out = {"doc_id": batch.column("doc_id").take(pa.array(owner, pa.int64()))}
        out |= {k: pa.array(v, pa.int64()) for k, v in (("start", start), ("length", size), ("ids_crc32", crc), ("doc_tokens", total))}
        return out | ({"ids": pa.array(ids, pa.list_(pa.int32()))} if keep_ids else {})

    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids
    return arrow_map(texts(docs), step, kinds)


def best_pattern(price: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The pattern worth most: price[k] for each piece of size k + 1, any number of each, sizes at most ``room``."""
    value, pick = np.zeros(room + 1), np.zeros(room + 1, dtype=np.int64)
    for c in range(1, room + 1):
        worth = price[:c] + value[c - 1 :: -1][:c]
        k = int(worth.argmax())
        value[c], pick[c] = (worth[k], k + 1) if worth[k] > value[c - 1] else (value[c - 1], 0)
    pattern, c = np.zeros(len(price)), room
    while c > 0:
        if pick[c]:
            pattern[pick[c] - 1] += 1
            c -= pick[c]
        else:
            c -= 1
    return float(value[room]), pattern


def cover(need: np.ndarray, room: int, gap: float = GAP, most_rounds: int = 3_000) -> list[tuple[int, dict[int, int]]]:
    """(times, {size: pieces}) such that need[k] pieces of size k + 1 are used exactly, in few sequences."""
    sizes = np.flatnonzero(need) + 1
    if not len(sizes):
        return []
    patterns = np.diag((room // sizes).astype(float))  # one column each, rows by size
    inverse = np.diag(1 / np.diag(patterns))
    times = inverse @ need[sizes - 1]
    best, center = 0.0, np.zeros(len(sizes))  # best bound so far and its prices
    for turn in range(1, most_rounds):
        own = inverse.sum(axis=0)
        column = None
        for pull in (0.8, 0.0) if best else (0.0,):  # prices near the best ones first: fewer rounds
            price = np.full(room, -1.0)
            price[sizes - 1] = pull * center + (1 - pull) * own
            worth, full = best_pattern(price, room)
            # prices over the worth are feasible, so no packing is smaller than this
            bound = float(price[sizes - 1] @ need[sizes - 1]) / worth
            if bound > best:
                best, center = bound, price[sizes - 1] / worth
            if own @ full[sizes - 1] > 1 + 1e-9:
                column = full[sizes - 1]
                break
        if column is None or times.sum() <= best * (1 + gap):
            break
        change = (inverse * column).sum(axis=1)  # too small for threads
        rising = change > 1e-9
        ratio = np.where(rising, times / np.where(rising, change, 1), np.inf)
        out = int(ratio.argmin())
        patterns[:, out] = column
        if turn % 100:
            row = inverse[out] / change[out]
            inverse -= np.outer(change, row)
            inverse[out] = row
        else:
            inverse = np.linalg.inv(patterns)
        times = np.maximum(inverse @ need[sizes - 1], 0)
    whole = np.floor(times + 1e-6).astype(np.int64)
    left = need[sizes - 1].astype(np.int64) - (patterns @ whole).round().astype(np.int64)
    for p in np.flatnonzero(whole):  # rounding noise never covers more than there is
        while (left < 0).any() and whole[p] > 0 and (patterns[left < 0, p] > 0).any():
            whole[p] -= 1
            left += patterns[:, p].round().astype(np.int64)
    found = [(int(n), {int(sizes[k]): int(patterns[k, p]) for k in np.flatnonzero(patterns[:, p] > 0.5)}) for p, n in enumerate(whole) if n]
    bins: list[tuple[int, dict[int, int]]] = []
    for k in np.argsort(-sizes, kind="stable"):
        for _ in range(left[k]):
            size = int(sizes[k])
            at = next((i for i, (free, _) in enumerate(bins) if free >= size), None)
            if at is None:
                bins.append((room, {}))
                at = len(bins) - 1
            free, held = bins[at]
            held[size] = held.get(size, 0) + 1
            bins[at] = (free - size, held)
    return found + [(1, held) for _, held in bins]


def shares(patterns: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (class, first rank, pieces per sequence, first sequence), by class and first rank."""
    rows, used, sequence = [], {}, 0
    for times, held in patterns:
        for size, n in held.items():
            rows.append((size, used.get(size, 0), n, sequence))
            used[size] = used.get(size, 0) + times * n
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def bundles(length: int, grid: int = GRID, most: int = BUNDLE) -> int:
    """How many pieces of this length go together: the number whose units are filled best, the least such."""
    return min(range(1, max(1, min(grid, most // length)) + 1), key=lambda n: (-n * length % grid / (n * length), n))


def classes(short: int, grid: int, room: int) -> np.ndarray:
    """Rows (pieces of a bundle, its units, units of a piece alone) by class: lengths to ``short``, then units."""
    rows = [(1, 0, 0)]
    for n in range(1, short + 1):
        q = bundles(n, grid)
        rows.append((q, -(-q * n // grid), -(-n // grid)))
    rows += [(1, u, u) for u in range(-(-short // grid) + 1, room + 1)]
    return np.array(rows, dtype=np.int64)


def pack(pieces: DataFrame, length: int = LENGTH, grid: int = GRID) -> DataFrame:
    """The pieces with sequence_id and offset. ``pieces`` should be a written table: it is read twice."""
    room = length // grid
    short = min(SHORT, room * grid) // grid * grid
    by_class = classes(short, grid, room)
    units = F.ceil(F.col("length") / grid).cast("long") + (short - short // grid)
    row = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    salted = pieces.withColumn("kind", F.when(F.col("length") <= short, F.col("length")).otherwise(units))
    salted = salted.withColumn("salt", F.pmod(F.xxhash64(*row), F.lit(SALTS)))
    counts = salted.groupBy("kind", "salt").agg(F.count(F.lit(1)).alias("n")).collect()  # at most classes x SALTS rows
    table = np.zeros((len(by_class), SALTS), dtype=np.int64)
    for r in counts:
        table[r["kind"], r["salt"]] = r["n"]
    first = np.cumsum(table, axis=1) - table
    together, wide, alone = by_class.T
    whole, rest = np.divmod(table.sum(axis=1), together)
    # Numbers of the first bundle and of the first single piece of each class among all that take as many units.
    need, before_bundles, before_rest = np.zeros(room + 1, dtype=np.int64), np.zeros_like(whole), np.zeros_like(rest)
    for items, size, before in ((whole, wide, before_bundles), (rest, alone, before_rest)):
        for k in np.flatnonzero(items):
            before[k] = need[size[k]]
            need[size[k]] += items[k]
    share = shares(cover(need[1:].astype(float), room))
    starts = share[:, 0] << 44 | share[:, 1]
    columns = pieces.columns
    small = pieces.sparkSession.sparkContext.broadcast((first, starts, share))

    def place(batch: pa.RecordBatch) -> dict:
        first, starts, share = small.value
        k, s, n = (batch.column(c).to_numpy() for c in ("kind", "salt", "row"))
        rank = first[k, s] + n - 1
        left = rank - whole[k] * together[k]
        size = np.where(left < 0, wide[k], alone[k])
        item = np.where(left < 0, before_bundles[k] + rank // together[k], before_rest[k] + left)
        own = share[np.searchsorted(starts, size << 44 | item, side="right") - 1]
        kept = {f: batch.column(f) for f in columns}
        return kept | {"kind": k, "rank": rank, "sequence_id": own[:, 3] + (item - own[:, 1]) // own[:, 2]}

    ranked = salted.withColumn("row", F.row_number().over(Window.partitionBy("kind", "salt").orderBy(*row)).cast("long"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    placed = arrow_map(ranked, place, f"{fields}, kind long, rank long, sequence_id long")
    before = Window.partitionBy("sequence_id").orderBy(F.desc("kind"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("kind", "rank")


def pack_documents(docs: DataFrame, path: str, length: int = LENGTH, keep_ids: bool = False) -> DataFrame:
    """Cut, write, pack: one row per piece."""
    return pack(stage(cut(docs, path, length, keep_ids), "pieces"), length)
