"""Language-model scores from a probabilistic suffix tree over words, beside those of a unigram model.

Tokens are words of a text in lower case (A to Z only), then one end. Symbols of the tree are the words of the training
part, the end, and one more for every word that was not learned, so its distributions and the unigram base are over the
same symbols. A context is up to ``DEPTH`` preceding words; the start of a text is one too.

Learning counts, over the whole training part, what follows each context, one level a pass. The root is add-one, as the
base. With n of a context's N occurrences followed by a word and u different words after it, the distribution is smoothed
by one from every count: P(word) = (n - 1 + u S) / N, or u S / N if the word never came next, S being what the context's
suffix gives. That sums to one. A context is kept if its distribution differs from its suffix's by at least ``GAIN`` nats
over its occurrences (a divergence test); one that is not kept has the distribution of its suffix. However many pass, all
are kept, in a table.

Words that came next once need not be stored, nor sent anywhere: N is the count of the context as a word of the level
above, and of the N those that are not among the words that came again are the words that came once. So a level is the
exact counts of what came more than once. Its candidates, whose context and suffix both came more than once by a filter of
fixed size, are dealt by key in packed columns, 16 bytes each, and counted bucket by bucket; the number of buckets grows
with the tokens, and no key is heavier than one row per batch.

So the log10 of P is the base's plus, for every suffix of the past that is kept, that of u / N and, where the word is
stored, that of (n - 1 + u S) / u S. The former belongs to the key of the context, the latter to that of context and word,
and the latter is the former one word later; every occurrence of a context has one word after it. Hence each position
looks up one key per level, and a text's score is the sum of what it finds: rows (key, value), for words with their base.

Keys are 64 bits wide. Words up to ``LONG`` bytes get a polynomial over random values of their bytes, longer ones XXH64;
a second hash tells whether two words of the table met, and then all starts anew with other random values, so that the
counts of words are exact. Two longer keys may meet, at 10^10 keys about three pairs.

Scoring: the ``HEAD`` most frequent words and the ``STATES`` most used other rows are broadcast, with a filter of fixed
size that tells which keys may be in the table. What may be and is not broadcast is dealt by key to the rest of the table,
packed, and comes back as sums per text. The filter only saves rows: the fuller it is, the more are sent in vain.

Defined results: null or empty text is one end token; a repeated row gives its result as often; a null doc_id is scored
and never learned from; without training rows N = V = 0, and all symbols are the one not learned, of probability 1; an
empty table gives none; texts of any length are read whole; extra columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflume.llm.common import cleaned, fold, in_steps, settle, texts
from orderflume.operators.lookup import lookup_join
from orderflume.sources.storage import remove_directory

DEPTH = 2
GAIN = 10.0
STATES = 2_000_000  # broadcast; the rest is joined
HEAD = 100_000
FILTER_BITS = 21  # 64-bit blocks of the filter, as a power of two
BUCKET = 20  # tokens that a bucket of counts stands for, as a power of two; four times as many in scoring
STEP = 4_000_000  # bytes of text that are worked on at once
CHUNK = 1 << 20  # bytes that are hashed at once
LONG = 64
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
START, END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # keys of what is no word


@functools.lru_cache(2)
def weights(seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random value per byte, the same for A and a; powers of an odd number, and of its inverse."""
    rng = np.random.default_rng(seed)
    letters = rng.integers(0, 1 << 64, 256, dtype=np.uint64)
    letters[65:91] = letters[97:123]
    base = int(rng.integers(0, 1 << 61, dtype=np.uint64)) * 8 + 3
    up, down = (np.multiply.accumulate(np.append(np.uint64(1), np.full(CHUNK + LONG, x, dtype=np.uint64))) for x in (base, pow(base, -1, 1 << 64)))
    return letters, up, down


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_keys(text: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Where words start in bytes that end with a space, and their keys."""
    letters, up, down = weights(seed)
    where, keys, lo = [], [], 0
    while lo < len(text):
        hi = min(lo + CHUNK, len(text))
        while not SPACE[text[hi - 1]]:  # to the end of the word
            ends = np.flatnonzero(SPACE[text[hi : hi + CHUNK]])
            hi = hi + int(ends[0]) + 1 if len(ends) else min(hi + CHUNK, len(text))
        part = text[lo:hi]
        space = np.append(True, SPACE[part])
        edges = np.flatnonzero(space[1:] != space[:-1])
        start, end = edges[::2], edges[1::2]
        near = part[: CHUNK + LONG]  # what ends after that is a long word
        sums = np.append(np.uint64(0), np.cumsum(letters[near] * up[: len(near)], dtype=np.uint64))
        key = scrambled((sums[np.minimum(end, len(near))] - sums[start]) * down[start])
        for i in np.flatnonzero(end - start > LONG):
            key[i] = xxhash.xxh64_intdigest(part[start[i] : end[i]].tobytes().lower(), seed)
        where.append(start + lo)
        keys.append(key)
        lo = hi
    return np.concatenate(where), np.concatenate(keys)


def tokens(strings: list[bytes], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all texts' tokens, one text after the other, each with its start before it; how many each text has so."""
    where, keys = word_keys(np.frombuffer(b"\n".join(strings) + b"\n", dtype=np.uint8), seed)
    ends = np.cumsum(np.fromiter(map(len, strings), dtype=np.int64, count=len(strings)) + 1)
    size = np.diff(np.searchsorted(where, ends), prepend=0) + 2
    own, last = np.empty(size.sum(), dtype=np.uint64), np.cumsum(size) - 1
    word = np.ones(len(own), dtype=bool)
    word[last] = word[last - size + 1] = False
    own[word], own[last], own[last - size + 1] = keys, END, START
    return own, size


def mixed(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Key of a context and the word after it, from those of the context and of its suffix and that word."""
    return scrambled(context * np.uint64(0xC2B2AE3D27D4EB4F) + suffix * np.uint64(0x9FB21C651E98DF25) + START)


def states(own: np.ndarray, size: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By context length, from 1: the positions that have one, and the keys of it with the token there, 0 at others.

    The key of the context is that of the level before, one position earlier; that of the suffix, at the same position.
    """
    at = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
    key = own
    for d in range(1, depth + 1):
        there = np.flatnonzero(at >= d)
        longer = np.zeros_like(own)
        longer[there] = mixed(key[there - 1], key[there])
        key = longer
        yield there, key


def word_counts(rows: DataFrame, seed: int) -> DataFrame:
    """(key, n, n_train, met) over all texts; the end and the start count as words; met: two words have that key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings, learn = batch.column("text").to_pylist(), batch.column("learn").to_numpy(zero_copy_only=False)
            for lo, hi in in_steps(strings, STEP):
                own, size = tokens(strings[lo:hi], seed)
                order = np.argsort(own)
                own, other = own[order], tokens(strings[lo:hi], seed + 1)[0][order]
                first = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (other[1:] != other[:-1])))
                n_train = np.add.reduceat(np.repeat(learn[lo:hi], size)[order].astype(np.int64), first)
                n = np.diff(np.append(first, len(own)))
                yield pa.RecordBatch.from_pydict({"key": own[first].view(np.int64), "other": other[first].view(np.int64), "n": n, "n_train": n_train})

    counts = rows.select("text", "learn").mapInArrow(run, "key long, other long, n long, n_train long")
    return counts.groupBy("key").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train"), (F.min("other") != F.max("other")).alias("met"))


def filter_of(keys: DataFrame) -> np.ndarray:
    """A filter of fixed size that holds all ``key``s, and others the more often the more there are."""
    mask = " | ".join(f"shiftleft(1L, cast(shiftright(key, {6 * i}) & 63L as int))" for i in range(4))
    blocks = keys.groupBy(F.shiftrightunsigned("key", 64 - FILTER_BITS).alias("block")).agg(F.expr(f"bit_or({mask})").alias("mask")).toArrow()
    table = np.zeros(1 << FILTER_BITS, dtype=np.uint64)
    table[blocks.column("block").to_numpy()] = blocks.column("mask").to_numpy().view(np.uint64)
    return table


def may_hold(table: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the filter's block of each key has all its bits."""
    mask = functools.reduce(np.bitwise_or, (np.uint64(1) << (key >> np.uint64(6 * i) & np.uint64(63)) for i in range(4)))
    return table[key >> np.uint64(64 - FILTER_BITS)] & mask == mask


def firsts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of one of each distinct key, and how often it comes."""
    order = np.argsort(keys)
    sorted_keys = keys[order]
    start = np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1])[: len(keys)])
    return order[start], np.diff(np.append(start, len(keys)))


def joined(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    """The numbers that the column's rows hold packed."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype)


def dealt(keys: np.ndarray, bits: int) -> tuple[list[int], list[slice]]:
    """The buckets that sorted keys are in, and where each of them lies."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    return bucket[first].tolist(), [slice(*x) for x in zip(first.tolist(), [*first[1:].tolist(), len(keys)])]


def followers(rows: DataFrame, d: int, shared: Broadcast, bits: int, seed: int) -> DataFrame:
    """(context, symbol, key, n): what follows contexts of d words more than once; symbol is the key of the suffix and the word.

    ``shared`` is a filter of what occurred more than once at the level above; what is not in it came once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = batch.column("text").to_pylist()
            for lo, hi in in_steps(strings, STEP):
                own, size = tokens(strings[lo:hi], seed)
                (_, above), (there, key) = [(None, own), *states(own, size, d)][-2:]
                may = may_hold(shared.value, above)
                there = there[may[there - 1] & may[there]]
                key = key[there]
                at, n = firsts(key)
                there = there[at]
                bucket, places = dealt(key[at], bits)
                packed = {"context": above[there - 1], "symbol": above[there], "n": n.astype(np.uint32)}
                yield pa.RecordBatch.from_pydict({"bucket": pa.array(bucket, pa.int32())} | {c: pa.array([x[p].tobytes() for p in places], pa.binary()) for c, x in packed.items()})

    def counted(table: pa.Table) -> pa.Table:
        context, symbol = (joined(table.column(c), np.uint64) for c in ("context", "symbol"))
        key = mixed(context, symbol)
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        n = np.add.reduceat(joined(table.column("n"), np.uint32).astype(np.int64)[order], first)
        first, n = first[n > 1], n[n > 1]
        of = order[first]
        return pa.table({"context": context[of].view(np.int64), "symbol": symbol[of].view(np.int64), "key": key[first].view(np.int64), "n": n})

    packed = rows.select("text").mapInArrow(run, "bucket int, context binary, symbol binary, n binary")
    return packed.groupBy("bucket").applyInArrow(counted, "context long, symbol long, key long, n long")


def level(counts: DataFrame, above: DataFrame, gain: float) -> DataFrame:
    """Of all that came next more than once: (context, key, n, total, kinds, kept, p_above, p).

    ``above`` has what came more than once (key, n) and its probability p; here p is that of the context, if it is kept.
    """
    suffixes = above.select(F.col("key").alias("symbol"), F.col("p").alias("p_above"))
    found = settle(lookup_join(counts, suffixes, "symbol").select("context", "key", "n", "p_above"), "found")
    drop(counts)
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    both = found.select("context", F.col("n").alias("again"), one.alias("different"), none.alias("total"))
    both = both.unionByName(above.select(F.col("key").alias("context"), none.alias("again"), none.alias("different"), F.col("n").alias("total")))
    totals = both.groupBy("context").agg(*(F.sum(c).alias(c) for c in ("again", "different", "total"))).where("different > 0")
    once = F.col("total") - F.col("again")
    rows = found.join(totals.select("context", "total", once.alias("once"), (once + F.col("different")).alias("kinds")), "context")
    share = (F.col("n") - 1 + F.col("kinds") * F.col("p_above")) / F.col("total")
    nats = F.sum(F.col("n") * F.ln(share / F.col("p_above"))).over(Window.partitionBy("context")) + F.col("once") * F.ln(F.col("kinds") / F.col("total"))
    rows = rows.withColumn("kept", nats >= gain)
    own = settle(rows.select("context", "key", "n", "total", "kinds", "kept", "p_above", F.when(F.col("kept"), share).otherwise(F.col("p_above")).alias("p")), "level")
    drop(found)
    return own


def drop(*tables: DataFrame) -> None:
    """Remove staged tables that nothing reads any more."""
    for table in tables:
        for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            remove_directory(table.sparkSession, path)


def fit(rows: DataFrame, words: DataFrame, symbols: int, bits: int, seed: int, depth: int = DEPTH, gain: float = GAIN) -> DataFrame:
    """(key, uses, value, base): what a word, a kept context, and a word after it, add to the log10 probability of a text.

    Base is null but for words; the start of a text has one of 0.
    """
    learned = words.where("n_train > 0")
    above = learned.where("n_train > 1").select("key", F.col("n_train").alias("n"), ((F.col("n_train") + 1) / symbols).alias("p"))
    base = F.when(F.col("key") == signed(START), 0.0).otherwise(F.log10(F.col("n_train") + 1.0))
    every, done = [learned.select("key", F.col("n_train").alias("uses"), F.lit(0.0).alias("value"), base.alias("base"))], [words]
    for d in range(1, depth + 1):
        shared = rows.sparkSession.sparkContext.broadcast(filter_of(above.select("key")))
        counts = settle(followers(rows, d, shared, bits, seed), "counts")
        shared.destroy()
        own = level(counts, above, gain)
        done.append(own)
        above = own.select("key", "n", "p")
        kept, none = own.where("kept"), F.lit(None).cast("double").alias("base")
        every.append(kept.groupBy(F.col("context").alias("key")).agg(F.max("total").alias("uses"), F.log10(F.max("kinds") / F.max("total")).alias("value")).withColumn("base", none))
        left = F.col("kinds") * F.col("p_above")
        every.append(kept.select("key", F.col("n").alias("uses"), F.log10((F.col("n") - 1 + left) / left).alias("value"), none))
    sums = (F.max("uses").alias("uses"), F.sum("value").alias("value"), F.max("base").alias("base"))
    values = settle(functools.reduce(DataFrame.unionByName, every).groupBy("key").agg(*sums), "values")
    drop(*done)
    return values


def signed(key: np.uint64) -> int:
    return int(key.astype(np.int64))


def most_used(values: DataFrame, most: int, *columns: str) -> tuple[DataFrame, tuple[np.ndarray, ...]]:
    """The rows that are to be joined; keys and other columns of the most used ones, at most ``most``."""
    order = F.floor(F.log2(F.col("uses").cast("double")) * 8).cast("int")
    bins = {r["bin"]: r["count"] for r in values.groupBy(order.alias("bin")).count().collect()}  # at most 8 x 63 rows
    least, held = max(bins, default=0) + 1, 0
    for b in sorted(bins, reverse=True):
        held += bins[b]
        if held > most:
            break
        least = b
    top = values.where(order >= least).select(*columns).toArrow()
    return values.where(order < least).select("key", "value", "base"), by_key(top, [*columns])


def by_key(table: pa.Table, columns: list[str]) -> tuple[np.ndarray, ...]:
    """The keys in order and the other columns, with null as 0; one key more than there are."""
    key, *others = (table.column(c) for c in columns)
    key = key.to_numpy().view(np.uint64)
    order = np.argsort(key)
    return np.append(key[order], np.uint64(2**64 - 1)), *(x.fill_null(0.0).to_numpy()[order] for x in others)


def places(table: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key is in the table, and whether it is there."""
    place = np.searchsorted(table[:-1], key)
    return place, (table[place] == key) & (place < len(table) - 1)


def score(docs: DataFrame, folds: int = 7, held: int = 2, head: int = HEAD, most: int = STATES, depth: int = DEPTH, gain: float = GAIN) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every whole text."""
    spark = docs.sparkSession
    of = fold("doc_id", folds)
    rows = texts(docs).select("doc_id", F.col("text").cast("binary").alias("text"), F.coalesce(of != held, F.lit(False)).alias("learn"), F.coalesce(of == held, F.lit(False)).alias("held_out"))
    with cleaned(spark):
        for seed in count(42, 2):
            words = settle(word_counts(rows, seed), "words")
            real = F.col("key") != signed(START)
            sums = words.agg(F.sum(F.when(real, F.col("n"))).alias("all"), F.sum(F.when(real, F.col("n_train"))).alias("N"), F.sum((real & (F.col("n_train") > 0)).cast("long")).alias("V"), F.max("met").alias("met")).first()
            if not sums["met"]:
                break
            drop(words)
        learned, symbols = sums["N"] or 0, (sums["N"] or 0) + (sums["V"] or 0) + 1
        bits = max(5, ((sums["all"] or 0) >> BUCKET).bit_length())
        values = fit(rows.where("learn"), words, symbols, bits, seed, depth, gain)
        more_words, top = most_used(values.where("base is not null"), head, "key", "value", "base")
        more_states, held = most_used(values.where("base is null"), most, "key", "value")
        rest = more_words.unionByName(more_states)
        shared = spark.sparkContext.broadcast((top, held, filter_of(values.select("key"))))
        del top, held
    bits -= 2
    fields = "bucket int, slot long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, more double"
    schema = pa.schema([("bucket", pa.int32()), ("slot", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("more", pa.float64())])
    asked = pa.schema([*schema, ("keys", pa.binary()), ("rows", pa.binary())])

    def filled(columns: dict, n: int, schema: pa.Schema) -> list[pa.Array]:
        return [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema]

    def part(batch: pa.RecordBatch, slot: int) -> Iterator[pa.RecordBatch]:
        words_held, held, filter_ = shared.value
        strings = batch.column("text").to_pylist()
        for lo, hi in in_steps(strings, STEP // 2):  # beside the tables that every worker holds
            own, size = tokens(strings[lo:hi], seed)
            n, of = hi - lo, np.repeat(np.arange(hi - lo, dtype=np.uint16 if hi - lo < 1 << 16 else np.uint32), size)
            place, hit = places(words_held[0], own)
            at = of[hit]
            sums = [np.bincount(at, w[place[hit]], n) for w in (words_held[2] > 0, words_held[2], words_held[1])]
            other = np.flatnonzero(~hit)
            other = other[may_hold(filter_, own[other])]
            key, key_of, there = [own[other]], [of[other]], np.ones(len(own), dtype=bool)
            for d, (position, state) in enumerate(states(own, size, depth), 1):
                if d == depth:  # no context itself: a word after one, which counts only if that does
                    position = position[there[position - 1]]
                position = position[may_hold(filter_, state[position])]
                place, hit = places(held[0], state[position])
                sums[2] += np.bincount(of[position[hit]], held[1][place[hit]], n)
                there[:] = False
                there[position] = True
                key.append(state[position[~hit]])
                key_of.append(of[position[~hit]])
            texts_of = {"bucket": np.full(n, -1 - TaskContext.get().partitionId()), "slot": np.arange(lo, hi) + slot, "n_tokens": size - 1, "n_known": sums[0].astype(np.int64), "base": sums[1], "more": sums[2]}
            whole = filled(texts_of, n, asked)
            whole[2:4] = batch.column("doc_id")[lo:hi], batch.column("held_out")[lo:hi]
            yield pa.RecordBatch.from_arrays(whole, schema=asked)
            key, key_of = np.concatenate(key), np.concatenate(key_of)
            order = np.argsort((key >> np.uint64(64 - bits)).astype(np.uint32), kind="stable")
            key, key_of = key[order], key_of[order]
            bucket, spans = dealt(key, bits)
            packed = {"keys": [key[p].tobytes() for p in spans], "rows": [key_of[p].tobytes() for p in spans]}
            yield pa.RecordBatch.from_arrays(filled({"bucket": bucket, "slot": [slot + lo] * len(bucket)} | packed, len(bucket), asked), schema=asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = TaskContext.get().partitionId() << 40  # names a row, nothing else
        for batch in batches:
            if batch.num_rows:
                yield from part(batch, slot)
                slot += batch.num_rows

    def answered(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or left.column("bucket")[0].as_py() < 0:
            return left.select(schema.names)
        table, value, base = by_key(right, ["key", "value", "base"])
        made = []
        for slot, keys, rows_of in zip(*(left.column(c).to_pylist() for c in ("slot", "keys", "rows"))):
            key = np.frombuffer(keys, dtype=np.uint64)
            of = np.frombuffer(rows_of, dtype=np.uint16 if len(rows_of) == 2 * len(key) else np.uint32)
            place, hit = places(table, key)
            at, of = np.unique(of[hit], return_inverse=True)
            known, logs, more = (np.bincount(of, w[place[hit]], len(at)) for w in (base > 0, base, value))
            made.append(pa.table(filled({"bucket": np.zeros(len(at), np.int32), "slot": at.astype(np.int64) + slot, "n_known": known.astype(np.int64), "base": logs, "more": more}, len(at), schema), schema=schema))
        return pa.concat_tables(made)

    asks = rows.drop("learn").mapInArrow(run, fields + ", keys binary, rows binary").groupBy("bucket")
    bucket = F.shiftrightunsigned("key", 64 - bits).cast("int").alias("bucket")
    parts = asks.cogroup(rest.select(bucket, "key", "value", "base").groupBy("bucket")).applyInArrow(answered, fields)
    sums = ("n_tokens", "n_known", "base", "more")
    each = parts.groupBy("slot").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), *(F.sum(c).alias(c) for c in sums))
    log = F.col("base") - F.col("n_tokens") * math.log10(symbols)
    scores = each.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(learned).cast("long").alias("train_tokens"),
        log.alias("base_score"),
        (log + F.col("more")).alias("score"),
    )
    scores = settle(scores, "scores")  # nothing else of this run is needed then
    shared.destroy()
    drop(values)
    return scores
