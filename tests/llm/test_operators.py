"""Small literal cases and brute force for every operator of the subpackage."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from orderflume.llm import golay, langid, neardup, packing, pieces, pii, quality, simhash, suffixtree, topk, toxicity
from orderflume.llm.common import fold

SMALL = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, label int, score double"
LONG = "wörd sentence number one, " * 4000
TEXTS = [None, "", " \n\t", "one", "one two three four", "one two three four", "One TWO three Four", "😀 mail a.b@c.de", LONG, "0000 1", "мир и труд"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long and repeated texts, a null id, columns whose names clash."""
    rows = [(i, t, "en", None, len(t or ""), "x", 1, 0.5) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[4], (None, "one two three four", None, None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


# --- personal data ----------------------------------------------------------------------

BASE = {
    "email": (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    "ip": (re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 13 <= len(re.sub("[ -]", "", m)) <= 19 and pii.luhn(re.sub("[ -]", "", m))),
    "phone": (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def base_spans(text):
    return [(k, m.start(), m.end()) for k, (pattern, good) in BASE.items() for m in pattern.finditer(text) if good(m[0])]


def test_base_spans_equal_the_patterns_on_random_text():
    rng = np.random.default_rng(1)
    alphabet = list("ab0123456789012345.@+- ()-%_é😀\n") + ["255.1.2.3", "a@b.co", "+1 (555) 010-2233", "4111 1111 1111 1111"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet, rng.integers(0, 60)))
        assert [s for s in pii.scan(text) if s[0] in pii.BASE_KINDS] == base_spans(text), text


def test_personal_data_edges(odd, none, docs):
    rows = pii.digest(pii.find_spans(odd)).collect()
    assert len(rows) == len(TEXTS) + 2 and sum(r.n_email for r in rows) == 1
    assert [r.base_sha256 for r in rows][:2] == [hashlib.sha256(b"").hexdigest()] * 2
    assert pii.digest(pii.find_spans(none)).collect() == []
    got = {r.doc_id: r.base_sha256 for r in pii.digest(pii.find_spans(docs)).collect()}
    for r in docs.collect():
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(r.text))
        assert got[r.doc_id] == hashlib.sha256(said.encode()).hexdigest()


def test_added_kinds_and_masking(odd):
    text = 'see https://x.org/a?b=1, account no: 12345678 and token = "abcdef1234567890".'
    assert [text[a:b] for k, a, b in pii.scan(text) if k in ("url", "account", "secret")] == ["https://x.org/a?b=1", "12345678", "abcdef1234567890"]
    assert pii.masked("to a@b.co now") == "to [EMAIL] now" and pii.masked(None) is None
    assert pii.redact(odd).columns == odd.columns


# --- language, toxicity, quality --------------------------------------------------------


def test_language_on_held_out_texts(docs):
    rows = langid.predict(docs, langid.fit(docs)).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    held = [r for r in rows if r.held_out and r.n_chars > 100]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.9


def test_language_edges(odd, none):
    rows = langid.predict(odd, langid.fit(odd)).collect()
    assert len(rows) == len(TEXTS) + 2
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {0, 1, 2, 9}
    assert langid.predict(none, langid.fit(none)).collect() == [] and langid.keep_known(odd).columns == odd.columns
    assert {r.lang_pred for r in langid.predict(odd, langid.fit(none)).collect()} == {"und"}


def test_regression_orders_thresholds():
    grade = np.repeat([0, 1, 2, 3], 50)
    weights, thresholds = toxicity.regress(np.arange(200), np.zeros(200, dtype=np.int64), grade.astype(float), grade, 1)
    assert weights[0] > 0 and (np.diff(thresholds) > 0).all()


def test_regression_ends_where_the_loss_is_least():
    rng = np.random.default_rng(11)
    value = rng.normal(size=(400, 3))
    latent = value @ [1.0, -0.7, 0.3] + rng.logistic(size=400)
    grade = (latent[:, None] > [0.0, 1.0, 2.0]).sum(axis=1)
    share = np.where(grade > 0, 0.5 / (grade > 0).mean(), 0.5 / (grade == 0).mean()) / len(grade)

    def loss(weights, thresholds):
        total = toxicity.RIDGE / 2 * sum(w * w for w in weights)
        for x, k, part in zip(value.tolist(), grade.tolist(), share.tolist()):
            score = sum(a * b for a, b in zip(weights, x))
            above = [1.0, *(1 / (1 + math.exp(t - score)) for t in thresholds), 0.0]
            total -= part * math.log(above[k] - above[k + 1])
        return total

    weights, thresholds = toxicity.regress(np.repeat(np.arange(400), 3), np.tile(np.arange(3), 400), value.ravel(), grade, 3)
    least = loss(weights, thresholds)
    for i in range(3):
        for move in (-0.1, 0.1):
            assert loss(weights + move * np.eye(3)[i], thresholds) > least
            assert loss(weights, thresholds + move * np.eye(3)[i]) > least


def test_severity_of_one_text_by_hand():
    model = toxicity.Model({"bad": 0, "good": 1, "^badn": 2}, np.array([1.5, -2.0, 0.7]), np.array([0.5, 1.0, 2.5]))
    text = "bad Bad good other badness"
    score = 1.5 * math.log(3) - 2.0 * math.log(2) + 0.7 * math.log(2)
    want = [1 / (1 + math.exp(t - score)) for t in model.thresholds]
    assert np.allclose(model.above([text, ""]), [want, [1 / (1 + math.exp(t)) for t in model.thresholds]])


def test_toxic_documents_are_caught(spark, odd, none):
    bad = ["you moron", "such an idiot", "pure trash", "moron and trash"]
    rows = [(i, f"{bad[i % 4]} said number {i}" if i % 3 == 0 else f"a quiet day number {i} said so") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.severity(docs, toxicity.fit(docs, labels)).collect()}
    assert [r.toxic for _, r in sorted(found.items())] == [i % 3 == 0 for i in range(300)]
    assert {r.doc_id for r in toxicity.keep_clean(docs, labels).collect()} == {i for i in range(300) if i % 3}
    model = toxicity.fit(docs, labels)
    assert toxicity.severity(odd, model).count() == len(TEXTS) + 2 and toxicity.severity(none, model).count() == 0
    assert {r.severity for r in toxicity.severity(odd, toxicity.fit(none, labels)).collect()} == {0.0}


def test_quality_gradient_and_held_out(spark, docs, labels, odd, none):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(big, marks)
    rows = quality.score(big, model).join(marks, "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.9
    assert quality.score(odd, model).count() == len(TEXTS) + 2 and quality.score(none, model).count() == 0
    assert {r.score for r in quality.score(odd, quality.fit(none, labels)).collect()} == {0.5}


def test_attention_equals_passage_by_passage():
    rng = np.random.default_rng(2)
    shapes = {"W": (quality.WIDTH, quality.HIDDEN), "b": quality.HIDDEN, "V": (quality.HIDDEN, quality.GATE), "U": (quality.HIDDEN, quality.GATE), "w": quality.GATE, "c": quality.HIDDEN, "d": 1}
    model = {k: rng.normal(0, 0.3, shape) for k, shape in shapes.items()}
    number = np.array([1, 4, 2])
    rows = rng.normal(size=(7, quality.WIDTH))
    got, weight = quality.forward(model, rows, number)[0], quality.forward(model, rows, number)[4]
    for bag, (first, many) in enumerate(zip([0, 1, 5], number)):
        hidden = [np.tanh(x @ model["W"] + model["b"]) for x in rows[first : first + many]]
        raw = [sum(math.tanh(h @ model["V"][:, k]) / (1 + math.exp(-(h @ model["U"][:, k]))) * model["w"][k] for k in range(quality.GATE)) for h in hidden]
        share = np.exp(raw) / np.exp(raw).sum()
        assert np.allclose(weight[first : first + many], share)
        assert math.isclose(got[bag], 1 / (1 + math.exp(-(sum(a * h for a, h in zip(share, hidden)) @ model["c"] + model["d"][0]))), rel_tol=1e-9)


# --- language model ---------------------------------------------------------------------


def tree_scores(texts, depth=2, gain=10.0):
    """Base and tree scores of (words, learned) by dictionaries; the sizes of what is kept; and the probabilities."""
    seen, after = Counter(), {}
    for words, learned in texts:
        if learned:
            seen.update(words)
            path = [None] * depth + words
            for i in range(depth, len(path)):
                for d in range(1, min(depth, i - depth + 1) + 1):
                    after.setdefault(tuple(path[i - d : i]), Counter())[path[i]] += 1
    symbols = sum(seen.values()) + len(seen) + 1
    kept = {}

    def p(context, word):
        if not context:
            return (seen[word] + 1) / symbols
        above = p(context[1:], word)
        if context not in kept:
            return above
        own = kept[context]
        return (max(own[word] - 1, 0) + len(own) * above) / sum(own.values())

    for d in range(1, depth + 1):
        passed = {}
        for context, own in after.items():
            if len(context) == d:
                total = sum(own.values())
                nats = 0.0
                for word, n in own.items():
                    above = p(context[1:], word)
                    nats += n * math.log((n - 1 + len(own) * above) / total / above)
                if nats >= gain:
                    passed[context] = own
        kept |= passed
    scores = []
    for words, _ in texts:
        path = [None] * depth + words
        scores.append((sum(math.log10(p((), w)) for w in words), sum(math.log10(p(tuple(path[max(i - depth, depth - 1) : i]), path[i])) for i in range(depth, len(path)))))
    return seen, scores, kept, p


@pytest.mark.parametrize(("head", "most", "depth"), [(100_000, 2_000_000, 2), (3, 0, 2), (100, 500, 3)])
def test_scores_equal_brute_force(docs, head, most, depth):
    rows = docs.collect()
    texts = [(r.text.encode().lower().split() + [b"\n"], zlib.crc32(str(r.doc_id).encode()) % 7 != 2) for r in rows]
    seen, scores, kept, _ = tree_scores(texts, depth)
    want = {r.doc_id: (w, learned, s) for r, (w, learned), s in zip(rows, texts, scores)}
    got = suffixtree.score(docs, head=head, most=most, depth=depth).collect()
    assert len(got) == len(rows) and {len(c) for c in kept} == set(range(1, depth + 1)) and len(kept) > 200
    for r in got:
        words, learned, (base, tree) = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(w in seen for w in words), sum(seen.values()))
        assert r.held_out is not learned
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, tree, rel_tol=1e-9)


def test_tree_is_a_distribution():
    rng = np.random.default_rng(3)
    words = [bytes([97 + x]) for x in rng.zipf(1.5, 4000) % 12]
    seen, _, kept, p = tree_scores([(words + words, True)])
    assert len(kept) > 5
    for context in [(), *kept]:  # the word that was not learned is one more symbol
        assert math.isclose(sum(p(context, w) for w in [*seen, b"unknown"]), 1, rel_tol=1e-9)


def test_order_of_words_matters_and_contexts_help_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    turned = F.when(F.col("doc_id") % 3 == 0, F.array_join(F.reverse(F.split("text", " ")), " ")).otherwise(F.col("text"))
    more = docs.where(fold("doc_id", 7) == 2).withColumn("text", turned)
    both = docs.where(fold("doc_id", 7) != 2).unionByName(more)
    straight = {r.doc_id: r for r in suffixtree.score(docs).where("held_out").collect()}
    mixed = {r.doc_id: r for r in suffixtree.score(both).where("held_out").collect()}
    worse = [mixed[i].score < r.score for i, r in straight.items() if i % 3 == 0 and r.n_tokens > 50]
    assert len(worse) > 10 and sum(worse) > 0.9 * len(worse)
    assert all(math.isclose(mixed[i].score, r.score, rel_tol=1e-9) for i, r in straight.items() if i % 3)
    assert sum(r.score for r in straight.values()) > sum(r.base_score for r in straight.values())


def test_score_edges(spark, odd, none):
    rows = suffixtree.score(odd).collect()
    assert len(rows) == len(TEXTS) + 2 and sorted(r.n_tokens for r in rows)[:3] == [1, 1, 1]
    texts = [(r.text or "").encode().lower().split() + [b"\n"] for r in odd.collect()]
    ids = [r.doc_id for r in odd.collect()]
    learned = [i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for i in ids]
    _, scores, _, _ = tree_scores(list(zip(texts, learned)))
    key = lambda x: (str(x[0]), round(x[1], 6), round(x[2], 6))
    assert sorted(key((r.doc_id, r.base_score, r.score)) for r in rows) == sorted(key((i, *s)) for i, s in zip(ids, scores))
    assert suffixtree.score(none).collect() == []
    alone = suffixtree.score(spark.createDataFrame([(None, "a b a b")], "doc_id long, text string")).first()
    assert (alone.train_tokens, alone.n_known, alone.base_score, alone.score) == (0, 0, 0.0, 0.0)


def test_word_keys_tell_words_apart():
    words = [b"a", b"A", b"ab", b"ba", "wörd".encode(), b"x" * 64, b"X" * 65, b"y" * 3_000_000, b"b"]
    text = b" \t" + b" ".join([*words, b"a" * 1_048_560, b"cd ef"]) + b"\r\n\x0b\x0c"
    found, size = suffixtree.tokens([text, b"", text.upper(), b" "], 42)
    split = [text.lower().split(), [], text.upper().lower().split(), []]
    assert size.tolist() == [len(s) + 2 for s in split]
    want = [w for s in split for w in ("start", *s, "end")]
    assert len(set(found.tolist())) == len(set(want)) == len(set(zip(found.tolist(), want)))


def test_tree_leaves_only_its_scores_staged(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    size = lambda at: sum(p.stat().st_size for p in (at.rglob("*.parquet") if at.is_dir() else [at]) if p.is_file())
    before = size(root)
    rows = suffixtree.score(spark.read.parquet(path)).count()
    assert rows == spark.read.parquet(path).count()
    assert size(root) - before < 0.1 * size(Path(path))


# --- pieces and packing -----------------------------------------------------------------


def test_pieces_equal_the_library():
    import sentencepiece

    library, codec = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.codec(PIECES)
    rng = np.random.default_rng(2)
    alphabet = list("abcdeinorst THE,.\n\t0é中😀") + ["   ", "ing", "tion"]
    strings = ["".join(rng.choice(alphabet, rng.integers(0, 50))) for _ in range(1500)]
    for s, packed, ids in zip(strings, codec.encode(strings), library.encode(strings)):
        assert np.frombuffer(packed, "<u4").tolist() == ids and codec.decode(packed) == s


def test_pieces_edges(odd, none):
    rows = pieces.round_trip(odd, PIECES).collect()
    assert len(rows) == len(TEXTS) + 2 and all(r.same for r in rows)
    decoded = {r.doc_id: r.text for r in pieces.decode(pieces.encode(odd, PIECES), PIECES).collect()}
    assert all(decoded[i] == (t or "") for i, t in enumerate(TEXTS))
    assert pieces.round_trip(none, PIECES).collect() == []


def test_words_give_the_tokenizer_s_ids():
    rng = np.random.default_rng(3)
    alphabet = list("abcABC'.,!* \n\r\t0123é中😀İΣ́\x1c ") + ["'s", "<|endoftext|>", "don't", "the"]
    strings = ["".join(rng.choice(alphabet, rng.integers(0, 50))) for _ in range(1500)]
    own = packing.coder(TOKENIZER).tokenizer
    for s, packed in zip(strings, packing.token_bytes(strings, TOKENIZER)):
        assert np.frombuffer(packed, "<u4").tolist() == [*own.encode(s, add_special_tokens=False).ids, 2], repr(s)


def test_cover_meets_the_need_exactly():
    need = np.random.default_rng(4).poisson(20, 64).astype(float)
    patterns = packing.cover(need, 64)
    used = np.zeros(64)
    for times, held in patterns:
        assert sum(k * n for k, n in held.items()) <= 64
        for k, n in held.items():
            used[k - 1] += times * n
    assert (used == need).all()
    assert sum(t for t, _ in patterns) <= 1.02 * (need * np.arange(1, 65)).sum() / 64 + 4
    assert packing.cover(np.zeros(64), 64) == []


@pytest.mark.parametrize("mean", [1, 5, 20, 80, 900])
def test_short_pieces_leave_little_padding(spark, mean):
    drawn = np.minimum(np.random.default_rng(mean).geometric(1 / mean, 2_000_000 // mean // 4), packing.LENGTH)
    rows = [(None if i % 3 else i, 0, n, i, n) for i, n in enumerate(drawn.tolist())]
    pieces = spark.createDataFrame(rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    found = packing.pack(pieces).toPandas()
    assert sorted(found.length) == sorted(drawn.tolist()) and sorted(found.ids_crc32) == list(range(len(rows)))
    for _, held in found.sort_values("offset").groupby("sequence_id"):
        assert held.length.sum() <= packing.LENGTH and held.offset.tolist() == [0, *held.length.cumsum().tolist()[:-1]]
    sequences = found.sequence_id.nunique()
    assert sorted(found.sequence_id.unique()) == list(range(sequences))
    padding = 1 - drawn.sum() / (sequences * packing.LENGTH)
    print(mean, sequences, padding)
    assert sequences <= -(-drawn.sum() // packing.LENGTH) * 1.02 + 2


def test_packing_keeps_every_id_once(docs, odd, none):
    rows = packing.pack_documents(docs, TOKENIZER, keep_ids=True).toPandas()
    own = packing.coder(TOKENIZER).tokenizer
    for r in docs.collect():
        ids = [*own.encode(r.text, add_special_tokens=False).ids, 2]
        part = rows[rows.doc_id == r.doc_id].sort_values("start")
        assert [i for x in part.ids for i in x] == ids and set(part.doc_tokens) == {len(ids)}
        assert [zlib.crc32(np.array(x, dtype="<u4").tobytes()) for x in part.ids] == part.ids_crc32.tolist()
    rows = rows.sort_values(["sequence_id", "offset"])
    assert (rows.groupby("sequence_id").length.cumsum() - rows.length == rows.offset).all()
    assert rows.groupby("sequence_id").length.sum().max() <= 4096
    assert {r.doc_id for r in packing.pack_documents(odd, TOKENIZER).collect()} == {None, *range(len(TEXTS))}
    assert packing.pack_documents(none, TOKENIZER).collect() == []


# --- fingerprints and vectors -----------------------------------------------------------


def test_golay_keys_meet_within_one_bit():
    words = np.random.default_rng(5).integers(0, 1 << 23, 5000)
    for bit in range(23):
        assert (golay.nearby(words) == golay.nearest(words ^ (1 << bit))[:, None]).any(axis=1).all()


def roots_of(n, pairs):
    root = list(range(n))
    for a, b in pairs:
        while root[a] != a:
            a = root[a]
        while root[b] != b:
            b = root[b]
        root[max(a, b)] = min(a, b)
    for i in range(n):
        while root[i] != root[root[i]]:
            root[i] = root[root[i]]
    return root


@pytest.mark.parametrize("dense", [20_000, 10])
def test_fingerprints_within_four_bits_link(spark, dense):
    rng = np.random.default_rng(6)
    centers = rng.integers(0, 2**63, 60, dtype=np.uint64)
    fps = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 9), replace=False)) for c in centers for _ in range(12)]
    fps = np.unique(np.array(fps, dtype=np.uint64))
    nodes = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    edges = simhash.components(simhash.links(simhash.cells(nodes, dense)))
    i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None]) <= 4)
    root = roots_of(len(fps), zip(i.tolist(), j.tolist()))
    groups = {}
    for r in edges.collect():
        groups.setdefault(r.root, set()).add(r.node)
    expected = {}
    for k, x in enumerate(root):
        expected.setdefault(x, set()).add(int(fps.view(np.int64)[k]))
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_fingerprint_is_a_majority_of_shingle_bits():
    text = "a b c d e f g".encode()
    words = text.split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(4)]
    assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 4)


def test_near_duplicate_documents(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    found = {r.doc_id: r.component_id for r in rows}
    assert len(rows) == len(TEXTS) + 2 and (found[0], found[1], found[2]) == (0, 0, 0)
    assert (found[4], found[5], found[6], found[None]) == (4, 4, 4, 4)
    assert simhash.near_duplicates(none).collect() == []
    kept = [r.doc_id for r in simhash.keep_first(odd).collect()]
    assert kept.count(4) == 1 and 5 not in kept and None in kept and simhash.keep_first(odd).columns == odd.columns


def test_different_texts_of_one_id_stay(spark):
    copy, other, lone = "one two three four five six", "red green blue black white grey", "north east south west up down"
    rows = [(1, copy), (5, copy), (5, other), (5, other), (5, lone), (7, lone), (9, other)]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, copy), (5, lone), (5, other)]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, label int")


BAD = [(900, None), (1000, []), (1001, [0.0, float("nan"), 1.0]), (1002, [1.0, None, 1.0]), (1003, [0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (1100, [1.0, 1.0])]


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=3), 1)]) for i in range(0, 700, 7)]
    got = topk.top_k(vectors(spark, rows + BAD), "vec_id % 100 = 0", 10).collect()
    whole = {i: np.floor(np.float32(v).astype(float) * 1024) for i, v in [*rows, BAD[4]]}
    for q in (i for i in whole if i % 100 == 0):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:10]
        assert sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert topk.top_k(vectors(spark, []), "vec_id % 100 = 0", 10).collect() == []


def test_top_k_of_one_vector_many_times(spark):
    rows = [(i, [0.5, 0.25, 1.0]) for i in range(9000)]
    got = topk.top_k(vectors(spark, rows).repartition(3), "vec_id % 1000 = 0", 4).collect()
    want = [(q, r + 1, v) for q in range(0, 9000, 1000) for r, v in enumerate([v for v in range(5) if v != q][:4])]
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == want


@pytest.mark.parametrize("long_list", [4096, 16])
def test_pivot_index_recall_and_components(spark, long_list):
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(120, 24))
    made = np.concatenate([c + 0.2 * rng.normal(size=(rng.integers(1, 12), 24)) for c in centers])
    made = np.concatenate([made, made[:30]]).astype(np.float32)  # copies too
    rows = [(int(i), v.tolist()) for i, v in enumerate(made)]
    got = {r.vec_id: r for r in neardup.near_duplicates(vectors(spark, rows + BAD), long_list=long_list).collect()}
    unit = made.astype(float) / np.linalg.norm(made.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    links = np.array([got[i].n_links for i in range(len(made))])
    assert (links <= near.sum(axis=1)).all() and links.sum() >= 0.95 * near.sum()
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in (900, 1000, 1001, 1002, 1003)) and len(got) == len(rows) + len(BAD)
    assert neardup.near_duplicates(vectors(spark, [])).collect() == []


def dense_third(n, seed, mean=0.96, width=64):
    """n unit vectors in mixed order, a third of them around one centre; and which those are."""
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, width))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    inside = rng.permutation(n) < n // 3
    rows[inside] *= math.sqrt(1 - mean)
    rows[inside, 0] += math.sqrt(mean)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True), inside


@pytest.mark.parametrize("long_list", [4096, 300])
def test_pivot_index_keeps_links_of_a_dense_group(spark, long_list):
    made, inside = dense_third(3000, 9)
    made = made.astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(made)]
    got = {r.vec_id: r for r in neardup.near_duplicates(vectors(spark, rows), prefix=2, long_list=long_list).collect()}
    near = made.astype(float) @ made.astype(float).T >= 0.95 * np.outer(*[np.linalg.norm(made.astype(float), axis=1)] * 2)
    np.fill_diagonal(near, False)
    links = np.array([got[i].n_links for i in range(len(made))])
    assert (links <= near.sum(axis=1)).all() and links.sum() >= 0.99 * near.sum()
    assert len({got[i].component_id for i in np.flatnonzero(inside & near.any(axis=1))}) == 1


def test_pivots_of_a_large_table_are_shared_in_a_dense_group():
    made, inside = dense_third(120_000, 10)
    pivots = neardup.keep_apart(made, 2 * math.isqrt(len(made)))
    some = made[inside][:1500]
    near = neardup.nearest(some, pivots, neardup.PREFIX)
    i, j = np.nonzero(np.triu(some @ some.T >= neardup.THRESHOLD, 1))
    pick = np.random.default_rng(11).choice(len(i), 20_000)
    assert (near[i[pick]][:, :, None] == near[j[pick]][:, None, :]).any(axis=(1, 2)).mean() >= 0.99
    assert (np.triu(pivots @ pivots.T, 1) <= neardup.APART).all()


@pytest.mark.parametrize("crowded", [0.0, 0.3, 0.5, 0.7, 0.8])
@pytest.mark.parametrize("dense", [False, True])
def test_pivots_of_crowded_vectors(crowded, dense):
    """Vectors with a mean cosine of ``crowded``, a third of them around one if ``dense``: links are found in short lists."""
    rng = np.random.default_rng(5)
    n, m, width = 8000, 1000, 48

    def units(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    rows = rng.normal(size=(n, width))
    rows[:, 0] = 0
    rows = units(rows) * math.sqrt(1 - crowded)
    rows[:, 0] = math.sqrt(crowded)
    if dense:
        rows[: n // 3] = units(rows[0] + 0.2 * units(rng.normal(size=(n // 3, width))))
    other, cosine = rng.normal(size=(m, width)), rng.uniform(neardup.THRESHOLD, 0.99, (m, 1))
    other = units(other - (other * rows[-m:]).sum(axis=1, keepdims=True) * rows[-m:])
    rows = np.concatenate([rows, cosine * rows[-m:] + np.sqrt(1 - cosine**2) * other])
    want = 2 * math.isqrt(len(rows))
    pivots, centre = neardup.choose(rows[rng.permutation(len(rows))[: neardup.CANDIDATES * want]], want)
    near = neardup.nearest(neardup.seen_from(rows, centre), pivots, neardup.PREFIX)
    assert len(pivots) > 0.8 * want
    assert np.bincount(near.ravel()).max() < (0.4 if dense else 0.1) * len(rows)
    assert (near[n - m : n, :, None] == near[n:, None, :]).any(axis=(1, 2)).mean() > 0.98
