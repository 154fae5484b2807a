"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

A text is marked (a space before it, spaces as marks) and falls into words, which no piece crosses. The distinct words that
a worker does not know yet are sorted; going through them in order is a depth-first walk of their trie, since what a
word shares with the one before it is a stack of forward states that stays. The forward state of a prefix is the last
piece on its best path, with the nodes of a trie of all pieces that lead on from it, so that only pieces that do end at a
character are tried there. For a model of merges, a path is worth nothing (minus infinity) unless merging really gives it,
which holds exactly if each two neighbouring pieces, merged from their characters on, give these two again. So each
prefix has one best path, one step extends it, and the result equals the library's.

Characters without a piece become byte pieces and let nothing merge across. Decoding joins pieces and bytes and takes the
leading mark off again.

Defined results: null or empty text has no ids and decodes to the empty text; a mark character in a text comes back as a
space, as in the library; texts of any length are encoded whole; rows repeat as given; null ids are kept; an empty table
gives none; extra columns are ignored.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orderflume.llm.common import arrow_map, in_steps, texts

MARK = "▁"
CACHED = 400_000  # words, and pairs of pieces, of a generation; two are held
STEP = 1_000_000
WORD = re.compile(" +[^ \n]*|[^ \n]+|\n")
NORMAL, USER, BYTE = 1, 4, 6  # kinds of pieces in the model's format (fixed values)


class Recent(dict):
    """A mapping that forgets what was not asked for lately: when a generation is full, the one before it goes."""

    def __init__(self, most: int):
        self.most, self.older = most, {}

    def __missing__(self, key):
        value = self.older[key]
        self[key] = value
        return value

    def keep(self, key, value) -> None:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value


class Codec:
    """One model in a Python worker."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as format_

        model = format_.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or model.normalizer_spec.precompiled_charsmap:
            raise ValueError("a model of merges with byte pieces and without normalization is needed")
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes: list[bytes] = []
        self.byte_ids = [0] * 256
        for i, p in enumerate(model.pieces):
            if p.type in (NORMAL, USER):
                self.ids[p.piece], self.scores[p.piece] = i, p.score
                self.bytes.append(p.piece.replace(MARK, " ").encode())
            elif p.type == BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                self.bytes.append(bytes([int(p.piece[3:5], 16)]))
            else:
                self.bytes.append(b"")
        if any("\n" in p or MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece goes across words")
        self.trie: dict = {}
        for piece in self.ids:
            if self.merge(piece) == [piece]:  # else merging never gives it
                node = self.trie
                for c in piece:
                    node = node.setdefault(c, {})
                node[""] = piece
        self.known: Recent = Recent(CACHED)
        self.pairs: Recent = Recent(CACHED)

    def merge(self, text: str) -> list[str]:
        """Pieces of a short text by merging: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            scores = [self.scores.get(a + b, -np.inf) for a, b in zip(parts, parts[1:])]
            i = int(np.argmax(scores)) if len(scores) > 8 else scores.index(max(scores))
            if scores[i] == -np.inf:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def stands(self, left: str, right: str) -> bool:
        """Whether merging leaves these two pieces side by side."""
        try:
            return self.pairs[left, right]
        except KeyError:
            got = self.merge(left + right) == [left, right]
            self.pairs.keep((left, right), got)
            return got

    def best(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Packed ids of sorted marked words; what two neighbours share is searched once."""
        ids, stands, pairs, trie = self.ids, self.stands, self.pairs, self.trie
        before, last = "", [""]  # last[i]: the piece that ends the best path of the first i characters
        open_: list[list[tuple[int, dict]]] = [[]]  # open_[i]: where pieces that go on at character i start, and their nodes
        for word in words:
            most = min(len(before), len(word))
            same = next((i for i in range(most) if before[i] != word[i]), most)
            del last[same + 1 :], open_[same + 1 :]
            for end in range(same, len(word)):
                c = word[end]
                grown = [(start, node[c]) for start, node in open_[end] if c in node]
                if c in trie:
                    grown.append((end, trie[c]))
                open_.append(grown)
                for start, node in grown:  # the longest first
                    if "" in node:
                        piece, left = node[""], last[start]
                        if not start or pairs.get((left, piece)) or left not in ids or stands(left, piece):
                            break
                else:
                    piece = c  # a character without a piece
                last.append(piece)
            at, path = len(word), []
            while at:
                piece = last[at]
                path.append(piece)
                at -= len(piece)
            out: list[int] = []
            for piece in reversed(path):
                i = ids.get(piece)
                out += [i] if i is not None else [self.byte_ids[b] for b in piece.encode()]
            yield word, array("I", out).tobytes()
            before = word

    def encode(self, strings: list[str]) -> Iterator[bytes]:
        """Packed ids (little-endian unsigned 32-bit) of each text."""
        for lo, hi in in_steps(strings, STEP):
            split = [WORD.findall(" " + s.replace(MARK, " ")) if s else [] for s in strings[lo:hi]]
            made: dict[str, bytes] = {}
            marked = {}
            for w in set().union(*split):
                try:
                    made[w] = self.known[w]
                except KeyError:
                    marked[w.replace(" ", MARK)] = w
            for w, packed in self.best(sorted(marked)):
                made[marked[w]] = packed
                if len(w) <= 64:
                    self.known.keep(marked[w], packed)
            for words in split:
                yield b"".join([made[w] for w in words])

    def decode(self, packed: bytes) -> str:
        text = b"".join(map(self.bytes.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))
        return text[text[:1] == b" " :].decode("utf-8", "replace")


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array<int>) of every whole text."""

    def step(batch: pa.RecordBatch) -> dict:
        ids = [np.frombuffer(b, dtype="<u4").astype(np.int32) for b in codec(path).encode(batch.column("text").to_pylist())]
        return {"doc_id": batch.column("doc_id"), "ids": pa.array(ids, pa.list_(pa.int32()))}

    return arrow_map(texts(docs), step, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text from doc_id and ids; null ids give an empty text."""

    def step(batch: pa.RecordBatch) -> dict:
        ids = (np.array(x or [], dtype="<u4").tobytes() for x in batch.column("ids").to_pylist())
        return {"doc_id": batch.column("doc_id"), "text": pa.array([codec(path).decode(b) for b in ids], pa.string())}

    return arrow_map(encoded.select("doc_id", "ids"), step, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32 and whether decoding the ids gives the text again, in one pass of one worker."""

    def step(batch: pa.RecordBatch) -> dict:
        strings, own = batch.column("text").to_pylist(), codec(path)
        n, crc, same = [], [], []
        for text, packed in zip(strings, own.encode(strings)):
            n.append(len(packed) // 4)
            crc.append(zlib.crc32(packed))
            same.append(own.decode(packed) == text.replace(MARK, " "))
        return {"doc_id": batch.column("doc_id"), "n_ids": pa.array(n, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()), "same": pa.array(same, pa.bool_())}

    return arrow_map(texts(docs), step, "doc_id long, n_ids long, ids_crc32 long, same boolean")
