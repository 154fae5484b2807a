"""Personal data by anchor expansion.

An Aho-Corasick automaton walks each text once and reports anchors: at-signs, plus signs, digits, URL schemes and
identifier cues. Around each anchor a small deterministic parser expands to the boundaries of what it may belong to and
validates it. Nothing else of the text is looked at, so the work grows with the text plus the anchors.

Kinds, in output order: email, ip, card, phone (their patterns are fixed by the query's contract), then url, account and
secret. Spans are half-open ranges of code points; spans of one kind never overlap, spans of two kinds may.

Defined results: a null or empty text has no spans; texts of any length are read whole; a repeated row gives its result
again; a null doc_id is kept; other columns are ignored by ``find_spans`` and kept by ``redact``; an empty table gives none.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflume.llm.common import arrow_map, texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account", "secret")

LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
SCHEME_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
RUN = re.compile(r"[0-9]+")
QUAD = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
DIAL = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LINK = re.compile(r"[^\s<>\"'`|\\^{}]+")
ACCOUNT = re.compile(r"(?i:\s?(?:no\.?|number|nr\.?)?)\s?[:=#]?\s?([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}|[0-9]{6,17})(?![A-Za-z0-9])")
SECRET = re.compile(r"\s?[:=]\s?[\"']?([A-Za-z0-9_./+=-]{8,})")

SCHEMES = ("http", "https", "ftp", "ftps", "sftp")
ACCOUNT_CUES = ("iban", "account", "acct")
SECRET_CUES = ("token", "password", "passwd", "secret", "api_key", "apikey", "access_key")
AT, PLUS, DIGIT, SCHEME, HOST, ACCOUNT_CUE, SECRET_CUE = range(7)


@functools.cache
def anchors():
    """The automaton, once per Python worker."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, kind in (("@", AT), ("+", PLUS), ("://", SCHEME), ("www.", HOST), *((d, DIGIT) for d in "0123456789")):
        found.add_word(word, (kind, len(word)))
    for cues, kind in ((ACCOUNT_CUES, ACCOUNT_CUE), (SECRET_CUES, SECRET_CUE)):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def small(part: str) -> bool:
    """At most 255, however many zeros lead."""
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def mod97(code: str) -> bool:
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of one text, by kind in the order of KINDS, then by start."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    free = dict.fromkeys(KINDS, 0)  # per kind, where the next match may start
    last_at = 0
    for end, (kind, size) in anchors().iter(text):
        at, after = end - size + 1, end + 1
        if kind == DIGIT:
            if at >= free["card"]:
                m = CHAIN.match(text, at)
                free["card"] = m.end() if m else after
                if m:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        spans["card"].append(m.span())
            if at >= free["ip"]:
                m = QUAD.match(text, at)
                free["ip"] = m.end() if m else RUN.match(text, at).end()
                if m and all(map(small, m.groups())):
                    spans["ip"].append(m.span())
        elif kind == AT:
            low = max(free["email"], last_at)
            last_at = after
            left = text[low:at]
            start = low + len(left.rstrip(LOCAL_PART))
            m = DOMAIN.match(text, after) if start < at else None
            if m:
                spans["email"].append((start, m.end()))
                free["email"] = m.end()
        elif kind == PLUS:
            m = DIAL.match(text, at)
            if m and 9 <= sum(map(str.isdigit, m[0])) <= 15:
                spans["phone"].append(m.span())
        elif kind in (SCHEME, HOST):
            low = max(free["url"], at - 8)
            if low <= at:
                start = low + len(text[low:at].rstrip(SCHEME_CHARS)) if kind == SCHEME else at
                named = text[start:at].lower() in SCHEMES if kind == SCHEME else not text[max(at - 1, 0) : at].isalnum()
                m = LINK.match(text, after) if named else None
                stop = after + len(m[0].rstrip(".,;:!?)]*$%&#")) if m else after
                if stop > after and text[after].isalnum():
                    spans["url"].append((start, stop))
                    free["url"] = stop
        else:
            name, parser = ("account", ACCOUNT) if kind == ACCOUNT_CUE else ("secret", SECRET)
            m = parser.match(text, after) if at >= free[name] else None
            if m and (name == "secret" or m[1].isdigit() or mod97(m[1].replace(" ", ""))):
                spans[name].append(m.span(1))
                free[name] = m.end(1)
    return [(k, a, b) for k in KINDS for a, b in spans[k]]


SPANS = "array<struct<kind: string, start: long, end: long>>"


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id and the spans of every whole text."""
    made = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def step(batch: pa.RecordBatch) -> dict:
        found = ([{"kind": k, "start": a, "end": b} for k, a, b in scan(t)] for t in batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id"), "spans": pa.array(list(found), made)}

    return arrow_map(texts(docs), step, f"doc_id long, spans {SPANS}")


def masked(text: str | None) -> str | None:
    """The text with each stretch of overlapping spans replaced by the name of its first kind."""
    spans = sorted((a, b, KINDS.index(k)) for k, a, b in scan(text)) if text else []
    if not spans:
        return text
    parts, done, i = [], 0, 0
    while i < len(spans):
        start, stop, kind = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < stop:
            stop, kind = max(stop, spans[i][1]), min(kind, spans[i][2])
            i += 1
        parts += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = stop
    return "".join(parts) + text[done:]


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked; n_chars, if there, follows the text, all else stays."""

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            clean = pa.array([masked(t) for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), clean)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the hash of the base spans and all spans as text."""

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *(of(k) for k in BASE_KINDS),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
