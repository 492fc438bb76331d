"""Personal data: regular expressions propose spans, checksums confirm them, context
words near a span adjust its score.

Kinds: email, ip, card (Luhn), phone are the base kinds and are all kept; iban
(mod-97) and ssn are added where confirmed and scored at ``LEAST`` or more.
Positions are code points, end exclusive.  Every pattern is written so that one
pass over a text is linear in its length, also for long runs of digits or words.

Defined cases: a null text is empty (no spans); texts are scanned whole; rows
that repeat are scanned one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BASE = ("email", "ip", "card", "phone")
LEAST = 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a match can start at the first digit of a run only: from a later one it would end the same way
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

# Score before context, and words near a span that raise or lower it.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4}
RAISE = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "address", "server", "host"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "telefon", "mobile"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
}
LOWER = {"ip": ("version", "release"), "card": ("order", "serial"), "phone": ("isbn",), "ssn": ("part", "model")}
NEAR = 40


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Goes from @ to @: back over the local part, no further than the last match, then the domain."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(free, at + 1))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            yield m.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        groups = m[0]
        while groups:  # a capital word behind the number may have been taken along
            if 15 <= len(n := groups.replace(" ", "")) <= 34 and mod97(n):
                yield m.start(), m.start() + len(groups)
                break
            groups = groups.rpartition(" ")[0]


def ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text):
        yield m.span()


KINDS = {"email": emails, "ip": ips, "card": cards, "phone": phones, "iban": ibans, "ssn": ssns}


def score(kind: str, text: str, start: int, end: int) -> float:
    near = set(re.findall(r"[a-z]+", (text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]).lower()))
    up = any(w in near for w in RAISE.get(kind, ()))
    down = any(w in near for w in LOWER.get(kind, ()))
    return round(min(1.0, max(0.0, SCORES[kind] + 0.2 * up - 0.3 * down)), 2)


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score), in the order of KINDS, then of start."""
    text = text or ""
    out = []
    for kind, find in KINDS.items():
        for start, end in find(text):
            s = score(kind, text, start, end)
            if kind in BASE or s >= LEAST:
                out.append((kind, start, end, s))
    return out


SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def find(docs: DataFrame) -> DataFrame:
    """doc_id and its spans, one row per document."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("score", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans(t.as_py())]
                     for t in b.column("text")]
            yield pa.record_batch([b.column("doc_id"), pa.array(found, kind)], names=["doc_id", "spans"])

    own = docs.select(docs["doc_id"], docs["text"].cast("string").alias("text"))
    id_type = own.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("spans", T._parse_datatype_string(SPAN))])
    return own.mapInArrow(scan, schema)


def report(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans, all spans and their scores, per document."""
    def joined(found, of) -> str:
        return ",".join(f"{k}:{s}:{e}" for k, s, e, _ in found if k in of)

    names = ["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans", "scores"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [spans(t.as_py()) for t in b.column("text")]
            counts = [pa.array([sum(s[0] == k for s in f) for f in found], pa.int64()) for k in BASE]
            yield pa.record_batch([
                b.column("doc_id"), *counts,
                pa.array([hashlib.sha256(joined(f, BASE).encode()).hexdigest() for f in found], pa.string()),
                pa.array([joined(f, KINDS) for f in found], pa.string()),
                pa.array([",".join(f"{s[3]:g}" for s in f) for f in found], pa.string())], names=names)

    own = docs.select(docs["doc_id"], docs["text"].cast("string").alias("text"))
    schema = T.StructType([T.StructField("doc_id", own.schema["doc_id"].dataType),
                           *[T.StructField(f"n_{k}", T.LongType()) for k in BASE],
                           *[T.StructField(n, T.StringType()) for n in names[5:]]])
    return own.mapInArrow(scan, schema)


def mask(text: str | None) -> str | None:
    """The text with each span replaced by its kind in angle brackets; of spans that overlap, the first stays."""
    if text is None:
        return None
    out, at = [], 0
    for kind, start, end, _ in sorted(spans(text), key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
            at = end
    return "".join(out) + text[at:]
