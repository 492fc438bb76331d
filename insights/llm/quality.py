"""Quality by perplexity under a Kneser-Ney model of trusted text.

Documents and labels are dealt by a hash of doc_id over blocks (by one of the text where it is null).  A task goes through
the texts of its block and gives the distinct character n-grams of the block with
their counts in trusted texts (label quality 1, not toxic).  Those tables are summed
over all blocks; joins sharded by n-gram give each a probability
(``kneser_ney``); the probabilities of a block's n-grams go back to the block, and its
task scores every document.  So what moves is one row per n-gram and block, not per
n-gram and document, and no task holds the whole model.

A document's perplexity is the inverse geometric mean of its characters'
probabilities.  A language's threshold is a quantile of the perplexities of its
trusted documents, times a tolerance; languages without any take that of all.

Defined cases: a text without characters has no perplexity and is not kept; a document
without doc_id has no label; of repeated labels one trusted row is enough; without
trusted text all characters are as probable and everything with text is kept; rows
that repeat are scored one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from insights.llm.kneser_ney import BITS, ORDER, probabilities
from insights.plans.sinks import materialize

QUANTILE = 0.99
TOLERANCE = 1.15
PACK_CHARS = 1 << 18
#: text of a block: what a task goes through, and has one row per n-gram for
BLOCK_BYTES = 1 << 24
TRUSTED, GRAMS, TEXTS = 0, 1, 2
ROW = "block int, kind int, gram long, p double, payload binary"
SLOTS = 22


def grams(text: str) -> np.ndarray:
    """One number per character: itself and the ones before, lower-cased, spaces before the start."""
    data = (" " * (ORDER - 1) + text.lower()).encode("utf-32-le", "surrogatepass")
    c = np.frombuffer(data, np.uint32).astype(np.int64)
    c = np.where(c < 1 << BITS, c, (c * 2654435761 >> 8) & ((1 << BITS) - 1))
    n = len(c) - ORDER + 1
    out = np.zeros(n, np.int64)
    for j in range(ORDER):
        out = (out << BITS) | c[j : j + n]
    return out


class Slots:
    """A table from grams to numbers: direct slots by hash, and a sorted list for the grams whose slot is taken."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.full(1 << SLOTS, -1, np.int64)
        self.at = np.zeros(1 << SLOTS, np.int32)
        slot = self.slot(keys)
        self.keys[slot] = keys  # of grams with one slot the last stays
        self.at[slot] = np.arange(len(keys))
        rest = np.flatnonzero(self.keys[slot] != keys)
        order = np.argsort(keys[rest])
        self.rest, self.rest_at = keys[rest][order], rest[order].astype(np.int32)

    @staticmethod
    def slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 where there is none."""
        slot = self.slot(keys)
        out = np.where(self.keys[slot] == keys, self.at[slot], -1)
        lost = np.flatnonzero(out < 0)
        if len(lost) and len(self.rest):
            i = np.minimum(np.searchsorted(self.rest, keys[lost]), len(self.rest) - 1)
            out[lost] = np.where(self.rest[i] == keys[lost], self.rest_at[i], -1)
        return out


def _block(doc_id: int | None, text: str | None, blocks: int) -> int:
    """By id, where a label finds it; documents without an id have none and are dealt by their text."""
    of = str(doc_id).encode() if doc_id is not None else (text or "").encode("utf-8", "surrogatepass")
    return zlib.crc32(of) % blocks


def _packed(blocks: int):
    """Texts of a scan task, compressed together by block: rows of kind TEXTS."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        size: dict[int, int] = {}
        press = zstandard.ZstdCompressor(level=6)

        def closed(k: int) -> pa.RecordBatch:
            rows = held.pop(k)
            size.pop(k)
            table = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True),
                                    (pa.int64(), pa.string(), pa.string()), strict=True)], names=["id", "lang", "text"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as w:
                w.write_batch(table)
            return pa.record_batch([pa.array([k], pa.int32()), pa.array([TEXTS], pa.int32()), pa.array([None], pa.int64()),
                                    pa.array([None], pa.float64()), pa.array([press.compress(sink.getvalue())], pa.binary())],
                                   names=["block", "kind", "gram", "p", "payload"])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                k = _block(row[0], row[2], blocks)
                held.setdefault(k, []).append(row)
                size[k] = size.get(k, 0) + len(row[2] or "")
                if size[k] >= PACK_CHARS:
                    yield closed(k)
        for k in list(held):
            yield closed(k)

    return run


def _trusted_rows(blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, ids = b.num_rows, b.column("doc_id")
            yield pa.record_batch([
                pa.array([_block(i, None, blocks) for i in ids.to_pylist()], pa.int32()), pa.array([TRUSTED] * n, pa.int32()),
                ids, pa.array([None] * n, pa.float64()), pa.array([None] * n, pa.binary())],
                names=["block", "kind", "gram", "p", "payload"])
    return run


def _texts(payload: bytes) -> Iterator[tuple]:
    data = zstandard.ZstdDecompressor().decompressobj().decompress(payload)
    with pa.ipc.open_stream(data) as r:
        for b in r:
            yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, set, list, list, Iterator[tuple]]]:
    """Goes through sorted rows: (block, trusted ids, grams, probabilities, texts); a block's texts come one by one."""
    def rows() -> Iterator[tuple]:
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

    stream = rows()
    row = next(stream, None)
    while row is not None:
        block, trusted, keys, p = row[0], set(), [], []
        while row is not None and row[0] == block and row[1] != TEXTS:
            if row[1] == TRUSTED:
                trusted.add(row[2])
            else:
                keys.append(row[2])
                p.append(row[3])
            row = next(stream, None)

        def texts() -> Iterator[tuple]:
            nonlocal row
            while row is not None and row[0] == block and row[1] == TEXTS:
                yield from _texts(row[4])
                row = next(stream, None)

        yield block, trusted, keys, p, texts()
        while row is not None and row[0] == block:  # texts that were not asked for
            row = next(stream, None)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, gram, c): distinct grams of each block, c their count in trusted texts."""
    for block, trusted, _, _, texts in _blocks(batches):
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        slots, fresh = Slots(keys), []
        held = 0

        def settle() -> None:
            nonlocal keys, counts, slots, fresh, held
            if fresh:
                new = np.unique(np.concatenate([g for g, _ in fresh]))
                new = new[slots.find(new) < 0]
                keys = np.concatenate([keys, new])
                counts = np.concatenate([counts, np.zeros(len(new), np.int64)])
                slots = Slots(keys)
                if old := [g for g, t in fresh if t]:
                    counts += np.bincount(slots.find(np.concatenate(old)), minlength=len(keys))
                fresh, held = [], 0

        for doc_id, _, text in texts:
            if text:
                g = grams(text)
                t = doc_id is not None and doc_id in trusted
                at = slots.find(g)
                if t:
                    counts += np.bincount(at[at >= 0], minlength=len(keys)) if len(g) * 50 > len(keys) else 0
                    if len(g) * 50 <= len(keys):
                        np.add.at(counts, at[at >= 0], 1)
                g = g[at < 0]
                if len(g):
                    fresh.append((g, t))
                    held += len(g)
                if held >= 1 << 18:
                    settle()
        settle()
        for lo in range(0, len(keys), 1 << 16):
            k = keys[lo : lo + (1 << 16)]
            yield pa.record_batch([pa.array(np.full(len(k), block, np.int32)), pa.array(k),
                                   pa.array(counts[lo : lo + len(k)])], names=["block", "gram", "c"])


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, trusted, keys, p, texts in _blocks(batches):
        slots, logs = Slots(np.array(keys, np.int64)), np.log(np.array(p + [1.0]))
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (
                pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.bool_()), strict=True)],
                names=["doc_id", "lang", "n_grams", "perplexity", "trusted"])

        for doc_id, lang, text in texts:
            n, ppl = 0, None
            if text:
                g = grams(text)
                n, ppl = len(g), float(np.exp(-logs[slots.find(g)].mean()))
            out.append((doc_id, lang, n, ppl, doc_id is not None and doc_id in trusted))
            if len(out) >= 4096:
                yield batch()
                out = []
        if out:
            yield batch()


def perplexities(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, n_grams, perplexity, trusted of every document."""
    size = docs.agg(F.sum(F.octet_length(docs["text"].cast("string")))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["lang"].cast("string").alias("lang"),
                      docs["text"].cast("string").alias("text"))
    trusted = labels.filter((labels["quality"] == 1) & (F.coalesce(labels["toxic"], F.lit(0)) != 1)
                            & labels["doc_id"].isNotNull()).select(labels["doc_id"].cast("long").alias("doc_id"))
    dealt = own.mapInArrow(_packed(blocks), ROW).unionByName(trusted.distinct().mapInArrow(_trusted_rows(blocks), ROW))

    def by_block(rows: DataFrame) -> DataFrame:
        return rows.repartitionById(blocks, "block").sortWithinPartitions("block", "kind")  # a block a task

    found = materialize(by_block(dealt).mapInArrow(_counted, "block int, gram long, c long"), "grams")
    total = materialize(found.groupBy("gram").agg(F.sum("c").alias("c")), "counts")
    p = probabilities(total.filter("c > 0"), total.select("gram"))
    back = found.select("block", "gram").join(p, "gram").select(
        "block", F.lit(GRAMS).alias("kind"), "gram", "p", F.lit(None).cast("binary").alias("payload"))
    return by_block(dealt.unionByName(back)).mapInArrow(
        _scored, "doc_id long, lang string, n_grams long, perplexity double, trusted boolean")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, lang, n_grams, perplexity, threshold, keep of every document."""
    scored = materialize(perplexities(docs, labels), "perplexities")
    known = scored.filter("trusted and perplexity is not null")
    level = F.percentile_approx("perplexity", quantile, 10_000) * tolerance
    by_lang = known.groupBy(F.col("lang").alias("_lang")).agg(level.alias("own"))
    of_all = known.agg(level.alias("every")).first()["every"]  # one number
    threshold = F.coalesce("own", F.lit(of_all).cast("double"))
    return (scored.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")), "left")
            .select("doc_id", "lang", "n_grams", "perplexity", threshold.alias("threshold"),
                    (F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= threshold, F.lit(True)))
                    .alias("keep")))
