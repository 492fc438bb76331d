"""The Kneser-Ney model against a plain implementation, and what the classifier keeps."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from insights.llm import kneser_ney, quality


def plain_model(texts, order=quality.ORDER):
    """P(last character | the ones before) as a function, from the textbook recursion."""
    top = Counter(g for t in texts for g in quality.grams(t).tolist())
    tables = {order: dict(top)}
    mask = lambda k: (1 << (kneser_ney.BITS * k)) - 1
    for k in range(order - 1, 0, -1):
        tables[k] = dict(Counter(g & mask(k) for g in tables[k + 1]))
    d, total, held = {}, {}, {}
    for k, t in tables.items():
        n = Counter(t.values())
        if not n[1] or not n[2]:
            d[k] = (0.5, 0.75, 1.0)
        else:
            y = n[1] / (n[1] + 2 * n[2])
            raw = (1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 1.5)
            d[k] = tuple(min(max(x, 0.1), j + 0.9) for j, x in enumerate(raw))
        total[k], held[k] = defaultdict(int), defaultdict(float)
        for g, c in t.items():
            total[k][g >> kneser_ney.BITS] += c
            held[k][g >> kneser_ney.BITS] += d[k][min(c, 3) - 1]

    def p(g, k=order):
        shorter = p(g & mask(k - 1), k - 1) if k > 1 else 1 / (len(tables[1]) + 1)
        c, context = tables[k].get(g, 0), g >> kneser_ney.BITS
        if context not in total[k]:
            return shorter
        return (c - (d[k][min(c, 3) - 1] if c else 0) + held[k][context] * shorter) / total[k][context]

    return p


def test_perplexities_equal_the_plain_model(odd, odd_rows, spark):
    labels = spark.createDataFrame([(1, 1, 0), (6, 1, 0), (5, 1, 1), (7, 0, 0), (None, 1, 0), (6, 1, 0), (9, 1, None)],
                                   "doc_id long, quality int, toxic int")
    p = plain_model([t for i, t, *_ in odd_rows if i in (1, 6, 9)])
    texts = defaultdict(set)
    for i, t, *_ in odd_rows:
        texts[i].add(t)
    got = quality.classify(odd, labels).collect()
    assert len(got) == len(odd_rows)
    memo = {}
    for r in got:
        (text,) = texts[r["doc_id"]]
        if not text:
            assert r["perplexity"] is None and not r["keep"]
        else:
            logs = [math.log(memo.setdefault(g, None) or memo.update({g: p(g)}) or memo[g]) for g in quality.grams(text).tolist()]
            assert r["perplexity"] == pytest.approx(math.exp(-sum(logs) / len(logs)), rel=1e-9)
        assert r["keep"] or r["doc_id"] not in (1, 6, 9)


def test_junk_goes_and_trusted_text_stays(docs001, spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    trusted = {r["doc_id"] for r in labels.filter("quality = 1 and toxic = 0").collect()}
    kept = {r["doc_id"]: r["keep"] for r in quality.classify(docs001, labels).collect()}
    assert np.mean([kept[i] for i in trusted]) > 0.95


def test_quality_without_rows_or_labels(none, odd, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.classify(none, labels).count() == 0
    assert {r["keep"] for r in quality.classify(odd, labels).collect() if r["perplexity"] is not None} == {True}


def test_slots_find_every_key():
    keys = np.unique(np.random.default_rng(2).integers(0, 1 << 48, 200_000))
    slots = quality.Slots(keys)
    assert (slots.find(keys) == np.arange(len(keys))).all() and (slots.find(keys[:9] + (1 << 50)) == -1).all()


def test_blocks_take_rows_without_ids_apart():
    dealt = [quality._block(None, f"text {i}", 16) for i in range(2000)]
    assert max(Counter(dealt).values()) < 250 and len(set(dealt)) == 16
    assert quality._block(5, "a", 16) == quality._block(5, None, 16) and quality._block(None, None, 16) == quality._block(None, "", 16)


def test_more_blocks_give_the_same_perplexities(docs001, spark, monkeypatch):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    one = {r["doc_id"]: r["perplexity"] for r in quality.perplexities(docs001, labels).collect()}
    monkeypatch.setattr(quality, "BLOCK_BYTES", 1 << 15)
    many = {r["doc_id"]: r["perplexity"] for r in quality.perplexities(docs001, labels).collect()}
    assert one == pytest.approx(many, rel=1e-9)
