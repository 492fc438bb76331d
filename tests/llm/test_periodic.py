"""Periodic runs against a plain scan of every period."""

import hashlib
import random
import re
import zlib

import numpy as np

from insights.llm import periodic


def brute(w):
    """Every run; of texts beyond 50,000 words those of periods up to 3,000 (the one such text here has no longer ones)."""
    number, out = {}, {}
    w = np.array([number.setdefault(x, len(number)) for x in w], dtype=np.int32)
    for q in range(1, min(len(w) // 4, 3000 if len(w) > 50_000 else len(w)) + 1):
        same = w[:-q] == w[q:]
        if np.count_nonzero(same) < max(6 - q, 3 * q):
            continue
        edge = np.flatnonzero(np.diff(same, prepend=False, append=False))
        for i, j in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def check(df):
    order = lambda r: (r[0] is None, r[0] or 0, r[6], r[7])
    got = sorted((tuple(r) for r in periodic.report(df).collect()), key=order)
    want = sorted((expected(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=order)
    assert got == want
    return got


def test_runs_of_random_texts():
    rng = random.Random(1)
    for _ in range(800):
        texts = []
        for _ in range(rng.randint(1, 4)):
            texts.append([x for _ in range(rng.randint(0, 8)) for x in
                          [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(1, 6))] * rng.randint(1, 7)])
        sizes = np.array([len(w) for w in texts])
        first = np.cumsum(sizes) - sizes
        got = periodic.runs_of(np.array([x for w in texts for x in w], dtype=np.int64), np.repeat(np.arange(len(texts)), sizes))
        assert got == [(s + f, n, q) for f, w in zip(first.tolist(), texts) for s, n, q in brute(w)]


def test_long_runs_take_time_in_proportion():
    for w in (np.zeros(150_000, dtype=np.int64), np.tile(np.arange(1000), 150)):
        assert periodic.runs_of(w, np.zeros(len(w), dtype=np.int64)) == [(0, len(w), len(np.unique(w)))]


def test_odd_rows(odd, none):
    assert len(check(odd)) == odd.count()
    assert check(none) == []


def test_texts_with_runs(spark):
    rows = [(i, t) for i, t in enumerate([
        "a a a a a", "a a a a a a", "x " + "a b " * 4 + "c", "a b " * 9, "é 天\n" * 6, "a b a b a b a", " \t\n", "b " + "a " * 9 + "b",
        "😀 " * 7, " ".join("abcabcabcabcab" * 3), "one two three " * 40 + "four " * 6 + "one two three " * 5])]
    got = {r[0]: r for r in check(spark.createDataFrame(rows + [(None, "z " * 8)], "doc_id long, text string"))}
    assert got[0][1] == 0 and got[1][1:6] == (1, 0, 6, 1, 6000)


def test_documents(docs001):
    got = check(docs001)
    assert sum(r[1] > 0 for r in got) >= 10


def test_operator_gives_spans_and_texts(spark):
    r = periodic.periodic_runs(spark.createDataFrame([(5, "say " + "so it goes " * 5 + "on")], "doc_id long, text string")).first()
    assert [tuple(x) for x in r["runs"]] == [(1, 15, 3)] and r["collapsed"] == "say so it goes on" and r["n_words"] == 17
