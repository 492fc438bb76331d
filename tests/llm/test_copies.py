"""Exact and near copies, fingerprints and mixing against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from insights.llm import exact_dedup, fingerprints, mixing, near_duplicates, shingles

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def norm(text):
    return (text or "").translate(LOWER)


def test_exact_dedup_of_odd_rows(odd, odd_rows, none):
    got = exact_dedup.exact_dedup(odd, runs=5, fan_in=2).collect()
    groups = defaultdict(list)
    for i, t, *_ in odd_rows:
        groups[hashlib.sha256(norm(t).encode()).hexdigest()].append(i)
    assert len(got) == len(odd_rows) and sum(r["kept"] for r in got) == len(groups)
    for r in got:
        own = groups[r["text_sha256"]]
        ids = [i for i in own if i is not None]
        assert r["group_size"] == len(own) and r["keep_id"] == (max(ids) if ids else None)
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len(groups)
    assert exact_dedup.exact_dedup(none).count() == 0 and exact_dedup.drop_copies(none).count() == 0


def plain_classes(rows):
    """doc_id -> (class_id, n_links), by all pairs of distinct shingle sets."""
    sets = defaultdict(list)
    for i, t in rows:
        sets[frozenset(shingles.shingles(t).tolist())].append(i)
    keys = [k for k in sets if k]
    parent, degree = list(range(len(keys))), [0] * len(keys)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(keys)):
        for j in range(i):
            common = len(keys[i] & keys[j])
            if common >= 0.8 * (len(keys[i]) + len(keys[j]) - common) - 1e-9:
                degree[i] += 1
                degree[j] += 1
                parent[root(i)] = root(j)
    classes = defaultdict(list)
    for i, k in enumerate(keys):
        classes[root(i)] += sets[k]
    out = {}
    for i, k in enumerate(keys):
        ids = [x for x in classes[root(i)] if x is not None]
        for x in sets[k]:
            out[x] = (min(ids) if ids else None, degree[i])
    for x in sets.get(frozenset(), []):
        out[x] = (x, 0)
    return out


def near_copies(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for base in range(6):
        text = list(rng.choice(words, 120))
        for k in range(25):
            own = list(text)
            for at in rng.integers(0, len(own), k % 7):
                own[at] = str(rng.choice(words))
            rows.append((len(rows), " ".join(own)))
    rows += [(1000 + i, " ".join(rng.choice(words, 60))) for i in range(40)]
    return rows


def test_near_duplicates_lose_no_link(spark):
    rows = near_copies(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_classes(rows)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_duplicates.classes(docs).collect()}
    assert got == want and max(n for _, n in want.values()) > 5


def test_near_duplicates_in_several_blocks(spark, monkeypatch):
    rows = near_copies(spark)
    monkeypatch.setattr(near_duplicates, "BLOCK_SETS", 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_duplicates.classes(docs).collect()}
    assert got == plain_classes(rows)


def test_near_duplicates_in_buckets_of_several_blocks(spark, monkeypatch):
    rows = near_copies(spark)
    monkeypatch.setattr(near_duplicates, "BUCKET_SETS", 3)
    monkeypatch.setattr(near_duplicates, "CHUNK", 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_duplicates.classes(docs).collect()}
    assert got == plain_classes(rows)


def test_chained_boilerplate_makes_no_component(spark):
    """Texts that share a third of their words with the next ones meet in buckets, but are not compared as one group."""
    rng = np.random.default_rng(8)
    parts = [" ".join(f"p{k}x{i}" for i in range(40)) for k in range(302)]
    rows = [(k, " ".join(parts[k : k + 3])) for k in range(300)]
    rows += [(1000 + k, f"{rows[k][1]} w{rng.integers(1000)}") for k in range(0, 300, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = near_duplicates.materialize(near_duplicates.distinct_sets(near_duplicates.sketches(docs)), "sets")
    met = near_duplicates.buckets(sets).select("set_id").distinct().count()
    sizes = [r["count"] for r in near_duplicates.components(near_duplicates.candidate_edges(sets)).groupBy("comp").count().collect()]
    assert met > 250 and max(sizes) <= 8 and sum(n * n for n in sizes) < 1000
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_duplicates.classes(docs).collect()}
    assert got == plain_classes(rows)


def test_near_duplicates_of_rows_without_ids(spark):
    """A third of the rows has no id: texts are found by id and hash, and no row is lost or doubled."""
    rows = near_copies(spark)
    rows = [(None if i % 3 == 0 else i, t) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates.classes(docs).collect()
    plain = plain_classes([(k, t) for k, (_, t) in enumerate(rows)])
    assert sorted(r["n_links"] for r in got) == sorted(n for _, n in plain.values())


def test_near_duplicates_of_odd_rows(odd, odd_rows, none):
    want = plain_classes([(r[0], r[1]) for r in odd_rows])
    got = near_duplicates.classes(odd).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        assert (r["class_id"], r["n_links"]) == want[r["doc_id"]]
    kept = near_duplicates.representatives(odd)
    # classes with words, and each text without words on its own
    n = len({v[0] for i, v in want.items()} | {3, 4})
    assert kept.columns == odd.columns and kept.count() == n
    assert near_duplicates.classes(none).count() == 0 and near_duplicates.representatives(none).count() == 0


def test_pruning_needs_what_the_posterior_says():
    steps = near_duplicates.needed(0.8, 1e-6)
    assert [n for n, _ in steps] == [32, 64, 96, 128] and all(0 < k < 0.8 * n for n, k in steps)


def paragraphs(text):
    parts = [p for p in re.split(r"\n+|(?<=[.!?])[ \t\r\x0b\f]+|(?<=[。！？])(?![。！？])", text) if p]
    own = set(parts)
    return own | ({len(parts) - len(own)} if len(own) < len(parts) else set())


def check_fingerprints(docs):
    distinct = {(r["doc_id"], r["text"] or "") for r in docs.collect()}
    rows = sorted(distinct, key=lambda r: (r[0] is not None, r[0] or 0))
    got = {(r["doc_id"], r["n_chars"]): r for r in fingerprints.fingerprint(docs).collect()}
    assert len(got) == len(rows)
    prints = {}
    for k, (i, text) in enumerate(rows):
        after, n = rows[(k + 1) % len(rows)][1], len(text)
        edited = text[: n - n // 4] + after[: n // 4]
        r = got[i, n]
        like = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(like(paragraphs(text), paragraphs(edited)))
        assert r["near_next"] == pytest.approx(like(paragraphs(text), paragraphs(after)))
        for t, p in ((text, r["fingerprint"]), (edited, r["edited_fingerprint"])):
            assert prints.setdefault(t, p) == p


def test_fingerprints_of_odd_rows(odd, none):
    check_fingerprints(odd)
    assert fingerprints.fingerprint(none).count() == 0


def test_fingerprints_of_documents(docs001):
    check_fingerprints(docs001)


def plain_targets(sizes):
    """Rounds as stated: stop at twice the size, share the rest anew by weight."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in capped]
        rest = total - sum(2 * sizes[s] for s in capped)
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_} if open_ else {}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else share[s] for s in names}
        capped |= over


@pytest.mark.parametrize("which", ["odd", "docs001"])
def test_mixing_targets_and_copies(which, request, none):
    docs = request.getfixturevalue(which)
    got = mixing.mix(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for r in docs.collect():
        sizes[r["source"]] += size(r["text"])
    want = plain_targets(sizes)
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    assert len(got) == docs.count()
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        rate = want[s] / sizes[s] if sizes[s] else 0
        assert r["taken"] == r["size"] * r["copies"] and int(rate + 1e-9) <= r["copies"] + 1e-9 and r["copies"] <= 2
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    emitted = mixing.emit(docs)
    assert emitted.columns == docs.columns
    assert emitted.count() == sum(r["copies"] for r in got)
    assert mixing.mix(none).count() == 0 and mixing.emit(none).count() == 0


def test_mixing_of_equal_rows(spark):
    """A source of one row many times comes near its target too: its rows draw one by one."""
    rows = [(1, "five words stand in here", "a")] * 400 + [(2, "three words here", "b")] * 400 + [(3, "own words", "c"), (None, None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    for size in (5, 3):
        own = [r for r in got if r["size"] == size]
        assert sum(r["taken"] for r in own) == pytest.approx(own[0]["target"], rel=0.1)
        assert all(r["taken"] <= 2 * size for r in own)
    emitted = mixing.emit(docs).groupBy("doc_id").count().collect()
    for r in emitted:
        if r["doc_id"] in (1, 2):
            assert r["count"] * (5, 3)[r["doc_id"] - 1] == pytest.approx(
                next(x["target"] for x in got if x["doc_id"] == r["doc_id"]), rel=0.1)
