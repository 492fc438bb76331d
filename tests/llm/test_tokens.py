"""Token ids, block files and packing against the tokenizers library and exact round trips."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from insights.llm import configurations, packing, pfor, token_files, tokens


def plain_ids(name, texts, end):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return [e.ids + [end] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_pieces_encode_as_the_whole_text(name):
    texts = ["", " ", "a  b", "x\n\ny", "a \n b", "tab\there", "  lead", "trail ", "nl\n", "\nstart", "don't we're", "Σας ΣΑΣ",
             "a\xa0b c", "é x", "1234 5.6 x_y", "\r\n a", "<|endoftext|> hi", "é.. Ö!! 中文 text。", "a.\x1cb c", "İstanbul I",
             "foo\x85bar baz", "...", "a\n...\nb!", "word.\nNext, one", "éa é"]
    enc = tokens.encoder(name)
    for _ in range(2):
        assert [np.frombuffer(x, tokens.ID).tolist() + [2] for x in enc.encode(texts)] == plain_ids(name, texts, 2)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .\n\t'é1Σ!", max_size=40))
def test_any_text_encodes_as_the_whole_text(text):
    for name in (tokens.BYTE_BPE, tokens.WORD_BPE):
        assert np.frombuffer(tokens.encoder(name).encode([text])[0], tokens.ID).tolist() + [0] == plain_ids(name, [text], 0)[0]


class Counting:
    """A tokenizer that counts the strings it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.given += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_new_words_go_to_the_tokenizer_in_runs(name):
    import os

    import public_tokenizers

    enc = tokens.Encoder(public_tokenizers.path(name), name == tokens.BYTE_BPE)
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    words = [f"{a}{b}é{c}" for a in "qxzw" for b in "aeioukpt" for c in "lmnrsvbdfg"]
    texts = ["one " + " ".join(words), "two " + " ".join(f"{w}$$$" for w in words)]
    enc.tokenizer = Counting(enc.tokenizer)
    got = [np.frombuffer(x, tokens.ID).tolist() for x in enc.encode(texts, 2)]
    assert got == plain_ids(name, texts, 2)
    assert enc.tokenizer.given < len(words) // 10
    before = enc.tokenizer.given
    enc.encode(texts[::-1], 2)
    assert enc.tokenizer.given == before


def test_words_in_use_are_kept(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 20)
    asked = []
    kept = tokens.Kept(lambda words: [asked.append(w) or w.encode() for w in words])
    for i in range(30):
        words = ["common", *(f"w{i}x{k}" for k in range(5)), "common"]
        assert kept(words) == [w.encode() for w in words]
        assert len(kept.newer) + len(kept.older) <= 40
    assert asked.count("common") == 1 and len(asked) == 151


def test_signs_that_normalising_makes_go_with_those_behind():
    texts = ["\u0958. x", "a\u095e!! \u0915\u093c. \u09dc", "\u1100\u1161. \u0130."]
    got = tokens.encoder(tokens.WORD_BPE).encode(texts, 0)
    assert [np.frombuffer(x, tokens.ID).tolist() for x in got] == plain_ids(tokens.WORD_BPE, texts, 0)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500), st.sampled_from([0.5, 0.9, 0.95, 1.0]))
def test_blocks_round_trip(ids, percentile):
    data = pfor.encode(np.array(ids, np.uint32), percentile)
    assert pfor.decode(data).tolist() == ids
    assert pfor.decode(data, 1, 3).tolist() == ids[256:768]


def test_outliers_become_exceptions():
    ids = np.tile(np.arange(16, dtype=np.uint32), 64)
    few = ids.copy()
    few[::256] = 50_000
    assert len(pfor.encode(few)) < len(pfor.encode(ids)) + 4 * 10


def test_token_files_round_trip(odd, odd_rows, none, docs001):
    for docs in (odd, docs001):
        rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
        want, start = [], 0
        for (i, _), ids in zip(rows, plain_ids(tokens.BYTE_BPE, [t for _, t in rows], 2), strict=True):
            want.append((i, start, len(ids), crc(ids)))
            start += len(ids)
        got = [tuple(r) for r in token_files.round_trip(docs).collect()]
        key = lambda r: r[1]
        assert sorted(got, key=key) == want
    assert token_files.round_trip(none).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), max_size=40))
def test_configurations_cover_the_histogram(histogram):
    groups = configurations.solve(histogram, 64)
    covered = {}
    for config, m in groups:
        assert sum(n * a for n, a in config.items()) <= 64 and m > 0
        for n, a in config.items():
            covered[n] = covered.get(n, 0) + a * m
    assert covered == histogram


def test_the_program_places_nearly_all_of_the_documents():
    """On the lengths of 10,000 documents, and of many more: what best fit places is a small part."""
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"]).column("text").to_pylist()
    encoder, histogram = tokens.encoder(tokens.WORD_BPE), {}
    for lo, hi in tokens.slices(texts):
        for ids in encoder.encode(texts[lo:hi], packing.END):
            full, rest = divmod(len(ids) // tokens.ID.itemsize, packing.CAPACITY)
            for n, k in ((packing.CAPACITY, full), (rest, 1)):
                if n and k:
                    histogram[n] = histogram.get(n, 0) + k
    for times in (1, 1000):
        pieces = {n: k * times for n, k in histogram.items()}
        total = sum(n * k for n, k in pieces.items())
        groups, left = configurations.program(pieces, packing.CAPACITY)
        assert sum(m * n * a for c, m in groups for n, a in c.items()) + left @ np.arange(len(left)) == total
        assert left @ np.arange(len(left)) < 0.1 * total
        used = sum(m for _, m in configurations.best_fit(groups, left, packing.CAPACITY))
        assert used <= 1.002 * -(-total // packing.CAPACITY)


def test_program_against_exact_optimum():
    """Small instances: never below the true least number of sequences, seldom above."""
    import itertools

    def least(items, capacity):
        for m in range(1, len(items) + 1):
            bins = [0] * m

            def place(k):
                if k == len(items):
                    return True
                for j in range(m):
                    if bins[j] + items[k] <= capacity and bins[j] not in bins[:j]:
                        bins[j] += items[k]
                        if place(k + 1):
                            return True
                        bins[j] -= items[k]
                return False

            if place(0):
                return m
        return 0

    rng, above = np.random.default_rng(3), 0
    for _ in range(60):
        items = sorted(rng.integers(1, 21, rng.integers(1, 9)).tolist(), reverse=True)
        histogram = {n: len(list(g)) for n, g in itertools.groupby(items)}
        used, best = sum(m for _, m in configurations.solve(histogram, 20)), least(items, 20)
        assert used >= best
        above += used - best
    assert above <= 3


def test_configurations_come_near_the_bound():
    rng = np.random.default_rng(1)
    lengths = np.clip(rng.lognormal(6.2, 1.0, 60_000).astype(int), 1, 2048)
    histogram = {int(n): int(k) for n, k in zip(*np.unique(lengths, return_counts=True), strict=True)}
    used = sum(m for _, m in configurations.solve(histogram, 2048))
    assert used <= 1.002 * lengths.sum() / 2048


@pytest.mark.parametrize("which", ["odd", "docs001"])
def test_packing_places_every_piece_once(which, request):
    docs = request.getfixturevalue(which)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = []
    for (i, _), ids in zip(rows, plain_ids(tokens.WORD_BPE, [t for _, t in rows], 0), strict=True):
        want += [(i, k // 2048, k, len(ids[k : k + 2048]), crc(ids[k : k + 2048])) for k in range(0, len(ids), 2048)]
    got = packing.pack(docs).collect()
    assert sorted((str(tuple(r)[:5]) for r in got)) == sorted(map(str, want))
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= 1 + 1.05 * max(sum(w[3] for w in want) / 2048, sum(w[3] > 1024 for w in want))


def test_packing_nothing(none):
    assert packing.pack(none).count() == 0
