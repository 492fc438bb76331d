"""Periodic run detection: maximal pairs of a bottom-up LCP-interval tree over the words of a text.

A maximal pair is two places that share their next L words, with different words before and
behind.  Two places q apart that share L words span a stretch of L + q words of period q, and
as nothing extends a maximal pair, the stretch is a run.  A run that counts has at least
max(6, 4 q) words, so its pair has q <= L / 3 and L >= 5: only such pairs are looked for.

1. Places whose next five words occur once in their text can't be in such a pair; a hash of
   the five words sets them aside (an equal hash only keeps a place too many).
2. The other suffixes are sorted by prefix doubling, for a block of texts at once; a suffix
   never meets those of another text.  The levels of the doubling give the longest common
   prefixes of neighbours.
3. The intervals of the LCP array are closed bottom-up.  Each holds its places in order, and
   by the word on their left (class lists).  Where two lists meet, the places of the smaller
   are looked up in the larger, within a third of the common prefix: places so near one
   another lie in one periodic stretch, all but its first have the same word on the left, so
   a look at the two ends of the window finds the classes in it.
4. A stretch whose period is a multiple of its smallest one comes as a pair of the same start
   and length; the smallest period stays.

Texts go to tasks as Spark deals them; nothing is shuffled.  A task works on blocks of texts
of about ``BLOCK_WORDS`` words, or on one longer text at a time.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, TIMES = 6, 4  # a run has at least max(LEAST, TIMES * period) words
PREFIX = 5  # common words of any pair that counts: L >= (TIMES - 1) q and L + q >= LEAST
BLOCK_WORDS = 1 << 18
RUN = ("start", "length", "period")
Edit = Callable[[int | None, list[bytes]], list[bytes]]

_rng = np.random.Generator(np.random.PCG64(12))
_SPREAD = _rng.integers(1 << 62, 1 << 63, PREFIX, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _candidates(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places whose next five words occur again in the same text (by hash; none is missed)."""
    n = len(words) - PREFIX + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    h = text[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    w = words.astype(np.uint64) + np.uint64(1)
    for j in range(PREFIX):
        x = w[j : j + n] * _SPREAD[j]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + (x ^ (x >> np.uint64(32)))
    at = np.flatnonzero(text[:n] == text[PREFIX - 1 :])  # the five words lie in one text
    order = at[np.argsort(h[at])]
    same = h[order[1:]] == h[order[:-1]]
    return np.sort(order[np.append(same, False) | np.insert(same, 0, False)])


def _heads(new: np.ndarray) -> np.ndarray:
    """For sorted rows with marks where a group begins: the number of the row that begins each row's group."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _suffixes(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidate places by suffix, and the common words of each with the one before (0: fewer than five)."""
    at, n = _candidates(words, text), len(words)
    if not len(at):
        return at, at
    # levels[k]: rank of the next 5 * 2^k words of each place that is a candidate or five words behind
    # one (no other is asked for); words behind the end of a text are less than all others
    ranked = np.union1d(at, at + PREFIX)
    of = np.append(text, -1)[ranked]
    keys = [of]
    for j in range(PREFIX):
        place = np.minimum(ranked + j, n - 1)
        keys.append(np.where((ranked + j < n) & (text[place] == of), words[place], -1))
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(ranked), dtype=bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    level = np.zeros(n + 1, dtype=np.int64)
    level[ranked[order]] = _heads(new)
    levels, step, active = [level], PREFIX, at
    while True:
        rank = levels[-1][active]
        active = active[np.bincount(rank)[rank] > 1]
        if not len(active):
            break
        rank, behind = levels[-1][active], levels[-1][active + step]
        order = np.lexsort([behind, rank])
        mine, rank, behind = active[order], rank[order], behind[order]
        group = np.insert(rank[1:] != rank[:-1], 0, True)
        part = np.insert(behind[1:] != behind[:-1], 0, True) | group
        level = levels[-1].copy()
        level[mine] = rank + _heads(part) - _heads(group)
        levels.append(level)
        step *= 2
    order = at[np.argsort(levels[-1][at])]
    a, b = order[:-1], order[1:]
    common = np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        common[levels[k][a + common] == levels[k][b + common]] += PREFIX << k
    for _ in range(PREFIX - 1):  # what is left is shorter than the first level
        i, j = np.minimum(a + common, n - 1), np.minimum(b + common, n - 1)
        inside = (a + common < n) & (b + common < n) & (text[i] == text[a]) & (text[j] == text[b])
        more = inside & (words[i] == words[j]) & (common >= PREFIX)
        if not more.any():
            break
        common[more] += 1
    return order, np.append(np.where(common >= PREFIX, common, 0), 0)


class _Interval:
    """Places of an LCP interval: all in order, and by the word on their left."""

    __slots__ = ("common", "every", "classes")

    def __init__(self, place: int, left: int):
        self.common, self.every, self.classes = 0, [place], {left: [place]}


def _meet(a: _Interval, b: _Interval, common: int, left: list[int], found: list[tuple[int, int, int]]) -> _Interval:
    """Report the maximal pairs between two lists that share ``common`` words, and put the smaller into the larger."""
    big, small = (a, b) if len(a.every) >= len(b.every) else (b, a)
    reach = common // (TIMES - 1)
    every, classes = big.every, big.classes
    for i in small.every:
        lo, hi = bisect_left(every, i - reach), bisect_right(every, i + reach)
        if lo < hi:
            mine = left[i]
            for c in {left[every[lo]], left[every[hi - 1]]}:
                if c != mine:
                    of = classes[c]
                    for j in of[bisect_left(of, i - reach) : bisect_right(of, i + reach)]:
                        q = abs(i - j)
                        if common + q >= LEAST:
                            found.append((min(i, j), common + q, q))
    for i in small.every:
        insort(every, i)
        insort(classes.setdefault(left[i], []), i)
    big.common = common
    return big


def _pairs(order: list[int], common: list[int], left: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, distance) of the maximal pairs that can be runs.

    ``common[k]``: common words of the suffixes k and k + 1, 0 at the end.  Intervals are closed
    bottom-up; the stack holds the open ones, each with the children it has so far."""
    found: list[tuple[int, int, int]] = []
    stack: list[_Interval] = []
    for place, c in zip(order, common, strict=True):
        done = _Interval(place, left[place])
        while stack and stack[-1].common > c:
            upper = stack.pop()
            done = _meet(upper, done, upper.common, left, found)
        if c and stack and stack[-1].common == c:
            stack[-1] = _meet(stack[-1], done, c, left, found)
        elif c:
            done.common = c
            stack.append(done)
    return found


def runs_of(words: np.ndarray, text: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every run, by start and period; ``words``: word numbers of some
    texts one after another, ``text``: the number of each word's text, rising; starts count over all words."""
    order, common = _suffixes(words, text)
    if not len(order):
        return []
    left = np.insert(words[:-1], 0, -1)
    left[np.insert(text[1:] != text[:-1], 0, True)] = -1
    least: dict[tuple[int, int], int] = {}
    for start, length, q in _pairs(order.tolist(), common.tolist(), left.tolist()):
        if q < least.get((start, length), q + 1):
            least[start, length] = q
    return sorted(((s, n, q) for (s, n), q in least.items()), key=lambda r: (r[0], r[2]))


def _blocks(ids: list, texts: list, edit: Edit | None) -> Iterator[list[tuple[object, list[bytes]]]]:
    block, size = [], 0
    for i, t in zip(ids, texts, strict=True):
        words = (t or b"").split()  # ASCII white space only, as on bytes
        if edit is not None:
            words = edit(i, words)
        if block and size + len(words) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((i, words))
        size += len(words)
    if block:
        yield block


def _worked(block: list[tuple[object, list[bytes]]]) -> pa.RecordBatch:
    number: dict[bytes, int] = {}
    sizes = np.array([len(w) for _, w in block])
    words = np.fromiter((number.setdefault(x, len(number)) for _, w in block for x in w), np.int64, int(sizes.sum()))
    first = np.cumsum(sizes) - sizes
    runs = runs_of(words, np.repeat(np.arange(len(block)), sizes))
    owner = np.searchsorted(first + sizes, [r[0] for r in runs], side="right")
    of: list[list[tuple[int, int, int]]] = [[] for _ in block]
    for k, (s, n, q) in zip(owner.tolist(), runs, strict=True):
        of[k].append((s - int(first[k]), n, q))
    kept = []
    for (_, w), mine in zip(block, of, strict=True):
        if mine:
            keep = np.ones(len(w), dtype=bool)
            for s, n, q in mine:
                keep[s + q : s + n] = False
            w = [w[i] for i in np.flatnonzero(keep).tolist()]
        kept.append(b" ".join(w))
    return pa.record_batch([pa.array([i for i, _ in block], pa.int64()), pa.array(sizes, pa.int64()),
                            pa.array([[dict(zip(RUN, r, strict=True)) for r in mine] for mine in of],
                                     pa.list_(pa.struct([(f, pa.int64()) for f in RUN]))),
                            pa.array(kept, pa.binary()).view(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period of each, by start, then period), collapsed (the words
    that no run contains after its first period, joined by a space), one row for each row of ``docs``.

    ``edit``: changes the words of a document before they are looked at.
    Defined cases: a null text is empty, and an empty text has no words, no runs and an empty collapsed
    text; rows that repeat come back each; a null doc_id stays null; an empty table gives an empty
    result; other columns are ignored; a text of any length is worked on whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in _blocks(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), edit):
                yield _worked(block)

    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").cast("binary").alias("text"))
    return own.mapInArrow(run, "doc_id long, n_words long, "
                               "runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The edit that the query plants: with h = crc32 of the decimal id and h % 10 = 0, the words from some place
    on repeat with some period.  A null id plants nothing."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def report(docs: DataFrame) -> DataFrame:
    """The contract of op12, from the runs and collapsed texts of the edited documents."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = periodic_runs(docs, planted).withColumn("best", best)
    length, start, period = (F.col(f"best.{k}") for k in "lsp")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-start).alias("start"), length.alias("length"),
        (-period).alias("period"), F.expr("1000 * best.l div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
