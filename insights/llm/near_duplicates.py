"""N-gram Jaccard join: sets of word shingles, MinHash values, Bayesian pruning, exact check.

1. Every whole text becomes its set of five-word shingles.  Texts with equal sets are
   copies of one another and go on as one set, so a text that a third of all rows
   share is one row from here on.
2. Sets that agree in a band of MinHash values share a bucket; buckets with the same sets
   are one.  Sets are compared within their buckets (large ones in pairs of blocks) by the
   low byte of each MinHash value, in steps of ``STEP``: after each step a pair whose
   posterior probability of reaching the threshold (uniform prior) is below ``TOLERANCE``
   is dropped.  Low bytes agree where the values do, so no pair goes that the values would
   keep.  A task gives back a spanning forest of the pairs left, never the pairs; sets that
   the forest joins already are not compared again.  The components of the forests hold
   every pair left, and chains through shared boilerplate end where likeness does.
3. Within a component, all pairs are compared in square blocks, by whole values with the
   same steps; the rest is verified exactly on the shingle sets.  A task gives back link
   counts and a spanning forest of its links.  Each pair lies in one block, so counts add up.
4. The components of the verified links are the classes.

A set that is similar to another at 0.8 shares none of 32 bands of 4 values with a
chance of 5e-8; pruning loses such a pair with a chance of about 1e-6 a step.

Defined cases: a text without words has no shingle and stands alone; a null doc_id is
left out of a class's least id unless all its ids are null; rows that repeat are copies;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from insights.llm import shingles as S
from insights.llm.columns import whole_row
from insights.llm.graph import components
from insights.plans.sinks import materialize

THRESHOLD = 0.8
HASHES, BAND, STEP = 128, 4, 32
TOLERANCE = 1e-6
BLOCK_SETS, BLOCK_SHINGLES = 512, 1 << 20
#: sets of one bucket that a task holds are two times as many at most
BUCKET_SETS, CHUNK = 4096, 512


def needed(threshold: float, tolerance: float, step: int = STEP, hashes: int = HASHES) -> list[tuple[int, int]]:
    """(values compared, least agreeing ones to go on): with a uniform prior the posterior is
    Beta(agree + 1, n - agree + 1), and P(similarity >= t) = P(Binomial(n + 1, t) <= agree)."""
    out = []
    for n in range(step, hashes + 1, step):
        p, agree = 0.0, 0
        while True:
            p += math.comb(n + 1, agree) * threshold ** agree * (1 - threshold) ** (n + 1 - agree)
            if p >= tolerance:
                break
            agree += 1
        out.append((n, agree))
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text as it stands (h), digest of the shingle set, its size, MinHash
    values and the low bytes of these; one row per document."""
    mul, add = S.seeds(HASHES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = (S.shingles(t.as_py()) for t in b.column("text"))
            rows = []
            for s in sets:
                values = S.minhash(s, mul, add) if len(s) else None
                rows.append((hashlib.md5(s.tobytes()).digest(), len(s), values.tobytes(), values.astype(np.uint8).tobytes())
                            if len(s) else (None, 0, None, None))
            types = (pa.binary(), pa.int64(), pa.binary(), pa.binary())
            yield pa.record_batch([b.column("doc_id"), b.column("h"),
                                   *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))],
                                  names=["doc_id", "h", "digest", "n", "signature", "low"])

    text = docs["text"].cast("string")
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    return own.mapInArrow(run, "doc_id long, h long, digest binary, n long, signature binary, low binary")


def distinct_sets(sketched: DataFrame) -> DataFrame:
    """set_id, digest, n, signature, low, rep_id (least doc_id), copies: one row per distinct set."""
    return (sketched.filter(F.col("digest").isNotNull()).groupBy("digest")
            .agg(F.first("n").alias("n"), F.first("signature").alias("signature"), F.first("low").alias("low"),
                 F.min("doc_id").alias("rep_id"), F.count(F.lit(1)).alias("copies"),
                 F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h")).getField("h").alias("rep_h"))
            .withColumn("set_id", F.monotonically_increasing_id()))


def buckets(sets: DataFrame) -> DataFrame:
    """(key, set_id, blocks): the members of every bucket of two sets or more, each different one once."""
    width = BAND * 4
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("signature", 1 + b * width, width))
                     for b in range(HASHES // BAND)])
    keyed = sets.select("set_id", F.explode(keys).alias("key"))
    of = [F.bit_xor(F.xxhash64(F.lit(k), "set_id")).alias(f"x{k}") for k in (0, 1)]
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("set_id").alias("least"), *of).filter("m > 1")
    each = shared.groupBy("m", "least", "x0", "x1").agg(F.min("key").alias("key"))
    return keyed.join(each.select("key", F.ceil(F.col("m") / BUCKET_SETS).cast("int").alias("blocks")), "key")


def candidate_edges(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(u, v): spanning forests of the pairs in a bucket that no Bayesian step drops."""
    rows = buckets(sets).join(sets.select("set_id", "low"), "set_id")
    block = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    # a bucket of several blocks goes through pairs of different blocks, which hold the pairs within one too
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.array_except(F.sequence(F.lit(0), F.col("blocks") - 1), F.array("block")))
    dealt = rows.withColumn("block", block).withColumn("other", F.explode(others)).select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "set_id", "low")
    return (dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(_joined(threshold), "u long, v long").distinct())


class _Block:
    """Compares the sets of two blocks of one component (or of one with itself)."""

    def __init__(self, threshold: float):
        self.threshold, self.steps = threshold, needed(threshold, TOLERANCE)

    def alive(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of a, row of b) that no step drops; the first step goes over all pairs in the
        block, value by value, later ones over those left."""
        n, least = self.steps[0]
        agree = np.zeros((len(a), len(b)), dtype=np.uint8)
        for k in range(n):
            agree += a[:, k, None] == b[None, :, k]
        i, j = np.nonzero(agree >= least)
        total, before = agree[i, j].astype(np.int64), n
        for n, least in self.steps[1:]:
            for lo in range(0, len(i), 1 << 16):
                at = slice(lo, lo + (1 << 16))
                total[at] += (a[i[at], before:n] == b[j[at], before:n]).sum(axis=1)
            go = total >= least
            i, j, total, before = i[go], j[go], total[go], n
        return i, j

    def common(self, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """Exact sizes of all intersections, over the shingles that two sets have at least."""
        every = a + b
        owner = np.repeat(np.arange(len(every)), [len(x) for x in every])
        _, column, count = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
        shared = count[column] > 1
        owner, column = owner[shared], column[shared]
        _, column = np.unique(column, return_inverse=True)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        out = np.zeros((len(a), len(b)), dtype=np.float32)
        width = 4096
        for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            x, y = np.searchsorted(column, (lo, lo + width))
            m = np.zeros((len(every), width), dtype=np.float32)
            m[owner[x:y], column[x:y] - lo] = 1
            out += m[: len(a)] @ m[len(a):].T
        return out

    def links(self, a: list, b: list, same: bool) -> list[tuple[int, int, int]]:
        """(set_id, links, root) for the sets with a link; a and b: (set_id, signature, shingles)."""
        i, j = self.alive(np.stack([x[1] for x in a]), np.stack([x[1] for x in b]))
        if same:
            i, j = i[i < j], j[i < j]
        if not len(i):
            return []
        rows, i = np.unique(i, return_inverse=True)
        cols, j = np.unique(j, return_inverse=True)
        sets_a, sets_b = [a[k][2] for k in rows], [b[k][2] for k in cols]
        both = self.common(sets_a, sets_b)[i, j]
        size = np.array([len(x) for x in sets_a])[i] + np.array([len(x) for x in sets_b])[j]
        met = both >= self.threshold * (size - both) - 1e-9
        left, right = [a[rows[k]][0] for k in i[met]], [b[cols[k]][0] for k in j[met]]
        parent: dict[int, int] = {}
        count: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for x, y in zip(left, right, strict=True):
            count[x], count[y] = count.get(x, 0) + 1, count.get(y, 0) + 1
            rx, ry = root(x), root(y)
            parent[max(rx, ry)] = min(rx, ry)
        return [(x, n, root(x)) for x, n in count.items()]


def _forest(block: _Block, low: np.ndarray) -> list[tuple[int, int]]:
    """(member, first) for the sets that pairs left by the Bayesian steps join, by row.

    One set goes over the others; those it is left with are in its group and not compared among
    themselves, only with those outside, until nothing is outside."""
    group, rest = np.arange(len(low)), np.arange(len(low))
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            met = np.zeros(len(rest), bool)
            for x in range(0, len(front), CHUNK):
                for y in range(0, len(rest), CHUNK):
                    open_ = np.flatnonzero(~met[y : y + CHUNK]) + y
                    if len(open_):
                        met[open_[block.alive(low[front[x : x + CHUNK]], low[rest[open_]])[1]]] = True
            group[rest[met]] = group[front[0]]
            front, rest = rest[met], rest[~met]
    return [(i, int(g)) for i, g in enumerate(group) if i != g]


def _joined(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(threshold)
        key, ids, low, edges = None, [], [], []

        def close() -> None:
            if len(ids) > 1:
                found = _forest(block, np.frombuffer(b"".join(low), np.uint8).reshape(len(ids), HASHES))
                edges.extend((ids[i], ids[g]) for i, g in found)

        def given() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(c), pa.int64()) for c in zip(*edges, strict=True)], names=["u", "v"])

        for batch in batches:
            columns = (batch.column(k) for k in ("key", "i", "j", "set_id", "low"))
            for *now, set_id, bytes_ in zip(*(c.to_pylist() for c in columns), strict=True):
                if now != key:
                    close()
                    key, ids, low = now, [], []
                ids.append(set_id)
                low.append(bytes_)
            if len(edges) >= 1 << 14:
                yield given()
                edges.clear()
        close()
        if edges:
            yield given()

    return run


def _compare(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, key, a, b = _Block(threshold), None, {}, {}

        def closed() -> Iterator[pa.RecordBatch]:
            if key is not None:
                same = key[1] == key[2]
                rows = block.links(list(a.values()), list((a if same else b).values()), same) if a and (same or b) else []
                if rows:
                    yield pa.record_batch([pa.array(list(c), pa.int64()) for c in zip(*rows, strict=True)],
                                          names=["set_id", "links", "root"])

        for batch in batches:
            for r in batch.to_pylist():
                if (r["comp"], r["i"], r["j"]) != key:
                    yield from closed()
                    key, a, b = (r["comp"], r["i"], r["j"]), {}, {}
                # one row per set, also where documents repeat
                (a if r["block"] == r["i"] else b)[r["set_id"]] = (
                    r["set_id"], np.frombuffer(r["signature"], np.uint32), np.frombuffer(r["shingles"], np.uint64))
        yield from closed()

    return run


def _with_shingles(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The members with their shingle sets, worked out again from the text of the document that stands for each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [S.shingles(t.as_py()).tobytes() for t in b.column("text")]
            own = pa.array([hashlib.md5(s).digest() == d.as_py() for s, d in zip(sets, b.column("digest"), strict=True)],
                           pa.bool_())
            yield pa.record_batch([*(b.column(k) for k in ("set_id", "comp", "blocks", "signature")), pa.array(sets, pa.binary())],
                                  names=["set_id", "comp", "blocks", "signature", "shingles"]).filter(own)

    own = docs.select(docs["doc_id"].cast("long").alias("_doc_id"), docs["text"].cast("string").alias("text"))
    own = own.withColumn("_h", F.xxhash64("text"))
    return (members.join(own, members["rep_id"].eqNullSafe(own["_doc_id"]) & (members["rep_h"] == own["_h"]))
            .select("set_id", "comp", "blocks", "signature", "digest", "text")
            .mapInArrow(run, "set_id long, comp long, blocks int, signature binary, shingles binary"))


def links(docs: DataFrame, sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(set_id, links, root): the verified links of each block, as counts and a spanning forest."""
    comps = materialize(components(candidate_edges(sets, threshold)), "candidates")
    sizes = comps.join(sets.select(F.col("set_id").alias("node"), "n"), "node").groupBy("comp").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    # ids alone move by component; what is large moves by set, document and block
    members = comps.join(sizes, "comp").withColumnRenamed("node", "set_id").join(
        sets.select("set_id", "digest", "signature", "rep_id", "rep_h"), "set_id")
    whole = materialize(_with_shingles(docs, members), "members")
    dealt = (whole
             .withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("comp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "set_id", "signature", "shingles"))
    return (dealt.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
            .mapInArrow(_compare(threshold), "set_id long, links long, root long"))


def _per_set(docs: DataFrame, sketched: DataFrame, threshold: float) -> DataFrame:
    """_digest, class_set (least set of the class), class_id, n_links, rep_id, copies of every distinct set."""
    sets = materialize(distinct_sets(sketched), "sets")
    found = materialize(links(docs, sets, threshold), "links")
    comps = components(found.select(F.col("set_id").alias("u"), F.col("root").alias("v")))
    named = comps.join(sets.select(F.col("set_id").alias("node"), "rep_id"), "node")
    least = named.groupBy("comp").agg(F.min("rep_id").alias("class_id"))
    class_of = named.join(least, "comp").select(F.col("node").alias("set_id"), "comp", "class_id")
    count = found.groupBy("set_id").agg(F.sum("links").alias("n_links"))
    return (sets.select("set_id", "digest", "rep_id", "copies")
            .join(class_of, "set_id", "left").join(count, "set_id", "left")
            .select(F.col("digest").alias("_digest"), "rep_id", "copies",
                    F.coalesce("comp", "set_id").alias("class_set"),
                    F.coalesce("class_id", "rep_id").alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links")))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (least doc_id of its class), n_links (other texts it is linked to), rep_id
    (least doc_id with the same set), copies (rows with the same set), for every document."""
    sketched = materialize(sketches(docs), "sketches")
    per_set = _per_set(docs, sketched, threshold)
    return sketched.select("doc_id", "digest").join(per_set, F.col("digest") == F.col("_digest"), "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("rep_id", "doc_id").alias("rep_id"),
        F.coalesce("copies", F.lit(1)).alias("copies"))


def representatives(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class (the one with the least doc_id), with all its columns.

    A text without words is a class of its own; of rows equal in doc_id and text one stays."""
    sketched = materialize(sketches(docs), "sketches")
    per_set = _per_set(docs, sketched, threshold).select("_digest", "class_set")
    row = F.struct("doc_id", "h")
    stays = (sketched.select("doc_id", "h", "digest").join(per_set, F.col("digest") == F.col("_digest"))
             .groupBy("class_set").agg(F.min(row).alias("row")).select("row")
             .unionByName(sketched.filter(F.col("digest").isNull()).select(row.alias("row")).distinct())
             .select(F.col("row.doc_id").alias("id"), F.col("row.h").alias("h")))
    here = docs.select(whole_row(docs), docs["doc_id"].alias("own_id"), F.xxhash64(docs["text"].cast("string")).alias("own_h"))
    joined = here.join(stays, (F.col("own_h") == F.col("h")) & F.col("own_id").eqNullSafe(F.col("id")))
    one = Window.partitionBy("h", "id").orderBy("own_h")
    return joined.withColumn("n", F.row_number().over(one)).filter("n = 1").select("doc.*")
