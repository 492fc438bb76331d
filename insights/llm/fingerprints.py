"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests
(DataFrame operations only).

A text is a set of paragraph digests.  Paragraphs end at line ends, and at every sentence
end, whatever letter stands before it: a full stop, question or exclamation mark (also
those of other scripts) before white space, or a wide one, which needs none.  So texts of
few lines have several; a text that repeats paragraphs has one more element, which tells
how many repeats there are.  A sketch has three rows of
``ROW`` cells; every digest falls into one cell of each row, and a cell holds the number
of its digests, their exclusive or, and the exclusive or of their checks.  The
fingerprint is the sketch of the whole text, in hex.

Two versions are compared by subtracting sketches: what both hold cancels out.  A cell
with a single digest left gives it away (count of one either way, and the check fits);
taking it out of its other cells frees the next (peeling).  To recover differences of
any size, digests are dealt over groups of about ``LOAD`` differing ones, as a sampled
tenth of the digests foretells, and every group has a sketch of its own; groups that
don't peel to nothing are dealt over more groups with other hashes, again and again.
The recovered number of differing digests gives the likeness
``(|a| + |b| - differing) / (|a| + |b| + differing)``: common over all.

Defined cases: null text is empty; two texts without paragraphs are alike (1); a null
doc_id comes first; documents with one doc_id follow each other by a hash of their
text, and rows equal in doc_id and text are one document; in a table of one document
the next one is itself; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from insights.llm.columns import whole_text
from insights.plans.sinks import materialize

ROWS, ROW = 3, 4
LOAD = 3
#: digests that one sketch can give away
STEPS = 6
#: groups that the digests of a failed group are dealt over
AGAIN = 4
KEY = ["id0", "id1", "h"]
PARAGRAPH_END = r"\n+|(?<=[.!?．।॥؟۔።])\s+|(?<=[。！？｡])(?![。！？｡])\s*"


def elements(text: Column) -> Column:
    """The distinct paragraph digests of a text, and one for its repeats."""
    parts = F.filter(F.split(text, PARAGRAPH_END), lambda p: p != "")
    digests = F.transform(parts, lambda p: F.xxhash64(p))
    return F.concat(F.array_distinct(digests),
                    F.when(F.size(F.array_distinct(digests)) < F.size(digests),
                           F.array(F.xxhash64(F.lit("repeats"), F.size(digests) - F.size(F.array_distinct(digests)))))
                    .otherwise(F.array().cast("array<bigint>")))


CELLS = range(ROWS * ROW)
NAMES = ("n", "key", "check")


def _check(k: Column) -> Column:
    return F.xxhash64(F.lit("check"), k)


def _hits(hashed: str, i: int) -> str:
    """Whether a digest of this hash falls into cell ``i`` (of the row that the cell belongs to)."""
    return f"pmod(shiftright({hashed}, {8 * (i // ROW)}), {ROW}) = {i % ROW}"


def sketches(digests: DataFrame, by: list[str], *more: Column) -> DataFrame:
    """The sketch of each group of rows (hashed, sign, key, check): n0, key0, check0, n1, ...

    A version's digests count with sign 1, those of the version to subtract with -1: sums of
    signs and exclusive ors of both make the first sketch minus the second."""
    columns = []
    for i in CELLS:
        here = _hits("hashed", i)
        columns += [F.expr(f"sum(if({here}, sign, 0)) AS n{i}"), F.expr(f"bit_xor(if({here}, key, 0L)) AS key{i}"),
                    F.expr(f"bit_xor(if({here}, check, 0L)) AS check{i}")]
    return digests.groupBy(*by).agg(*columns, *more)


def as_text() -> Column:
    """A sketch in hex: number, digests, checks of each cell."""
    parts = ", ".join(f"lpad(hex({name}{i}), 16, '0')" for i in CELLS for name in NAMES)
    return F.expr(f"lower(concat({parts}))")


def peel(sketched: DataFrame, seed: int, keep: list[str]) -> DataFrame:
    """``keep`` and ``d``: how many digests each subtracted sketch gives away, null if it doesn't peel to nothing.

    A step takes one digest that stands alone in a cell out of its other cells."""
    now = sketched.selectExpr("*", "0 AS d")
    alone = ", ".join(
        f"CASE WHEN abs(n{i}) = 1 AND xxhash64('check', key{i}) = check{i} THEN "
        f"named_struct('sign', n{i}, 'key', key{i}, 'hashed', xxhash64({seed}, key{i})) END" for i in CELLS)
    less = []
    for i in CELLS:
        here = f"pure IS NOT NULL AND {_hits('pure.hashed', i)}"
        less += [f"if({here}, n{i} - pure.sign, n{i}) AS n{i}", f"if({here}, key{i} ^ pure.key, key{i}) AS key{i}",
                 f"if({here}, check{i} ^ xxhash64('check', pure.key), check{i}) AS check{i}"]
    for _ in range(STEPS):
        now = now.selectExpr("*", f"coalesce({alone}) AS pure").selectExpr(
            *keep, *less, "d + CAST(pure IS NOT NULL AS INT) AS d")
    empty = " AND ".join(f"{name}{i} = 0" for i in CELLS for name in NAMES)
    return now.selectExpr(*keep, f"if({empty}, d, NULL) AS d")


def dealt(digests: DataFrame, seed: int) -> DataFrame:
    """Adds each digest's hash, its check, and its group: ``part`` of the ``groups`` that its row asks for."""
    hashed = digests.withColumn("hashed", F.xxhash64(F.lit(seed), "key")).withColumn("check", _check(F.col("key")))
    at = F.pmod(F.shiftrightunsigned("hashed", 8 * ROWS), F.col("groups"))
    return hashed.withColumn("part", F.xxhash64("part", at)).drop("groups")


def recovered(digests: DataFrame, seed: int) -> DataFrame:
    """KEY, kind, part, d and, where the sketch failed, its digests (``own``)."""
    by = [*KEY, "kind", "part"]
    own = F.collect_list(F.struct("sign", "key")).alias("own")
    found = peel(sketches(dealt(digests, seed), by, own), seed, [*by, "own"])
    return found.withColumn("own", F.when(F.col("d").isNull(), F.col("own")))


def foretold(x: Column, y: Column) -> Column:
    """About how many digests differ: ten times what differs among a hashed tenth, one at least."""
    def tenth(keys: Column) -> Column:
        return F.filter(keys, lambda k: F.pmod(k, F.lit(10)) == 0)
    return F.greatest(F.lit(1), 10 * (F.size(F.array_except(tenth(x), tenth(y)))
                                      + F.size(F.array_except(tenth(y), tenth(x)))))


def _signed(keys: Column, kind: int, sign: int) -> Column:
    return F.transform(keys, lambda k: F.struct(F.lit(kind).alias("kind"), F.lit(sign).alias("sign"), k.alias("key")))


def ordered(docs: DataFrame) -> DataFrame:
    """KEY, n and rank (ascending doc_id, from 0) of every document, from a distributed sort."""
    small = docs.select(*KEY, "n").groupBy(*KEY).agg(F.first("n").alias("n"))
    placed = materialize(small.orderBy(F.col("id0").desc(), "id1", "h")
                         .withColumn("at", F.monotonically_increasing_id()), "order")
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("k"))  # a row per sort partition
    before = counts.select("part", (F.sum("k").over(Window.orderBy("part")) - F.col("k")).alias("before"))
    return placed.withColumn("part", part).join(before, "part").select(*KEY, "n", (F.col("before") + inside).alias("rank"))


def neighbours(docs: DataFrame) -> DataFrame:
    """KEY, n, the key of the document before (p0, p1, ph) and how many characters that one takes from here."""
    rows = materialize(ordered(docs), "ranks")
    total = rows.count()
    left = rows.select(F.col("id0").alias("p0"), F.col("id1").alias("p1"), F.col("h").alias("ph"),
                       F.floor(F.col("n") / 4).cast("int").alias("need"),
                       F.pmod(F.col("rank") + 1, F.lit(max(total, 1))).alias("rank"))
    return materialize(rows.join(left, "rank").drop("rank"), "neighbours")


def _versions(docs: DataFrame) -> DataFrame:
    """Per document: KEY, n, edited_sha256 and the digests of its text (a), its edited text (e) and the next text (b).

    The texts are shuffled once, by KEY; what a document passes on to the one before it
    (its digests and the first characters) is the only other thing that moves."""
    near = neighbours(docs)
    own = docs.select(*KEY, "text").join(near, KEY).dropDuplicates(KEY).withColumn("a", elements(F.col("text")))
    passed = own.select("p0", "p1", "ph", F.expr("left(text, need)").alias("head"), F.col("a").alias("b"))
    both = own.select(*KEY, "n", "text", "a").join(
        passed, (F.col("id0") == F.col("p0")) & (F.col("id1") == F.col("p1")) & (F.col("h") == F.col("ph")))
    edited = both.withColumn("edited", F.expr("concat(left(text, n - cast(floor(n / 4) as int)), head)"))
    return edited.select(*KEY, "n", F.sha2("edited", 256).alias("edited_sha256"), "a",
                         elements(F.col("edited")).alias("e"), "b")


def _digests(versions: DataFrame, *more: str) -> DataFrame:
    """A row per digest.  Kind 0: text against edited text, 1: against the next text, 2 and 3: the
    fingerprints of text and edited text."""
    a, e, b = F.col("a"), F.col("e"), F.col("b")
    # per document first, so that nothing is worked out anew for every digest
    told = versions.select(
        *KEY, *more, F.ceil(foretold(a, e) / LOAD).alias("g0"), F.ceil(foretold(a, b) / LOAD).alias("g1"), F.concat(
            _signed(a, 0, 1), _signed(e, 0, -1), _signed(a, 1, 1), _signed(b, 1, -1), _signed(a, 2, 1),
            _signed(e, 3, 1)).alias("all"))
    rows = told.select(*KEY, *more, "g0", "g1", F.explode("all").alias("of"))
    groups = F.when(F.col("of.kind") == 0, F.col("g0")).when(F.col("of.kind") == 1, F.col("g1")).otherwise(1)
    return rows.select(*KEY, *more, "of.*", F.lit(0).cast("bigint").alias("part"), groups.alias("groups"))


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    text = whole_text(docs)
    own = docs.select(docs["doc_id"].isNull().alias("id0"), F.coalesce(docs["doc_id"], F.lit(0)).cast("long").alias("id1"),
                      F.xxhash64(text).alias("h"), F.char_length(text).alias("n"), text.alias("text"))
    versions = materialize(_versions(own), "versions")
    by, seed = [*KEY, "kind", "part"], 1
    # the digests of a document stay together from here on: what follows needs no other exchange
    cells = sketches(dealt(_digests(versions.repartition(*KEY)), seed), by)
    found = peel(cells.withColumn("print", F.when(F.col("kind") > 1, as_text())), seed, [*by, "print"])
    failed = F.col("d").isNull() & (F.col("kind") < 2)
    first = materialize(found.groupBy(*KEY).agg(
        *[F.max(F.when(F.col("kind") == k, F.col("print"))).alias(f"print{k}") for k in (2, 3)],
        *[F.sum(F.when(F.col("kind") == k, F.col("d")).otherwise(0)).alias(f"d{k}") for k in (0, 1)],
        F.collect_list(F.when(failed, F.struct("kind", "part"))).alias("fails")), "peeled")
    rows = (versions.select(*KEY, "n", "edited_sha256", *[F.size(k).alias(f"n_{k}") for k in "aeb"])
            .join(first.drop("fails"), KEY, "left").join(_retried(versions, first, seed), KEY, "left"))
    nothing = F.lit("0" * 16 * len(CELLS) * len(NAMES))

    def likeness(k: int, y: str) -> Column:
        both = F.col("n_a") + F.col(f"n_{y}")
        d = F.coalesce(F.col(f"d{k}"), F.lit(0)) + F.coalesce(F.col(f"more{k}"), F.lit(0))
        return F.when(both == 0, 1.0).otherwise((both - d) / (both + d))

    return rows.select(
        F.when(~F.col("id0"), F.col("id1")).alias("doc_id"), F.col("n").cast("long").alias("n_chars"), "edited_sha256",
        F.coalesce("print2", nothing).alias("fingerprint"), F.coalesce("print3", nothing).alias("edited_fingerprint"),
        likeness(0, "e").alias("near_edited"), likeness(1, "b").alias("near_next"))


def _retried(versions: DataFrame, first: DataFrame, seed: int) -> DataFrame:
    """The groups that failed, dealt over more groups with other hashes until none fails: KEY, more0, more1."""
    some = first.filter(F.size("fails") > 0).select(*KEY, "fails")
    again = dealt(_digests(versions.join(some, KEY), "fails"), seed).filter(
        F.array_contains("fails", F.struct("kind", "part")))
    left = again.select(*KEY, "kind", "part", "sign", "key", F.lit(AGAIN).alias("groups"))
    done: list[DataFrame] = []
    while True:
        seed += 1
        tried = materialize(recovered(left, seed), "retried")
        done.append(tried.filter("d is not null").select(*KEY, "kind", "d"))
        lost = tried.filter("d is null")
        if lost.isEmpty():
            break
        left = lost.withColumn("groups", F.lit(AGAIN)).select(*KEY, "kind", "part", "groups", F.inline("own"))
    return reduce(DataFrame.unionByName, done).groupBy(*KEY).agg(*[
        F.sum(F.when(F.col("kind") == k, F.col("d")).otherwise(0)).alias(f"more{k}") for k in (0, 1)])
