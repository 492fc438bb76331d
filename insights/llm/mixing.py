"""Mixing sources to target weights (DataFrame operations only).

Sizes are words (runs of characters other than ASCII white space).  Sources in
code point order, null last, weigh 3, 1, 2, 3, 1, 2, ...; together they are to
give 150 % of all words.  A target stops at twice its source's size and the rest
is shared anew by weight: the targets are ``min(2 * size, level * weight)`` for
the one level at which they add up, which the sharing rounds reach from below.

A source's repetition rate is target / size.  Each document is emitted
``floor(rate)`` times, plus one copy whose draw (a hash of seed, doc_id and text)
falls below the fraction; reruns draw the same.  Rows repeated in doc_id and text
draw one by one, by their place in the files too, so that a source of many equal
rows comes near its target; reruns over the same files and splits draw the same.

Defined cases: null or blank texts have size 0; a source without words has
target 0; a null source is a source; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from insights.llm.columns import unit, whole_row
from insights.plans.sinks import materialize

# Fixed values of the mix.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
WORD = r"[^\x20\x09-\x0D]+"


def ranked_sources(sized: DataFrame) -> DataFrame:
    """source, source_size, weight: one aggregate over the documents, then the place
    of each source in code point order, from a distributed sort (no single-task
    window over the sources: only the counts of the sort's partitions meet)."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = materialize(totals.orderBy(F.col("source").asc_nulls_last())
                         .withColumn("at", F.monotonically_increasing_id()), "sources")
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.col("before") + inside
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    return (placed.withColumn("part", part).join(before, "part")
            .select("source", "source_size", weight.alias("weight")))


def level_of(sources: DataFrame) -> float:
    """The level of the targets: rounds over the sources, two sums each."""
    level = 0.0
    while True:
        capped = F.lit(level) * F.col("weight") > MOST * F.col("source_size")
        total, fixed, open_weight = sources.agg(
            F.sum("source_size"), F.sum(F.when(capped, MOST * F.col("source_size")).otherwise(0.0)),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))).first()
        if not total or not open_weight:
            return level
        higher = (SHARE * total - fixed) / open_weight
        if higher <= level * (1 + 1e-12):
            return level
        level = higher


def mark(docs: DataFrame, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), docs["doc_id"], docs["text"].cast("string"))


def sized_documents(docs: DataFrame, seed: int) -> DataFrame:
    text = docs["text"].cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(docs["doc_id"].alias("doc_id"), docs["source"].alias("source"), size.alias("size"),
                       mark(docs, seed).alias("mark"), F.monotonically_increasing_id().alias("row"))


def drawn(rows: DataFrame, sized: DataFrame) -> DataFrame:
    """``rows`` (mark, row, …) with ``draw``: by the mark alone, or by mark and row where several rows share the mark.
    What is joined is one row per repeated mark."""
    repeated = sized.groupBy(F.col("mark").alias("again")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("again")
    draw = F.when(F.col("again").isNull(), unit(F.col("mark"))).otherwise(unit(F.xxhash64("mark", "row")))
    return rows.join(repeated, F.col("mark") == F.col("again"), "left").withColumn("draw", draw)


def targets(sized: DataFrame) -> DataFrame:
    """source, source_size, target, rate: written once, small, joined by Spark's own size check."""
    sources = materialize(ranked_sources(sized), "weights")
    target = F.least(MOST * F.col("source_size"), F.lit(level_of(sources)) * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return sources.select(F.col("source").alias("of"), "source_size", target.alias("target"), rate.alias("rate"))


def copies(rate: Column, draw: Column) -> Column:
    """floor(rate), plus one where the draw falls below the fraction."""
    whole = F.floor(rate)
    return (whole + (draw < rate - whole).cast("long")).cast("long")


def mix(docs: DataFrame, seed: int = 5) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken for every document."""
    sized = materialize(sized_documents(docs, seed), "sizes")
    joined = drawn(sized, sized).join(targets(sized), F.col("source").eqNullSafe(F.col("of")))
    return (joined.withColumn("copies", copies(F.col("rate"), F.col("draw")))
            .select("doc_id", "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def emit(docs: DataFrame, seed: int = 5) -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, all its columns."""
    sized = materialize(sized_documents(docs, seed), "sizes")
    here = docs.select(whole_row(docs), docs["source"].alias("source"), mark(docs, seed).alias("mark"),
                       F.monotonically_increasing_id().alias("row"))
    return (drawn(here, sized).join(targets(sized), F.col("source").eqNullSafe(F.col("of")))
            .withColumn("copies", copies(F.col("rate"), F.col("draw"))).filter("copies > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc.*"))
