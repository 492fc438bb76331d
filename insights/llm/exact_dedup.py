"""Exact deduplication by a tree merge of sorted digest runs (DataFrame operations only).

Every row gets the SHA-256 of its normalised text (A-Z lower-cased, null as
empty).  The rows are dealt over ``runs`` runs; each run is sorted by digest and
merged within itself, then the runs are exchanged in rounds: in each round
``fan_in`` neighbouring runs meet and are merged, keeping one entry per digest
with the identifier that stays and the number of rows, until one run is left.
An entry holds at most one row per digest at every level, so a text that a third
of all rows share is summed up before every exchange and never gathered.

Digests are verified at every level: an entry's key also holds the length and a
second, independent hash, so texts that only collide in one are kept apart.

Defined cases: a null ``doc_id`` is the smallest of all; of rows that repeat a
``doc_id`` and text exactly one stays; an empty table gives an empty result;
columns other than ``doc_id`` and ``text`` play no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from insights.llm.columns import ascii_lower, whole_row, whole_text
from insights.plans.sinks import materialize

KEY = ["digest", "check", "length"]


def digests(docs: DataFrame) -> DataFrame:
    """One short row per document: row number, doc_id, digest and its verification."""
    text = ascii_lower(whole_text(docs))
    norm = docs.select(docs["doc_id"].alias("doc_id"), text.alias("norm"))
    return norm.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.unhex(F.sha2("norm", 256)).alias("digest"),
        F.xxhash64("norm").alias("check"), F.octet_length("norm").alias("length"))


def merge_runs(rows: DataFrame, runs: int = 16, fan_in: int = 4) -> DataFrame:
    """One entry per distinct text: key, the row that stays (largest doc_id, then
    smallest row number) and the number of rows."""
    entry = F.struct(F.col("doc_id"), (-F.col("row")).alias("negrow"))
    level = (rows.groupBy(F.pmod(F.xxhash64("row"), F.lit(runs)).alias("run"), *KEY)
             .agg(F.max(entry).alias("stays"), F.count(F.lit(1)).alias("n")))
    while runs > 1:
        runs = -(-runs // fan_in)
        level = (level.withColumn("run", F.floor(F.col("run") / fan_in))
                 .groupBy("run", *KEY).agg(F.max("stays").alias("stays"), F.sum("n").alias("n")))
    return level.drop("run")


def exact_dedup(docs: DataFrame, runs: int = 16, fan_in: int = 4) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256, and ``row``, its number in ``docs``."""
    rows = materialize(digests(docs), "digests")
    return _decide(rows, runs, fan_in).drop("row")


def _decide(rows: DataFrame, runs: int, fan_in: int) -> DataFrame:
    groups = merge_runs(rows, runs, fan_in)
    return (rows.join(groups, KEY).select(
        "doc_id", F.col("stays.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == -F.col("stays.negrow")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "row"))


def drop_copies(docs: DataFrame, runs: int = 16, fan_in: int = 4) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    The digest is worked out again beside the row, and the row is kept where its
    (digest, doc_id) is an entry that stays; rows equal in both are cut to one by
    a row number inside that pair.
    """
    from pyspark.sql import Window

    rows = materialize(digests(docs), "digests")
    stays = merge_runs(rows, runs, fan_in).select(*[F.col(k).alias(f"_{k}") for k in KEY],
                                                  F.col("stays.doc_id").alias("_id"))
    text = ascii_lower(whole_text(docs))
    here = docs.select(whole_row(docs), docs["doc_id"].alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"),
                       F.xxhash64(text).alias("check"), F.octet_length(text).alias("length"))
    joined = here.join(stays, (F.col("digest") == F.col("_digest")) & (F.col("check") == F.col("_check"))
                       & (F.col("length") == F.col("_length")) & F.col("doc_id").eqNullSafe(F.col("_id")), "inner")
    only = Window.partitionBy("_digest", "_check", "_length").orderBy("_id")
    return joined.withColumn("n", F.row_number().over(only)).filter("n = 1").select("doc.*")


SQL = """
with t as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) as text_sha256 from documents),
     g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from t group by text_sha256)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from t join g using (text_sha256)
"""
