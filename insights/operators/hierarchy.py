"""Parent links of any depth: root, depth and path of every node by pointer doubling.

Every node points to its parent; a round replaces each pointer by the pointer's pointer, so
after r rounds it reaches 2^r levels up, and a tree of depth d takes log2 d rounds.  What
still points somewhere when 2^r exceeds the number of nodes runs in a circle.  A round is one
equi-join of the pointers with the nodes, written down before the next.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.sinks import materialize

OK, ORPHAN, CYCLE = "ok", "orphan", "cycle"


def ancestry(links: DataFrame, id: str = "id", parent: str = "parent_id") -> DataFrame:  # noqa: A002
    """id, root, depth, status, cycle, path of every node.

    ``ok``: ``root`` has no parent, ``depth`` links above; ``path`` from the root down to the node.  ``orphan``:
    ``root`` names a parent that isn't there; depth and path from it on.  ``cycle``: the node lies in a circle or
    below one, which ``cycle`` names by its least id; root, depth and path are null.
    Rows without id are left out; an id that repeats keeps its least parent (none before any)."""
    nodes = links.select(F.col(id).alias("id"), F.col(parent).alias("parent")).filter(F.col("id").isNotNull())
    nodes = nodes.groupBy("id").agg(F.min(F.struct(F.col("parent").isNotNull(), F.col("parent"))).getField("parent").alias("parent"))
    there = nodes.select(F.col("id").alias("known"))
    first = nodes.join(there, F.col("parent") == F.col("known"), "left")
    at = materialize(first.select(
        "id", F.col("known").alias("up"), F.when(F.col("known").isNull(), F.col("id")).alias("root"),
        F.when(F.col("known").isNull(), 0).otherwise(1).cast("long").alias("depth"),
        (F.col("parent").isNotNull() & F.col("known").isNull()).alias("orphan"), F.col("id").alias("least")), "links")
    n = at.count()
    for _ in range(math.ceil(math.log2(n + 1)) + 1 if n else 0):
        if at.filter(F.col("up").isNotNull()).isEmpty():
            break
        at = materialize(_doubled(at), "links")
    circles = at.filter(F.col("up").isNotNull())
    named = circles.select("id", "up").join(circles.select(F.col("id").alias("up"), F.col("least").alias("cycle")), "up").select("id", "cycle")
    paths = _paths(nodes.join(at.filter(F.col("up").isNull()).select("id"), "id", "left_semi"), there)
    return (at.join(named, "id", "left").join(paths, "id", "left").select(
        "id", F.when(F.col("up").isNull(), F.col("root")).alias("root"), F.when(F.col("up").isNull(), F.col("depth")).alias("depth"),
        F.when(F.col("up").isNotNull(), CYCLE).when(F.col("orphan"), ORPHAN).otherwise(OK).alias("status"), "cycle", "path"))


def _doubled(at: DataFrame) -> DataFrame:
    far = at.select(F.col("id").alias("f_id"), *[F.col(c).alias(f"f_{c}") for c in ("up", "root", "depth", "orphan", "least")])
    moves = F.col("f_id").isNotNull()
    return at.join(far, F.col("up") == F.col("f_id"), "left").select(
        "id", F.col("f_up").alias("up"), F.coalesce("root", "f_root").alias("root"),
        F.when(moves, F.col("depth") + F.col("f_depth")).otherwise(F.col("depth")).alias("depth"),
        F.when(moves, F.col("f_orphan")).otherwise(F.col("orphan")).alias("orphan"),
        F.when(moves, F.least("least", "f_least")).otherwise(F.col("least")).alias("least"))


def _paths(nodes: DataFrame, there: DataFrame) -> DataFrame:
    """id, path (root first) of nodes that lie below no circle."""
    at = materialize(nodes.join(there, F.col("parent") == F.col("known"), "left")
                     .select("id", F.col("known").alias("up"), F.array("id").alias("path")), "paths")
    while not at.filter(F.col("up").isNotNull()).isEmpty():
        far = at.select(F.col("id").alias("f_id"), F.col("up").alias("f_up"), F.col("path").alias("f_path"))
        at = materialize(at.join(far, F.col("up") == F.col("f_id"), "left").select(
            "id", F.col("f_up").alias("up"),
            F.when(F.col("f_id").isNotNull(), F.concat("f_path", "path")).otherwise(F.col("path")).alias("path")), "paths")
    return at.select("id", "path")
