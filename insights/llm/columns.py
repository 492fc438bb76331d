"""Column expressions that several operators share (JVM side, no Python on executors)."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_text(df: DataFrame, name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and leave every other character; texts of ASCII alone take the quicker way."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase)))


def unit(h: Column) -> Column:
    """A 64-bit hash as a number in [0, 1)."""
    return F.shiftrightunsigned(h, 11) * F.lit(2.0 ** -53)


def uniform(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the columns alone."""
    return unit(F.xxhash64(F.lit(seed), *cols))


def whole_row(df: DataFrame) -> Column:
    """The row as one struct, so that columns worked out beside it can't clash with its own (``select("doc.*")``
    gives it back)."""
    return F.struct(*[df[c] for c in df.columns]).alias("doc")
