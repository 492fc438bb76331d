"""Column-level cleaning and conversion helpers.

Every helper returns a Spark ``Column`` built from built-in functions, so it
stays inside whole-stage codegen; none of them is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text tokens the source systems use for "no value".
NULL_TOKENS = ("", "null")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_dirty_null(c: Column | str) -> Column:
    """True for real NULL, empty text or the literal text ``'null'``."""
    return F.coalesce(F.lower(F.trim(_col(c))), F.lit("")).isin(*NULL_TOKENS)


def clean_null(c: Column | str) -> Column:
    """Dirty null tokens become a real NULL; other text is trimmed."""
    return F.when(is_dirty_null(c), F.lit(None).cast("string")).otherwise(F.trim(_col(c)))


def number_from_text(c: Column | str, precision: int = 10, scale: int = 1) -> Column:
    """Numeric value of text such as ``'23.4 km'`` or ``'32 minutes'``.

    Keeps digits and the decimal point (a plain ``[^0-9]`` strip would turn
    ``23.4`` into ``234``); unparsable text gives NULL instead of an error.
    """
    digits = F.regexp_replace(clean_null(c), r"[^0-9.]", "")
    return F.when(digits != "", digits).try_cast(f"decimal({precision},{scale})")


def csv_int_array(c: Column | str) -> Column:
    """Comma separated id list → ``array<int>``; dirty null → empty array.

    Items that are not integers are dropped rather than raising.
    """
    cleaned = clean_null(c)
    # split + array cast stays in generated code; a per-element lambda here is ~10x slower
    items = F.split(cleaned, r"\s*,\s*").try_cast("array<int>")
    return F.when(cleaned.isNull(), F.array().cast("array<int>")).otherwise(F.array_compact(items))


def parse_date(c: Column | str, fmt: str) -> Column:
    """Text → date with a Spark datetime pattern; bad text gives NULL."""
    return F.try_to_date(_col(c), fmt)


def dow_sunday0(d: Column | str) -> Column:
    """Day of week with 0 = Sunday … 6 = Saturday."""
    return F.dayofweek(_col(d)) - 1


# Fixed value: two-digit years 69-99 mean 19xx, 00-68 mean 20xx (POSIX strptime rule).
TWO_DIGIT_YEAR_PIVOT = 69


def parse_short_date(c: Column | str, fmt: str = "d/M/yy") -> Column:
    """Text date with a two-digit year → date, using the POSIX century pivot.

    Spark's ``yy`` always lands in 2000-2099; years at or above 20``PIVOT``
    are moved back one century.
    """
    d = parse_date(c, fmt)
    return F.when(F.year(d) >= 2000 + TWO_DIGIT_YEAR_PIVOT, F.add_months(d, -1200)).otherwise(d)
