"""Language identification by compression.

For each language a raw-content zstandard dictionary is made of a bounded sample
of labelled text: ``excerpts`` documents with the smallest hash of their id, one
stretch of ``excerpt_chars`` characters of each, at a hashed place.  A text is lower-cased,
its ASCII digits, signs and white space become single spaces, and it is cut into
windows; every window is compressed with each dictionary, and the language with the
fewest bytes in all is predicted.  A text whose margin is below ``DOUBT`` is compressed
again with a search for shorter matches.  The margin to the second is its score; a
margin below ``least_margin`` is rejected.

Only text and non-null ``lang`` of documents whose crc32(doc_id) mod 4 is not 2
are learned from; a prediction sees the text alone.

Defined cases: null text or text without a letter is ``und`` with score 0 and
rejected; without labelled rows everything is; ties go to the language with more
labelled rows, then to the name that sorts first; with a single language its score is 1; rows that repeat are predicted
one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXCERPTS = 128
EXCERPT_CHARS = 800
WINDOW = 4096
LEVEL = 6
DOUBT = 0.03
LEAST_MARGIN = 0.002
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_SPACED = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))


def plain(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_SPACED).split())


def held_out(docs: DataFrame) -> Column:
    return F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, excerpts: int = EXCERPTS, chars: int = EXCERPT_CHARS) -> dict[str, bytes]:
    """Language to dictionary content, the language with most labelled rows first; at
    most ``excerpts * chars`` characters each."""
    text, place = docs["text"].cast("string"), F.xxhash64(F.lit("place"), docs["doc_id"])
    start = F.pmod(place, F.greatest(F.char_length(text) - chars, F.lit(0)) + 1).cast("int") + 1
    learned = docs.filter(~held_out(docs) & docs["lang"].isNotNull() & text.rlike(r"\p{L}"))
    rows = learned.select(
        docs["lang"].alias("lang"), F.xxhash64(F.lit("pick"), docs["doc_id"], text).alias("pick"),
        F.substring(text, start, F.lit(chars)).alias("excerpt"))
    first = Window.partitionBy("lang").orderBy("pick", "excerpt")
    picked = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= excerpts)
    counts = {r["lang"]: r["count"] for r in learned.groupBy("lang").count().collect()}
    parts: dict[str, list[tuple[int, str]]] = {}
    for r in picked.collect():
        parts.setdefault(r["lang"], []).append((r["n"], r["excerpt"]))
    return {k: plain("\n".join(x for _, x in sorted(parts[k])))
            for k in sorted(parts, key=lambda k: (-counts[k], k))}


class Classifier:
    """The dictionaries, prepared once per task."""

    def __init__(self, contents: dict[str, bytes], window: int = WINDOW):
        self.names, self.window = list(contents), window
        close = zstandard.ZstdCompressionParameters(
            window_log=18, chain_log=16, hash_log=16, search_log=4, min_match=3, target_length=32,
            strategy=zstandard.STRATEGY_BTLAZY2, write_content_size=False)
        self.quick = [self._encoder(contents[k], zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=window, dict_size=len(contents[k]), write_content_size=False)) for k in contents]
        self.close = [self._encoder(contents[k], close) for k in contents]

    @staticmethod
    def _encoder(content: bytes, params) -> zstandard.ZstdCompressor:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        return zstandard.ZstdCompressor(compression_params=params, dict_data=d)

    def _best(self, encoders, cuts: list[bytes]) -> tuple[str, float]:
        sizes = sorted((sum(len(e.compress(c)) for c in cuts), i) for i, e in enumerate(encoders))
        return self.names[sizes[0][1]], 1.0 if len(sizes) == 1 else 1 - sizes[0][0] / sizes[1][0]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and margin (0 to 1)."""
        if not text or not self.names or not _LETTER.search(text):
            return UNKNOWN, 0.0
        data = plain(text)
        cuts = [data[i : i + self.window] for i in range(0, len(data), self.window)]
        said = self._best(self.quick, cuts)
        return said if said[1] >= DOUBT else self._best(self.close, cuts)


def predict(docs: DataFrame, least_margin: float = LEAST_MARGIN) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every document."""
    contents = docs.sparkSession.sparkContext.broadcast(sample(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Classifier(contents.value)
        for b in batches:
            said = [c.predict(t.as_py()) for t in b.column("text")]
            yield pa.record_batch([
                b.column("doc_id"), b.column("held_out"), pa.array([x for x, _ in said], pa.string()),
                pa.array([s for _, s in said], pa.float64()),
                pa.array([x == UNKNOWN or s < least_margin for x, s in said], pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    own = docs.select(docs["doc_id"], held_out(docs).alias("held_out"), docs["text"].cast("string").alias("text"))
    schema = T.StructType([T.StructField("doc_id", own.schema["doc_id"].dataType),
                           T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return own.mapInArrow(run, schema)


def accepted(docs: DataFrame, least_margin: float = LEAST_MARGIN) -> DataFrame:
    """The documents whose language is told with margin enough, with all their columns."""
    contents = docs.sparkSession.sparkContext.broadcast(sample(docs))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Classifier(contents.value)
        for b in batches:
            said = (c.predict(t.as_py()) for t in b.column(at))
            yield b.filter(pa.array([x != UNKNOWN and s >= least_margin for x, s in said], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
