"""The pipeline's stages on odd rows, and the whole run on the small tables."""

import __spark_entry__
import corpus_pipeline
from insights.llm import queries


def test_stages_keep_the_columns(spark, odd, none):
    for start in (odd, none):
        docs = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = docs.count()
            docs = spark.createDataFrame(stage(spark, docs, "").collect(), start.schema)
            assert docs.columns == start.columns
            assert docs.count() <= before or name == "mixing"
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
        assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_extra_columns_of_any_name(spark):
    """Columns named like those that the stages work with stay what they are."""
    names = ["_id", "_digest", "_check", "_length", "digest", "check", "length", "n", "h", "id", "own_id", "own_h", "doc", "of", "rate",
             "draw", "copies", "copy", "target", "weight", "class_set", "set_id", "__n", "__of", "__id", "row"]
    rows = [(i, t, "en", "web", 1, *range(len(names))) for i, t in enumerate(["one two three four five six", "One two three four five six", "x", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"{n} int" for n in names))
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and {tuple(r) for r in out.collect()} <= {tuple(r) for r in rows}, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert {r["doc_id"] for r in docs.collect()} <= {1, 2, 3}


def test_names_and_registration():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES if k != "pipeline")
    assert numbers == list(range(1, 14)) and [k for k, _ in corpus_pipeline.STAGES][2] == "near_duplicates"
    assert set(queries.QUERIES) <= set(__spark_entry__.queries()) and set(queries.ORACLE_SQL) <= set(queries.QUERIES)
