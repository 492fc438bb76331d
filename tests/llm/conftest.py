import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, size string, n long, digest string, copies int, h string, key string, count int"

BASE = ("The quick brown fox jumps over the lazy dog while the band plays on. "
        "Nobody in the village had ever seen such a thing before that day. ")


def _rows():
    long_text = " ".join(f"word{i % 977} and line {i}." for i in range(30_000))
    texts = [
        (1, BASE * 3, "en", "web"), (2, (BASE * 3).upper(), "en", "web"), (3, None, "en", None), (4, "", None, "web"),
        (5, "Licensed under the Apache License, Version 2.0.\n" + BASE, "en", "code"),
        (6, "Der schnelle braune Fuchs springt über den faulen Hund. Niemand hatte es gesehen.", "de", "web"),
        (6, "Der schnelle braune Fuchs springt über den faulen Hund. Niemand hatte es gesehen.", "de", "web"),
        (7, "mail me: a.b@c.example.org or +1 (212) 555-0100, card 4111 1111 1111 1111 at 10.0.0.255", "en", "mail"),
        (None, "Le renard brun saute. " * 8, "fr", "livres"), (None, "Le renard brun saute. " * 8, "fr", "livres"),
        (9, long_text, "en", "big"), (10, "a\n\n b  c\td\r\n", "en", ""), (11, "12345 67", "es", "é"), (12, "É É é", "es", "é"),
        (13, BASE * 3 + "Indeed so.", "en", "web"), (14, "same same", "en", "x"), (15, "same same", "en", "x"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), k, "s", 7, "d", 3, "h", "k", 1)
            for k, (i, t, lang, s) in enumerate(texts)]


@pytest.fixture(scope="session")
def odd_rows():
    return _rows()


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """Nulls in any column, empty, very long, tied and repeated rows, extra columns with clashing names."""
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs001(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
