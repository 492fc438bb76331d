"""Operators on texts that earlier shortcuts read too coarsely."""

import re

import pytest

from insights.llm import fingerprints, licenses

SCHEMA = "doc_id long, text string"


def sentences(text):
    """The distinct pieces between line ends and sentence ends, and one for repeats."""
    parts = [p for p in re.split(r"\n+|(?<=[.!?])[ \t\r\x0b\f]+|(?<=[。！？])(?![。！？])", text) if p]
    return set(parts) | ({len(parts) - len(set(parts))} if len(set(parts)) < len(parts) else set())


def check_sentences(docs):
    rows = sorted({(r["doc_id"], r["text"]) for r in docs.collect()})
    got = {r["doc_id"]: r for r in fingerprints.fingerprint(docs).collect()}
    like = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    for k, (i, text) in enumerate(rows):
        after, n = rows[(k + 1) % len(rows)][1], len(text)
        edited = text[: n - n // 4] + after[: n // 4]
        assert got[i]["near_edited"] == pytest.approx(like(sentences(text), sentences(edited)))
        assert got[i]["near_next"] == pytest.approx(like(sentences(text), sentences(after)))
    return got


def test_fingerprints_cut_at_every_sentence_end(spark):
    texts = ["Up it went. Nobody saw him! Was it a dog? A cat ran. Birds sang. Then all was calm. It began to rain. Day 2.",
             "Кот спал. Шёл дождь! Кто там? Никто. Стало темно. Мы ушли домой. Утром был снег. Конец.",
             "天黑了。外面下雨！谁在那里？没有人。猫在睡觉。我们回家。早上下雪了。完。"]
    got = check_sentences(spark.createDataFrame(list(enumerate(texts)), SCHEMA))
    assert all(r["near_edited"] > 0.4 for r in got.values())


def test_fingerprints_of_documents_by_sentences(docs001):
    check_sentences(docs001.select("doc_id", "text"))


def test_licenses_first_word_behind_characters_of_two_units(spark):
    texts = ["😀 mit license", "😀😀 x 😀 MIT License and the mit license", "a 😀 b\nApache License 😀"]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()}
    assert [(got[i]["first_word"], got[i]["last_word"]) for i in range(3)] == [(1, 1), (3, 7), (3, 3)]


def test_licenses_wrapped_over_lines(spark):
    bsd = """ * Redistribution and use in source and binary forms, with or
 * without modification, are permitted provided that the following
 * conditions are met:
 *"""
    mit = """# Permission is hereby granted, free of charge, to any person
# obtaining a copy of this software and associated documentation
# files (the "Software"), to deal in the Software."""
    one = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
    apart = "\n".join(f"{w} and {'x ' * 30}" for w in one.split())
    texts = [bsd, mit, bsd + "\n\n" + mit, "so that the\n" + one + "\nthe", apart, bsd + "\n" + "y " * 40 + "\n" + bsd]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()}
    assert [(got[i]["labels"], got[i]["n_blocks"]) for i in range(6)] == [
        ("bsd", 1), ("mit", 1), ("bsd,mit", 2), ("bsd", 1), ("", 0), ("bsd", 2)]
    assert all(got[i]["score"] == 1.0 for i in (0, 1, 2, 3, 5)) and got[4]["score"] == 0
