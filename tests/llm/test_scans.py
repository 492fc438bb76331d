"""Personal data, licenses and languages against plain re-statements of what they find."""

import hashlib
import re
import zlib

from insights.llm import language, licenses, pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = "".join(c for c in m[0] if c in "0123456789")
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii_base_spans_equal_the_plain_patterns(odd, docs001):
    for docs in (odd, docs001):
        texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        want = sorted(((i if i is not None else -1), hashlib.sha256(",".join(plain_spans(t)).encode()).hexdigest())
                      for i, t in texts)
        got = pii.report(docs).collect()
        assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["base_sha256"]) for r in got) == want


def test_pii_runs_that_meet_end_to_end():
    for text in ("x@y.z_a@b.c", "a@b.c.d@e.f", "@@a@b", "a@b", "1.2.3.4.5.6.7.8", "256.1.1.1 1.256.1.1.1", "..1.1.1.1",
                 "4111-1111 1111-1111 4", "+1--2", "+123456789", "+1 (22) 33-44-55.", "é@ü.x a@b.c", "9" * 4_000 + ".1.1.1"):
        assert [s for s in (f"{k}:{a}:{b}" for k, a, b, _ in pii.spans(text)) if s.split(":")[0] in BASE] == plain_spans(text)


def test_pii_added_kinds_need_their_checksum_and_context():
    kinds = lambda t: [k for k, *_ in pii.spans(t)]
    assert "iban" in kinds("IBAN DE89 3704 0044 0532 0130 00 THANKS")
    assert "iban" not in kinds("IBAN DE88 3704 0044 0532 0130 00")
    assert "ssn" in kinds("social security number 123-45-6789") and "ssn" not in kinds("part 123-45-6789")
    assert pii.mask("write a@b.example now") == "write <email> now"


def plain_labels(words):
    """Every window of a notice's number of words, looked at one by one."""
    found = set()
    for label, text, needed, barred in licenses.TEMPLATES:
        own, long = set(text.split()), len(text.split())
        for i in range(len(words)):
            here = set(words[i : i + long])
            if words[i] in own and len(here & own) >= 0.8 * len(own) - 1e-9 and here >= set(needed) and not here & set(barred):
                found.add(label)
    return found


LABELS = {
    "Licensed under CC BY 4.0": "cc-by", "licensed under CC BY-NC 4.0": "cc-by-nc", "All rights reserved.": "reserved",
    "released a statement about the license fee and spoke under oath of the mit and the committee": "",
    "reserved seats: all guests have equal rights": "", "All other rights are reserved": "",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "",
    "Unless permitted, redistribution is met with the following conditions": "",
    "The above copyright notice and this permission notice shall be\n * included in all copies or substantial portions": "mit",
    "Neither the name of the copyright holder nor the names of its contributors\nmay be used to endorse or promote products"
    " derived\nfrom this software without specific prior written permission.": "bsd",
}


def test_licenses_need_the_words_that_tell_them_apart(spark):
    pad = " other words of a long text on one line" * 60
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(LABELS)] + [(k + 100, pad + " " + t + pad) for k, t in enumerate(LABELS)],
                                 "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["n_blocks"]) for r in licenses.scan(docs).collect()}
    for k, (text, label) in enumerate(LABELS.items()):
        assert got[k][0] == label and got[k + 100][0] == label, text
        assert got[k][1] == got[k + 100][1] == (1 if label else 0), text


def test_licenses_base_places_and_blocks(odd, docs001):
    for docs in (odd, docs001):
        for r, t in zip(sorted(licenses.scan(docs).collect(), key=str), sorted(docs.collect(), key=str), strict=True):
            assert 0 <= r["score"] <= 1
        got = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
        for t in docs.collect():
            r = got[t["doc_id"]]
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t["text"] or "").translate(LOWER))
            at = sorted(i for p in licenses.PHRASES for i in range(len(words))
                        if words[i : i + len(p.split())] == p.split())
            assert (r["n_words"], r["n_base"]) == (len(words), len(at))
            assert (r["first_word"], r["last_word"]) == ((at[0], at[-1]) if at else (None, None))
            labels = set(filter(None, r["base_labels"].split(",")))
            labels |= plain_labels(words)
            assert r["labels"] == ",".join(sorted(labels))


def test_licenses_and_pii_of_an_empty_table(none):
    assert licenses.scan(none).count() == 0 and pii.report(none).count() == 0


def test_language_held_out_accuracy_and_odd_rows(odd, docs001):
    truth = {r["doc_id"]: r["lang"] for r in docs001.collect()}
    held = [r for r in language.predict(docs001).collect() if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.9
    got = language.predict(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (3, 4, 11):
            assert (r["lang_pred"], r["rejected"]) == ("und", True)
    kept = language.accepted(odd)
    assert kept.columns == odd.columns and {3, 4, 11}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_language_without_rows_or_labels(none, odd):
    from pyspark.sql import functions as F
    assert language.predict(none).count() == 0
    assert {r["lang_pred"] for r in language.predict(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_texts_without_letters_are_unknown(spark, docs001):
    from insights.llm import language

    signs = spark.createDataFrame([(900_000 + k, t, None, "x", 1) for k, t in enumerate(["²", "Ⅷ ½", "①", "12 + 3", "_"])], docs001.schema)
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs001.unionByName(signs)).filter("doc_id >= 900000").collect()}
    assert set(got.values()) == {"und"} and len(got) == 5


def test_predictions_against_compression_by_hand(spark, docs001):
    """The same dictionaries, each text compressed on its own: the smallest wins, narrow margins and no letters are unknown."""
    import zstandard

    from insights.llm import language

    contents = language.sample(docs001)
    docs = docs001.limit(60)
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs001).collect()}
    level = {n: zstandard.ZstdCompressor(level=language.LEVEL, dict_data=zstandard.ZstdCompressionDict(
        c, dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for n, c in contents.items()}
    same = 0
    for r in docs.collect():
        data = language.plain(r["text"] or "")
        if not data:
            assert got[r["doc_id"]] == "und"
            continue
        sizes = sorted((len(z.compress(data)), n) for n, z in level.items())
        same += got[r["doc_id"]] in (sizes[0][1], "und")
    assert same >= 55
