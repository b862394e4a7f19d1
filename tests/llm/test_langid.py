import binascii
from collections import Counter

import numpy as np
from casemill.llm import langid


def brute_trigrams(text):
    s = "".join(c if c.isalpha() else " " for c in text.lower())
    s = " " + " ".join(s.split()) + " " if s.strip() else ""
    return Counter(s[i:i + 3] for i in range(len(s) - 2))


def test_bundle_is_the_sum_of_bound_vectors():
    for text in ["Ab, ab!", "x", "", "12 3", "  Éa\n\nÉa ß", "İstanbul"]:
        want = np.zeros(langid.DIM)
        code = lambda c: 0 if c == " " else ord(c)
        for g, n in brute_trigrams(text).items():
            a, b, c = (langid.letter_vector(code(x)).astype(int) for x in g)
            want += n * np.roll(a, 2) * np.roll(b, 1) * c
        assert np.array_equal(langid.bundles([text], block=3)[0], want)


def test_held_out_accuracy_and_columns(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in d.select("doc_id", "lang").collect()}
    got = langid.identify(d).collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (binascii.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    out = [r for r in got if r.held_out]
    assert np.mean([lang[r.doc_id] == r.lang_pred for r in out]) > 0.97


def test_labels_of_held_out_rows_and_of_the_row_itself_are_not_used(spark, docs):
    rows = [(i, "der die das und " * 5 if i % 2 else "the of and this " * 5, "de" if i % 2 else "en", "s") for i in range(60)]
    flipped = [(i, t, ("xx" if binascii.crc32(str(i).encode()) % 5 == 0 else g), "z") for i, t, g, _ in rows]
    a, b = (sorted(langid.identify(docs(*x)).collect()) for x in (rows, flipped))
    assert a == b and {r.lang_pred for r in a} == {"de", "en"}


def test_edge_cases(spark, docs):
    d = docs((1, "the of and", "en"), (2, None, "en"), (3, "", "en"), (4, "123 !!", "en"), (None, "the", None), (6, "the of", None))
    got = {r.doc_id: r for r in langid.identify(d.selectExpr("*", "'x' AS lang_pred", "1.0D AS score")).collect()}
    assert {got[k].lang_pred for k in (2, 3, 4)} == {"und"} and got[6].lang_pred == "en"
    assert got[None].held_out is True and got[None].lang_pred == "en"
    assert langid.identify(docs()).count() == 0
    assert langid.identify(docs((1, "abc", None))).first().lang_pred == "und"
