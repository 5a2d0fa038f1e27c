"""Column functions against plain Python on awkward values."""

import re

from pyspark.sql import functions as F

from screenline.functions import fields as fl
from screenline.functions import text as tx


def one(spark, col, value):
    return spark.range(1).select(F.lit(value).cast("string").alias("v")).select(col(F.col("v"))).first()[0]


def test_squash_is_unicode_aware(spark):
    s = "  a b c \t\n d "
    assert one(spark, tx.squash, s) == " ".join(s.split())


def test_norm_venue_and_key(spark):
    assert one(spark, tx.norm_venue, "Front. Oncol. (Lausanne)!") == "front oncol lausanne"
    assert one(spark, tx.compact_key, "PMID 12-b.pdf") == "pmid12bpdf"


def test_blank(spark):
    for v, want in ((None, True), ("", True), (" \t\n", True), ("x", False)):
        assert one(spark, tx.is_blank, v) is want


def test_words_equal_guarded_regex(spark):
    text = "p53 (TP53)-driven, anti-p53; p53/rb +p53 xp53 p53."
    found = set(one(spark, tx.words, text))
    for term in ("p53", "tp53", "anti-p53", "p53/rb", "xp53", "rb", "driven"):
        guarded = re.search(rf"(?<![A-Za-z0-9+/-]){re.escape(term)}(?![A-Za-z0-9+/-])", text.lower())
        assert (term in found) == bool(guarded), term


def test_declared_terms(spark):
    got = one(spark, lambda c: tx.declared_terms(c, ("the", "of")), "IL-6 signaling of the gut; AKT | the\nmTOR, rare cell type")
    assert got == sorted({"il-6 signaling gut", "il-6", "akt", "mtor", "rare cell type"})


def test_feedback_phrases_keep_order(spark):
    got = one(spark, tx.feedback_phrases, "zeta path (x); Alpha; ab; - zeta path -; beta|gamma")
    assert got == ["zeta path", "alpha", "beta", "gamma"]


def test_windows(spark):
    got = spark.range(1).select(tx.windows(F.lit("A Title"), F.lit("One  two. Three! \n Four? five"))).first()[0]
    assert got == ["a title", "one two.", "three!", "four?", "five"]


def test_evidence_windows_headings_and_chunks(spark):
    long = "x" * 1700
    text = f"Intro words\nFirst one. Second.\nEnds here.\nMethods\n{long}"
    got = spark.range(1).select(tx.evidence_windows(F.lit("T"), F.lit(text))).first()[0]
    assert [tuple(g) for g in got] == [
        ("title", "t"),
        ("Intro words", "Intro words"),
        ("Intro words", "First one."),
        ("Intro words", "Second."),
        ("Intro words", "Ends here."),
        ("Methods", "Methods"),
        ("Methods", "x" * 800),
        ("Methods", "x" * 800),
        ("Methods", "x" * 100),
    ]
    assert spark.range(1).select(tx.has_chunk(F.lit(text))).first()[0] is True


def test_doi_forms(spark):
    assert one(spark, fl.norm_doi, " https://doi.org/10.1/x ") == "10.1/x"
    assert one(spark, fl.norm_doi, "doi:10.1/x") == "10.1/x"
    assert one(spark, fl.norm_doi, None) == ""
    assert set(one(spark, fl.doi_keys, "10.1/abc-12345.d")) == {"101abc12345d", "abc12345d", "12345"}
    assert one(spark, fl.doi_keys, "nodoi") == ["nodoi"]


def test_years(spark):
    for v, want in (("2019 Mar 4", "2019"), ("2019-03", "2019"), ("Spring", ""), ("", ""), (None, ""), ("12/2020", "2020")):
        assert one(spark, fl.year_of, v) == want


def test_notes(spark):
    d = spark.range(1)
    note = lambda a, b, **k: d.select(fl.append_note(F.lit(a), F.lit(b), **k)).first()[0]
    assert note("a", "b") == "a b" and note("", "b") == "b" and note("a", "") == "a"
    assert note("a b", "b", once=True) == "a b" and note("a", "b", once=True) == "a b"


def test_int_setting(spark):
    m = F.create_map(F.lit("a"), F.lit("12"), F.lit("b"), F.lit("-3"), F.lit("c"), F.lit("2x"))
    got = spark.range(1).select(*[fl.int_setting(m, k, 7).alias(k) for k in "abcd"]).first()
    assert tuple(got) == (12, 7, 7, 7)
