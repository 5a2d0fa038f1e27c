"""Decision tables: every combination of flags against a plain statement of
the rules."""

import itertools
import random
import re

import pytest

from pyspark.sql import functions as F

from screenline.operators import evidence, match, phrases, triage

NAMES = ("p", "m", "o", "c", "x", "r", "e", "review", "claim", "direct", "contextual", "comparator")


def flag_table(rows, names):
    data = [(i, *v) for i, v in enumerate(itertools.product([False, True], repeat=len(names)))]
    d = rows(data, "i int, " + ", ".join(f"{n} boolean" for n in names))
    rest = [n for n in NAMES if n not in names]
    return d.select("i", F.struct(*[F.col(n) for n in names], *[F.lit(False).alias(n) for n in rest]).alias("flags"))


def test_first_decision(spark, rows):
    names = ("p", "m", "o", "c", "x", "r", "review", "claim")
    for number in (1, 2):
        d = flag_table(rows, names).select("flags.*", triage.first_decision(F.lit(number)).alias("d"))
        for row in d.collect():
            p, m, o, c, x, r, review, claim = (row[n] for n in names)
            if (p and m and o) or claim:
                want = "direct_claim"
            elif review and p and (m or o) and r:
                want = "review_frame"
            elif number == 1 and p and o and m + o + c + r >= 2:
                want = "learning_probe"
            else:
                want = "exclusion" if x else "no_claim"
            assert row["d"]["reason"] == want
            assert (row["d"]["decision"] == "include") == (want not in ("exclusion", "no_claim"))


def test_rescue(spark, rows):
    names = ("p", "m", "o", "c", "x", "r", "review", "claim")
    for row in flag_table(rows, names).select("flags.*", triage.rescue_verdict().alias("d")).collect():
        p, m, o, c, x, r, review, claim = (row[n] for n in names)
        positive = p and ((m and o) or claim)
        if x and not positive:
            want = (False, "high", "excluded")
        elif positive:
            want = (True, "medium", "claim")
        elif p and c and (m or o):
            want = (True, "low", "comparator")
        elif review and p and (m or o or r):
            want = (True, "low", "review")
        else:
            want = (False, "medium", "no_signal")
        assert (row["d"]["keep"], row["d"]["confidence"], row["d"]["reason"]) == want


def test_adjudicate(spark, rows):
    names = ("x", "direct", "contextual", "comparator")
    for row in flag_table(rows, names).select("flags.*", triage.adjudicate_verdict().alias("d")).collect():
        x, direct, contextual, comparator = (row[n] for n in names)
        if x and not (direct or comparator):
            want = (False, "exclusion_stronger")
        elif direct or contextual or comparator:
            want = (True, "direct" if direct else "contextual" if contextual else "comparator")
        else:
            want = (False, "no_claim")
        assert (row["d"]["keep"], row["d"]["reason"]) == want


PROFILE = [
    ("primary", "akt"),
    ("primary", "liver cancer"),
    ("mechanism", "autophagy"),
    ("mechanism", "akt"),
    ("outcome", "survival"),
    ("comparator", "mtor"),
    ("exclusion", "zebrafish"),
    ("exclusion", "survival"),
    ("review_frame", "history"),
    ("claim", "increases"),
    ("review_term", "systematic review"),
    ("primary", "c++"),
]


def profile(rows):
    return rows([("r", 1, a, b) for a, b in PROFILE], "run_id string, pass_number int, role string, term string")


def flags_of(rows, title, abstract, kinds=("Journal Article",)):
    d = rows([("r", 1, "a", title, abstract, list(kinds))], "run_id string, pass_number int, paper_id string, title string, abstract string, publication_types array<string>")
    return match.paper_flags(d, profile(rows)).first()["flags"]


def test_paper_flags(spark, rows):
    f = flags_of(rows, "Liver  cancer", "Autophagy here. Then survival.")
    assert not f.p and f.m and f.o, "two spaces in the raw text keep the phrase from matching the document"
    f = flags_of(rows, "On liver cancer", "In liver cancer  autophagy increases. Other.")
    assert f.p and f.m and not f.o and f.e and f.claim and f.direct
    f = flags_of(rows, "x", "liver\ncancer and autophagy increases it")
    assert not f.p and f.claim, "a window is squashed, so the phrase is found there"
    f = flags_of(rows, "AKT", "akt increases.")
    assert f.p and f.m and f.claim and not f.direct, "a term of both roles is no mechanism of its own"
    f = flags_of(rows, "C++ tools", "A systematic review.")
    assert f.p and f.review
    assert not flags_of(rows, "xc++", "akt1 pakt").p
    assert flags_of(rows, "", None).p is False


def test_slices_change_nothing(spark, rows, monkeypatch):
    d = rows(
        [("r", 1, str(i), t, a, ["Review"]) for i, (t, a) in enumerate([("On liver cancer", "liver cancer autophagy increases survival."), ("mtor", "zebrafish"), ("", "")])],
        "run_id string, pass_number int, paper_id string, title string, abstract string, publication_types array<string>",
    )
    one = {r.paper_id: r.flags for r in match.paper_flags(d, profile(rows)).collect()}
    monkeypatch.setattr(match.pack_profile, "__defaults__", (match.RUN_KEYS, 3))
    many = {r.paper_id: r.flags for r in match.paper_flags(d, profile(rows)).collect()}
    assert one == many and one["0"].claim


def test_role_sets(spark, rows):
    p = profile(rows)
    assert {r.term for r in match.hard_negative_terms(p).collect()} == {"zebrafish"}
    assert {(r.role, r.term) for r in match.distinct_signal_terms(p).collect()} == {
        ("mechanism", "autophagy"),
        ("outcome", "survival"),
        ("comparator", "mtor"),
    }


TEXTS = {
    "direct": ("On akt", "autophagy and survival in liver cancer increases."),
    "distributed": ("t", "liver cancer autophagy.\nAnd c++ autophagy.\nSurvival."),
    "review_frame": ("t", "liver cancer.\nAutophagy here.\nSurvival.\nHistory."),
    "exclusion": ("t", "zebrafish only"),
    "partial": ("t", "liver cancer only"),
    "weak": ("t", "nothing"),
}


def test_reading_branches(spark, rows):
    prof = rows(
        [("r", 1, a, b) for a, b in PROFILE if b != "akt"],
        "run_id string, pass_number int, role string, term string",
    )
    d = rows(
        [("r", 1, k, t, x) for k, (t, x) in TEXTS.items()],
        "run_id string, pass_number int, paper_id string, title string, raw_text string",
    )
    got = {r.paper_id: r for r in evidence.review_fulltext(d, prof).collect()}
    assert {k: r.fulltext_rationale for k, r in got.items()} == {k: k for k in TEXTS}
    assert got["direct"].supporting_text_locator == "full text: matched liver cancer;autophagy;survival;increases"
    assert got["exclusion"].supporting_text_locator == "exclusion: zebrafish"


def test_word_cut_by_length_is_found(spark, rows):
    """A long line is cut every 800 characters, also inside words."""
    body = "y" * 796 + " zzzakt autophagy survival " + "w" * 100
    d = rows([("r", 1, "a", "", body)], "run_id string, pass_number int, paper_id string, title string, raw_text string")
    r = evidence.review_fulltext(d, profile(rows)).first()
    assert r.fulltext_rationale == "direct", "the second piece starts with akt"


def test_prompt_fit(spark, rows):
    reviews = rows(
        [("r", 1, p, dec, mech, obj, top) for p, dec, mech, obj, top in [
            ("a", "keep", "high", "high", "central"),
            ("b", "keep", "low", "high", "central"),
            ("c", "drop", "low", "low", "incidental"),
            ("d", "keep", "high", "high", "central"),
            ("e", "keep", "high", "high", "central"),
        ]],
        "run_id string, pass_number int, paper_id string, fulltext_decision string, mechanistic_relevance string, objective_relevance string, topic_centrality string",
    )
    ev = rows(
        [("r", 1, "a", "direct", "direct_target", "central", "direct_mechanistic"), ("r", 1, "b", "direct", "direct_target", "central", "x"), ("r", 1, "d", "background", "direct_target", "incidental", "foundational_background")],
        "run_id string, pass_number int, paper_id string, evidence_tier string, directness string, target_centrality string, retention_role string",
    )
    got = {r.paper_id: r.fit for r in evidence.prompt_fit(reviews, ev).collect()}
    assert got == {"a": True, "b": False, "c": True, "d": False, "e": False}


def plainly_matched(text, phrases, stop):
    low, out = text.lower(), set()
    for p in phrases:
        first = [t for t in re.findall("[a-z][a-z0-9+/-]{2,}", p.lower()) if t not in stop][:4]
        if p in low or (first and all(t in low for t in first)):
            out.add(p)
    return out


@pytest.mark.parametrize("few, block", [(1_000, 10**6), (0, 10**6), (0, 700)])
def test_phrases(spark, rows, monkeypatch, few, block):
    """In the row, by one index, by several."""
    monkeypatch.setattr(phrases, "BLOCK_CHARS", block)
    rng = random.Random(few + block)
    base = ["alpha", "beta", "gamma", "al", "x", "é", "the", "alphabet", "a+b", "c/d-e", "\U0001F600", "then", "beta-gamma"]
    texts = [" ".join(rng.choices(base, k=rng.randrange(0, 12))) for _ in range(150)] + ["", "The ALPHA beta", "é" * 40, "alpha beta gamma al x " * 9]
    listed = [" ".join(rng.choices(base, k=rng.randrange(1, 9))) for _ in range(120)]
    listed += [" x ", "ALPHA", "alpha", "é" * 30, "é" * 16, "é" * 17, "then then then then nowhere", "alpha beta gamma al x " * 3]
    d = rows([*enumerate(texts), (900, None), (5, texts[5])], "phrase_no int, text string")
    p = rows([(t,) for t in listed] + [("",), (None,), ("alpha",)], "phrase string")
    got = sorted((r.phrase_no, r.phrase) for r in phrases.match_phrases(d, F.col("text"), p, ("the",), few).collect())
    want = [(i, x) for i, t in [*enumerate(texts), (5, texts[5])] for x in plainly_matched(t, set(listed), {"the"})]
    assert got == sorted(want)


def test_a_worker_holds_no_found_phrases(spark, rows):
    """Every text holds every long phrase: 4.8 GB of phrases in one batch of texts."""
    d = rows([(i, "some alpha and beta") for i in range(300)], "i int, text string").coalesce(1)
    p = rows([(i,) for i in range(2_000)], "i int").select(F.concat(F.lit("alpha beta "), "i", F.repeat(F.lit("é"), 4_000)).alias("phrase"))
    got = phrases.match_phrases(d, F.col("text"), p, ("and",)).groupBy("i").agg(F.count("*").alias("n"), F.sum(F.length("phrase")).alias("c")).collect()
    assert len(got) == 300 and {r.n for r in got} == {2_000} and {r.c for r in got} == {2_000 * 4_011 + 6_890}


@pytest.mark.parametrize("chars", [10**6, 12])
def test_phrases_in_small_blocks(spark, rows, monkeypatch, chars):
    """Many blocks of few phrases, in one group and in several; few columns kept."""
    for k, v in {"BLOCK_CHARS": chars, "BLOCK_BYTES": 300, "AT_ONCE": 2, "SLICE_MET": 7, "GIVEN_ROWS": 5, "SLICE_FOUND": 10}.items():
        monkeypatch.setattr(phrases, k, v)
    rng = random.Random(chars)
    base = ["alpha", "beta", "gamma", "al", "x", "é", "the", "c/d-e", "\U0001F600", "then"]
    texts = [" ".join(rng.choices(base, k=rng.randrange(0, 9))) for _ in range(60)] + [None, ""]
    listed = sorted({" ".join(rng.choices(base, k=rng.randrange(1, 6))) for _ in range(25)} | {"ALPHA", "é" * 9, "x" * 400})
    d, p = rows([(i, "z", t) for i, t in enumerate(texts)], "i int, more string, text string"), rows([(t,) for t in listed], "phrase string")
    found = phrases.match_phrases(d, F.col("text"), p, ("the",), 0, keep=["more", "i"])
    assert found.columns == ["more", "i", "phrase"]
    assert sorted((r.i, r.phrase) for r in found.collect()) == sorted((i, x) for i, t in enumerate(texts) if t is not None for x in plainly_matched(t, listed, {"the"}))


def test_found_phrases_take_little_disk(spark, rows, tmp_path):
    """300,000 rows with 6,000 phrases of 267 bytes."""
    d = rows([(i, "some alpha and beta") for i in range(50)], "i int, text string").coalesce(1)
    number = F.concat(*[F.translate(F.md5(F.concat("i", F.lit(f" {k}"))), "abcdef", "012345") for k in range(8)])
    p = rows([(i,) for i in range(6_000)], "i int").select(F.concat(F.lit("alpha beta "), number).alias("phrase"))
    phrases.match_phrases(d, F.col("text"), p, ("and",)).select("i", "phrase").write.parquet(f"{tmp_path}/found")
    assert spark.read.parquet(f"{tmp_path}/found").count() == 300_000
    assert sum(f.stat().st_size for f in (tmp_path / "found").glob("*.parquet")) < 10_000_000


def test_no_phrases(spark, rows):
    d = rows([(1, "alpha")], "i int, text string")
    for few in (0, 5):
        assert phrases.match_phrases(d, F.col("text"), rows([], "phrase string"), (), few).collect() == []
