"""Term matching: which terms of which role a text holds, in the document and
in its sentence windows.

Everything happens inside the row. A profile is packed to arrays (one row per
run and pass, or several when it is large) and joined to the papers; words are
met by set intersection with the tokens of the text, phrases by substring. No
text is shuffled and no pair of paper and term is ever materialised.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenline.functions.text import (
    PRESCREEN_TOKEN,
    TRIAGE_TOKEN,
    evidence_windows,
    has_chunk,
    squash,
    text_of,
    tokens,
    windows,
    words,
)
from screenline.session import fits

# Roles a term can have in a run's scope contract. "claim" and
# "review_term" are word lists the caller supplies alongside the contract.
SCOPE_ROLES = ("primary", "mechanism", "outcome", "comparator", "exclusion", "review_frame")
ROLES = SCOPE_ROLES + ("claim", "review_term")

RUN_KEYS = ("run_id", "pass_number")
# Terms of one run held in one packed row. A larger profile gives more rows.
PACK_TERMS = 20_000
# Packed profiles of at most this many terms, over all runs, are broadcast.
BROADCAST_TERMS = 200_000


def clean_profile(profile: DataFrame, keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    term = squash(F.lower(F.col("term")))
    return profile.select(*keys, "role", term.alias("term")).where(F.col("term") != "").distinct()


def distinct_signal_terms(profile: DataFrame, keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """Mechanism terms not primary, outcome terms in neither, comparator terms
    not primary; four characters or more."""
    p = clean_profile(profile, keys)
    blocked = {"mechanism": ["primary"], "outcome": ["primary", "mechanism"], "comparator": ["primary"]}
    rank = F.when(F.col("role") == "primary", 0).when(F.col("role") == "mechanism", 1).otherwise(2)
    wanted = p.where(F.col("role").isin(*blocked) & (F.length("term") >= 4))
    higher = p.where(F.col("role").isin("primary", "mechanism")).groupBy(*keys, "term").agg(
        F.max(F.col("role") == "primary").alias("is_primary"), F.max(rank == 1).alias("is_mechanism")
    )
    hit = wanted.join(higher, [*keys, "term"], "left")
    free = ~F.coalesce("is_primary", F.lit(False)) & ~(
        (F.col("role") == "outcome") & F.coalesce("is_mechanism", F.lit(False))
    )
    return hit.where(free).select(*keys, "role", "term")


def hard_negative_terms(profile: DataFrame, keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """Exclusion terms that no other scope role declares."""
    p = clean_profile(profile, keys).where(F.col("role").isin(*SCOPE_ROLES))
    others = p.where("role <> 'exclusion'").select(*keys, "term").distinct()
    return p.where("role = 'exclusion'").join(others, [*keys, "term"], "left_anti").select(*keys, "role", "term")


def role_union(profile: DataFrame, roles: Sequence[str], keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    return clean_profile(profile, keys).where(F.col("role").isin(*roles)).select(*keys, "term").distinct()


def role_minus(profile: DataFrame, role: str, others: Sequence[str], keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    keep = role_union(profile, [role], keys)
    return keep.join(role_union(profile, others, keys), [*keys, "term"], "left_anti")


def pack_profile(
    profile: DataFrame, keys: Sequence[str] = RUN_KEYS, terms_per_row: int = PACK_TERMS
) -> tuple[DataFrame, int, list[str]]:
    """Packed profile, its number of slices, and the roles with phrases: one
    row per run, pass and slice with, per role, the words and the phrases
    (``<role>_words``, ``<role>_loose``). The slice of a term depends on its
    hash, so a term is in one slice only, with every role it has. The table is
    marked for broadcast when its terms are few enough."""
    p = clean_profile(profile, keys)
    # Review words match as plain substrings, whatever they look like.
    plain = F.col("term").rlike("^[a-z0-9+/-]+$") & (F.col("role") != "review_term")
    p = p.withColumn("_plain", plain)
    per_run = p.groupBy(*keys).agg(
        F.count("*").alias("n"), F.collect_set(F.when(~F.col("_plain"), F.col("role"))).alias("loose")
    )
    sizes = per_run.agg(F.max("n"), F.sum("n"), F.flatten(F.collect_set("loose"))).first()
    loose = [r for r in ROLES if r in set(sizes[2] or [])]
    slices = max(1, -(-(sizes[0] or 0) // terms_per_row))
    p = p.withColumn("slice", F.pmod(F.xxhash64("term"), F.lit(slices)).cast("int"))
    term = F.col("term")
    aggs = [F.collect_set(F.when((F.col("role") == r) & F.col("_plain"), term)).alias(f"{r}_words") for r in ROLES]
    aggs += [F.collect_set(F.when((F.col("role") == r) & ~F.col("_plain"), term)).alias(f"{r}_loose") for r in loose]
    packed = p.groupBy(*keys, "slice").agg(*aggs)
    return (F.broadcast(packed) if (sizes[1] or 0) <= BROADCAST_TERMS else packed), slices, loose


def _loose_test(text: Column, role: str):
    """Test of one phrase, for use in a filter."""
    if role == "review_term":
        return lambda t: F.contains(text, t)
    return lambda t: _loose_in(text, t)


def _loose_in(text: Column, term: Column) -> Column:
    """Phrases match as substrings, odd single words between non-word
    characters."""
    guarded = F.concat(F.lit("(?<![A-Za-z0-9+/-])\\Q"), term, F.lit("\\E(?![A-Za-z0-9+/-])"))
    return F.when(F.contains(term, F.lit(" ")), F.contains(text, term)).otherwise(F.rlike(text, guarded))


def ordered(terms: Column) -> Column:
    """Longest first, then alphabetic."""
    keyed = F.transform(terms, lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t")))
    return F.transform(F.array_sort(keyed), lambda s: s["t"])


def _candidates(df: DataFrame, profile: DataFrame, keys, id_cols, token_col: str, text_col: str):
    """Add, per role, the profile's words among the tokens and its phrases
    inside the text (``_cand_<role>_words``, ``_cand_<role>_loose``). One
    packed row per run keeps it in the row; a profile of several slices is
    merged by id and text, null ids too. Returns the table and the roles that have phrases."""
    packed, slices, loose = pack_profile(profile, keys)
    if loose and text_col == "_flat":
        df = df.withColumn("_flat", squash(F.col("_full")))
    rows = df
    if slices > 1:
        df = df.withColumn("_of", F.xxhash64(token_col, text_col))
        id_cols = list(dict.fromkeys([*keys, *id_cols, "_of"]))
        # Rows with one id and text are looked at once.
        rows = df.select(*dict.fromkeys([*id_cols, token_col, text_col])).dropDuplicates(id_cols)
    joined = rows.join(packed, list(keys), "left")
    none = F.array().cast("array<string>")
    found = {
        f"_cand_{r}_words": F.array_intersect(F.coalesce(F.col(f"{r}_words"), none), F.col(token_col)) for r in ROLES
    }
    for r in loose:
        found[f"_cand_{r}_loose"] = F.filter(F.coalesce(F.col(f"{r}_loose"), none), _loose_test(F.col(text_col), r))
    out = joined.select(*rows.columns, *[c.alias(n) for n, c in found.items()])
    if slices == 1:
        return out, loose
    merged = out.groupBy(*id_cols).agg(*[F.flatten(F.collect_list(c)).alias(c) for c in found])
    named = merged.select(*[F.col(c).alias(f"_m_{c}") for c in id_cols], *found)
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(named[f"_m_{c}"]) for c in id_cols])
    return df.join(named, same, "left").drop("_of", *[f"_m_{c}" for c in id_cols]), loose


def _kinds(loose: Sequence[str], role: str) -> list[str]:
    return ["words", "loose"] if role in loose else ["words"]


def _terms(kind: str, role: str, loose: Sequence[str]) -> Column:
    parts = [F.col(f"_{kind}_{role}_{k}") for k in _kinds(loose, role)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _number(kind: str, role: str, loose: Sequence[str]) -> Column:
    out = F.size(f"_{kind}_{role}_words")
    return out + F.size(f"_{kind}_{role}_loose") if role in loose else out


def _hit_columns(loose: Sequence[str]) -> dict[str, Column]:
    """Candidates that hold in the whole text as it stands: phrases were met
    in the squashed text, where they hold a little more often."""
    out = {f"_hit_{r}_words": F.col(f"_cand_{r}_words") for r in ROLES}
    for r in loose:
        out[f"_hit_{r}_loose"] = F.filter(F.col(f"_cand_{r}_loose"), _loose_test(F.col("_full"), r))
    return out


def _holds(w: Column, kind: str, role: str, loose: Sequence[str]) -> Column:
    """Does a window struct (w text, t tokens) hold one of the terms? The size
    tests also keep the term arrays as columns of their own, so that they are
    computed once per row and not once per window."""
    found = (F.size(f"_{kind}_{role}_words") > 0) & F.arrays_overlap(F.col(f"_{kind}_{role}_words"), w["t"])
    if role in loose:
        phrases = F.col(f"_{kind}_{role}_loose")
        found = found | ((F.size(phrases) > 0) & F.exists(phrases, lambda p: _loose_in(w["w"], p)))
    return found


def _window_hits(w: Column, role: str, loose: Sequence[str]) -> Column:
    """Ordered terms of the role in one window text."""
    found = F.array_intersect(F.col(f"_cand_{role}_words"), words(w))
    if role in loose:
        found = F.concat(found, F.filter(F.col(f"_cand_{role}_loose"), lambda p: _loose_in(w, p)))
    return ordered(found)


def match_terms(
    df: DataFrame, text: Column, profile: DataFrame, id_cols: Sequence[str] = ("paper_id",), keys: Sequence[str] = RUN_KEYS
) -> DataFrame:
    """Per row the ordered matched terms of each scope role, as ``terms_<role>``."""
    low = F.lower(text_of(text))
    base = df.withColumn("_text", low).withColumn("_tok", words(F.col("_text")))
    found, loose = _candidates(base, profile, keys, [*keys, *id_cols], "_tok", "_text")
    return found.select(
        *df.columns, *[ordered(_terms("cand", r, loose)).alias(f"terms_{r}") for r in SCOPE_ROLES + ("claim",)]
    )


def matched_pairs(
    df: DataFrame, text: Column, profile: DataFrame, id_cols: Sequence[str] = ("paper_id",), keys: Sequence[str] = RUN_KEYS
) -> DataFrame:
    """``match_terms`` in long form: one row per paper, role and term."""
    wide = match_terms(df.select(*keys, *id_cols, text.alias("_t0")), F.col("_t0"), profile, id_cols, keys)
    pairs = F.array(
        *[
            F.struct(F.lit(r).alias("role"), F.col(f"terms_{r}").alias("terms"))
            for r in SCOPE_ROLES + ("claim",)
        ]
    )
    one = wide.select(*keys, *id_cols, F.explode(pairs).alias("m"))
    return one.select(*keys, *id_cols, "m.role", F.explode("m.terms").alias("term"))


def paper_flags(
    papers: DataFrame, profile: DataFrame, id_cols: Sequence[str] = ("paper_id",), keys: Sequence[str] = RUN_KEYS
) -> DataFrame:
    """Add ``flags`` to papers with title, abstract and publication_types.

    Document level: p m o c x r e (a term of the role occurs), review.
    Window level: claim (p and m and (o or e) in one window) and, on the
    profile's distinct signal terms, direct, contextual, comparator.
    """
    ids = [*keys, *id_cols]
    full = F.lower(F.concat(text_of(F.col("title")), F.lit("\n"), text_of(F.col("abstract"))))
    base = papers.withColumn("_full", full).withColumn("_tok", words(F.col("_full")))
    d, loose = _candidates(base, profile, keys, ids, "_tok", "_flat")
    d = d.withColumns({**_hit_columns(loose), **own_columns(loose)})
    any_of = {r: _number("hit", r, loose) > 0 for r in ROLES}
    cand = {r: _number("cand", r, loose) > 0 for r in ROLES}
    gate = cand["primary"] & (cand["mechanism"] | cand["claim"] | cand["comparator"])
    wins = F.transform(
        windows(F.col("title"), F.col("abstract")), lambda w: F.struct(w.alias("w"), words(w).alias("t"))
    )
    primary_wins = F.filter(wins, lambda w: _holds(w, "cand", "primary", loose))
    per_window = F.transform(
        primary_wins,
        lambda w: F.struct(
            _holds(w, "cand", "mechanism", loose).alias("m"),
            _holds(w, "cand", "outcome", loose).alias("o"),
            _holds(w, "cand", "claim", loose).alias("e"),
            _holds(w, "own", "mechanism", loose).alias("m2"),
            _holds(w, "own", "outcome", loose).alias("o2"),
            _holds(w, "own", "comparator", loose).alias("c2"),
        ),
    )
    d = d.withColumn("_win", F.when(gate, per_window))

    def some(test) -> Column:
        return F.coalesce(F.exists(F.col("_win"), test), F.lit(False))

    direct = lambda w: w["m2"] & (w["o2"] | w["e"])
    flags = F.struct(
        any_of["primary"].alias("p"),
        any_of["mechanism"].alias("m"),
        any_of["outcome"].alias("o"),
        any_of["comparator"].alias("c"),
        any_of["exclusion"].alias("x"),
        any_of["review_frame"].alias("r"),
        any_of["claim"].alias("e"),
        is_review(F.col("publication_types"), any_of["review_term"]).alias("review"),
        some(lambda w: w["m"] & (w["o"] | w["e"])).alias("claim"),
        some(direct).alias("direct"),
        some(lambda w: ~direct(w) & w["e"] & (w["m2"] | w["o2"])).alias("contextual"),
        some(lambda w: w["c2"] & (w["m2"] | w["o2"] | w["e"])).alias("comparator"),
    )
    return d.select(*papers.columns, flags.alias("flags"))


def is_review(publication_types: Column, review_word_found: Column) -> Column:
    kinds = F.lower(F.array_join(publication_types, ";"))
    return F.coalesce(kinds.contains("review"), F.lit(False)) | review_word_found


def own_columns(loose: Sequence[str]) -> dict[str, Column]:
    """The candidates that are distinct signals (see distinct_signal_terms)."""
    out = {}
    blocked = {"mechanism": ["primary"], "outcome": ["primary", "mechanism"], "comparator": ["primary"]}
    for role, others in blocked.items():
        for k in _kinds(loose, role):
            c = F.filter(F.col(f"_cand_{role}_{k}"), lambda t: F.length(t) >= 4)
            for b in others:
                if k in _kinds(loose, b):
                    c = F.array_except(c, F.col(f"_cand_{b}_{k}"))
            out[f"_own_{role}_{k}"] = c
    return out


def fulltext_flags(
    texts: DataFrame, profile: DataFrame, id_cols: Sequence[str] = ("paper_id",), keys: Sequence[str] = RUN_KEYS
) -> DataFrame:
    """Add ``ft`` to full texts with title and raw_text: role flags and ordered
    hits of the document, the first direct window, counts of supporting
    windows and the title's own flags."""
    ids = [*keys, *id_cols]
    title, body = text_of(F.col("title")), F.lower(text_of(F.col("raw_text")))
    base = texts.withColumn("_body", body)
    base = base.withColumn("_full", F.concat(F.lower(title), F.lit("\n"), F.col("_body")))
    base = base.withColumn(
        "_wins",
        F.transform(
            evidence_windows(title, F.col("_body")),
            lambda w: F.struct(w["locator"].alias("locator"), w["window"].alias("w"), words(w["window"]).alias("t")),
        ),
    )
    # A line cut by length can end inside a word, and the piece is then a word
    # of its own, so the pieces' words join the document's.
    base = base.withColumn("_cut", has_chunk(F.col("_body")))
    base = base.withColumn("_doctok", words(F.col("_full")))
    base = base.withColumn(
        "_tok",
        F.when(F.col("_cut"), F.array_union(F.col("_doctok"), F.flatten(F.transform("_wins", lambda w: w["t"]))))
        .otherwise(F.col("_doctok")),
    )
    d, loose = _candidates(base, profile, keys, ids, "_tok", "_flat")
    hits = _hit_columns(loose)
    for r in ROLES:
        w = F.col(f"_cand_{r}_words")
        hits[f"_hit_{r}_words"] = F.when(F.col("_cut"), F.array_intersect(w, F.col("_doctok"))).otherwise(w)
    d = d.withColumns(hits)
    d = d.withColumn(
        "_marks",
        F.transform(
            F.col("_wins"),
            lambda w: F.struct(
                _holds(w, "cand", "primary", loose).alias("p"),
                _holds(w, "cand", "mechanism", loose).alias("m"),
                (_holds(w, "cand", "outcome", loose) | _holds(w, "cand", "claim", loose)).alias("oe"),
            ),
        ),
    )
    first = F.array_position(F.transform("_marks", lambda x: x["p"] & x["m"] & x["oe"]), True)
    d = d.withColumn("_first", F.when(first > 0, F.get(F.col("_wins"), (first - 1).cast("int"))))
    hit = {r: ordered(_terms("hit", r, loose)) for r in SCOPE_ROLES + ("claim",)}
    has_title = F.length(title) > 0
    mark0 = F.get(F.col("_marks"), F.lit(0))
    negatives = _terms("hit", "exclusion", loose)
    for r in SCOPE_ROLES:
        if r != "exclusion":
            negatives = F.array_except(negatives, _terms("hit", r, loose))
    first_hits = F.concat(*[_window_hits(F.col("_first.w"), r, loose) for r in ("primary", "mechanism", "outcome", "claim")])
    ft = F.struct(
        *[v.alias(f"terms_{k}") for k, v in hit.items()],
        ordered(negatives).alias("terms_negative"),
        F.col("_first.locator").alias("first_locator"),
        F.when(F.col("_first").isNotNull(), F.slice(first_hits, 1, 8)).alias("first_terms"),
        F.size(F.filter("_marks", lambda x: x["p"] & (x["m"] | x["oe"]))).alias("supporting_windows"),
        (has_title & mark0["p"]).alias("title_p"),
        (has_title & mark0["m"]).alias("title_m"),
        (has_title & mark0["oe"]).alias("title_oe"),
    )
    return d.select(*texts.columns, ft.alias("ft"))


def document_positive(ft: str = "ft") -> Column:
    """Distributed evidence: every needed role in the document, and a telling
    title or two supporting windows."""
    n = lambda r: F.size(f"{ft}.terms_{r}") > 0
    whole = n("primary") & n("mechanism") & (n("outcome") | n("claim"))
    title_p = F.col(f"{ft}.title_p")
    return whole & (
        (title_p & (F.col(f"{ft}.title_m") | F.col(f"{ft}.title_oe")))
        | (F.col(f"{ft}.supporting_windows") >= 2)
        | (title_p & n("comparator") & (n("mechanism") | n("outcome")))
    )


def overlap_terms(df: DataFrame, topic: DataFrame, text: Column, stop: Sequence[str] = ()) -> DataFrame:
    """Add ``overlap``: sorted tokens of the text that are topic terms of the
    run (tables of (run_id, pass_number, term), 80 terms by default)."""
    packed = topic.groupBy(*RUN_KEYS).agg(F.collect_set("term").alias("_topic"))
    # The bound is on terms, whatever the number of runs and passes.
    packed = F.broadcast(packed) if fits(topic, BROADCAST_TERMS) else packed
    found = df.withColumn("_tok", F.array_distinct(tokens(text, stop, PRESCREEN_TOKEN))).join(packed, list(RUN_KEYS), "left")
    both = F.array_sort(F.array_intersect("_tok", F.coalesce("_topic", F.array().cast("array<string>"))))
    return found.withColumn("overlap", both).drop("_tok", "_topic")


def phrase_matches(text: Column, phrases: Column, stop: Sequence[str] = ()) -> Column:
    """Phrases that are in the text, or whose first four tokens all are."""
    low = F.lower(text)

    def found(p: Column) -> Column:
        first4 = F.slice(tokens(p, stop), 1, 4)
        return F.contains(low, p) | ((F.size(first4) > 0) & F.forall(first4, lambda t: F.contains(low, t)))

    return F.filter(phrases, found)


def frequent_terms(
    df: DataFrame,
    text: Column,
    n: int,
    keys: Sequence[str] = RUN_KEYS,
    stop: Sequence[str] = (),
    pattern: str = TRIAGE_TOKEN,
) -> DataFrame:
    """Top n tokens per run by count, ties alphabetic."""
    counts = (
        df.select(*keys, F.explode(tokens(text, stop, pattern)).alias("term"))
        .groupBy(*keys, "term")
        .agg(F.count("*").alias("n"))
    )
    return top_terms_per(counts, keys, n)


def top_terms_per(counts: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Rows (keys, term, n, rank) of the n most counted terms per key. The
    rank filter is a literal, so each task keeps at most n rows per key before
    the shuffle."""
    w = W.partitionBy(*keys).orderBy(F.desc("n"), F.asc("term"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


# How many frequent words stand in for undeclared primary terms.
FALLBACK_PRIMARY = 20


def build_profile(declared: DataFrame, frequent: DataFrame, keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """Profile (run, pass, role, term) from a contract's declared terms. A run
    that declares no primary terms takes its 20 most frequent words; with no
    mechanism, the other frequent words; with no outcome, the mechanism terms.
    ``frequent`` is (run, pass, term, rank)."""
    ks = list(keys)
    d = declared.select(*ks, "role", "term").distinct()
    runs = frequent.select(*ks).distinct()
    has = d.groupBy(*ks).agg(*[F.count_if(F.col("role") == r).alias(f"_{r}") for r in ("primary", "mechanism", "outcome")])
    runs = runs.join(has, ks, "left").na.fill(0)
    f = frequent.select(*ks, "term", "rank").join(runs, ks)
    spare = f.where((F.col("_primary") == 0) & (F.col("rank") <= FALLBACK_PRIMARY))
    primary = d.where("role = 'primary'").unionByName(spare.select(*ks, F.lit("primary").alias("role"), "term"))
    rest = f.where("_mechanism = 0").join(primary.select(*ks, "term"), [*ks, "term"], "left_anti")
    mechanism = d.where("role = 'mechanism'").unionByName(rest.select(*ks, F.lit("mechanism").alias("role"), "term"))
    no_outcome = runs.where("_outcome = 0").select(*ks)
    copied = mechanism.join(no_outcome, ks, "left_semi").select(*ks, F.lit("outcome").alias("role"), "term")
    others = d.where(~F.col("role").isin("primary", "mechanism"))
    return primary.unionByName(mechanism).unionByName(others).unionByName(copied)
