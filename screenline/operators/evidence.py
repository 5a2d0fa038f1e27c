"""Reading full texts: decision, evidence row, rescue of drops, and what the
terms of kept and dropped papers teach the next pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenline.functions.fields import top_terms
from screenline.functions.text import text_of
from screenline.operators.match import (
    RUN_KEYS,
    SCOPE_ROLES,
    clean_profile,
    document_positive,
    fulltext_flags,
    top_terms_per,
)

# One outcome per branch of the reading, in order of strength.
OUTCOMES = {
    "direct": ("keep", "high", "high", "central", "high", "direct", "run_declared_mechanism", "direct_target", "central", "none", "direct_mechanistic"),
    "distributed": ("keep", "medium", "medium", "supporting", "medium", "indirect", "distributed_fulltext_signal", "pathway_or_context", "supporting", "none", "direct_mechanistic"),
    "review_frame": ("keep", "medium", "medium", "supporting", "medium", "background", "review_frame_context", "pathway_or_context", "supporting", "none", "foundational_background"),
    "exclusion": ("drop", "low", "low", "incidental", "medium", "exclude", "off_scope_or_deferred_context", "incidental", "incidental", "tighten_query", "exclude"),
    "partial": ("drop", "low", "medium", "supporting", "medium", "background", "weak_or_partial_overlap", "pathway_or_context", "supporting", "reviewer_calibration", "exclude"),
    "weak": ("drop", "low", "low", "incidental", "medium", "exclude", "weak_overlap", "incidental", "incidental", "tighten_query", "exclude"),
}
OUTCOME_FIELDS = (
    "fulltext_decision",
    "mechanistic_relevance",
    "objective_relevance",
    "topic_centrality",
    "review_confidence",
    "evidence_tier",
    "evidence_type",
    "directness",
    "target_centrality",
    "query_feedback_signal",
    "retention_role",
)
REVIEW_FIELDS = OUTCOME_FIELDS[:5]
EVIDENCE_FIELDS = OUTCOME_FIELDS[5:] + OUTCOME_FIELDS[4:5]


def _n(role: str) -> Column:
    return F.size(f"ft.terms_{role}") > 0


def _t(*roles: str) -> Column:
    return F.concat(*[F.col(f"ft.terms_{r}") for r in roles])


def reading_branch() -> Column:
    return (
        F.when(F.col("ft.first_locator").isNotNull(), "direct")
        .when(document_positive(), "distributed")
        .when(_n("primary") & _n("mechanism") & _n("outcome") & _n("review_frame"), "review_frame")
        .when(_n("negative"), "exclusion")
        .when(_n("primary") | (_n("mechanism") & _n("comparator")), "partial")
        .otherwise("weak")
    )


def _locator() -> Column:
    """Where the decisive terms are: a window, or the document's own list."""

    def listed(label: str, terms: Column, n: int) -> Column:
        return F.concat(F.lit(f"{label}: "), F.array_join(F.slice(terms, 1, n), ";"))

    b = F.col("branch")
    return (
        F.when(
            b == "direct",
            F.concat(F.col("ft.first_locator"), F.lit(": matched "), F.array_join(F.col("ft.first_terms"), ";")),
        )
        .when(b == "distributed", listed("document", _t("primary", "mechanism", "outcome", "comparator"), 10))
        .when(b == "review_frame", listed("review frame", _t("primary", "mechanism", "outcome", "review_frame"), 8))
        .when(b == "exclusion", listed("exclusion", F.col("ft.terms_negative"), 6))
        .when(b == "partial", listed("matched", _t("primary", "mechanism", "comparator"), 8))
        .otherwise("weak overlap")
    )


def review_fulltext(
    texts: DataFrame,
    profile: DataFrame,
    id_cols: Sequence[str] = ("paper_id",),
    keys: Sequence[str] = RUN_KEYS,
    keep_terms: bool = False,
) -> DataFrame:
    """Full texts (title, raw_text) with every review and evidence field; the
    rationale is a reason code. ``keep_terms`` also keeps the matched terms
    per role, from which ``reading_pairs`` learns without a second reading."""
    d = fulltext_flags(texts, profile, id_cols, keys).withColumn("branch", reading_branch())
    names = list(OUTCOMES)
    table = F.create_map(
        *[
            x
            for b in names
            for x in (F.lit(b), F.struct(*[F.lit(v).alias(f) for f, v in zip(OUTCOME_FIELDS, OUTCOMES[b])]))
        ]
    )
    d = d.withColumn("_o", F.element_at(table, F.col("branch")))
    rest = [c for c in texts.columns if c not in OUTCOME_FIELDS + ("fulltext_rationale",)]
    return d.select(
        *rest,
        *[F.col(f"_o.{f}").alias(f) for f in OUTCOME_FIELDS],
        F.col("branch").alias("fulltext_rationale"),
        _locator().alias("supporting_text_locator"),
        *[c.alias(n) for n, c in learning_note().items()],
        (F.size("ft.terms_negative") > 0).alias("negative_found"),
        *([F.col(f"ft.terms_{r}").alias(f"terms_{r}") for r in SCOPE_ROLES] if keep_terms else []),
    )


def reading_pairs(reviewed: DataFrame, id_cols: Sequence[str] = ("paper_id",), keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """Matched (paper, role, term) of a reading that kept its terms."""
    per_role = F.array(*[F.struct(F.lit(r).alias("role"), F.col(f"terms_{r}").alias("terms")) for r in SCOPE_ROLES])
    d = reviewed.select(*keys, *id_cols, F.explode(per_role).alias("m"))
    return d.select(*keys, *id_cols, "m.role", F.explode("m.terms").alias("term"))


def learning_note() -> dict[str, Column]:
    """What the paper teaches: a signal and the first terms of each role."""
    keep = F.col("_o.fulltext_decision") == "keep"
    signal = (
        F.when(keep, "retain")
        .when(F.col("_o.query_feedback_signal") == "reviewer_calibration", "calibrate_reviewer")
        .otherwise("demote_or_exclude")
    )
    parts = [
        F.concat(F.lit(f"{r}="), top_terms(F.col(f"ft.terms_{r}"), 4))
        for r in ("primary", "mechanism", "outcome", "comparator")
    ]
    more = F.when(
        signal == "demote_or_exclude", F.concat(F.lit("; exclusion="), top_terms(F.col("ft.terms_exclusion"), 4))
    ).otherwise("")
    implication = (
        F.when(keep, "retain_terms")
        .when(F.col("_o.query_feedback_signal") == "reviewer_calibration", "tighten_reviewer_rules")
        .otherwise("demote_terms")
    )
    return {
        "topic_learning_signal": signal,
        "scientific_note": F.concat(F.concat_ws("; ", *parts), more),
        "next_query_implication": implication,
    }


EVIDENCE_COLUMNS = (
    "paper_id",
    "evidence_tier",
    "evidence_type",
    "directness",
    "target_centrality",
    "supporting_text_locator",
    "query_feedback_signal",
    "review_confidence",
    "retention_role",
    "scientific_note",
    "topic_learning_signal",
    "next_query_implication",
)


def extract_evidence(reviewed: DataFrame, keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    return reviewed.select(*keys, *EVIDENCE_COLUMNS)


def rescue_fulltext(
    reviews: DataFrame,
    texts: DataFrame,
    profile: DataFrame,
    id_cols: Sequence[str] = ("paper_id",),
    keys: Sequence[str] = RUN_KEYS,
) -> DataFrame:
    """Read every dropped paper once more. One row per drop: confirmed or
    overturned. ``reviews`` may come from anyone; ``texts`` has the payloads."""
    ids = [*keys, *id_cols]
    drops = reviews.where(F.trim("fulltext_decision") == "drop").select(
        *ids, F.col("fulltext_rationale").alias("original_fulltext_rationale")
    )
    # A drop with no readable payload is read as an empty text.
    mine = drops.join(texts.select(*ids, "title", "raw_text"), ids, "left")
    again = review_fulltext(mine, profile, id_cols, keys)
    keep = F.col("fulltext_decision") == "keep"
    return again.select(
        *ids,
        "title",
        F.lit("drop").alias("original_fulltext_decision"),
        "original_fulltext_rationale",
        F.when(keep, "overturn_to_keep").otherwise("confirm_drop").alias("rescue_decision"),
        F.col("fulltext_decision").alias("final_fulltext_decision"),
        F.col("fulltext_rationale").alias("rescue_rationale"),
        keep.alias("positive_signal_found"),
        (keep & F.col("negative_found")).alias("negative_signal_overridden"),
        "supporting_text_locator",
        "review_confidence",
        *[c for c in OUTCOME_FIELDS if c not in ("fulltext_decision", "review_confidence")],
    )


def apply_rescue(reviews: DataFrame, rescued: DataFrame, id_cols: Sequence[str] = ("paper_id",), keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """Reviews after rescue: overturned drops take the new decision."""
    ids = [*keys, *id_cols]
    won = rescued.where("rescue_decision = 'overturn_to_keep'").select(
        *ids, *[F.col("final_fulltext_decision" if c == "fulltext_decision" else c).alias(f"_{c}") for c in REVIEW_FIELDS]
    )
    d = reviews.join(won, ids, "left")
    return d.select(
        *[F.coalesce(f"_{c}", c).alias(c) if c in REVIEW_FIELDS else F.col(c) for c in reviews.columns]
    )


def learn_terms(pairs: DataFrame, decisions: DataFrame, id_cols: Sequence[str] = ("paper_id",), keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """Document frequency per bucket and term. ``pairs`` are matched (paper,
    role, term); ``decisions`` tell keep or drop. Kept papers count their
    primary and mechanism terms as direct and comparator and review-frame
    terms as supporting; dropped papers count every scope term as noise.
    A term with two roles counts once per paper and bucket."""
    ids = [*keys, *id_cols]
    scope = pairs.where(F.col("role").isin(*SCOPE_ROLES))
    kept = F.col("fulltext_decision") == "keep"
    bucket = (
        F.when(kept & F.col("role").isin("primary", "mechanism"), "direct")
        .when(kept & F.col("role").isin("comparator", "review_frame"), "supporting")
        .when(~kept, "noise")
    )
    d = scope.join(decisions.select(*ids, "fulltext_decision"), ids).withColumn("bucket", bucket)
    once = d.where("bucket is not null").select(*ids, "bucket", "term").distinct()
    return once.groupBy(*keys, "bucket", "term").agg(F.count("*").alias("papers"))


# How many terms of each bucket a feedback row carries.
FEEDBACK_LIMITS = {"direct": 12, "supporting": 12, "noise": 10, "missing": 10}
FALLBACK_ROLES = {
    "direct": ("primary", "mechanism"),
    "supporting": ("review_frame", "comparator"),
    "noise": ("exclusion",),
    "missing": ("mechanism",),
}


def feedback(learned: DataFrame, reviews: DataFrame, profile: DataFrame) -> DataFrame:
    """One row per run and pass. A bucket with no learned term falls back to
    the profile's terms, longest first; later passes end the deferral of file
    requests."""
    keys = list(RUN_KEYS)
    base = reviews.groupBy(*keys).agg(F.count("*").alias("source_paper_count"))
    ranked = top_terms_per(
        learned.select(*keys, "bucket", "term", F.col("papers").alias("n")), [*keys, "bucket"], 12
    )
    got = ranked.groupBy(*keys, "bucket").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda s: s["term"]).alias("terms")
    )
    p = clean_profile(profile)
    spare = None
    for bucket, roles in FALLBACK_ROLES.items():
        part = p.where(F.col("role").isin(*roles)).select(*keys, F.lit(bucket).alias("bucket"), "term").distinct()
        spare = part if spare is None else spare.unionByName(part)
    # The rank by length is the fallback's order; it needs no counts.
    spare = top_terms_per(spare.withColumn("n", F.length("term")), [*keys, "bucket"], 12)
    spare = spare.groupBy(*keys, "bucket").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda s: s["term"]).alias("spare")
    )
    both = spare.join(got, [*keys, "bucket"], "full_outer").select(
        *keys, "bucket", F.coalesce("terms", "spare").alias("terms")
    )
    wide = both.groupBy(*keys).agg(
        *[
            F.slice(F.coalesce(F.max(F.when(F.col("bucket") == b, F.col("terms"))), F.array().cast("array<string>")), 1, n).alias(b)
            for b, n in FEEDBACK_LIMITS.items()
        ]
    )
    d = base.join(wide, keys, "left")
    text = {b: F.array_join(text_list(b), "; ") for b in FEEDBACK_LIMITS}
    said = {b: F.when(text[b] == "", "none").otherwise(text[b]) for b in FEEDBACK_LIMITS}
    return d.select(
        *keys,
        F.concat(F.lit("loop_"), F.lpad(F.col("pass_number").cast("string"), 3, "0")).alias("loop_id"),
        "source_paper_count",
        text["direct"].alias("direct_mechanisms"),
        text["supporting"].alias("supporting_mechanisms"),
        text["direct"].alias("retained_keyword_families"),
        text["noise"].alias("noise_keyword_families"),
        text["missing"].alias("missing_keyword_families"),
        F.lit("pair_primary_with_mechanism").alias("recommended_query_changes"),
        F.lit("require_primary_plus_evidence").alias("recommended_abstract_rule_changes"),
        F.concat_ws("; ", *[F.concat(F.lit(f"{b}="), said[b]) for b in FEEDBACK_LIMITS]).alias("topic_learning"),
        F.when(F.col("pass_number") >= 2, "final_pdf_pass").otherwise("defer_pdfs").alias("pdf_deferral_decision"),
    )


def text_list(c: str) -> Column:
    return F.coalesce(F.col(c), F.array().cast("array<string>"))


# Evidence that carries a kept paper in the final phase.
STRONG_TIERS = ("direct", "indirect", "comparator")
CONTEXT_ROLES = ("foundational_background", "field_synthesis", "perspective_gap", "exclude")


def prompt_fit(reviews: DataFrame, evidence: DataFrame, keys: Sequence[str] = RUN_KEYS) -> DataFrame:
    """Add ``fit``: papers not kept pass; kept papers need relevance and at
    least one strong evidence row."""
    ids = [*keys, "paper_id"]
    t = lambda c: F.trim(text_of(F.col(c)))
    strong = t("evidence_tier").isin(*STRONG_TIERS) & (t("target_centrality") != "incidental")
    near = t("directness").isin("direct_target", "same_family_comparator") & ~t("retention_role").isin(*CONTEXT_ROLES)
    backed = evidence.groupBy(*ids).agg(F.bool_or(strong | near).alias("_backed"))
    d = reviews.join(backed, ids, "left")
    low = (t("objective_relevance") == "low") | (t("mechanistic_relevance") == "low") | (t("topic_centrality") == "incidental")
    fit = (t("fulltext_decision") != "keep") | (~low & F.coalesce("_backed", F.lit(False)))
    return d.withColumn("fit", fit).drop("_backed")


def weak_keeps(reviews: DataFrame, evidence: DataFrame) -> DataFrame:
    return prompt_fit(reviews, evidence).where(~F.col("fit")).drop("fit")


def weak_keep_signals(reviews: DataFrame, evidence: DataFrame) -> DataFrame:
    """Per run, pass and feedback signal the evidence rows of weak keeps, and
    the first ten papers."""
    keys = list(RUN_KEYS)
    weak = weak_keeps(reviews, evidence).select(*keys, "paper_id").distinct()
    rows = evidence.join(weak, [*keys, "paper_id"], "left_semi")
    rows = rows.select(*keys, F.trim(text_of(F.col("query_feedback_signal"))).alias("signal"), "paper_id")
    n = rows.groupBy(*keys, "signal").agg(F.count("*").alias("n"))
    ids = rows.distinct().select(*keys, "signal", F.col("paper_id").alias("term"), F.lit(0).alias("n"))
    first = top_terms_per(ids, [*keys, "signal"], 10).groupBy(*keys, "signal").agg(
        F.array_sort(F.collect_list("term")).alias("examples")
    )
    return n.join(first, [*keys, "signal"])
