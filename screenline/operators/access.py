"""Access to what is still unread: the request shortlist, the reading list and
the decision whether to ask for files at all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenline.functions.fields import access_status, feedback_phrases_of, int_setting, stored_name, text_setting
from screenline.functions.text import is_blank, strip, text_of
from screenline.operators.match import RUN_KEYS, phrase_matches
from screenline.operators.ranking import latest_row
from screenline.session import small

IDS = (*RUN_KEYS, "paper_id")

# Feedback columns that carry learned and noise phrases. Rule
# changes are reason codes here, so they are no phrases to look for.
LEARNED_FIELDS = (
    "direct_mechanisms",
    "supporting_mechanisms",
    "retained_keyword_families",
    "missing_keyword_families",
)
NOISE_FIELDS = ("noise_keyword_families",)


def enrich(rows: DataFrame, manifest: DataFrame, triage: DataFrame, keys: Sequence[str] = IDS) -> DataFrame:
    """Left lookups of the manifest's and the triage table's columns."""
    m = manifest.select(*keys, *[c for c in ("year", "publication_types", "source_query", "abstract") if c in manifest.columns])
    t = triage.select(*keys, "second_pass_decision", "promotion_decision")
    return rows.join(m, list(keys), "left").join(t, list(keys), "left")


def ready_runs(feedback: DataFrame, settings: DataFrame | None = None) -> DataFrame:
    """Runs in the final access phase: enough feedback rows and the latest of
    them ends the deferral. Columns run_id and the latest feedback's fields."""
    n = feedback.groupBy("run_id").agg(F.count("*").alias("_loops"))
    last = latest_row(feedback, ["run_id"], ["pass_number", "loop_id"])
    d = last.join(n, "run_id")
    need = F.lit(2)
    if settings is not None:
        d = d.join(settings.select("run_id", "settings"), "run_id", "left")
        need = F.greatest(F.lit(2), F.coalesce(int_setting(F.col("settings"), "min_big_workflow_loops", 2), F.lit(2)))
        d = d.withColumn("_need", need).drop("settings")
        need = F.col("_need")
    ok = (F.col("_loops") >= need) & (F.trim("pdf_deferral_decision") == "final_pdf_pass")
    return d.where(ok).select(*feedback.columns)


def shortlist(
    queue: DataFrame,
    manifest: DataFrame,
    triage: DataFrame,
    feedback: DataFrame,
    run_terms: DataFrame,
    stop: Sequence[str] = (),
) -> DataFrame:
    """Rank the queue by learned, noise and run phrases in title, abstract and
    source query. ``run_terms`` is (run_id, term, rank). Only runs in the
    final access phase with learned phrases have a shortlist."""
    ready = ready_runs(feedback)
    learned = feedback_phrases_of([F.col(c) for c in LEARNED_FIELDS if c in feedback.columns], stop)
    noise = feedback_phrases_of([F.col(c) for c in NOISE_FIELDS if c in feedback.columns], stop)
    terms = run_terms.groupBy("run_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda s: s["term"]).alias("_run_terms")
    )
    per_run = ready.select("run_id", learned.alias("_learned"), noise.alias("_noise")).join(terms, "run_id", "left")
    per_run = per_run.where(F.size("_learned") > 0)
    d = enrich(queue, manifest, triage).join(small(per_run), "run_id")
    text = F.concat_ws("\n", *[text_of(F.col(c)) for c in ("title", "abstract", "source_query")])
    none = F.array().cast("array<string>")
    d = d.withColumn("_text", text).withColumns(
        {
            "_l": phrase_matches(F.col("_text"), F.col("_learned"), stop),
            "_n": phrase_matches(F.col("_text"), F.col("_noise"), stop),
            "_u": phrase_matches(F.col("_text"), F.coalesce("_run_terms", none), stop),
        }
    )
    nl, nn, nu = F.size("_l"), F.size("_n"), F.size("_u")

    def out(priority: str, decision: str, category: str, matched: Column, reason: str) -> Column:
        return F.struct(
            F.lit(priority).alias("priority"),
            F.lit(decision).alias("decision"),
            F.lit(category).alias("category"),
            matched.alias("matched"),
            F.lit(reason).alias("reason"),
        )

    first = lambda arr, n: F.array_join(F.slice(arr, 1, n), "; ")
    v = (
        F.when((nn > 0) & (nl == 0), out("exclude", "do_not_request", "noise", first(F.col("_n"), 8), "noise"))
        .when(
            text_of(F.col("promotion_decision")) != "advance_to_import",
            out("exclude", "do_not_request", "noise", F.lit("not_advanced"), "not_advanced"),
        )
        .when(
            (nl >= 2) & (nu > 0),
            out("high", "request_pdf", "strong_learned_match", first(F.concat("_l", "_u"), 10), "strong_learned_match"),
        )
        .when(nl > 0, out("medium", "request_pdf", "possible_learned_match", first(F.col("_l"), 10), "possible_learned_match"))
        .when((nu > 0) & (nn == 0), out("low", "request_pdf", "access_uncertain", first(F.col("_u"), 8), "run_terms_only"))
        .otherwise(out("low", "defer_pdf", "access_uncertain", F.lit("none"), "no_match"))
    )
    d = d.withColumn("_v", v)
    return d.select(
        *IDS,
        "pmid",
        "doi",
        "title",
        "year",
        "publication_types",
        F.col("_v.priority").alias("priority"),
        F.col("_v.decision").alias("shortlist_decision"),
        F.col("_v.category").alias("evidence_category"),
        F.col("_v.matched").alias("learned_criteria_matched"),
        F.col("_v.reason").alias("shortlist_rationale"),
        "source_query",
        "second_pass_decision",
        "promotion_decision",
    )


# Columns of the request list.
REQUEST_FIELDS = (
    "paper_id",
    "pmid",
    "doi",
    "title",
    "year",
    "publication_types",
    "priority",
    "evidence_category",
    "learned_criteria_matched",
    "shortlist_rationale",
)


def request_list(short: DataFrame, feedback: DataFrame) -> DataFrame:
    """The shortlist rows to be asked for, once a run's latest feedback says so."""
    last = latest_row(feedback, ["run_id"], ["pass_number", "loop_id"])
    final = last.where("pdf_deferral_decision = 'final_pdf_pass'").select("run_id")
    d = short.where("shortlist_decision = 'request_pdf'").join(small(final), "run_id", "left_semi")
    return d.select(*RUN_KEYS, *REQUEST_FIELDS)


def final_reading_list(
    reviews: DataFrame, manifest: DataFrame, triage: DataFrame, imports: DataFrame, settings: DataFrame
) -> DataFrame:
    """Kept papers, and outside the learning phase the advanced papers whose
    text could not be read. ``settings`` is (run_id, access_phase)."""
    ids = list(IDS)
    m = manifest.select(*ids, "year", "publication_types")
    kept = reviews.where("fulltext_decision = 'keep'")
    cols = ("pmid", "pmcid", "doi", "title")
    a = kept.join(m, ids, "left").select(
        *ids,
        *cols,
        "year",
        "publication_types",
        F.lit("selected_for_reading").alias("final_decision"),
        F.col("fulltext_rationale").alias("final_rationale"),
        F.lit("fulltext_review").alias("selection_basis"),
        F.lit("readable").alias("fulltext_access_status"),
        "normalized_source_type",
        "normalized_path",
        "review_confidence",
    )
    phase = settings.select("run_id", "access_phase")
    adv = triage.where("promotion_decision = 'advance_to_import'").where(~is_blank(F.col("paper_id")))
    adv = adv.join(small(phase), "run_id", "left")
    adv = adv.where(F.coalesce("access_phase", F.lit("pmc_learning")) != "pmc_learning")
    adv = adv.select(*ids, "second_pass_rationale", "second_pass_confidence").join(kept.select(*ids), ids, "left_anti")
    unread = imports.where(is_blank(F.col("normalized_path")))
    status = access_status(F.col("normalized_path"), F.col("pdf_import_status"))
    reason = F.concat_ws(" ", F.nullif(strip(text_of(F.col("second_pass_rationale"))), F.lit("")), F.lit("fulltext_not_readable"))
    b = adv.join(unread.select(*ids, *cols, "pdf_import_status", "normalized_path"), ids).join(m, ids, "left")
    b = b.select(
        *ids,
        *cols,
        "year",
        "publication_types",
        F.lit("abstract_relevant_fulltext_unavailable").alias("final_decision"),
        reason.alias("final_rationale"),
        F.lit("abstract_triage_only").alias("selection_basis"),
        status.alias("fulltext_access_status"),
        F.lit("missing").alias("normalized_source_type"),
        F.lit("").alias("normalized_path"),
        F.col("second_pass_confidence").alias("review_confidence"),
    )
    return a.unionByName(b)


def access_decision(settings: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per run. ``settings`` is (run_id, settings map), ``counts`` is
    (run_id, queue_count, loop_count, latest_decision, has_shortlist)."""
    d = settings.select("run_id", "settings").join(counts, "run_id", "left")
    s = F.col("settings")
    policy = text_setting(s, "pdf_policy", "pause_for_user")
    learning = text_setting(s, "access_phase", "pmc_learning") == "pmc_learning"
    need = F.greatest(F.lit(2), int_setting(s, "min_big_workflow_loops", 2))
    loops = F.coalesce("loop_count", F.lit(0))
    ready = (
        (loops >= need)
        & F.coalesce(F.col("latest_decision") == "final_pdf_pass", F.lit(False))
        & F.coalesce("has_shortlist", F.lit(False))
    )
    required = policy == "require_fulltext_completion"
    status = (
        F.when(F.coalesce("queue_count", F.lit(0)) == 0, "not_needed")
        .when(learning & ~ready & ~required, "deferred_for_pmc_learning")
        .when((loops < need) & ~required, "deferred_for_pmc_learning")
        .when(policy == "pause_for_user", "paused_for_user")
        .when(required, "awaiting_pdf")
        .otherwise("continue_without_pdf")
    )
    action = (
        F.when(F.col("status") == "not_needed", "continue_fulltext_review")
        .when(F.col("status") == "deferred_for_pmc_learning", "continue_pmc_learning")
        .when(F.col("status") == "awaiting_pdf", "provide_pdfs_then_continue")
        .otherwise("continue_pmc_only")
    )
    return d.select("run_id", status.alias("status"), ready.alias("final_shortlist_ready")).withColumn(
        "recommended_action", action
    )


def merge_reports(new: DataFrame, old: DataFrame, imports: DataFrame, root: str = "PDF") -> DataFrame:
    """The import report after another round: the new rows, the old rows of
    papers not in it that are still staged, and staged imports in neither."""
    ids = list(IDS)
    staged = imports.where("pdf_import_status = 'staged_from_user_download'").where(~is_blank(F.col("paper_id")))
    still = old.join(new.select(*ids), ids, "left_anti").join(staged.select(*ids), ids, "left_semi")
    rest = staged.join(new.select(*ids), ids, "left_anti").join(old.select(*ids), ids, "left_anti")
    rest = rest.select(
        *ids,
        "pmid",
        "doi",
        "title",
        F.lit("staged").alias("import_status"),
        F.lit("").alias("match_method"),
        F.lit(None).cast("double").alias("match_score"),
        F.lit("").alias("source_filename"),
        F.concat(F.lit(f"{root}/"), stored_name(F.col("pmid"), F.col("paper_id"))).alias("staged_pdf_path"),
        F.lit("kept_from_earlier").alias("notes"),
    )
    return new.unionByName(still).unionByName(rest)
