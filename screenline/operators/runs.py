"""Where each run stands: counts, gates, what to do next."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenline.functions.fields import int_setting, ratio, text_setting
from screenline.functions.text import is_blank, strip, text_of
from screenline.operators.evidence import weak_keeps
from screenline.operators.match import RUN_KEYS
from screenline.operators.quality import (
    coverage_counts,
    gate_open,
    in_final_phase,
    pass_readiness,
    readiness_reasons,
    strict_runs,
    union_all,
)
from screenline.operators.ranking import latest_row
from screenline.schemas import REVISION_LEARNING, REVISION_PATHS
from screenline.session import small

KEYS = list(RUN_KEYS)
Tables = Mapping[str, DataFrame]


def status_counts(state: DataFrame, status: str = "latest_status", keys: Sequence[str] = ("run_id",)) -> DataFrame:
    return state.groupBy(*keys, status).agg(F.count("*").alias("n"))


Counted = tuple[DataFrame, Mapping[str, Column | None]]


def _tagged(specs: Sequence[Counted], keys: Sequence[str], ids: bool) -> DataFrame:
    """Rows of all tables under each other, a 0/1 column per count; a count
    with no test counts every row of its table."""
    names = [n for _, tests in specs for n in tests]
    parts = []
    for df, tests in specs:
        one = {n: F.lit(1) if t is None else F.coalesce(t, F.lit(False)).cast("int") for n, t in tests.items()}
        cols = [one.get(n, F.lit(0)).alias(n) for n in names]
        pid = strip(text_of(F.col("paper_id"))) if "paper_id" in df.columns else F.lit("")
        parts.append(df.select(*keys, *([pid.alias("paper_id")] if ids else []), *cols))
    return union_all(parts)


def counted(specs: Sequence[Counted], keys: Sequence[str]) -> DataFrame:
    """Counts over many tables per key in one aggregation: each task adds up
    its rows of any table, so a single small exchange serves them all."""
    names = [n for _, tests in specs for n in tests]
    return _tagged(specs, keys, False).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


def paper_marks(specs: Sequence[Counted], keys: Sequence[str] = KEYS) -> DataFrame:
    """Per paper how many rows of each kind it has, over all stage tables."""
    names = [n for _, tests in specs for n in tests]
    return _tagged(specs, keys, True).groupBy(*keys, "paper_id").agg(*[F.sum(n).alias(n) for n in names])


def run_counts(tables: Tables, keys: Sequence[str] = KEYS) -> DataFrame:
    """The report's counts, per run and pass."""
    c = F.col
    request = c("shortlist_decision") == "request_pdf"
    specs = [
        (tables["paper_manifest"], {"papers_retrieved": None}),
        (tables["first_pass"], {"abstract_includes": c("first_pass_decision") == "include"}),
        (
            tables["second_pass"],
            {
                "advance_to_import": c("promotion_decision") == "advance_to_import",
                "stopped": c("promotion_decision") == "stop",
            },
        ),
        (
            tables["import_status"],
            {
                "text_usable": c("pmc_parse_status") == "usable",
                "text_unusable": c("pmc_parse_status") == "unusable",
                "no_automated_access": c("pmc_access_status") == "missing",
                "pdf_needed": c("pdf_needed").cast("string").isin("yes", "true"),
                "pdf_normalized": c("pdf_import_status") == "normalized",
                "normalized_total": ~is_blank(c("normalized_path")),
            },
        ),
        (tables["fulltext_review"], {"fulltext_keep": c("fulltext_decision") == "keep"}),
        (
            tables["final_reading_list"],
            {"relevant_unreadable": c("final_decision") == "abstract_relevant_fulltext_unavailable"},
        ),
        (
            tables["pdf_download_shortlist"],
            {"pdf_requests": request, "pdf_requests_high": request & (c("priority") == "high")},
        ),
    ]
    return counted(specs, keys)


def tier_counts(evidence: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return evidence.groupBy(*keys, "evidence_tier").agg(F.count("*").alias("n"))


def shortlist_counts(short: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return short.groupBy(*keys, "priority", "shortlist_decision").agg(F.count("*").alias("n"))


QUEUE_ALERT = 0.50


def queue_rate(queue: DataFrame, imports: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Share of imports waiting for a file, and whether that is too many."""
    d = counted([(imports, {"imports": None}), (queue, {"queued": None})], keys)
    r = ratio(F.col("queued"), F.col("imports"))
    return d.withColumn("queue_rate", r).withColumn("alert", (F.col("imports") > 0) & (F.col("queue_rate") > QUEUE_ALERT))


def snapshot_counts(tables: Tables, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per run and pass, to be appended when a pass is put away."""
    c = F.col
    specs = [
        (tables["paper_manifest"], {"paper_manifest_rows": None}),
        (tables["second_pass"], {"advance_to_import": c("promotion_decision") == "advance_to_import"}),
        (tables["import_status"], {"import_status_rows": None}),
        (
            tables["fulltext_review"],
            {"fulltext_review_rows": None, "fulltext_keep_count": c("fulltext_decision") == "keep"},
        ),
        (tables["manual_pdf_queue"], {"manual_pdf_queue_rows": None}),
        (tables["pmc_mechanism_feedback"], {"completed_big_loop_count": None}),
    ]
    last = latest_row(tables["pmc_mechanism_feedback"], list(keys), ["loop_id"]).select(
        *keys, F.col("loop_id").alias("latest_feedback_loop_id"), F.col("pdf_deferral_decision").alias("latest_pdf_deferral_decision")
    )
    return counted(specs, keys).join(last, list(keys), "left")


def state_summary(tables: Tables, papers: DataFrame, decisions: DataFrame, records: DataFrame) -> DataFrame:
    """Recorded state against the tables, per run and pass, with drift flags."""
    live = decisions.where("status <> 'superseded'")
    d = counted(
        [
            (tables["paper_manifest"], {"manifest_rows": None}),
            (tables["first_pass"], {"first_pass_rows": None}),
            (tables["second_pass"], {"second_pass_rows": None}),
            (records, {"record_rows": None}),
            (live, {"active_decisions": None}),
        ],
        KEYS,
    )
    d = d.withColumn("records_short", F.col("record_rows") < F.col("manifest_rows")).withColumn(
        "decisions_differ", (F.col("active_decisions") > 0) & (F.col("active_decisions") != F.col("second_pass_rows"))
    )
    by_status = papers.groupBy("run_id").agg(
        *[F.count_if(F.col("latest_status") == s).alias(f"papers_{s}") for s in ("collected", "advanced", "rejected", "superseded")]
    )
    return d.join(by_status, "run_id", "left")


# Stages in hand-off order, with what closes each.
STAGES = (
    ("collection_pending", "metadata_collection", "loop_to_query_scout"),
    ("abstract_triage_first_pass_pending", "abstract_triage", "loop_to_abstract_triage"),
    ("abstract_triage_second_pass_pending", "abstract_triage", "loop_to_abstract_triage"),
    ("pmc_import_pending", "fulltext_import", "continue"),
    ("fulltext_review_pending", "fulltext_review", "loop_to_fulltext_review"),
    ("missing_evidence_extraction", "fulltext_review", "loop_to_fulltext_review"),
    ("evidence_extraction_incomplete", "fulltext_review", "loop_to_fulltext_review"),
    ("fulltext_rescue_pending", "fulltext_review", "loop_to_fulltext_review"),
    ("fulltext_rescue_incomplete", "fulltext_review", "loop_to_fulltext_review"),
    ("pmc_feedback_pending", "fulltext_review", "loop_to_fulltext_review"),
)


def _any_blank(*cols: str) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | is_blank(F.col(c))
    return out


def stage_sums(tables: Tables) -> DataFrame:
    """Per run and pass the row and id counts all gates look at: one exchange
    by paper over every stage table, one small one by run. Tables a caller does
    not give count as empty."""
    c = F.col
    decided = strip(text_of(c("fulltext_decision")))
    wanted = [
        ("paper_manifest", {"m": None}),
        ("first_pass", {"a": None, "a_blank": _any_blank("first_pass_decision", "first_pass_confidence", "triage_actor")}),
        (
            "second_pass",
            {
                "b": None,
                "b_blank": _any_blank("second_pass_decision", "second_pass_confidence", "promotion_decision"),
                "adv": strip(text_of(c("promotion_decision"))) == "advance_to_import",
            },
        ),
        ("import_status", {"i": None, "i_text": ~is_blank(c("normalized_path"))}),
        ("fulltext_review", {"r": None, "r_said": decided != "", "r_drop": decided == "drop"}),
        ("evidence_extraction", {"e": None}),
        ("fulltext_rescue", {"s": None}),
        ("pmc_mechanism_feedback", {"f": None}),
        ("manual_pdf_queue", {"q": None}),
        ("pdf_download_shortlist", {"l": None, "l_ask": c("shortlist_decision") == "request_pdf"}),
    ]
    given = [(tables[t], tests) for t, tests in wanted if t in tables]
    marks = paper_marks(given)
    marks = marks.withColumns({n: F.lit(0) for t, tests in wanted if t not in tables for n in tests})
    named = c("paper_id") != ""

    def differ(x: str, y: str) -> Column:
        return F.count_if(named & ((c(x) > 0) != (c(y) > 0)))

    total = lambda n: F.sum(n).cast("long")
    return marks.groupBy(*KEYS).agg(
        total("m").alias("papers"),
        (total("a") - total("m")).alias("first_rows"),
        differ("m", "a").alias("first_ids"),
        total("a_blank").alias("first_blank"),
        (total("b") - total("m")).alias("second_rows"),
        differ("m", "b").alias("second_ids"),
        total("b_blank").alias("second_blank"),
        differ("adv", "i").alias("import_ids"),
        differ("i_text", "r").alias("review_ids"),
        differ("r_said", "e").alias("evidence_ids"),
        F.count_if(named & (c("r_drop") > 0) & (c("s") == 0)).alias("rescue_missing"),
        total("i").alias("imports"),
        total("r").alias("reviews"),
        total("e").alias("evidence"),
        total("r_drop").alias("drops"),
        total("s").alias("rescues"),
        total("f").alias("feedbacks"),
        total("q").alias("queue"),
        total("l").alias("shortlist"),
        total("l_ask").alias("requests"),
    )


def stage_tests(sums: DataFrame, passes: DataFrame) -> DataFrame:
    """Per run and pass one boolean per stage, true while it is open.
    ``passes`` names the runs and passes asked about."""
    d = passes.select(*KEYS).distinct().join(sums, KEYS, "left").na.fill(0)
    c = F.col
    read = (c("reviews") > 0) & (c("evidence") > 0)
    tests = (
        c("papers") == 0,
        (c("first_rows") != 0) | (c("first_ids") > 0) | (c("first_blank") > 0),
        (c("second_rows") != 0) | (c("second_ids") > 0) | (c("second_blank") > 0),
        c("import_ids") > 0,
        c("review_ids") > 0,
        (c("reviews") > 0) & (c("evidence") == 0),
        read & (c("evidence_ids") > 0),
        read & (c("drops") > 0) & (c("rescues") == 0),
        read & (c("rescue_missing") > 0),
        read & (c("feedbacks") == 0),
    )
    return d.select(*KEYS, *[t.alias(s[0]) for s, t in zip(STAGES, tests)])


def open_stages(tables: Tables, passes: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    """Every open stage per run and pass, numbered in hand-off order."""
    d = stage_tests(stage_sums(tables) if sums is None else sums, passes)
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("stage_no"),
                F.lit(s[0]).alias("trigger"),
                F.lit(s[1]).alias("source_stage"),
                F.lit(s[2]).alias("action"),
                F.col(s[0]).alias("open"),
            )
            for n, s in enumerate(STAGES, 1)
        ]
    )
    e = d.select(*KEYS, F.explode(rows).alias("s")).where("s.open")
    return e.select(*KEYS, "s.stage_no", "s.trigger", "s.source_stage", "s.action")


def first_open_stage(tables: Tables, passes: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    d = open_stages(tables, passes, sums)
    return d.groupBy(*KEYS).agg(F.min_by(F.struct("stage_no", "trigger", "source_stage", "action"), "stage_no").alias("s")).select(
        *KEYS, "s.*"
    )


DECISION_COLUMNS = ("trigger", "triggered", "source_stage", "action", "rank")


def _decision(df: DataFrame, rank: int, trigger: str, source: str, action: Column | str, triggered: bool = True) -> DataFrame:
    act = F.lit(action) if isinstance(action, str) else action
    return df.select(
        *KEYS,
        F.lit(trigger).alias("trigger"),
        F.lit(triggered).alias("triggered"),
        F.lit(source).alias("source_stage"),
        act.alias("action"),
        F.lit(rank).alias("rank"),
    )


def review_gate(tables: Tables) -> DataFrame:
    """Open gate between import and evidence, for runs that ask for it."""
    c = coverage_counts(tables["import_status"], tables["fulltext_review"], tables["evidence_extraction"])
    c = strict_runs(c, tables).where(gate_open())
    act = F.when((F.col("unattempted") > 0) | (F.col("unqueued") > 0), "continue").otherwise("loop_to_fulltext_review")
    return _decision(c, 0, "pmc_fulltext_review_gate_incomplete", "fulltext_review", act)


# Signals that point back to the query or to the reading rules.
QUERY_SIGNALS = ("tighten_query", "change_scope", "add_rescue_query")
RULE_SIGNALS = ("reviewer_calibration", "none", "")


def density_gate(tables: Tables) -> DataFrame:
    """Weak keeps in the final phase send the run back to the query, or to the
    reading rules when any of their signals says so."""
    w = weak_keeps(tables["fulltext_review"], tables["evidence_extraction"])
    w = w.join(small(in_final_phase(tables)), "run_id", "left_semi").select(*KEYS, "paper_id").distinct()
    any_ev = tables["evidence_extraction"].select(*KEYS).distinct()
    w = w.join(any_ev, KEYS, "left_semi")
    sig = tables["evidence_extraction"].select(*KEYS, "paper_id", strip(text_of(F.col("query_feedback_signal"))).alias("s"))
    g = w.join(sig, [*KEYS, "paper_id"], "left").groupBy(*KEYS).agg(
        F.coalesce(F.bool_or(F.col("s").isin(*QUERY_SIGNALS)), F.lit(False)).alias("q"),
        F.coalesce(F.bool_or(F.col("s").isin(*RULE_SIGNALS)), F.lit(False)).alias("r"),
    )
    act = F.when(F.col("q") & ~F.col("r"), "loop_to_query_scout").otherwise("loop_to_abstract_triage")
    return _decision(g, 2, "final_prompt_fit_density_not_satisfied", "workflow_control", act)


def run_facts(tables: Tables, passes: DataFrame, sums: DataFrame) -> DataFrame:
    """What the remaining triggers look at, per run and pass. Feedback is
    counted up to the pass asked about."""
    fb = tables["pmc_mechanism_feedback"]
    wants = _any_filled("recommended_query_changes", "noise_keyword_families", "missing_keyword_families")
    p = passes.select(*KEYS).distinct()
    f = fb.select(
        "run_id",
        F.col("pass_number").alias("_pass"),
        "loop_id",
        strip(text_of(F.col("pdf_deferral_decision"))).alias("_said"),
        ((F.col("pdf_deferral_decision") == "defer_pdfs") & wants).alias("_change"),
    )
    upto = p.join(f, "run_id").where(F.col("_pass") <= F.col("pass_number"))
    upto = upto.groupBy(*KEYS).agg(
        F.count("*").alias("all_feedbacks"),
        F.max_by("_said", F.struct("_pass", "loop_id")).alias("latest"),
        F.bool_or(F.col("_change") & (F.col("_pass") == F.col("pass_number"))).alias("query_change"),
    )
    phase = tables["settings"].select(
        "run_id", text_setting(F.col("settings"), "access_phase", "pmc_learning").alias("access_phase")
    )
    d = p.join(sums, KEYS, "left").join(upto, KEYS, "left").join(phase, "run_id", "left")
    return d.na.fill(0).na.fill(False, ["query_change"]).na.fill("", ["latest"]).na.fill("pmc_learning", ["access_phase"])


def _any_filled(*cols: str) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | ~is_blank(F.col(c))
    return out


QUIET = 99


def loop_bounds(settings: DataFrame, least: int = 2, most: int = 2) -> DataFrame:
    """run_id, min_loops and max_loops as each run's settings have them; the
    most is never below the least."""
    low = F.coalesce(int_setting(F.col("settings"), "min_big_workflow_loops", least), F.lit(least))
    high = F.coalesce(int_setting(F.col("settings"), "max_workflow_loops", most), F.lit(most))
    return settings.select("run_id", low.alias("min_loops"), F.greatest(low, high).alias("max_loops"))


def _bounded(f: DataFrame, bounds: DataFrame | None, least: int, most: int) -> tuple[DataFrame, Column, Column]:
    if bounds is None:
        return f, F.lit(least), F.lit(most)
    f = f.join(bounds.select("run_id", "min_loops", "max_loops"), "run_id", "left")
    return f, F.coalesce("min_loops", F.lit(least)), F.coalesce("max_loops", F.lit(most))


def loop_decisions(
    tables: Tables,
    passes: DataFrame,
    min_loops: int = 2,
    max_loops: int = 2,
    bounds: DataFrame | None = None,
    sums: DataFrame | None = None,
) -> DataFrame:
    """Every decision per run and pass, numbered; none gives one "no" row. The
    bounds on loops are those of the run (``loop_bounds``), where given."""
    gate = review_gate(tables)
    sums = stage_sums(tables) if sums is None else sums
    stage = first_open_stage(tables, passes, sums).select(
        *KEYS, "trigger", F.lit(True).alias("triggered"), "source_stage", "action", F.lit(1).alias("rank")
    )
    f = run_facts(tables, passes, sums)
    f = f.join(gate.select(*KEYS, F.lit(True).alias("gate")), KEYS, "left").na.fill(False, ["gate"])
    f, min_loops, max_loops = _bounded(f, bounds, min_loops, max_loops)
    c = F.col
    learning = c("access_phase") != "final_access"
    many = (c("imports") > 0) & (ratio(c("queue"), c("imports")) > QUEUE_ALERT) & learning
    minimum = (c("reviews") > 0) & (c("all_feedbacks") > 0) & (c("all_feedbacks") < min_loops) & ~c("gate")
    has_fb, final = c("feedbacks") > 0, c("latest") == "final_pdf_pass"
    no_fb = many & (c("reviews") > 0) & (c("evidence") > 0) & ~has_fb
    large = many & ~no_fb & has_fb & (c("latest") == "defer_pdfs")
    ready = many & ~no_fb & ~large & has_fb & final & (c("shortlist") > 0)
    rest = [
        (3, "pmc_learning_query_feedback", "fulltext_review", "loop_to_run_guidance_reviser", c("query_change") & learning & ~c("gate"), True),
        (4, "minimum_big_loop_not_satisfied", "fulltext_review", "loop_to_run_guidance_reviser", minimum, True),
        (5, "maximum_big_loop_reached", "workflow_control", "stop_blocked", ~minimum & (c("all_feedbacks") >= max_loops) & ~final, True),
        (6, "missing_pdf_shortlist", "fulltext_import", "build_pdf_shortlist", (c("all_feedbacks") >= min_loops) & has_fb & (c("queue") > 0) & final & (c("shortlist") == 0), True),
        (7, "missing_pmc_mechanism_feedback", "fulltext_review", "loop_to_fulltext_review", no_fb, True),
        (8, "large_pdf_queue_after_pmc_learning", "fulltext_import", "loop_to_run_guidance_reviser", large, True),
        (9, "final_pdf_shortlist_ready", "fulltext_import", "continue", ready, False),
        (10, "missing_evidence_extraction", "fulltext_review", "loop_to_fulltext_review", (c("reviews") > 0) & (c("evidence") == 0), True),
    ]
    found = F.filter(
        F.array(
            *[
                F.when(
                    test,
                    F.struct(
                        F.lit(t).alias("trigger"),
                        F.lit(on).alias("triggered"),
                        F.lit(s).alias("source_stage"),
                        F.lit(a).alias("action"),
                        F.lit(r).alias("rank"),
                    ),
                )
                for r, t, s, a, test, on in rest
            ]
        ),
        lambda x: x.isNotNull(),
    )
    more = f.select(*KEYS, F.explode(found).alias("d")).select(*KEYS, "d.*")
    every = union_all([gate, stage, density_gate(tables), more])
    # Every pass gets a quiet row, which stays only where nothing else does. At
    # most a dozen rows per run and pass are numbered.
    quiet = passes.select(*KEYS).distinct()
    every = every.unionByName(_decision(quiet, QUIET, "no_loop_trigger", "workflow_control", "continue", False))
    n = F.row_number().over(W.partitionBy(*KEYS).orderBy("rank"))
    every = every.withColumn("_n", n).where((F.col("rank") < QUIET) | (F.col("_n") == 1))
    return every.select(*KEYS, F.concat(F.lit("loop_"), F.col("_n").cast("string")).alias("loop_id"), *DECISION_COLUMNS)


def run_state(
    decisions: DataFrame,
    tables: Tables,
    passes: DataFrame,
    min_loops: int = 2,
    max_loops: int = 2,
    bounds: DataFrame | None = None,
    sums: DataFrame | None = None,
) -> DataFrame:
    """One row per run and pass: status, signal and next action; ``bounds`` and
    ``sums`` as for ``loop_decisions``."""
    d = decisions.groupBy(*KEYS).agg(
        F.count_if("triggered").alias("active_loop_count"), F.min_by("action", "rank").alias("_action")
    )
    sums = stage_sums(tables) if sums is None else sums
    f = run_facts(tables, passes, sums).join(d, KEYS, "left").na.fill(0, ["active_loop_count"])
    f, min_loops, max_loops = _bounded(f, bounds, min_loops, max_loops)
    c = F.col
    loops, final = c("all_feedbacks"), c("latest") == "final_pdf_pass"

    def out(status: str, signal: str, action: Column | str) -> Column:
        act = F.lit(action) if isinstance(action, str) else action
        return F.struct(F.lit(status).alias("status"), F.lit(signal).alias("signal"), act.alias("action"))

    read = (c("reviews") > 0) & (loops > 0)
    v = (
        F.when((loops >= max_loops) & ~final, out("blocked", "", "stop_blocked"))
        .when(c("active_loop_count") > 0, out("loop_required", "", c("_action")))
        .when(read & (loops < min_loops), out("loop_required", "", "loop_to_query_scout"))
        .when((c("queue") > 0) & final & (c("shortlist") == 0), out("awaiting_pdf_shortlist", "", "build_pdf_download_shortlist"))
        .when(read & final & (c("queue") > 0), out("complete", "pdf_download_shortlist_ready", "report_final_loop"))
        .when(read & final, out("complete", "no_pdf_queue", "report_final_loop"))
        .when(c("latest") == "defer_pdfs", out("loop_required", "", "loop_to_query_scout"))
        .otherwise(out("running", "", "continue_workflow"))
    )
    phase = F.when((loops >= min_loops) & final, "final_access").otherwise(c("access_phase"))
    return f.withColumn("_v", v).select(
        *KEYS,
        c("_v.status").alias("status"),
        phase.alias("access_phase"),
        c("_v.signal").alias("completion_signal"),
        c("_v.action").alias("next_action"),
        "active_loop_count",
        loops.alias("completed_big_loop_count"),
        min_loops.alias("min_big_workflow_loops"),
        max_loops.alias("max_workflow_loops"),
        c("latest").alias("latest_pdf_deferral_decision"),
        c("queue").alias("manual_pdf_queue_count"),
        c("shortlist").alias("pdf_download_shortlist_count"),
        c("requests").alias("pdf_request_count"),
    )


def revision_of(feedback: DataFrame, revisions: DataFrame) -> DataFrame:
    """Latest feedback per run with the last revision row of its loop."""
    last = latest_row(feedback, ["run_id"], ["pass_number", "loop_id"])
    last = last.select("run_id", "pass_number", "loop_id", "pdf_deferral_decision")
    order = [c for c in ("created_at", "revision_id") if c in revisions.columns]
    rv = revisions.drop("pass_number").withColumnRenamed("feedback_loop_id", "loop_id")
    rv = latest_row(rv, ["run_id", "loop_id"], order).withColumn("has_revision", F.lit(True))
    return last.join(rv, ["run_id", "loop_id"], "left").withColumn("has_revision", F.coalesce("has_revision", F.lit(False)))


def rerun_ready(tables: Tables) -> DataFrame:
    """Per run and pass the reasons why the next pass cannot start yet."""
    d = pass_readiness(tables)
    why = d.select(*KEYS, F.explode(readiness_reasons()).alias("reason"))
    gate = review_gate(tables).select(*KEYS, F.lit("review_gate_open").alias("reason"))
    rv = revision_of(tables["pmc_mechanism_feedback"], tables["run_guidance_revision_log"])
    rv = rv.where("pdf_deferral_decision = 'defer_pdfs'")
    fields = REVISION_PATHS + REVISION_LEARNING
    blank = F.filter(F.array(*[F.when(is_blank(F.col(c)), F.lit(f"revision_blank_{c}")) for c in fields]), lambda x: x.isNotNull())
    some = F.when(~F.col("has_revision"), F.array(F.lit("no_revision"))).otherwise(blank)
    rev = rv.select(*KEYS, F.explode(some).alias("reason"))
    return union_all([why, gate, rev])
