"""Registered queries on run counts, gates and decisions, with SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenline.operators import runs
from screenline.operators.evidence import prompt_fit, weak_keep_signals
from screenline.plans.quality_queries import COVERAGE, READY, WEAK
from screenline.plans.registry import Registry
from screenline.plans.stages import ctes, passes, stage_tables
from screenline.schemas import REVISION_LEARNING, REVISION_PATHS
from screenline.session import cut

query = Registry()
S = "WITH " + ctes()
KEYS = ["run_id", "pass_number"]


def _count(table: str, **tests: str) -> str:
    cols = ", ".join(f"count(*) FILTER (WHERE {t}) AS {n}" for n, t in tests.items())
    return f"(SELECT run_id, pass_number, {cols} FROM {table} GROUP BY ALL)"


def _joined(cols: list[str], *parts: str) -> str:
    out = " FULL JOIN ".join(p if not i else f"{p} USING (run_id, pass_number)" for i, p in enumerate(parts))
    return "SELECT run_id, pass_number, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in cols) + " FROM " + out


_RC = {
    "paper_manifest": {"papers_retrieved": "true"},
    "first_pass": {"abstract_includes": "first_pass_decision = 'include'"},
    "second_pass": {"advance_to_import": "promotion_decision = 'advance_to_import'", "stopped": "promotion_decision = 'stop'"},
    "import_status": {
        "text_usable": "pmc_parse_status = 'usable'",
        "text_unusable": "pmc_parse_status = 'unusable'",
        "no_automated_access": "pmc_access_status = 'missing'",
        "pdf_needed": "pdf_needed = 'yes'",
        "pdf_normalized": "pdf_import_status = 'normalized'",
        "normalized_total": "normalized_path <> ''",
    },
    "fulltext_review": {"fulltext_keep": "fulltext_decision = 'keep'"},
    "final_reading_list": {"relevant_unreadable": "final_decision = 'abstract_relevant_fulltext_unavailable'"},
    "pdf_download_shortlist": {
        "pdf_requests": "shortlist_decision = 'request_pdf'",
        "pdf_requests_high": "shortlist_decision = 'request_pdf' AND priority = 'high'",
    },
}


@query("run_counts", S + "\n" + _joined([n for t in _RC.values() for n in t], *[_count(t, **c) for t, c in _RC.items()]))
def _(spark, sf):
    return runs.run_counts(stage_tables(spark, sf, *_RC))


@query("tier_counts", S + " SELECT run_id, pass_number, evidence_tier, count(*) AS n FROM evidence_extraction GROUP BY ALL")
def _(spark, sf):
    return runs.tier_counts(stage_tables(spark, sf, "evidence_extraction")["evidence_extraction"])


@query("shortlist_counts", S + " SELECT run_id, pass_number, priority, shortlist_decision, count(*) AS n FROM pdf_download_shortlist GROUP BY ALL")
def _(spark, sf):
    return runs.shortlist_counts(stage_tables(spark, sf, "pdf_download_shortlist")["pdf_download_shortlist"])


@query(
    "queue_rate",
    S
    + " SELECT *, CASE WHEN imports = 0 THEN 0.0 ELSE queued / imports END AS queue_rate, imports > 0 AND queued / imports > 0.5 AS alert FROM ("
    + _joined(["imports", "queued"], _count("import_status", imports="true"), _count("manual_pdf_queue", queued="true"))
    + ")",
)
def _(spark, sf):
    t = stage_tables(spark, sf, "manual_pdf_queue", "import_status")
    return runs.queue_rate(t["manual_pdf_queue"], t["import_status"])


_SNAP = {
    "paper_manifest": {"paper_manifest_rows": "true"},
    "second_pass": {"advance_to_import": "promotion_decision = 'advance_to_import'"},
    "import_status": {"import_status_rows": "true"},
    "fulltext_review": {"fulltext_review_rows": "true", "fulltext_keep_count": "fulltext_decision = 'keep'"},
    "manual_pdf_queue": {"manual_pdf_queue_rows": "true"},
    "pmc_mechanism_feedback": {"completed_big_loop_count": "true"},
}


@query(
    "snapshot_counts",
    S
    + " SELECT c.*, f.loop_id AS latest_feedback_loop_id, f.pdf_deferral_decision AS latest_pdf_deferral_decision FROM ("
    + _joined([n for t in _SNAP.values() for n in t], *[_count(t, **c) for t, c in _SNAP.items()])
    + ") c LEFT JOIN pmc_mechanism_feedback f USING (run_id, pass_number)",
)
def _(spark, sf):
    return runs.snapshot_counts(stage_tables(spark, sf, *_SNAP))


@query(
    "state_summary",
    S
    + " SELECT *, record_rows < manifest_rows AS records_short, active_decisions > 0 AND active_decisions <> second_pass_rows AS decisions_differ FROM ("
    + _joined(
        ["manifest_rows", "first_pass_rows", "second_pass_rows", "record_rows", "active_decisions"],
        _count("paper_manifest", manifest_rows="true"),
        _count("first_pass", first_pass_rows="true"),
        _count("second_pass", second_pass_rows="true"),
        _count("fulltext_review", record_rows="true"),
        _count("pass_decisions", active_decisions="true"),
    )
    + ") LEFT JOIN (SELECT run_id, count(*) FILTER (WHERE pass_number = 1) AS papers_collected, count(*) FILTER (WHERE pass_number = 2) AS papers_rejected, CAST(0 AS BIGINT) AS papers_advanced, CAST(0 AS BIGINT) AS papers_superseded FROM paper_manifest GROUP BY run_id) USING (run_id)",
)
def _(spark, sf):
    t = stage_tables(spark, sf, "paper_manifest", "first_pass", "second_pass", "fulltext_review", "pass_decisions")
    state = t["paper_manifest"].select("run_id", F.when(F.col("pass_number") == 1, "collected").otherwise("rejected").alias("latest_status"))
    return runs.state_summary(t, state, t["pass_decisions"], t["fulltext_review"])


_STAGE_TABLES = (
    "paper_manifest",
    "first_pass",
    "second_pass",
    "import_status",
    "fulltext_review",
    "evidence_extraction",
    "fulltext_rescue",
    "pmc_mechanism_feedback",
)


def _cover(a: str, b: str, n: int, blank: str | None = None, rows: bool = False) -> str:
    """Runs and passes where the ids of a and b differ (or rows, or blanks)."""
    k = "run_id, pass_number, paper_id"
    sub = lambda x: f"SELECT {k} FROM {x}"
    out = f"SELECT run_id, pass_number, {n} AS stage_no FROM (({sub(a)} EXCEPT {sub(b)}) UNION ALL ({sub(b)} EXCEPT {sub(a)}))"
    if rows:
        c = "SELECT run_id, pass_number, count(*) AS {0} FROM {1} GROUP BY ALL"
        out += f" UNION ALL SELECT run_id, pass_number, {n} FROM ({c.format('x', a)}) FULL JOIN ({c.format('y', b)}) USING (run_id, pass_number) WHERE coalesce(x, 0) <> coalesce(y, 0)"
    if blank:
        out += f" UNION ALL SELECT run_id, pass_number, {n} FROM {b} WHERE {blank}"
    return out


_RE = "(SELECT run_id, pass_number FROM fulltext_review INTERSECT SELECT run_id, pass_number FROM evidence_extraction)"
OPEN = f"""adv AS (SELECT * FROM second_pass WHERE promotion_decision = 'advance_to_import'),
readable AS (SELECT * FROM import_status WHERE normalized_path <> ''), done AS (SELECT * FROM fulltext_review WHERE fulltext_decision <> ''),
dropped AS (SELECT * FROM fulltext_review WHERE fulltext_decision = 'drop'),
open AS (SELECT DISTINCT run_id, CAST(pass_number AS INTEGER) AS pass_number, stage_no FROM (
  {_cover('paper_manifest', 'first_pass', 2, "trim(coalesce(first_pass_decision, '')) = '' OR coalesce(first_pass_confidence, '') = ''", True)} UNION ALL
  {_cover('paper_manifest', 'second_pass', 3, "second_pass_decision = ''", True)} UNION ALL
  {_cover('adv', 'import_status', 4)} UNION ALL {_cover('readable', 'fulltext_review', 5)} UNION ALL
  SELECT run_id, pass_number, 6 FROM fulltext_review WHERE (run_id, pass_number) NOT IN (SELECT run_id, pass_number FROM evidence_extraction) UNION ALL
  SELECT * FROM ({_cover('done', 'evidence_extraction', 7)}) WHERE (run_id, pass_number) IN {_RE} UNION ALL
  SELECT run_id, pass_number, 8 FROM dropped WHERE (run_id, pass_number) NOT IN (SELECT run_id, pass_number FROM fulltext_rescue) AND (run_id, pass_number) IN {_RE} UNION ALL
  SELECT run_id, pass_number, 9 FROM (SELECT run_id, pass_number, paper_id FROM dropped EXCEPT SELECT run_id, pass_number, paper_id FROM fulltext_rescue) WHERE (run_id, pass_number) IN {_RE} UNION ALL
  SELECT run_id, pass_number, 10 FROM {_RE} WHERE (run_id, pass_number) NOT IN (SELECT run_id, pass_number FROM pmc_mechanism_feedback))),
names(stage_no, trigger, source_stage, action) AS (VALUES {", ".join(f"({n}, '{s[0]}', '{s[1]}', '{s[2]}')" for n, s in enumerate(runs.STAGES, 1))}),
first_open AS (SELECT run_id, pass_number, min(stage_no) AS stage_no FROM open GROUP BY ALL)"""


@query("open_stages", S + f",\n{OPEN} SELECT run_id, pass_number, stage_no, trigger, source_stage, action FROM open JOIN names USING (stage_no)")
def _(spark, sf):
    return runs.open_stages(stage_tables(spark, sf, *_STAGE_TABLES), passes(spark, sf))


@query("first_open_stage", S + f",\n{OPEN} SELECT run_id, pass_number, stage_no, trigger, source_stage, action FROM first_open JOIN names USING (stage_no)")
def _(spark, sf):
    return runs.first_open_stage(stage_tables(spark, sf, *_STAGE_TABLES), passes(spark, sf))


_GATE = """gate AS (SELECT run_id, CAST(pass_number AS INTEGER) AS pass_number, CASE WHEN unattempted > 0 OR unqueued > 0 THEN 'continue' ELSE 'loop_to_fulltext_review' END AS action
  FROM cov WHERE run_id <> 'de' AND (unattempted > 0 OR unqueued > 0 OR missing_review > 0 OR missing_evidence > 0))"""


@query("review_gate", S + f",\n{COVERAGE}, {_GATE} SELECT run_id, pass_number, 'pmc_fulltext_review_gate_incomplete' AS trigger, action FROM gate")
def _(spark, sf):
    t = stage_tables(spark, sf, "import_status", "fulltext_review", "evidence_extraction", "settings")
    return runs.review_gate(t).select(*KEYS, "trigger", "action")


_DENSE = """dense AS (SELECT w.run_id, CAST(w.pass_number AS INTEGER) AS pass_number,
  CASE WHEN bool_or(coalesce(e.query_feedback_signal IN ('tighten_query', 'change_scope', 'add_rescue_query'), false)) AND NOT bool_or(coalesce(e.query_feedback_signal IN ('reviewer_calibration', 'none', ''), false))
  THEN 'loop_to_query_scout' ELSE 'loop_to_abstract_triage' END AS action FROM weak w LEFT JOIN evidence_extraction e USING (run_id, pass_number, paper_id)
  WHERE w.run_id IN (SELECT run_id FROM final_runs) GROUP BY ALL)"""


@query("density_gate", S + f",\n{WEAK}, {_DENSE} SELECT run_id, pass_number, 'final_prompt_fit_density_not_satisfied' AS trigger, action FROM dense")
def _(spark, sf):
    t = stage_tables(spark, sf, "fulltext_review", "evidence_extraction", "pmc_mechanism_feedback")
    return runs.density_gate(t).select(*KEYS, "trigger", "action")


@query("prompt_fit", S + f",\n{WEAK} SELECT paper_id, (run_id, pass_number, paper_id) NOT IN (SELECT run_id, pass_number, paper_id FROM weak) AS fit FROM fulltext_review")
def _(spark, sf):
    t = stage_tables(spark, sf, "fulltext_review", "evidence_extraction")
    return prompt_fit(*t.values()).select("paper_id", "fit")


@query(
    "weak_keep_signals",
    S
    + f""",\n{WEAK} SELECT run_id, pass_number, signal, count(*) AS n, array_to_string(list(paper_id ORDER BY paper_id)[1:10], ';') AS examples
    FROM (SELECT run_id, pass_number, paper_id, query_feedback_signal AS signal FROM evidence_extraction SEMI JOIN weak USING (run_id, pass_number, paper_id)) GROUP BY ALL""",
)
def _(spark, sf):
    t = stage_tables(spark, sf, "fulltext_review", "evidence_extraction")
    return weak_keep_signals(*t.values()).withColumn("examples", F.array_join("examples", ";"))


_ALL = _STAGE_TABLES + ("manual_pdf_queue", "pdf_download_shortlist", "settings")
FACTS = """facts AS (SELECT p.run_id, p.pass_number, CASE WHEN p.run_id IN ('en', 'fr') THEN 'final_access' ELSE 'pmc_learning' END AS phase,
  (SELECT count(*) FROM pmc_mechanism_feedback f WHERE f.run_id = p.run_id AND f.pass_number = p.pass_number) AS fb,
  (SELECT count(*) FROM pmc_mechanism_feedback f WHERE f.run_id = p.run_id AND f.pass_number <= p.pass_number) AS allfb,
  coalesce((SELECT arg_max(pdf_deferral_decision, f.pass_number) FROM pmc_mechanism_feedback f WHERE f.run_id = p.run_id AND f.pass_number <= p.pass_number), '') AS last,
  coalesce((SELECT bool_or(pdf_deferral_decision = 'defer_pdfs') FROM pmc_mechanism_feedback f WHERE f.run_id = p.run_id AND f.pass_number = p.pass_number), false) AS change,
  (SELECT count(*) FROM import_status f WHERE f.run_id = p.run_id AND f.pass_number = p.pass_number) AS imports,
  (SELECT count(*) FROM manual_pdf_queue f WHERE f.run_id = p.run_id AND f.pass_number = p.pass_number) AS queue,
  (SELECT count(*) FROM pdf_download_shortlist f WHERE f.run_id = p.run_id AND f.pass_number = p.pass_number) AS short,
  (SELECT count(*) FROM pdf_download_shortlist f WHERE f.run_id = p.run_id AND f.pass_number = p.pass_number AND shortlist_decision = 'request_pdf') AS asked,
  (SELECT count(*) FROM fulltext_review f WHERE f.run_id = p.run_id AND f.pass_number = p.pass_number) AS reviews,
  (SELECT count(*) FROM evidence_extraction f WHERE f.run_id = p.run_id AND f.pass_number = p.pass_number) AS evidence,
  EXISTS (SELECT 1 FROM gate g WHERE g.run_id = p.run_id AND g.pass_number = p.pass_number) AS gated
  FROM (SELECT DISTINCT run_id, pass_number FROM paper_manifest) p),
f2 AS (SELECT *, imports > 0 AND queue > 0.5 * imports AND phase <> 'final_access' AS many, reviews > 0 AND allfb > 0 AND allfb < 2 AND NOT gated AS minimum FROM facts),
decisions AS (
  SELECT run_id, pass_number, 'pmc_fulltext_review_gate_incomplete' AS trigger, true AS triggered, 'fulltext_review' AS source_stage, action, 0 AS rank FROM gate
  UNION ALL SELECT run_id, pass_number, trigger, true, source_stage, action, 1 FROM first_open JOIN names USING (stage_no)
  UNION ALL SELECT run_id, pass_number, 'final_prompt_fit_density_not_satisfied', true, 'workflow_control', action, 2 FROM dense
  UNION ALL SELECT run_id, pass_number, 'pmc_learning_query_feedback', true, 'fulltext_review', 'loop_to_run_guidance_reviser', 3 FROM f2 WHERE change AND phase <> 'final_access' AND NOT gated
  UNION ALL SELECT run_id, pass_number, 'minimum_big_loop_not_satisfied', true, 'fulltext_review', 'loop_to_run_guidance_reviser', 4 FROM f2 WHERE minimum
  UNION ALL SELECT run_id, pass_number, 'maximum_big_loop_reached', true, 'workflow_control', 'stop_blocked', 5 FROM f2 WHERE NOT minimum AND allfb >= 2 AND last <> 'final_pdf_pass'
  UNION ALL SELECT run_id, pass_number, 'missing_pdf_shortlist', true, 'fulltext_import', 'build_pdf_shortlist', 6 FROM f2 WHERE allfb >= 2 AND fb > 0 AND queue > 0 AND last = 'final_pdf_pass' AND short = 0
  UNION ALL SELECT run_id, pass_number, 'missing_pmc_mechanism_feedback', true, 'fulltext_review', 'loop_to_fulltext_review', 7 FROM f2 WHERE many AND reviews > 0 AND evidence > 0 AND fb = 0
  UNION ALL SELECT run_id, pass_number, 'large_pdf_queue_after_pmc_learning', true, 'fulltext_import', 'loop_to_run_guidance_reviser', 8 FROM f2 WHERE many AND fb > 0 AND last = 'defer_pdfs'
  UNION ALL SELECT run_id, pass_number, 'final_pdf_shortlist_ready', false, 'fulltext_import', 'continue', 9 FROM f2 WHERE many AND fb > 0 AND last = 'final_pdf_pass' AND short > 0
  UNION ALL SELECT run_id, pass_number, 'missing_evidence_extraction', true, 'fulltext_review', 'loop_to_fulltext_review', 10 FROM f2 WHERE reviews > 0 AND evidence = 0),
numbered AS (
  SELECT *, 'loop_' || row_number() OVER (PARTITION BY run_id, pass_number ORDER BY rank) AS loop_id FROM (SELECT * FROM decisions
  UNION ALL SELECT run_id, pass_number, 'no_loop_trigger', false, 'workflow_control', 'continue', 99 FROM f2 WHERE (run_id, pass_number) NOT IN (SELECT run_id, pass_number FROM decisions)))"""
LOOPS = f"{S},\n{OPEN},\n{COVERAGE}, {_GATE},\n{WEAK}, {_DENSE},\n{FACTS}\n"


@query("loop_decisions", LOOPS + "SELECT run_id, pass_number, loop_id, trigger, triggered, source_stage, action, rank FROM numbered")
def _(spark, sf):
    return runs.loop_decisions(stage_tables(spark, sf, *_ALL), passes(spark, sf))


@query(
    "run_state",
    LOOPS
    + """, n AS (SELECT run_id, pass_number, count(*) FILTER (WHERE triggered) AS active, arg_min(action, rank) AS act FROM numbered GROUP BY ALL),
    v AS (SELECT f.*, active, act, CASE WHEN allfb >= 2 AND last <> 'final_pdf_pass' THEN 'blocked' WHEN active > 0 THEN 'active' WHEN reviews > 0 AND allfb > 0 AND allfb < 2 THEN 'minimum'
      WHEN queue > 0 AND last = 'final_pdf_pass' AND short = 0 THEN 'awaiting' WHEN reviews > 0 AND allfb > 0 AND last = 'final_pdf_pass' THEN CASE WHEN queue > 0 THEN 'done_queue' ELSE 'done' END
      WHEN last = 'defer_pdfs' THEN 'minimum' ELSE 'running' END AS c FROM f2 f JOIN n USING (run_id, pass_number))
    SELECT run_id, pass_number, CASE c WHEN 'blocked' THEN 'blocked' WHEN 'active' THEN 'loop_required' WHEN 'minimum' THEN 'loop_required' WHEN 'awaiting' THEN 'awaiting_pdf_shortlist' WHEN 'running' THEN 'running' ELSE 'complete' END AS status,
    CASE WHEN allfb >= 2 AND last = 'final_pdf_pass' THEN 'final_access' ELSE phase END AS access_phase,
    CASE c WHEN 'done_queue' THEN 'pdf_download_shortlist_ready' WHEN 'done' THEN 'no_pdf_queue' ELSE '' END AS completion_signal,
    CASE c WHEN 'blocked' THEN 'stop_blocked' WHEN 'active' THEN act WHEN 'minimum' THEN 'loop_to_query_scout' WHEN 'awaiting' THEN 'build_pdf_download_shortlist' WHEN 'running' THEN 'continue_workflow' ELSE 'report_final_loop' END AS next_action,
    active AS active_loop_count, allfb AS completed_big_loop_count, last AS latest_pdf_deferral_decision, queue AS manual_pdf_queue_count, short AS pdf_download_shortlist_count, asked AS pdf_request_count FROM v""",
)
def _(spark, sf):
    t, p = stage_tables(spark, sf, *_ALL), passes(spark, sf)
    sums = cut(runs.stage_sums(t))
    d = runs.run_state(runs.loop_decisions(t, p, sums=sums), t, p, sums=sums)
    return d.drop("min_big_workflow_loops", "max_workflow_loops")


@query(
    "revision_of",
    S
    + """, l AS (SELECT run_id, max(pass_number) AS pass_number, arg_max(loop_id, pass_number) AS loop_id FROM pmc_mechanism_feedback GROUP BY run_id)
    SELECT l.run_id, CAST(l.pass_number AS INTEGER) AS pass_number, l.loop_id, r.revision_id, r.run_id IS NOT NULL AS has_revision
    FROM l LEFT JOIN run_guidance_revision_log r ON r.run_id = l.run_id AND r.feedback_loop_id = l.loop_id""",
)
def _(spark, sf):
    t = stage_tables(spark, sf, "pmc_mechanism_feedback", "run_guidance_revision_log")
    return runs.revision_of(*t.values()).select(*KEYS, "loop_id", "revision_id", "has_revision")


_RBLANK = " UNION ALL ".join(
    f"SELECT l.run_id, l.pass_number, 'revision_blank_{c}' FROM l JOIN run_guidance_revision_log r ON r.run_id = l.run_id AND r.feedback_loop_id = l.loop_id WHERE coalesce(trim(r.{c}), '') = ''"
    for c in REVISION_PATHS + REVISION_LEARNING
)


@query(
    "rerun_ready",
    S
    + f""",\n{READY}, {COVERAGE}, {_GATE}, l AS (SELECT * FROM (SELECT run_id, max(pass_number) AS pass_number, arg_max(loop_id, pass_number) AS loop_id, arg_max(pdf_deferral_decision, pass_number) AS d FROM pmc_mechanism_feedback GROUP BY run_id) WHERE d = 'defer_pdfs')
    SELECT run_id, CAST(pass_number AS INTEGER) AS pass_number, reason FROM (SELECT * FROM why UNION ALL SELECT run_id, pass_number, 'review_gate_open' FROM gate
    UNION ALL SELECT run_id, pass_number, 'no_revision' FROM l WHERE (run_id, loop_id) NOT IN (SELECT run_id, feedback_loop_id FROM run_guidance_revision_log) UNION ALL {_RBLANK})""",
)
def _(spark, sf):
    return runs.rerun_ready(stage_tables(spark, sf, *_STAGE_TABLES, "run_guidance_revision_log", "settings"))
