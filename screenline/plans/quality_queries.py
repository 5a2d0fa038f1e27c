"""Registered queries on checks, coverage and sets, with SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from screenline.operators import quality as q
from screenline.plans.registry import Registry
from screenline.plans.stages import SETTINGS, ctes, settings, stage_tables
from screenline.plans.views import table
from screenline.schemas import REQUIRED_COLUMNS, REVISION_LEARNING, REVISION_PATHS, VOCABULARY
from screenline.session import shared_dir
from screenline.sources import stage

query = Registry()
S = "WITH " + ctes() + "\n"


def violation(check: str, item: str, detail: str) -> str:
    return f"SELECT run_id, pass_number, '{check}' AS \"check\", {item} AS item, {detail} AS detail"


def diff_sql(a: str, b: str, check: str) -> str:
    """Ids of one side only; a and b are SELECT run_id, pass_number, paper_id."""
    k = "run_id, pass_number, paper_id"
    return (
        violation(check, "paper_id", "'missing'") + f" FROM (SELECT {k} FROM ({a}) EXCEPT SELECT {k} FROM ({b}))"
        " UNION ALL " + violation(check, "paper_id", "'extra'") + f" FROM (SELECT {k} FROM ({b}) EXCEPT SELECT {k} FROM ({a}))"
    )


def gap_sql(a: str, b: str, check: str) -> str:
    n = "SELECT run_id, pass_number, count(*) AS {0} FROM {1} GROUP BY ALL"
    return (
        violation(check, "'rows'", "coalesce(y, 0) || ' vs ' || coalesce(x, 0)")
        + f" FROM ({n.format('x', a)}) FULL JOIN ({n.format('y', b)}) USING (run_id, pass_number) WHERE coalesce(x, 0) <> coalesce(y, 0)"
    )


def checked(name: str, fn, oracle: str, *tables: str):
    @query(name, S + oracle)
    def _(spark, sf):
        return fn(stage_tables(spark, sf, *tables))


A = "SELECT run_id, pass_number, paper_id FROM "

_QUALITY = " UNION ALL ".join(
    f"""SELECT '{t}' AS tbl, '{c}' AS col, run_id, pass_number, count(*) FILTER (WHERE v = '') AS blank_count, count(*) FILTER (WHERE v <> '' AND v NOT IN {(*vals, '')}) AS invalid_count,
    array_to_string((list(DISTINCT v) FILTER (WHERE v <> '' AND v NOT IN {(*vals, '')})), ',') AS examples
    FROM (SELECT run_id, pass_number, trim(coalesce({c}, '')) AS v FROM {t}) GROUP BY ALL"""
    for t in VOCABULARY
    for c, vals in VOCABULARY[t].items()
)


@query("column_quality", S + f"SELECT tbl, col, run_id, pass_number, blank_count, invalid_count, coalesce(examples, '') AS examples FROM ({_QUALITY})")
def _(spark, sf):
    parts = []
    for n, t in stage_tables(spark, sf, *VOCABULARY).items():
        d = q.column_quality(t, VOCABULARY[n])
        parts.append(
            d.select(
                F.lit(n).alias("tbl"),
                F.col("column").alias("col"),
                "run_id",
                "pass_number",
                "blank_count",
                "invalid_count",
                F.array_join("examples", ",").alias("examples"),
            )
        )
    return q.union_all(parts)


checked(
    "check_values",
    q.check_values,
    f"""SELECT run_id, pass_number, 'blank_value' AS "check", tbl || '.' || col AS item, CAST(blank_count AS VARCHAR) AS detail FROM ({_QUALITY}) WHERE blank_count > 0
    UNION ALL SELECT run_id, pass_number, 'invalid_value', tbl || '.' || col, invalid_count || ': ' || examples FROM ({_QUALITY}) WHERE invalid_count > 0""",
    *VOCABULARY,
)

# A column that the files of one run lack besides those no file of the table has.
_DROPPED = {
    "paper_manifest": "abstract",
    "blocked_venue_records": "match_value",
    "query_diagnostics": "decision",
    "first_pass": "synthesis_role",
    "second_pass": "second_pass_rationale",
    "import_status": "title",
    "pdf_download_shortlist": "priority",
    "fulltext_review": "topic_centrality",
    "fulltext_rescue": "rescue_decision",
    "evidence_extraction": "retention_role",
    "pmc_mechanism_feedback": "direct_mechanisms",
    "workflow_loop_decision": "action",
    "run_guidance_revision_log": "revision_rationale",
    "final_reading_list": "final_decision",
}


def _lost(t: str, keys: str, rows: str, late: str = "false") -> str:
    """Required columns that are not among those of the table's rows."""
    return f"""SELECT {keys}, 'missing_column' AS "check", '{t}' AS item, c AS detail FROM (SELECT *, unnest({list(REQUIRED_COLUMNS[t])}) AS c FROM (
        {rows})) WHERE NOT list_contains(held, c) OR ({late} AND c = '{_DROPPED[t]}')"""


@query(
    "check_columns",
    S
    + " UNION ALL ".join(
        _lost(t, "run_id, pass_number", f"SELECT DISTINCT run_id, pass_number, json_keys(to_json({t})) AS held FROM {t}", "run_id = 'de'") for t in _DROPPED
    ),
)
def _(spark, sf):
    """All stage tables as CSV files by run and pass, and what their headers lack."""
    parts = []
    for name, t in stage_tables(spark, sf, *_DROPPED).items():
        path = f"{shared_dir(spark)}/headers-{uuid.uuid4().hex}"
        late = F.col("run_id") == "de"
        for d in (t.where(~late), t.where(late).drop(_DROPPED[name])):
            d.write.mode("append").partitionBy("run_id", "pass_number").option("header", "true").csv(path)
        parts.append(q.check_headers(stage.read_headers(spark, path), name))
    return q.union_all(parts)


checked(
    "check_triage_coverage",
    q.check_triage_coverage,
    " UNION ALL ".join(
        [gap_sql("paper_manifest", n, f"{n}_rows") + " UNION ALL " + diff_sql(A + "paper_manifest", A + n, f"{n}_ids") for n in ("first_pass", "second_pass")]
    ),
    "paper_manifest",
    "first_pass",
    "second_pass",
)
checked(
    "check_import_handoff",
    q.check_import_handoff,
    diff_sql(A + "second_pass WHERE promotion_decision = 'advance_to_import'", A + "import_status", "import_ids"),
    "second_pass",
    "import_status",
)
checked(
    "check_fulltext_handoff",
    q.check_fulltext_handoff,
    diff_sql(A + "import_status WHERE normalized_path <> ''", A + "fulltext_review", "review_ids")
    + " UNION ALL "
    + violation("stored_text", "paper_id", "normalized_path")
    + " FROM import_status WHERE normalized_path <> '' AND normalized_path NOT IN (SELECT path FROM stored)",
    "import_status",
    "fulltext_review",
    "stored",
)
@query(
    "pending_reviews",
    S + "SELECT run_id, pass_number, count(*) FILTER (WHERE fulltext_decision = '') AS pending FROM fulltext_review GROUP BY ALL",
)
def _(spark, sf):
    return q.pending_reviews(stage_tables(spark, sf, "fulltext_review")["fulltext_review"])


checked(
    "check_evidence_handoff",
    q.check_evidence_handoff,
    diff_sql(A + "fulltext_review WHERE fulltext_decision <> ''", A + "evidence_extraction", "evidence_ids"),
    "fulltext_review",
    "evidence_extraction",
)
checked(
    "check_rescue_handoff",
    q.check_rescue_handoff,
    violation("rescue_unknown", "paper_id", "'absent_from_review'")
    + " FROM (SELECT run_id, pass_number, paper_id FROM fulltext_rescue EXCEPT SELECT run_id, pass_number, paper_id FROM fulltext_review) UNION ALL "
    + violation("rescue_decision", "paper_id", "final_fulltext_decision || ' vs ' || fulltext_decision")
    + " FROM fulltext_rescue JOIN fulltext_review USING (run_id, pass_number, paper_id) WHERE final_fulltext_decision <> fulltext_decision",
    "fulltext_rescue",
    "fulltext_review",
)
WEAK = """weak AS (SELECT r.run_id, r.pass_number, r.paper_id FROM fulltext_review r LEFT JOIN evidence_extraction e USING (run_id, pass_number, paper_id)
  WHERE r.fulltext_decision = 'keep' AND (r.objective_relevance = 'low' OR e.evidence_tier IS NULL OR e.evidence_tier = 'background')),
final_runs AS (SELECT run_id FROM (SELECT run_id, arg_max(pdf_deferral_decision, pass_number) AS d FROM pmc_mechanism_feedback GROUP BY run_id) WHERE d = 'final_pdf_pass')"""
SW = "WITH " + ctes() + ",\n" + WEAK + "\n"


def checked_weak(name, fn, oracle, *tables):
    @query(name, SW + oracle)
    def _(spark, sf):
        return fn(stage_tables(spark, sf, *tables))


checked_weak(
    "check_prompt_fit",
    q.check_prompt_fit,
    violation("weak_keep", "paper_id", "'keep'") + " FROM weak WHERE run_id IN (SELECT run_id FROM final_runs)",
    "fulltext_review",
    "evidence_extraction",
    "pmc_mechanism_feedback",
)
_UNREAD = A + "import_status WHERE normalized_path = ''"
_AWAY = A + "final_reading_list WHERE final_decision = 'abstract_relevant_fulltext_unavailable'"
checked(
    "check_final_list",
    q.check_final_list,
    diff_sql(A + "fulltext_review WHERE fulltext_decision = 'keep'", A + "final_reading_list WHERE final_decision = 'selected_for_reading'", "final_selected")
    + f" UNION ALL SELECT * FROM ({diff_sql(_UNREAD, _AWAY, 'final_unavailable')}) WHERE run_id IN ('en', 'fr') UNION ALL "
    + violation("final_unavailable", "paper_id", "'in_learning_phase'")
    + f" FROM ({_AWAY}) WHERE run_id NOT IN ('en', 'fr')",
    "final_reading_list",
    "fulltext_review",
    "import_status",
    "settings",
)
_RUN_DIFF = """SELECT run_id, CAST(NULL AS INTEGER) AS pass_number, 'shortlist_ids' AS "check", paper_id AS item, 'missing' AS detail FROM
  (SELECT run_id, paper_id FROM manual_pdf_queue EXCEPT SELECT run_id, paper_id FROM pdf_download_shortlist) WHERE run_id IN (SELECT run_id FROM r WHERE loops >= 2 AND last = 'final_pdf_pass')"""
checked(
    "check_shortlist",
    q.check_shortlist,
    f""", r AS (SELECT run_id, count(*) AS loops, arg_max(pdf_deferral_decision, pass_number) AS last FROM pmc_mechanism_feedback GROUP BY run_id),
    n AS (SELECT q.run_id, r.loops, r.last, (SELECT count(*) FROM pdf_download_shortlist s WHERE s.run_id = q.run_id) AS listed,
      (SELECT count(*) FROM pdf_download_shortlist s WHERE s.run_id = q.run_id AND shortlist_decision = 'request_pdf') AS asked
      FROM (SELECT DISTINCT run_id FROM manual_pdf_queue) q JOIN r USING (run_id))
    {_RUN_DIFF} UNION ALL
    SELECT run_id, NULL, 'shortlist_early', CASE WHEN loops < 2 AND last = 'final_pdf_pass' THEN 'feedback' ELSE 'shortlist' END, CASE WHEN loops >= 2 THEN 'rows_before_final' WHEN last = 'final_pdf_pass' THEN 'final_before_minimum' ELSE 'rows_before_minimum' END
      FROM n WHERE (loops < 2 AND last = 'final_pdf_pass') OR (listed > 0 AND (loops < 2 OR last <> 'final_pdf_pass')) UNION ALL
    SELECT run_id, NULL, 'shortlist_requests', 'rows', 'none_requested' FROM n WHERE loops >= 2 AND last = 'final_pdf_pass' AND asked = 0""",
    "manual_pdf_queue",
    "pdf_download_shortlist",
    "pmc_mechanism_feedback",
)
checked(
    "check_state",
    q.check_state,
    """, f AS (SELECT run_id, count(*) AS loops, arg_max(pdf_deferral_decision, pass_number) AS last FROM pmc_mechanism_feedback GROUP BY run_id),
    a AS (SELECT run_id, count(*) FILTER (WHERE triggered = 'yes') AS active FROM workflow_loop_decision GROUP BY run_id),
    j AS (SELECT s.*, f.loops, f.last, a.active, (SELECT count(*) FROM manual_pdf_queue q WHERE q.run_id = s.run_id) AS queue,
      (SELECT count(*) FROM pdf_download_shortlist q WHERE q.run_id = s.run_id) AS short FROM workflow_state s JOIN f USING (run_id) JOIN a USING (run_id)),
    t AS (
      SELECT run_id, status, 'status' AS item FROM j WHERE status NOT IN ('initialized', 'running', 'loop_required', 'awaiting_pdf_shortlist', 'complete', 'blocked')
      UNION ALL SELECT run_id, status, 'active_loop_count' FROM j WHERE active_loop_count <> active
      UNION ALL SELECT run_id, status, 'manual_pdf_queue_count' FROM j WHERE manual_pdf_queue_count <> queue
      UNION ALL SELECT run_id, status, 'pdf_download_shortlist_count' FROM j WHERE pdf_download_shortlist_count <> short
      UNION ALL SELECT run_id, status, 'latest_pdf_deferral_decision' FROM j WHERE latest_pdf_deferral_decision <> last
      UNION ALL SELECT run_id, status, 'completed_big_loop_count' FROM j WHERE completed_big_loop_count <> loops
      UNION ALL SELECT run_id, status, 'max_workflow_loops' FROM j WHERE max_workflow_loops <> 2
      UNION ALL SELECT run_id, status, 'no_active_loop' FROM j WHERE loops > 0 AND loops < 2 AND active = 0
      UNION ALL SELECT run_id, status, 'complete_not_final_access' FROM j WHERE status = 'complete' AND access_phase <> 'final_access'
      UNION ALL SELECT run_id, status, 'complete_with_active_loops' FROM j WHERE status = 'complete' AND active > 0
      UNION ALL SELECT run_id, status, 'complete_below_minimum' FROM j WHERE status = 'complete' AND loops < 2
      UNION ALL SELECT run_id, status, 'complete_not_final' FROM j WHERE status = 'complete' AND last <> 'final_pdf_pass'
      UNION ALL SELECT run_id, status, 'complete_without_shortlist' FROM j WHERE status = 'complete' AND queue > 0 AND short = 0
      UNION ALL SELECT run_id, status, 'complete_signal' FROM j WHERE status = 'complete' AND queue > 0 AND completion_signal <> 'pdf_download_shortlist_ready')
    SELECT run_id, CAST(NULL AS INTEGER) AS pass_number, 'run_state' AS "check", item, status AS detail FROM t""",
    "workflow_state",
    "workflow_loop_decision",
    "manual_pdf_queue",
    "pdf_download_shortlist",
    "pmc_mechanism_feedback",
)
_BLANK = " UNION ALL ".join(
    f"SELECT f.run_id, f.pass_number, f.loop_id, '{c}' AS col FROM f JOIN run_guidance_revision_log r ON r.run_id = f.run_id AND r.feedback_loop_id = f.loop_id WHERE coalesce(trim(r.{c}), '') = ''"
    for c in REVISION_PATHS + REVISION_LEARNING
)
checked(
    "check_revisions",
    q.check_revisions,
    f""", f AS (SELECT run_id, pass_number, loop_id FROM pmc_mechanism_feedback WHERE pdf_deferral_decision = 'defer_pdfs')
    {violation("revision_missing", "loop_id", "'no_revision'")} FROM f WHERE NOT EXISTS (SELECT 1 FROM run_guidance_revision_log r WHERE r.run_id = f.run_id AND r.feedback_loop_id = f.loop_id)
    UNION ALL {violation("revision_blank", "loop_id", "col")} FROM ({_BLANK})""",
    "pmc_mechanism_feedback",
    "run_guidance_revision_log",
)
_TRIO = ("paper_manifest", "first_pass", "second_pass", "pmc_mechanism_feedback")
READY = """ready AS (SELECT m.run_id, m.pass_number, m.n AS papers, coalesce(a.n, 0) AS na, coalesce(a.b, 0) AS ba, coalesce(b.n, 0) AS nb, coalesce(b.b, 0) AS bb, f.d AS said
  FROM (SELECT run_id, pass_number, count(*) AS n FROM paper_manifest GROUP BY ALL) m
  LEFT JOIN (SELECT run_id, pass_number, count(*) AS n, count(*) FILTER (WHERE trim(first_pass_decision) = '') AS b FROM first_pass GROUP BY ALL) a USING (run_id, pass_number)
  LEFT JOIN (SELECT run_id, pass_number, count(*) AS n, count(*) FILTER (WHERE second_pass_decision = '' OR promotion_decision = '') AS b FROM second_pass GROUP BY ALL) b USING (run_id, pass_number)
  LEFT JOIN (SELECT run_id, pass_number, pdf_deferral_decision AS d FROM pmc_mechanism_feedback) f USING (run_id, pass_number)),
why AS (SELECT run_id, pass_number, 'first_pass_incomplete' AS reason FROM ready WHERE na <> papers OR ba > 0
  UNION ALL SELECT run_id, pass_number, 'second_pass_incomplete' FROM ready WHERE nb <> papers OR bb > 0
  UNION ALL SELECT run_id, pass_number, 'no_feedback' FROM ready WHERE said IS NULL
  UNION ALL SELECT run_id, pass_number, 'no_rerun_requested' FROM ready WHERE said <> 'defer_pdfs')"""
checked(
    "check_pass_sequence",
    q.check_pass_sequence,
    f""", {READY} SELECT p.run_id, CAST(p.pass_number AS INTEGER) AS pass_number, 'pass_sequence' AS "check", reason AS item, 'previous_pass' AS detail
    FROM (SELECT DISTINCT run_id, pass_number FROM paper_manifest WHERE pass_number > 1) p JOIN why w ON w.run_id = p.run_id AND w.pass_number = p.pass_number - 1""",
    *_TRIO,
)


@query(
    "check_caps",
    """WITH x AS (SELECT event_id, event_type, week(ts) AS w, CAST(props->>'k' AS INTEGER) AS k, CAST(trunc(value) AS INTEGER) AS v FROM events)
    SELECT 'run' AS run_id, CAST(w AS INTEGER) AS pass_number, 'collection_capped' AS "check", 'q' || event_id AS item, v || ' of ' || k AS detail FROM x WHERE event_type = 'click' AND v < k
    UNION ALL SELECT 'run', CAST(w AS INTEGER), 'forbidden_cap', 'retmax', CAST(event_id AS VARCHAR) FROM x WHERE event_type = 'view'""",
)
def _(spark, sf):
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("int")
    e = table(spark, sf, "events").select(
        F.lit("run").alias("run_id"),
        F.weekofyear("ts").cast("int").alias("pass_number"),
        F.concat(F.lit("q"), F.col("event_id")).alias("query_id"),
        F.when(kind == "click", "collection").otherwise("round_1").alias("round_id"),
        k.alias("raw_hit_count"),
        F.col("value").cast("int").alias("collected_count"),
        F.lit("no").alias("truncated_by_constraint"),
        F.when(kind == "view", "- `retmax`: 5").otherwise("- `page`: 5").alias("line"),
        F.col("event_id").alias("line_no"),
    )
    return q.check_caps({"query_diagnostics": e, "setting_lines": e})


@query(
    "check_settings",
    f"""SELECT run_id, CAST(NULL AS INTEGER) AS pass_number, 'setting' AS "check", k AS item, v AS detail
    FROM (VALUES {", ".join(f"('{run}', '{k}', '{v}')" for run, kv in SETTINGS.items() for k, v in kv.items())}) s(run_id, k, v)
    WHERE run_id IN (SELECT lang FROM documents) AND ({" OR ".join(f"(k = '{k}' AND v NOT IN {legal})" for k, (_, legal) in q.MODES.items())}
      OR (k IN {q.LOOP_SETTINGS} AND CAST(v AS INTEGER) <> 2))""",
)
def _(spark, sf):
    return q.check_settings({"settings": settings(spark, sf)})


COVERAGE = """cov AS (SELECT i.run_id, i.pass_number, count(*) FILTER (WHERE a) AS available, count(*) FILTER (WHERE a AND pmc_parse_status = 'not_attempted') AS unattempted,
  count(*) FILTER (WHERE u) AS usable, count(*) FILTER (WHERE u AND r.paper_id IS NOT NULL) AS reviewed, count(*) FILTER (WHERE u AND e.paper_id IS NOT NULL) AS evidenced,
  count(*) FILTER (WHERE a AND pmc_parse_status = 'unusable' AND pdf_needed = 'no') AS unqueued, count(*) FILTER (WHERE u AND r.paper_id IS NULL) AS missing_review,
  count(*) FILTER (WHERE u AND e.paper_id IS NULL) AS missing_evidence
  FROM (SELECT *, pmc_access_status = 'available' AS a, pmc_access_status = 'available' AND pmc_parse_status = 'usable' AND normalized_path <> '' AS u FROM import_status) i
  LEFT JOIN (SELECT DISTINCT run_id, pass_number, paper_id FROM fulltext_review WHERE fulltext_decision <> '') r USING (run_id, pass_number, paper_id)
  LEFT JOIN (SELECT DISTINCT run_id, pass_number, paper_id FROM evidence_extraction WHERE evidence_tier <> '') e USING (run_id, pass_number, paper_id) GROUP BY ALL)"""


@query("coverage_counts", S + f", {COVERAGE} SELECT * FROM cov")
def _(spark, sf):
    t = stage_tables(spark, sf, "import_status", "fulltext_review", "evidence_extraction")
    return q.coverage_counts(*t.values())


checked(
    "check_review_gate",
    q.check_review_gate,
    f", {COVERAGE} "
    + " UNION ALL ".join(
        violation("review_gate", f"'{k}'", f"CAST({k} AS VARCHAR)") + f" FROM cov WHERE {k} > 0 AND run_id <> 'de'"
        for k in ("unattempted", "unqueued", "missing_review", "missing_evidence")
    ),
    "import_status",
    "fulltext_review",
    "evidence_extraction",
    "settings",
)


@query(
    "check_listing",
    """SELECT lang AS run_id, CAST(1 AS INTEGER) AS pass_number, 'undeclared_file' AS "check", path AS item, 'not_allowed' AS detail FROM (
    SELECT lang, CASE lang WHEN 'en' THEN 'artifacts/' || source || '/' || doc_id || '.csv' WHEN 'de' THEN 'notes/' || doc_id || '.md' WHEN 'fr' THEN 'manifest.csv' ELSE 'artifacts/' || doc_id || '.txt' END AS path FROM documents)
    WHERE NOT (path LIKE 'artifacts/%.csv' OR path = 'manifest.csv')""",
)
def _(spark, sf):
    doc, lang = F.col("doc_id").cast("string"), F.col("lang")
    path = (
        F.when(lang == "en", F.concat_ws("", F.lit("artifacts/"), F.col("source"), F.lit("/"), doc, F.lit(".csv")))
        .when(lang == "de", F.concat(F.lit("notes/"), doc, F.lit(".md")))
        .when(lang == "fr", "manifest.csv")
        .otherwise(F.concat(F.lit("artifacts/"), doc, F.lit(".txt")))
    )
    d = table(spark, sf, "documents").select(lang.alias("run_id"), F.lit(1).alias("pass_number"), path.alias("path"))
    return q.check_listing(d, ["manifest.csv"], ["artifacts/*.csv"])


@query(
    "check_prior_payloads",
    """SELECT event_type AS run_id, CAST(week(ts) AS INTEGER) AS pass_number, 'prior_payload' AS "check", 'pmid-' || event_id AS item, 'not_purged' AS detail
    FROM events WHERE week(ts) < 5 AND event_type IN ('click', 'view')""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select(
        F.col("event_type").alias("run_id"),
        F.weekofyear("ts").cast("int").alias("pass_number"),
        F.concat(F.lit("pmid-"), F.col("event_id")).alias("paper_id"),
    )
    runs = e.select("run_id").distinct()
    state = runs.withColumn("status", F.when(F.col("run_id").isin("click", "view"), "complete").otherwise("running"))
    active = e.groupBy("run_id").agg(F.max("pass_number").alias("pass_number"))
    return q.check_prior_payloads(e, state, active)


checked(
    "check_recorded",
    q.check_recorded,
    """SELECT run_id, CAST(NULL AS INTEGER) AS pass_number, 'no_recorded_decisions' AS "check", 'pass_decisions' AS item, 'empty' AS detail
    FROM paper_manifest GROUP BY run_id HAVING max(pass_number) > 1 AND run_id NOT IN (SELECT run_id FROM pass_decisions)""",
    "paper_manifest",
    "pass_decisions",
)


@query(
    "check_required",
    """WITH l AS (SELECT DISTINCT lang AS run_id, CAST(1 + doc_id % 2 AS INTEGER) AS pass_number, source AS path FROM documents)
    SELECT k.run_id, k.pass_number, 'required_missing' AS "check", r.path AS item, 'absent' AS detail FROM (SELECT DISTINCT run_id, pass_number FROM l) k,
    (VALUES ('src0'), ('src1'), ('brief.md')) r(path) WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.run_id = k.run_id AND l.pass_number = k.pass_number AND l.path = r.path)""",
)
def _(spark, sf):
    d = table(spark, sf, "documents").select(
        F.col("lang").alias("run_id"), (1 + F.col("doc_id") % 2).cast("int").alias("pass_number"), F.col("source").alias("path")
    )
    return q.check_required(d, ["src0", "src1", "brief.md"])


checked(
    "check_order",
    q.check_order,
    violation("feedback_order", "'review_rules'", "'missing_before_feedback'")
    + " FROM (SELECT run_id, pass_number FROM pmc_mechanism_feedback EXCEPT SELECT run_id, pass_number FROM review_rules) UNION ALL "
    + violation("feedback_order", "'fulltext_rescue'", "'missing_before_feedback'")
    + " FROM (SELECT run_id, pass_number FROM pmc_mechanism_feedback EXCEPT SELECT run_id, pass_number FROM fulltext_rescue)",
    "pmc_mechanism_feedback",
    "review_rules",
    "fulltext_rescue",
)


_LISTED = """SELECT lang AS run_id, CASE lang WHEN 'en' THEN 'artifacts/' || source || '/' || doc_id || '.csv' WHEN 'de' THEN 'notes/' || doc_id || '.md'
  WHEN 'fr' THEN 'manifest.csv' ELSE 'artifacts/' || doc_id || '.txt' END AS path FROM documents"""
_WHOLE = {
    "check_columns": S + " UNION ALL ".join(_lost(t, "NULL AS run_id, CAST(NULL AS INTEGER) AS pass_number", f"SELECT json_keys(to_json({t})) AS held FROM {t} LIMIT 1") for t in _DROPPED),
    "check_caps": S
    + """SELECT run_id, pass_number, 'collection_capped' AS "check", query_id AS item, collected_count || ' of ' || raw_hit_count AS detail
      FROM query_diagnostics WHERE collected_count < raw_hit_count AND round_id = 'collection'
      UNION ALL SELECT 'fr', 1, 'forbidden_cap', 'retmax', '7'""",
    "check_listing": f"""SELECT run_id, 1 AS pass_number, 'undeclared_file' AS "check", path AS item, 'not_allowed' AS detail FROM ({_LISTED}) WHERE NOT (path LIKE 'artifacts/%.csv' OR path = 'manifest.csv')""",
    "check_required": f"""SELECT run_id, 1 AS pass_number, 'required_missing' AS "check", r AS item, 'absent' AS detail FROM (SELECT DISTINCT run_id FROM ({_LISTED})) k, (VALUES ('manifest.csv'), ('brief.md')) v(r)
      WHERE NOT EXISTS (SELECT 1 FROM ({_LISTED}) l WHERE l.run_id = k.run_id AND l.path = r)""",
    "check_prior_payloads": S
    + """SELECT run_id, pass_number, 'prior_payload' AS "check", paper_id AS item, 'not_purged' AS detail
      FROM d WHERE pass_number < 2 AND run_id IN (SELECT run_id FROM workflow_state WHERE status = 'complete')""",
}
_SHARED = [c.__name__ for c in q.CHECKS if c.__name__ not in _WHOLE]


@query(
    "validate",
    " UNION ALL ".join(
        f'SELECT run_id, CAST(pass_number AS INTEGER) AS pass_number, "check", item, detail FROM ({text})'
        for text in [*_WHOLE.values(), *(query.oracles[n] for n in _SHARED)]
    ),
)
def _(spark, sf):
    """Every check over all stage tables at once."""
    t = stage_tables(spark, sf)
    doc, lang = F.col("doc_id").cast("string"), F.col("lang")
    docs = table(spark, sf, "documents")
    path = (
        F.when(lang == "en", F.concat(F.lit("artifacts/"), F.col("source"), F.lit("/"), doc, F.lit(".csv")))
        .when(lang == "de", F.concat(F.lit("notes/"), doc, F.lit(".md")))
        .when(lang == "fr", "manifest.csv")
        .otherwise(F.concat(F.lit("artifacts/"), doc, F.lit(".txt")))
    )
    t["listing"] = docs.select(lang.alias("run_id"), F.lit(1).alias("pass_number"), path.alias("path"))
    t["payloads"] = stage_tables(spark, sf, "d")["d"].select("run_id", "pass_number", "paper_id")
    t["active"] = t["payloads"].groupBy("run_id").agg(F.max("pass_number").alias("pass_number"))
    line = F.when(F.col("run_id") == "fr", "- `retmax`: 5").otherwise("- `page`: 5")
    t["setting_lines"] = t["settings"].select("run_id", F.lit(1).alias("pass_number"), line.alias("line"), F.lit(7).alias("line_no"))
    return q.validate(t, ["manifest.csv"], ["artifacts/*.csv"], ["manifest.csv", "brief.md"])


@query(
    "id_difference",
    """SELECT doc_id, 'missing' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT page_id + 100000000, 'extra' FROM pages""",
)
def _(spark, sf):
    """Documents against labelled documents and pages."""
    one = lambda c: [F.lit("r").alias("run_id"), c.cast("string").alias("paper_id")]
    a = table(spark, sf, "documents").select(*one(F.col("doc_id")))
    b = table(spark, sf, "labels").select(*one(F.col("doc_id")))
    b = b.unionByName(table(spark, sf, "pages").select(*one(F.col("page_id") + 100000000)))
    d = q.id_difference(a, b, ["run_id"])
    return d.select(F.col("paper_id").cast("bigint").alias("doc_id"), "side")


@query(
    "same_ids",
    """SELECT n.n_name AS run_id, count(DISTINCT c_custkey) AS rows_a, count(o_orderkey) AS rows_b, count(DISTINCT c_custkey) FILTER (WHERE o_orderkey IS NULL) AS missing,
    CAST(0 AS BIGINT) AS extra, count(DISTINCT c_custkey) = count(o_orderkey) AND count(*) FILTER (WHERE o_orderkey IS NULL) = 0 AS same
    FROM customer JOIN nation n ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""",
)
def _(spark, sf):
    """Per nation: customers against the customers of its orders."""
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("run_id"))
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey").join(nation, "c_nationkey")
    a = c.select("run_id", F.col("c_custkey").cast("string").alias("paper_id"))
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")).join(c, "c_custkey")
    b = o.select("run_id", F.col("c_custkey").cast("string").alias("paper_id"))
    return q.same_ids(a, b, ["run_id"])


@query("distinct_ids", "SELECT DISTINCT l_returnflag AS run_id, CAST(l_partkey AS VARCHAR) AS paper_id FROM lineitem")
def _(spark, sf):
    d = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("run_id"), F.concat(F.lit(" "), F.col("l_partkey"), F.lit(" ")).alias("paper_id"))
    return q.distinct_ids(d, ["run_id"])


