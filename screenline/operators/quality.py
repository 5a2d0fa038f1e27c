"""Checks of the hand-offs between stages, as one long table of violations
(run_id, pass_number, check, item, detail). Every check is a set operation over
all runs and passes at once; ``tables`` maps stage names to tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fnmatch import translate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenline.functions.fields import int_setting, text_setting
from screenline.functions.text import is_blank, strip, text_of
from screenline.operators.collect import forbidden_caps, is_truncated
from screenline.operators.evidence import weak_keeps
from screenline.operators.fulltext import usable_import
from screenline.operators.match import RUN_KEYS
from screenline.operators.ranking import latest_row
from screenline.schemas import REQUIRED_COLUMNS, REVISION_LEARNING, REVISION_PATHS, VOCABULARY
from screenline.session import local_table, small

KEYS = list(RUN_KEYS)
VIOLATIONS = "run_id string, pass_number int, check string, item string, detail string"
Tables = Mapping[str, DataFrame]


def _t(c: str) -> Column:
    return strip(text_of(F.col(c).cast("string")))


def _rows(df: DataFrame, check: str, item: Column, detail: Column | str) -> DataFrame:
    d = F.lit(detail) if isinstance(detail, str) else detail
    number = F.col("pass_number") if "pass_number" in df.columns else F.lit(None).cast("int")
    return df.select("run_id", number.alias("pass_number"), F.lit(check).alias("check"), item.alias("item"), d.alias("detail"))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_ids(df: DataFrame, keys: Sequence[str] = KEYS, name: str = "paper_id") -> DataFrame:
    """Distinct non-blank ids."""
    d = df.withColumn(name, _t(name)).where(F.col(name) != "")
    return d.select(*keys, name).distinct()


def id_difference(a: DataFrame, b: DataFrame, keys: Sequence[str] = KEYS, name: str = "paper_id") -> DataFrame:
    """Ids in one table only: side ``missing`` (in a, not in b) or ``extra``."""
    ids = [*keys, name]
    x = distinct_ids(a, keys, name).withColumn("_a", F.lit(True))
    y = distinct_ids(b, keys, name).withColumn("_b", F.lit(True))
    d = x.join(y, ids, "full_outer").where(F.col("_a").isNull() | F.col("_b").isNull())
    return d.select(*ids, F.when(F.col("_b").isNull(), "missing").otherwise("extra").alias("side"))


def same_ids(a: DataFrame, b: DataFrame, keys: Sequence[str] = KEYS, name: str = "paper_id") -> DataFrame:
    """Per key: rows on both sides, ids missing and extra, and whether the
    tables cover each other row for row."""
    diff = id_difference(a, b, keys, name).groupBy(*keys).agg(
        F.count_if(F.col("side") == "missing").alias("missing"), F.count_if(F.col("side") == "extra").alias("extra")
    )
    n = row_counts(a, keys, "rows_a").join(row_counts(b, keys, "rows_b"), list(keys), "full_outer")
    d = n.join(diff, list(keys), "left").na.fill(0)
    return d.withColumn(
        "same", (F.col("missing") == 0) & (F.col("extra") == 0) & (F.col("rows_a") == F.col("rows_b"))
    )


def row_counts(df: DataFrame, keys: Sequence[str] = KEYS, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def column_quality(df: DataFrame, vocab: Mapping[str, Sequence[str]], keys: Sequence[str] = KEYS, examples: int = 5) -> DataFrame:
    """Per column with a vocabulary: blank and invalid counts, and up to five
    invalid values (most frequent first). Values are counted before anything is
    collected, so a list holds distinct values only."""
    cols = [c for c in vocab if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), _t(c).alias("value")) for c in cols])
    n = df.select(*keys, F.explode(pairs).alias("p")).groupBy(*keys, "p.column", "p.value").agg(F.count("*").alias("n"))
    bad = F.lit(False)
    for c in cols:
        bad = bad | ((F.col("column") == c) & ~F.col("value").isin(*vocab[c]))
    n = n.withColumn("_bad", bad & (F.col("value") != ""))
    order = W.partitionBy(*keys, "column", "_bad").orderBy(F.desc("n"), "value")
    shown = n.where("_bad").withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= examples)
    shown = shown.groupBy(*keys, "column").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_r", "value"))), lambda s: s["value"]).alias("examples")
    )
    total = n.groupBy(*keys, "column").agg(
        F.coalesce(F.sum(F.when(F.col("value") == "", F.col("n"))), F.lit(0)).alias("blank_count"),
        F.coalesce(F.sum(F.when(F.col("_bad"), F.col("n"))), F.lit(0)).alias("invalid_count"),
    )
    none = F.array().cast("array<string>")
    return total.join(shown, [*keys, "column"], "left").withColumn("examples", F.coalesce("examples", none))


def check_columns(tables: Tables) -> DataFrame:
    """Required columns that a table lacks (a property of the schema, so there
    is one row per table and column, with no run)."""
    rows = [
        (None, None, "missing_column", name, c)
        for name, want in REQUIRED_COLUMNS.items()
        if name in tables
        for c in want
        if c not in tables[name].columns
    ]
    spark = next(iter(tables.values())).sparkSession
    return local_table(spark, rows, VIOLATIONS)


def check_headers(headers: DataFrame, name: str) -> DataFrame:
    """Required columns that a stage table's files lack, per run and pass
    (``headers``: run_id, pass_number, columns)."""
    want = F.array(*[F.lit(c) for c in REQUIRED_COLUMNS[name]])
    d = headers.select(*KEYS, F.explode(F.array_except(want, "columns")).alias("lost")).distinct()
    return _rows(d, "missing_column", F.lit(name), F.col("lost"))


def check_values(tables: Tables) -> DataFrame:
    """Blank or undeclared values in columns with a vocabulary."""
    parts = []
    for name, vocab in VOCABULARY.items():
        if name not in tables or not any(c in tables[name].columns for c in vocab):
            continue
        q = column_quality(tables[name], vocab)
        item = F.concat(F.lit(f"{name}."), F.col("column"))
        parts.append(_rows(q.where("blank_count > 0"), "blank_value", item, F.col("blank_count").cast("string")))
        bad = F.concat(F.col("invalid_count").cast("string"), F.lit(": "), F.array_join("examples", ","))
        parts.append(_rows(q.where("invalid_count > 0"), "invalid_value", item, bad))
    return union_all(parts)


def _difference(a: DataFrame, b: DataFrame, check: str) -> DataFrame:
    return _rows(id_difference(a, b), check, F.col("paper_id"), F.col("side"))


def _count_gap(a: DataFrame, b: DataFrame, check: str) -> DataFrame:
    n = row_counts(a, KEYS, "x").join(row_counts(b, KEYS, "y"), KEYS, "full_outer").na.fill(0, ["x", "y"])
    return _rows(n.where("x <> y"), check, F.lit("rows"), F.concat_ws(" vs ", F.col("y").cast("string"), F.col("x").cast("string")))


def check_triage_coverage(tables: Tables) -> DataFrame:
    """Both triage tables hold each manifest row once."""
    m = tables["paper_manifest"]
    parts = []
    for name in ("first_pass", "second_pass"):
        parts.append(_count_gap(m, tables[name], f"{name}_rows"))
        parts.append(_difference(m, tables[name], f"{name}_ids"))
    return union_all(parts)


def advanced(triage: DataFrame) -> DataFrame:
    return triage.where(_t("promotion_decision") == "advance_to_import")


def readable(imports: DataFrame) -> DataFrame:
    return imports.where(~is_blank(F.col("normalized_path")))


def check_import_handoff(tables: Tables) -> DataFrame:
    return _difference(advanced(tables["second_pass"]), tables["import_status"], "import_ids")


def check_fulltext_handoff(tables: Tables) -> DataFrame:
    """Reviews cover the readable imports; where a listing of stored texts is
    given (``stored``: path), each path is in it."""
    r = readable(tables["import_status"])
    parts = [_difference(r, tables["fulltext_review"], "review_ids")]
    if "stored" in tables:
        paths = tables["stored"].select(F.col("path").alias("_p")).distinct()
        lost = r.withColumn("_p", _t("normalized_path")).join(paths, "_p", "left_anti")
        parts.append(_rows(lost, "stored_text", F.col("paper_id"), F.col("_p")))
    return union_all(parts)


def reviewed(reviews: DataFrame) -> DataFrame:
    return reviews.where(~is_blank(F.col("fulltext_decision")))


def pending_reviews(reviews: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Review rows without a decision, per run and pass."""
    return reviews.groupBy(*keys).agg(F.count_if(is_blank(F.col("fulltext_decision"))).alias("pending"))


def check_evidence_handoff(tables: Tables) -> DataFrame:
    return _difference(reviewed(tables["fulltext_review"]), tables["evidence_extraction"], "evidence_ids")


def check_rescue_handoff(tables: Tables) -> DataFrame:
    """Rescue rows belong to a review and agree with its decision."""
    ids = [*KEYS, "paper_id"]
    r = tables["fulltext_rescue"].where(~is_blank(F.col("paper_id"))).select(*ids, _t("final_fulltext_decision").alias("_r"))
    v = tables["fulltext_review"].where(~is_blank(F.col("paper_id"))).select(*ids, _t("fulltext_decision").alias("_v"))
    lost = r.join(v, ids, "left_anti").select(*ids).distinct()
    differ = r.join(v, ids).where("_r <> _v")
    return union_all(
        [
            _rows(lost, "rescue_unknown", F.col("paper_id"), "absent_from_review"),
            _rows(differ, "rescue_decision", F.col("paper_id"), F.concat_ws(" vs ", "_r", "_v")),
        ]
    )


def in_final_phase(tables: Tables) -> DataFrame:
    """Runs that are complete, in final access, or told so by feedback."""
    last = latest_row(tables["pmc_mechanism_feedback"], ["run_id"], ["pass_number", "loop_id"])
    f = last.where(_t("pdf_deferral_decision") == "final_pdf_pass").select("run_id")
    if "workflow_state" in tables:
        s = tables["workflow_state"].where("status = 'complete' or access_phase = 'final_access'").select("run_id")
        f = f.unionByName(s)
    return f.distinct()


def check_prompt_fit(tables: Tables) -> DataFrame:
    """Weakly backed keeps in the final phase."""
    w = weak_keeps(tables["fulltext_review"], tables["evidence_extraction"])
    w = w.join(small(in_final_phase(tables)), "run_id", "left_semi")
    return _rows(w, "weak_keep", F.col("paper_id"), F.col("fulltext_decision"))


def check_final_list(tables: Tables) -> DataFrame:
    """Selected papers are the kept ones; outside the learning phase the rest
    are the unreadable ones, within it there are none."""
    f = tables["final_reading_list"]
    keep = tables["fulltext_review"].where(_t("fulltext_decision") == "keep")
    sel = f.where(_t("final_decision") == "selected_for_reading")
    away = f.where(_t("final_decision") == "abstract_relevant_fulltext_unavailable")
    unread = tables["import_status"].where(is_blank(F.col("normalized_path")))
    phase = tables["settings"].select("run_id", text_setting(F.col("settings"), "access_phase", "pmc_learning").alias("_phase"))
    phase = small(phase)
    d = id_difference(unread, away).join(phase, "run_id", "left").where("_phase <> 'pmc_learning'")
    early = distinct_ids(away).join(phase, "run_id", "left").where("_phase is null or _phase = 'pmc_learning'")
    return union_all(
        [
            _difference(keep, sel, "final_selected"),
            _rows(d, "final_unavailable", F.col("paper_id"), F.col("side")),
            _rows(early, "final_unavailable", F.col("paper_id"), "in_learning_phase"),
        ]
    )


def feedback_totals(tables: Tables) -> DataFrame:
    """Per run: feedback rows and the latest decision on file requests."""
    fb = tables["pmc_mechanism_feedback"]
    last = latest_row(fb, ["run_id"], ["pass_number", "loop_id"]).select(
        "run_id", _t("pdf_deferral_decision").alias("latest_decision")
    )
    return row_counts(fb, ["run_id"], "loops").join(last, "run_id")


def check_shortlist(tables: Tables, min_loops: int = 2) -> DataFrame:
    """The shortlist covers the queue, asks for something, and does not come
    before the learning passes are over."""
    q, s = tables["manual_pdf_queue"], tables["pdf_download_shortlist"]
    fb = feedback_totals(tables)
    n = row_counts(q, ["run_id"], "queued").join(fb, "run_id")
    asks = s.groupBy("run_id").agg(
        F.count("*").alias("listed"), F.count_if(_t("shortlist_decision") == "request_pdf").alias("asked")
    )
    n = n.join(asks, "run_id", "left").na.fill(0, ["listed", "asked"])
    early = F.col("loops") < min_loops
    final = F.col("latest_decision") == "final_pdf_pass"
    ready = n.where(~early & final).select("run_id")
    diff = id_difference(q, s, ["run_id"]).join(ready, "run_id", "left_semi")
    return union_all(
        [
            _rows(n.where(early & final), "shortlist_early", F.lit("feedback"), "final_before_minimum"),
            _rows(n.where(early & (F.col("listed") > 0)), "shortlist_early", F.lit("shortlist"), "rows_before_minimum"),
            _rows(n.where(~early & ~final & (F.col("listed") > 0)), "shortlist_early", F.lit("shortlist"), "rows_before_final"),
            _rows(diff, "shortlist_ids", F.col("paper_id"), F.col("side")),
            _rows(n.where(~early & final & (F.col("asked") == 0)), "shortlist_requests", F.lit("rows"), "none_requested"),
        ]
    )


# States a run can be in.
STATUSES = ("initialized", "running", "loop_required", "awaiting_pdf_shortlist", "complete", "blocked")


def check_state(tables: Tables, min_loops: int = 2, max_loops: int = 2) -> DataFrame:
    """The stored run state agrees with the tables it sums up."""
    st = tables["workflow_state"]
    loops = tables["workflow_loop_decision"].groupBy("run_id").agg(F.count_if(_t("triggered") == "yes").alias("x_active"))
    q = row_counts(tables["manual_pdf_queue"], ["run_id"], "x_queue")
    s = row_counts(tables["pdf_download_shortlist"], ["run_id"], "x_short")
    fb = feedback_totals(tables)
    d = st
    for t in (loops, q, s, fb):
        d = d.join(t, "run_id", "left")
    d = d.na.fill(0, ["x_active", "x_queue", "x_short", "loops"])
    done = F.col("status") == "complete"

    def differ(have: str, want: Column) -> Column:
        return ~F.col(have).eqNullSafe(want)

    last = F.coalesce("latest_decision", F.lit(""))
    tests = {
        "status": ~F.col("status").isin(*STATUSES),
        "active_loop_count": differ("active_loop_count", F.col("x_active")),
        "manual_pdf_queue_count": differ("manual_pdf_queue_count", F.col("x_queue")),
        "pdf_download_shortlist_count": differ("pdf_download_shortlist_count", F.col("x_short")),
        "latest_pdf_deferral_decision": (last != "") & differ("latest_pdf_deferral_decision", last),
        "completed_big_loop_count": F.col("completed_big_loop_count").isNotNull()
        & (F.col("completed_big_loop_count") != F.col("loops")),
        "min_big_workflow_loops": F.coalesce(F.col("min_big_workflow_loops") != min_loops, F.lit(False)),
        "max_workflow_loops": F.coalesce(F.col("max_workflow_loops") != max_loops, F.lit(False)),
        "no_active_loop": (F.col("loops") > 0) & (F.col("loops") < min_loops) & (F.col("x_active") == 0),
        "complete_not_final_access": done & differ("access_phase", F.lit("final_access")),
        "complete_with_active_loops": done & (F.col("x_active") > 0),
        "complete_below_minimum": done & (F.col("loops") < min_loops),
        "complete_above_maximum": done & (F.col("loops") > max_loops),
        "complete_not_final": done & (last != "final_pdf_pass"),
        "complete_without_shortlist": done & (F.col("x_queue") > 0) & (F.col("x_short") == 0),
        "complete_signal": done & (F.col("x_queue") > 0) & differ("completion_signal", F.lit("pdf_download_shortlist_ready")),
    }
    failed = F.filter(F.array(*[F.when(v, F.lit(k)) for k, v in tests.items()]), lambda x: x.isNotNull())
    e = d.select("run_id", F.explode(failed).alias("_test"), "status")
    return _rows(e, "run_state", F.col("_test"), F.col("status"))


def check_revisions(tables: Tables) -> DataFrame:
    """Each deferring feedback has a revision row with every field filled.
    The last row of a loop counts."""
    fb = tables["pmc_mechanism_feedback"].where(_t("pdf_deferral_decision") == "defer_pdfs")
    fb = fb.select("run_id", "pass_number", _t("loop_id").alias("loop_id")).where("loop_id <> ''")
    rv = tables["run_guidance_revision_log"].withColumn("loop_id", _t("feedback_loop_id")).where("loop_id <> ''")
    rv = rv.drop("pass_number")
    order = [c for c in ("created_at", "revision_id") if c in rv.columns]
    rv = latest_row(rv, ["run_id", "loop_id"], order)
    fields = REVISION_PATHS + REVISION_LEARNING
    lost = fb.join(rv, ["run_id", "loop_id"], "left_anti")
    blank = F.filter(F.array(*[F.when(is_blank(F.col(c)), F.lit(c)) for c in fields]), lambda x: x.isNotNull())
    part = fb.join(rv, ["run_id", "loop_id"]).select("run_id", "pass_number", "loop_id", F.explode(blank).alias("_f"))
    return union_all(
        [
            _rows(lost, "revision_missing", F.col("loop_id"), "no_revision"),
            _rows(part, "revision_blank", F.col("loop_id"), F.col("_f")),
        ]
    )


def pass_readiness(tables: Tables) -> DataFrame:
    """Per run and pass what the next pass needs of it, as counts."""
    blank = lambda *cs: F.count_if(sum_any([is_blank(F.col(c)) for c in cs]))
    m = row_counts(tables["paper_manifest"], KEYS, "papers")
    a = tables["first_pass"].groupBy(*KEYS).agg(F.count("*").alias("first_rows"), blank("first_pass_decision").alias("first_blank"))
    b = tables["second_pass"].groupBy(*KEYS).agg(
        F.count("*").alias("second_rows"), blank("second_pass_decision", "promotion_decision").alias("second_blank")
    )
    fb = tables["pmc_mechanism_feedback"]
    f = latest_row(fb, KEYS, ["loop_id"]).select(*KEYS, _t("pdf_deferral_decision").alias("said"))
    d = m
    for t in (a, b, f):
        d = d.join(t, KEYS, "full_outer")
    return d.na.fill(0, ["papers", "first_rows", "first_blank", "second_rows", "second_blank"])


def sum_any(tests: Sequence[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def readiness_reasons() -> Column:
    tests = {
        "no_manifest": F.col("papers") == 0,
        "first_pass_incomplete": (F.col("first_rows") != F.col("papers")) | (F.col("first_blank") > 0),
        "second_pass_incomplete": (F.col("second_rows") != F.col("papers")) | (F.col("second_blank") > 0),
        "no_feedback": F.col("said").isNull(),
        "no_rerun_requested": F.col("said").isNotNull() & (F.col("said") != "defer_pdfs"),
    }
    return F.filter(F.array(*[F.when(v, F.lit(k)) for k, v in tests.items()]), lambda x: x.isNotNull())


def check_pass_sequence(tables: Tables) -> DataFrame:
    """A later pass exists only after a finished earlier one."""
    passes = union_all([t.select(*KEYS) for n, t in tables.items() if set(KEYS) <= set(t.columns)]).distinct()
    later = passes.where("pass_number > 1").withColumn("_prev", F.col("pass_number") - 1)
    r = pass_readiness(tables).withColumnRenamed("pass_number", "_prev")
    d = later.join(r, ["run_id", "_prev"], "left").na.fill(0, ["papers", "first_rows", "first_blank", "second_rows", "second_blank"])
    e = d.select(*KEYS, F.explode(readiness_reasons()).alias("_why"))
    return _rows(e, "pass_sequence", F.col("_why"), "previous_pass")


def check_caps(tables: Tables) -> DataFrame:
    """Settings that cap collection, and capped collection rows."""
    parts = []
    if "query_diagnostics" in tables:
        d = tables["query_diagnostics"].where(is_truncated())
        parts.append(_rows(d, "collection_capped", F.col("query_id"), F.concat_ws(" of ", F.col("collected_count").cast("string"), F.col("raw_hit_count").cast("string"))))
    if "setting_lines" in tables:
        c = forbidden_caps(tables["setting_lines"], "line")
        parts.append(_rows(c, "forbidden_cap", F.col("cap_key"), F.col("line_no").cast("string")))
    return union_all(parts)


# Legal settings.
MODES = {
    "artifact_policy": ("workflow_only", ("workflow_only", "allow_user_requested_exports")),
    "pmc_fulltext_review_gate_mode": ("all_available", ("all_available", "scaled")),
    "fulltext_lookup_mode": ("pmc_then_oa_final", ("pmc_then_oa_final", "pmc_only", "exhaustive_oa")),
}
LOOP_SETTINGS = ("min_big_workflow_loops", "max_workflow_loops")


def check_settings(tables: Tables) -> DataFrame:
    s = F.col("settings")
    tests = []
    for key, (default, legal) in MODES.items():
        v = text_setting(s, key, default)
        tests.append(F.when(~v.isin(*legal), F.struct(F.lit(key).alias("k"), v.alias("v"))))
    for key in LOOP_SETTINGS:
        v = int_setting(s, key, 2)
        tests.append(F.when(v != 2, F.struct(F.lit(key).alias("k"), v.cast("string").alias("v"))))
    bad = F.filter(F.array(*tests), lambda x: x.isNotNull())
    keys = [k for k in KEYS if k in tables["settings"].columns]
    d = tables["settings"].select(*keys, F.explode(bad).alias("b"))
    return _rows(d, "setting", F.col("b.k"), F.col("b.v"))


def coverage_counts(imports: DataFrame, reviews: DataFrame, evidence: DataFrame) -> DataFrame:
    """Per run and pass the sizes of the sets between import and evidence, by
    one join on the paper."""
    ids = [*KEYS, "paper_id"]
    av = _t("pmc_access_status") == "available"
    i = imports.where(~is_blank(F.col("paper_id"))).groupBy(*ids).agg(
        F.bool_or(av).alias("available"),
        F.bool_or(av & (_t("pmc_parse_status") == "not_attempted")).alias("unattempted"),
        F.bool_or(usable_import()).alias("usable"),
        F.bool_or(av & (_t("pmc_parse_status") == "unusable") & ~_yes("pdf_needed")).alias("unqueued"),
    )
    r = distinct_ids(reviewed(reviews)).withColumn("reviewed", F.lit(True))
    e = distinct_ids(evidence.where(~is_blank(F.col("evidence_tier")))).withColumn("evidenced", F.lit(True))
    d = i.join(r, ids, "left").join(e, ids, "left").na.fill(False)
    n = lambda c: F.count_if(c)
    u = F.col("usable")
    return d.groupBy(*KEYS).agg(
        n(F.col("available")).alias("available"),
        n(F.col("unattempted")).alias("unattempted"),
        n(u).alias("usable"),
        n(u & F.col("reviewed")).alias("reviewed"),
        n(u & F.col("evidenced")).alias("evidenced"),
        n(F.col("unqueued")).alias("unqueued"),
        n(u & ~F.col("reviewed")).alias("missing_review"),
        n(u & ~F.col("evidenced")).alias("missing_evidence"),
    )


def _yes(c: str) -> Column:
    """A flag column, boolean or yes/no text."""
    return F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))).isin("yes", "true")


def gate_open() -> Column:
    return (F.col("unattempted") > 0) | (F.col("unqueued") > 0) | (F.col("missing_review") > 0) | (F.col("missing_evidence") > 0)


def check_review_gate(tables: Tables) -> DataFrame:
    c = coverage_counts(tables["import_status"], tables["fulltext_review"], tables["evidence_extraction"])
    c = strict_runs(c, tables)
    parts = F.array(
        *[
            F.struct(F.lit(k).alias("k"), F.col(k).alias("n"))
            for k in ("unattempted", "unqueued", "missing_review", "missing_evidence")
        ]
    )
    d = c.select(*KEYS, F.explode(F.filter(parts, lambda p: p["n"] > 0)).alias("p"))
    return _rows(d, "review_gate", F.col("p.k"), F.col("p.n").cast("string"))


def strict_runs(df: DataFrame, tables: Tables) -> DataFrame:
    """Rows of runs whose review gate asks for everything available."""
    if "settings" not in tables:
        return df
    mode = text_setting(F.col("settings"), "pmc_fulltext_review_gate_mode", "all_available")
    lax = tables["settings"].where(mode != "all_available").select("run_id").distinct()
    return df.join(small(lax), "run_id", "left_anti")


def check_listing(listing: DataFrame, names: Sequence[str], patterns: Sequence[str]) -> DataFrame:
    """Paths that are neither declared names nor match a pattern (a star also
    crosses folders)."""
    ok = F.col("path").isin(*names)
    for p in patterns:
        ok = ok | F.col("path").rlike("(?s)^" + translate(p).replace("(?s:", "(?:").replace(r"\Z", "").replace(r"\z", "") + "$")
    return _rows(listing.where(~ok), "undeclared_file", F.col("path"), "not_allowed")


def check_prior_payloads(payloads: DataFrame, state: DataFrame, active: DataFrame) -> DataFrame:
    """Payloads of earlier passes in runs that are complete."""
    done = state.where("status = 'complete'").select("run_id")
    a = active.select("run_id", F.col("pass_number").alias("_active"))
    d = payloads.join(small(done), "run_id", "left_semi").join(small(a), "run_id")
    return _rows(d.where(F.col("pass_number") < F.col("_active")), "prior_payload", F.col("paper_id"), "not_purged")


def check_recorded(tables: Tables) -> DataFrame:
    """Runs of several passes have recorded triage decisions."""
    many = tables["paper_manifest"].groupBy("run_id").agg(F.max("pass_number").alias("_last")).where("_last > 1")
    got = tables["pass_decisions"].where("stage = 'abstract_triage'").select("run_id").distinct()
    return _rows(many.join(got, "run_id", "left_anti"), "no_recorded_decisions", F.lit("pass_decisions"), "empty")


def check_required(listing: DataFrame, required: Sequence[str]) -> DataFrame:
    """Per run and pass the required inputs and outputs not in the listing."""
    want = F.explode(F.array(*[F.lit(r) for r in required]))
    d = listing.select(*KEYS).distinct().withColumn("path", want)
    d = d.join(listing.select(*KEYS, "path").distinct(), [*KEYS, "path"], "left_anti")
    return _rows(d, "required_missing", F.col("path"), "absent")


def check_order(tables: Tables) -> DataFrame:
    """Feedback comes after the review rules and the rescue: per run and pass
    with feedback, both exist (``review_rules``: run_id, pass_number)."""
    fb = tables["pmc_mechanism_feedback"].select(*KEYS).distinct()
    parts = []
    for name in ("review_rules", "fulltext_rescue"):
        have = tables[name].select(*KEYS).distinct()
        parts.append(_rows(fb.join(have, KEYS, "left_anti"), "feedback_order", F.lit(name), "missing_before_feedback"))
    return union_all(parts)


CHECKS = (
    check_columns,
    check_values,
    check_triage_coverage,
    check_import_handoff,
    check_fulltext_handoff,
    check_evidence_handoff,
    check_rescue_handoff,
    check_prompt_fit,
    check_final_list,
    check_shortlist,
    check_state,
    check_revisions,
    check_pass_sequence,
    check_caps,
    check_settings,
    check_review_gate,
    check_recorded,
    check_order,
)


def completed(name: str, df: DataFrame) -> DataFrame:
    """A stage table with the required columns it lacks, blank."""
    lost = [c for c in REQUIRED_COLUMNS.get(name, ()) if c not in df.columns]
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in lost])


def validate(
    tables: Tables,
    names: Sequence[str] | None = None,
    patterns: Sequence[str] = (),
    required: Sequence[str] | None = None,
) -> DataFrame:
    """Every check as one table of violations. A missing column is reported
    once and read as blank by the other checks. A check that lacks a table is
    reported as ``not_run`` with the table's name, so no gap passes unseen.

    The checks of files take the table ``listing`` and the declared ``names``,
    ``patterns`` and ``required`` paths, the one of old payloads the tables
    ``payloads`` and ``active`` (run_id, pass_number)."""
    full = {n: completed(n, t) for n, t in tables.items()}
    checks = {c.__name__: (lambda c=c: c(tables if c is check_columns else full)) for c in CHECKS}
    checks["check_prior_payloads"] = lambda: check_prior_payloads(full["payloads"], full["workflow_state"], full["active"])
    if names is not None:
        checks["check_listing"] = lambda: check_listing(full["listing"], names, patterns)
    if required is not None:
        checks["check_required"] = lambda: check_required(full["listing"], required)
    parts, lost = [], []
    for name, check in checks.items():
        try:
            parts.append(check())
        except KeyError as e:
            if e.args[0] in tables:
                raise
            lost.append((None, None, "not_run", name, f"no table {e.args[0]}"))
        except IndexError:
            # A check over several tables, none of which is given.
            lost.append((None, None, "not_run", name, "no table of those it reads"))
    if lost:
        parts.append(local_table(next(iter(tables.values())).sparkSession, lost, VIOLATIONS))
    return union_all(parts)
