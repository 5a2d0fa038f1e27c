"""Per-paper state kept across passes. Plain files know no in-place update, so
a fold is a full outer join of the old state with the new rows (each unique by
key) written as a new version; the same functions serve batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenline.functions.fields import id_or_pmid, payload_hash
from screenline.functions.text import is_blank, strip, text_of
from screenline.operators.ranking import latest_per_key
from screenline.session import small

PAPERS = (
    "run_id string, paper_id string, pmid string, doi string, title string, year string, first_seen_pass int, "
    "last_seen_pass int, latest_status string, latest_decision string, latest_rationale string"
)
DECISIONS = (
    "run_id string, pass_number int, paper_id string, pmid string, stage string, decision string, status string, "
    "rationale string"
)
PAPER_KEY = ("run_id", "paper_id")


def fold(old: DataFrame, new: DataFrame, keys: Sequence[str], merged: dict[str, Column]) -> DataFrame:
    """Join old and new by key; ``merged`` gives each other column from
    ``o.<col>`` and ``n.<col>``, with ``o._is`` / ``n._is`` telling the side."""
    o = old.withColumn("_is", F.lit(True)).alias("o")
    n = new.withColumn("_is", F.lit(True)).alias("n")
    on = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    both = o.join(n, on, "full_outer")
    key_cols = [F.coalesce(F.col(f"o.{k}"), F.col(f"n.{k}")).alias(k) for k in keys]
    return both.select(*key_cols, *[c.alias(k) for k, c in merged.items()]).select(*old.columns)


def _new_or_old(c: str) -> Column:
    """The new value where the key is in the new rows, even when null."""
    return F.when(F.col("n._is"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))


def _keyed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with an id (own or from the pmid), the last one per paper."""
    d = rows.withColumn("paper_id", id_or_pmid(F.col("paper_id"), F.col("pmid"))).where("paper_id is not null")
    return latest_per_key(d, PAPER_KEY, order) if order else d


def _text(c: str) -> Column:
    return strip(text_of(F.col(c).cast("string"))).alias(c)


def supersede(papers: DataFrame, decisions: DataFrame, manifest: DataFrame, pass_number: int, keep_rejected: bool = False):
    """Papers and decisions of this pass that the manifest no longer holds.
    Runs with no manifest row are left alone. Returns both tables."""
    ids = manifest.withColumn("paper_id", id_or_pmid(F.col("paper_id"), F.col("pmid"))).where("paper_id is not null")
    ids = ids.select(*PAPER_KEY).distinct()
    runs = small(ids.select("run_id").distinct().withColumn("_run", F.lit(True)))
    here = ids.withColumn("_here", F.lit(True))

    def mark(df: DataFrame, of_pass: Column) -> DataFrame:
        d = df.join(here, list(PAPER_KEY), "left").join(runs, "run_id", "left")
        return d.withColumn("_gone", of_pass & F.col("_run").isNotNull() & F.col("_here").isNull())

    gone = F.col("_gone")
    p = mark(papers, F.col("last_seen_pass") == pass_number)
    if keep_rejected:
        gone = gone & (F.coalesce("latest_status", F.lit("")) != "rejected")
    p = p.withColumn("_g", gone).withColumns(
        {
            "latest_status": F.when(F.col("_g"), "superseded").otherwise(F.col("latest_status")),
            "latest_decision": F.when(F.col("_g"), "collection_overwrite").otherwise(F.col("latest_decision")),
            "latest_rationale": F.when(F.col("_g"), "absent_from_manifest").otherwise(F.col("latest_rationale")),
        }
    )
    d = mark(decisions, F.col("pass_number") == pass_number).withColumns(
        {
            "status": F.when(F.col("_gone"), "superseded").otherwise(F.col("status")),
            "rationale": F.when(F.col("_gone"), "absent_from_manifest").otherwise(F.col("rationale")),
        }
    )
    return p.select(*papers.columns), d.select(*decisions.columns)


def fold_collected(papers: DataFrame, manifest: DataFrame, pass_number: int, order: Sequence[str] = ()) -> DataFrame:
    """Papers of a collection: new ones come in as collected, known ones take
    the new fields; a rejected paper stays rejected."""
    new = _keyed(manifest, order).select(
        *PAPER_KEY, _text("pmid"), _text("doi"), _text("title"), _text("year")
    )
    rejected = F.col("o.latest_status") == "rejected"
    merged = {c: _new_or_old(c) for c in ("pmid", "doi", "title", "year")}
    merged |= {
        "first_seen_pass": F.coalesce("o.first_seen_pass", F.lit(pass_number)),
        "last_seen_pass": F.when(F.col("n._is"), F.lit(pass_number)).otherwise(F.col("o.last_seen_pass")),
        "latest_status": F.when(F.col("n._is") & ~F.coalesce(rejected, F.lit(False)), "collected").otherwise(
            F.col("o.latest_status")
        ),
        "latest_decision": F.col("o.latest_decision"),
        "latest_rationale": F.col("o.latest_rationale"),
    }
    return fold(papers, new, PAPER_KEY, merged)


def fold_triage(papers: DataFrame, decisions: DataFrame, triage: DataFrame, pass_number: int, order: Sequence[str] = ()):
    """Decisions of a pass: stop means rejected, anything else advanced.
    Returns papers and decisions."""
    new = _keyed(triage, order).select(
        *PAPER_KEY,
        _text("pmid"),
        _text("doi"),
        _text("title"),
        _text("year"),
        F.when(strip(F.col("promotion_decision")) == "stop", "rejected").otherwise("advanced").alias("status"),
        _text("second_pass_decision"),
        _text("promotion_decision"),
        _text("second_pass_rationale"),
    )
    seen = {
        "first_seen_pass": F.coalesce("o.first_seen_pass", F.lit(pass_number)),
        "last_seen_pass": F.when(F.col("n._is"), F.lit(pass_number)).otherwise(F.col("o.last_seen_pass")),
    }

    def pick(new_col: str, old_col: str) -> Column:
        return F.when(F.col("n._is"), F.col(f"n.{new_col}")).otherwise(F.col(f"o.{old_col}"))

    merged = {c: _new_or_old(c) for c in ("pmid", "doi", "title", "year")} | seen
    merged |= {
        "latest_status": pick("status", "latest_status"),
        "latest_decision": pick("second_pass_decision", "latest_decision"),
        "latest_rationale": pick("second_pass_rationale", "latest_rationale"),
    }
    rows = new.select(
        "run_id",
        F.lit(pass_number).alias("pass_number"),
        "paper_id",
        "pmid",
        F.lit("abstract_triage").alias("stage"),
        F.when(F.col("second_pass_decision") != "", F.col("second_pass_decision"))
        .otherwise(F.col("promotion_decision"))
        .alias("decision"),
        "status",
        F.col("second_pass_rationale").alias("rationale"),
    )
    # The stored pmid of a known decision row stays.
    drow = {c: _new_or_old(c) for c in ("decision", "status", "rationale")}
    drow["pmid"] = F.coalesce("o.pmid", "n.pmid")
    keys = ("run_id", "pass_number", "paper_id", "stage")
    return fold(papers, new, PAPER_KEY, merged), fold(decisions, rows, keys, drow)


RECORD_COLUMNS = ("pmid", "doi", "title", "journal", "year", "authors", "source_queries", "retrieval_batch")


def fold_records(records: DataFrame, new: DataFrame, pass_number: int, order: Sequence[str] = ()) -> DataFrame:
    """Payloads keyed by pass and paper with a hash of the content; rows with
    no id at all are skipped, rows not collected again stay."""
    n = _keyed(new, order).withColumn("pass_number", F.lit(pass_number))
    n = n.withColumn("sha256", payload_hash("paper_id", *RECORD_COLUMNS))
    keys = ("run_id", "pass_number", "paper_id")
    merged = {c: _new_or_old(c) for c in (*RECORD_COLUMNS, "sha256")}
    n = n.select(*keys, *RECORD_COLUMNS, "sha256")
    return fold(records, n, keys, merged)


READ_STATE = (
    "run_id string, paper_id string, pmid string, pmcid string, doi string, title string, first_read_pass int, "
    "last_read_pass int, source_route string, pmc_access_status string, pmc_parse_status string, "
    "normalized_path string, latest_fulltext_decision string, latest_evidence_tier string, latest_directness string, "
    "latest_target_centrality string, latest_query_feedback_signal string, latest_retention_role string, "
    "latest_rationale string"
)


def fold_read_state(
    state: DataFrame, review: DataFrame, evidence: DataFrame, pass_number: int, order: Sequence[str] = ()
) -> DataFrame:
    """Latest full-text reading per paper, with its evidence row if any; the
    pass of the first reading is kept."""
    ev_cols = ("evidence_tier", "directness", "target_centrality", "query_feedback_signal", "retention_role")
    # Of several evidence rows the last counts, where rows are numbered.
    place = F.col("row_no") if "row_no" in evidence.columns else F.lit(0)
    ev = evidence.where(~is_blank(F.col("paper_id"))).select(*PAPER_KEY, *[_text(c) for c in ev_cols], place.alias("_no"))
    ev = latest_per_key(ev, PAPER_KEY, ["_no", *ev_cols]).drop("_no")
    new = _keyed(review, order).join(ev, list(PAPER_KEY), "left")
    new = new.select(
        *PAPER_KEY,
        *[_text(c) for c in ("pmid", "pmcid", "doi", "title")],
        _text("normalized_source_type").alias("source_route"),
        F.lit("available").alias("pmc_access_status"),
        F.lit("usable").alias("pmc_parse_status"),
        _text("normalized_path"),
        _text("fulltext_decision").alias("latest_fulltext_decision"),
        *[text_of(F.col(c)).alias(f"latest_{c}") for c in ev_cols],
        _text("fulltext_rationale").alias("latest_rationale"),
    )
    merged = {c: _new_or_old(c) for c in new.columns if c not in PAPER_KEY}
    merged |= {
        "first_read_pass": F.coalesce("o.first_read_pass", F.lit(pass_number)),
        "last_read_pass": F.when(F.col("n._is"), F.lit(pass_number)).otherwise(F.col("o.last_read_pass")),
    }
    return fold(state, new, PAPER_KEY, merged)


def read_state_before(state: DataFrame, pass_number: int) -> DataFrame:
    return state.where(F.col("last_read_pass") < pass_number)


def replay(log: DataFrame) -> DataFrame:
    """The papers table after all passes at once, in closed form.

    ``log`` has one row per run, pass and paper with the manifest's fields,
    ``in_manifest`` and the triage columns (null where the pass took no
    decision). A paper's status follows from its last event: a decision, else
    a collection; a rejection outlives later collections.
    """
    status = F.when(F.col("promotion_decision") == "stop", "rejected").when(
        F.col("promotion_decision").isNotNull(), "advanced"
    )
    d = log.withColumn("_status", status)
    decided = F.when(F.col("_status").isNotNull(), F.col("pass_number"))
    last = lambda c: F.max_by(F.col(c), F.col("pass_number"))
    at_decision = lambda c: F.max_by(F.col(c), decided)
    g = d.groupBy(*PAPER_KEY).agg(
        last("pmid").alias("pmid"),
        last("doi").alias("doi"),
        last("title").alias("title"),
        last("year").alias("year"),
        F.min("pass_number").alias("first_seen_pass"),
        F.max("pass_number").alias("last_seen_pass"),
        F.max(decided).alias("_decided"),
        at_decision("_status").alias("_status"),
        at_decision("second_pass_decision").alias("latest_decision"),
        at_decision("second_pass_rationale").alias("latest_rationale"),
    )
    collected_after = F.col("_decided").isNull() | (
        (F.col("last_seen_pass") > F.col("_decided")) & (F.col("_status") != "rejected")
    )
    return g.withColumn("latest_status", F.when(collected_after, "collected").otherwise(F.col("_status"))).select(
        *PAPER_KEY,
        "pmid",
        "doi",
        "title",
        "year",
        "first_seen_pass",
        "last_seen_pass",
        "latest_status",
        "latest_decision",
        "latest_rationale",
    )
