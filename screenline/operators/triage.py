"""Decisions on titles and abstracts: prescreen hint, first pass, rescue of
excluded papers, stricter second reading in later passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenline.functions.text import is_blank
from screenline.operators.match import overlap_terms
from screenline.operators.ranking import latest_per_key

PRESCREEN_MIN_OVERLAP = 3
PRESCREEN_SHOWN_TERMS = 20


def _f(name: str) -> Column:
    return F.col(f"flags.{name}")


def _int(c: Column) -> Column:
    return c.cast("int")


def prescreen(papers: DataFrame, topic: DataFrame, stop: Sequence[str] = ()) -> DataFrame:
    """Hint only: three or more topic terms in title and abstract."""
    text = F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("abstract", F.lit("")))
    found = overlap_terms(papers, topic, text, stop)
    enough = F.size("overlap") >= PRESCREEN_MIN_OVERLAP
    return found.select(
        *papers.columns,
        F.when(enough, "possible_include").alias("prescreen_hint"),
        F.when(enough, "topic_overlap").alias("prescreen_rationale"),
        F.when(enough, F.array_join(F.slice("overlap", 1, PRESCREEN_SHOWN_TERMS), ";")).alias(
            "prescreen_overlap_terms"
        ),
    )


def first_decision(pass_number: Column) -> Column:
    """Struct of the first reading from ``flags``."""
    p, m, o, c, x, r = (_f(k) for k in "pmocxr")
    dimensions = _int(m) + _int(o) + _int(c) + _int(r)

    def out(decision: str, confidence: str, match: str, role: str, reason: str) -> Column:
        return F.struct(
            F.lit(decision).alias("decision"),
            F.lit(confidence).alias("confidence"),
            F.lit(match).alias("match"),
            F.lit(role).alias("role"),
            F.lit(reason).alias("reason"),
        )

    return (
        F.when((p & m & o) | _f("claim"), out("include", "high", "direct", "none", "direct_claim"))
        .when(
            _f("review") & p & (m | o) & r,
            out("include", "medium", "background_only", "field_synthesis", "review_frame"),
        )
        .when((pass_number == 1) & p & o & (dimensions >= 2), out("include", "low", "indirect", "none", "learning_probe"))
        .when(x, out("exclude", "medium", "background_only", "none", "exclusion"))
        .otherwise(out("exclude", "medium", "background_only", "none", "no_claim"))
    )


def triage_first(flagged: DataFrame) -> DataFrame:
    d = flagged.withColumn("_d", first_decision(F.col("pass_number")))
    return d.select(
        *flagged.columns,
        F.col("_d.decision").alias("first_pass_decision"),
        F.col("_d.reason").alias("first_pass_rationale"),
        F.col("_d.confidence").alias("first_pass_confidence"),
        F.col("_d.match").alias("topic_match_type"),
        F.lit("agent").alias("triage_actor"),
        F.col("_d.role").alias("synthesis_role"),
    )


def _verdict(keep: bool, confidence: str, reason: str, role: str = "none") -> Column:
    return F.struct(
        F.lit(keep).alias("keep"),
        F.lit(confidence).alias("confidence"),
        F.lit(reason).alias("reason"),
        F.lit(role).alias("role"),
    )


def rescue_verdict() -> Column:
    """Should an excluded paper come back? Struct (keep, confidence, reason, role)."""
    p, m, o, c, x, r = (_f(k) for k in "pmocxr")
    positive = p & ((m & o) | _f("claim"))
    return (
        F.when(x & ~positive, _verdict(False, "high", "excluded"))
        .when(positive, _verdict(True, "medium", "claim"))
        .when(p & c & (m | o), _verdict(True, "low", "comparator"))
        .when(_f("review") & p & (m | o | r), _verdict(True, "low", "review", "field_synthesis"))
        .otherwise(_verdict(False, "medium", "no_signal"))
    )


def adjudicate_verdict() -> Column:
    """The stricter reading of later passes, on the profile's own signal terms."""
    return (
        F.when(_f("x") & ~(_f("direct") | _f("comparator")), _verdict(False, "high", "exclusion_stronger"))
        .when(_f("direct"), _verdict(True, "high", "direct"))
        .when(_f("contextual"), _verdict(True, "medium", "contextual"))
        .when(_f("comparator"), _verdict(True, "medium", "comparator"))
        .otherwise(_verdict(False, "medium", "no_claim"))
    )


def flag_prior_drops(df: DataFrame, read_state: DataFrame) -> DataFrame:
    """Add ``prior_drop``: an earlier full-text reading spoke against the paper."""
    against = (
        (F.col("latest_fulltext_decision") == "drop")
        | (F.col("latest_retention_role") == "exclude")
        | F.col("latest_query_feedback_signal").isin("tighten_query", "reviewer_calibration")
    )
    keys = [k for k in ("run_id",) if k in read_state.columns and k in df.columns] + ["paper_id"]
    if "pass_number" in df.columns and "last_read_pass" in read_state.columns:
        earliest = read_state.where(against).groupBy(*keys).agg(F.min("last_read_pass").alias("_drop_pass"))
        hit = F.coalesce(F.col("_drop_pass") < F.col("pass_number"), F.lit(False))
        return df.join(earliest, keys, "left").withColumn("prior_drop", hit).drop("_drop_pass")
    ids = read_state.where(against).select(*keys).distinct().withColumn("_hit", F.lit(True))
    return df.join(ids, keys, "left").withColumn("prior_drop", F.coalesce("_hit", F.lit(False))).drop("_hit")


def triage_second(first: DataFrame) -> DataFrame:
    """Second reading of papers with ``flags``, the first decision and
    ``prior_drop``."""
    d = first.withColumn("_rescue", rescue_verdict()).withColumn("_judge", adjudicate_verdict())
    included = F.col("first_pass_decision") == "include"
    later = F.col("pass_number") >= 2
    held = F.col("prior_drop") & F.col("_rescue.keep")

    def none_if_blank(c: str, default: str) -> Column:
        return F.when(is_blank(F.col(c)), F.lit(default)).otherwise(F.trim(c))

    def row(keep: Column, confidence: Column, reason: Column, role: Column) -> Column:
        return F.struct(
            keep.alias("keep"), confidence.alias("confidence"), reason.alias("reason"), role.alias("role")
        )

    judge, rescue = F.col("_judge"), F.col("_rescue")
    noted = F.when(F.col("prior_drop") & ~judge["keep"], F.concat(judge["reason"], F.lit("+prior_drop"))).otherwise(
        judge["reason"]
    )
    v = (
        F.when(included & later, row(judge["keep"], judge["confidence"], noted, judge["role"]))
        .when(
            included,
            row(
                F.lit(True),
                none_if_blank("first_pass_confidence", "medium"),
                F.lit("confirmed"),
                none_if_blank("synthesis_role", "none"),
            ),
        )
        .when(held, row(judge["keep"], judge["confidence"], F.concat(judge["reason"], F.lit("+prior_drop")), judge["role"]))
        .otherwise(row(rescue["keep"], rescue["confidence"], rescue["reason"], rescue["role"]))
    )
    d = d.withColumn("_v", v)
    keep = F.col("_v.keep")
    decision = (
        F.when(included & keep, "confirm_include")
        .when(included, "overturn_to_exclude")
        .when(keep, "overturn_to_include")
        .otherwise("confirm_exclude")
    )
    rest = [c for c in first.columns if c != "synthesis_role"]
    return d.select(
        *rest,
        decision.alias("second_pass_decision"),
        F.col("_v.reason").alias("second_pass_rationale"),
        F.col("_v.confidence").alias("second_pass_confidence"),
        F.when(keep, "advance_to_import").otherwise("stop").alias("promotion_decision"),
        F.col("_v.role").alias("synthesis_role"),
    )


def carry_over(
    fresh: DataFrame,
    existing: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = ("run_id", "pass_number", "paper_id"),
    order: Sequence[str] = ("row_no",),
) -> DataFrame:
    """Rebuild a work table keeping what was already decided: blank ids are
    ignored and the last of repeated rows wins."""
    old = existing.where(~is_blank(F.col("paper_id")))
    old = latest_per_key(old, keys, order).select(*keys, *[F.col(c).alias(f"_old_{c}") for c in cols])
    both = fresh.join(old, list(keys), "left")
    out = []
    for c in fresh.columns:
        if c in cols:
            kept = F.when(~is_blank(F.col(f"_old_{c}").cast("string")), F.col(f"_old_{c}"))
            out.append(F.coalesce(kept, F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    extra = [F.col(f"_old_{c}").alias(c) for c in cols if c not in fresh.columns]
    return both.select(*out, *extra)
