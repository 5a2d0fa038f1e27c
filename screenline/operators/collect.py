"""From query hits to the paper table: provenance, memory of rejections, venue
rules, collection diagnostics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenline.functions.fields import ratio
from screenline.functions.text import is_blank, norm_venue, text_of
from screenline.session import fits, small


def dedupe_with_provenance(hits: DataFrame, keys: Sequence[str] = ("pmid",)) -> DataFrame:
    """One row per paper with the ordered distinct queries that found it.
    Repeats of a pair fall away before the shuffle, so what is collected per
    paper is at most one entry per query."""
    pairs = hits.groupBy(*keys, "query").agg(F.min("query_no").alias("query_no"))
    found = F.array_sort(F.collect_list(F.struct("query_no", "query")))
    return pairs.groupBy(*keys).agg(
        F.min("query_no").alias("first_query_no"), F.transform(found, lambda s: s["query"]).alias("source_queries")
    )


def query_counts(hits: DataFrame, keys: Sequence[str] = ("query_no",)) -> DataFrame:
    """Rows and distinct papers per query, by two counts so that a query with
    most of the hits is spread over tasks."""
    per_paper = hits.groupBy(*keys, "pmid").agg(F.count("*").alias("n"))
    return per_paper.groupBy(*keys).agg(
        F.sum("n").alias("raw_hit_count"), F.count("*").alias("collected_count")
    )


def read_rules(rules: DataFrame) -> DataFrame:
    """Usable venue rules with their normal form and place in the list."""
    kinds = ("journal_exact", "journal_prefix")
    r = rules.where(~is_blank(F.col("match_type")) & ~is_blank(F.col("match_value")))
    r = r.withColumn("norm_value", norm_venue(F.col("match_value")))
    return r.where(F.col("match_type").isin(*kinds) & (F.col("norm_value") != ""))


# Rules beyond this number are joined by key instead of being carried in the row.
ROW_RULES = 2_000


def block_venues(papers: DataFrame, rules: DataFrame, venue: str = "journal") -> DataFrame:
    """Add ``rule`` (rule_no, match_type, match_value, rationale): the first
    rule in list order whose venue equals or starts the paper's. A blank venue
    is never blocked."""
    r = read_rules(rules)
    if not fits(r, ROW_RULES):
        return _block_by_key(papers, r, venue)
    fields = F.struct("rule_no", "match_type", "match_value", "rationale", "norm_value")
    packed = r.agg(F.array_sort(F.collect_list(fields)).alias("rules"))
    v = norm_venue(text_of(F.col(venue)))
    d = papers.withColumn("_venue", v).withColumn("_rules", packed.scalar())
    prefix = F.lit("journal_prefix")
    hit = F.filter(
        F.col("_rules"),
        lambda x: (F.col("_venue") != "")
        & (
            (F.col("_venue") == x["norm_value"])
            | ((x["match_type"] == prefix) & F.startswith(F.col("_venue"), x["norm_value"]))
        ),
    )
    first = F.get(hit, F.lit(0))
    d = d.withColumn("_rule", first)
    rule = F.when(
        F.col("_rule").isNotNull(),
        F.struct(*[F.col(f"_rule.{c}").alias(c) for c in ("rule_no", "match_type", "match_value", "rationale")]),
    )
    return d.select(*papers.columns, rule.alias("rule"))


def _block_by_key(papers: DataFrame, r: DataFrame, venue: str) -> DataFrame:
    """The same for long rule lists: each distinct venue meets the rules by
    equality on its first n characters, n over the lengths rules have."""
    named = papers.withColumn("_venue", norm_venue(text_of(F.col(venue))))
    venues = named.select("_venue").distinct().where("_venue <> ''")
    lengths = r.select(F.length("norm_value").alias("n")).distinct()
    packed = lengths.agg(F.sort_array(F.collect_list("n")).alias("ns")).scalar()
    keys = venues.withColumn("_ns", packed).withColumn("_n", F.explode("_ns")).drop("_ns")
    keys = keys.where(F.col("_n") <= F.length("_venue")).withColumn("norm_value", F.expr("substring(_venue, 1, _n)"))
    whole = F.col("_n") == F.length("_venue")
    found = keys.join(r, "norm_value").where(whole | (F.col("match_type") == "journal_prefix"))
    rule = F.struct("rule_no", "match_type", "match_value", "rationale")
    best = found.groupBy("_venue").agg(F.min_by(rule, F.col("rule_no")).alias("rule"))
    return named.join(best, "_venue", "left").select(*papers.columns, "rule")


def kept(marked: DataFrame) -> DataFrame:
    return marked.where("rule is null").drop("rule")


def blocked(marked: DataFrame) -> DataFrame:
    rest = [c for c in marked.columns if c != "rule"]
    return marked.where("rule is not null").select(
        *rest,
        F.col("rule.match_type").alias("match_type"),
        F.col("rule.match_value").alias("match_value"),
        F.col("rule.rationale").alias("block_rationale"),
    )


def drop_rejected(papers: DataFrame, state: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """From the second pass on, papers rejected before do not come back. A
    rejection belongs to its run where both sides tell the run."""
    if keys is None:
        keys = [k for k in ("run_id", "pmid") if k == "pmid" or (k in papers.columns and k in state.columns)]
    gone = state.where("latest_status = 'rejected'")
    gone = gone.where(~is_blank(F.col("pmid"))).select(*keys).distinct().withColumn("_gone", F.lit(True))
    if "pass_number" not in papers.columns:
        return papers.join(gone, list(keys), "left_anti")
    marked = papers.join(gone, list(keys), "left")
    return marked.where(F.col("_gone").isNull() | (F.col("pass_number") <= 1)).drop("_gone")


def merge_details(summary: DataFrame, details: DataFrame, keys: Sequence[str] = ("pmid",)) -> DataFrame:
    return summary.join(details, list(keys), "left")


# Fixed value: share of the previous pass above which a rerun is looked at.
RERUN_RATIO = 0.8


def burden_change(manifest: DataFrame) -> DataFrame:
    """Per run and pass the collected rows, those of the pass before, and a
    warning above 80 percent of them."""
    n = manifest.groupBy("run_id", "pass_number").agg(F.count("*").alias("collected"))
    before = n.select("run_id", (F.col("pass_number") + 1).alias("pass_number"), F.col("collected").alias("prior"))
    d = n.join(before, ["run_id", "pass_number"], "left")
    bound = F.floor(F.col("prior") * RERUN_RATIO)
    warn = F.coalesce((F.col("prior") > 0) & (F.col("collected") > bound), F.lit(False))
    return d.select("run_id", "pass_number", "collected", "prior", warn.alias("warn"))


def sample_precision(judged: DataFrame, keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """Per query: judged records, on topic, noise, precision and its band."""
    d = judged.groupBy(*keys).agg(
        F.count("on_topic").alias("sample_size"),
        F.count_if(F.col("on_topic")).alias("sampled_on_topic_count"),
        F.count_if(~F.col("on_topic")).alias("sampled_noise_count"),
    )
    p = ratio(F.col("sampled_on_topic_count"), F.col("sample_size"))
    d = d.withColumn("estimated_precision", p)
    band = (
        F.when(F.col("estimated_precision") < 0.30, "refine")
        .when(F.col("estimated_precision") <= 0.60, "usable")
        .otherwise("accept")
    )
    return d.withColumn("band", band)


def seed_recall(seeds: DataFrame, hits: DataFrame) -> DataFrame:
    """Per query the share of known papers it finds."""
    known = seeds.select("pmid").distinct()
    total = known.agg(F.count("*")).scalar()
    found = hits.select("query_id", "pmid").distinct().join(known, "pmid", "left_semi")
    n = found.groupBy("query_id").agg(F.count("*").alias("found"))
    every = hits.select("query_id").distinct().join(n, "query_id", "left").withColumn("seeds", total)
    got = F.coalesce("found", F.lit(0))
    return every.select("query_id", got.alias("found"), "seeds", ratio(got, F.col("seeds")).alias("recall"))


def missed_seeds(seeds: DataFrame, hits: DataFrame) -> DataFrame:
    return seeds.select("pmid").distinct().join(hits, "pmid", "left_anti")


def prior_diagnostics(diagnostics: DataFrame) -> DataFrame:
    """Rows with any content that are not from a collection round."""
    filled = F.lit(False)
    for c in diagnostics.columns:
        filled = filled | ~is_blank(F.col(c).cast("string"))
    return diagnostics.where(filled & (F.coalesce(F.trim("round_id"), F.lit("")) != "collection"))


def is_truncated() -> Column:
    """A collection row that says so, or holds fewer records than hits."""
    digits = lambda c: F.when(F.trim(F.col(c).cast("string")).rlike("^[0-9]+$"), F.col(c).cast("long"))
    less = F.coalesce(digits("collected_count") < digits("raw_hit_count"), F.lit(False))
    flagged = F.coalesce(F.trim("truncated_by_constraint") == "yes", F.lit(False))
    return (F.trim("round_id") == "collection") & (flagged | less)


# Settings that would cap a collection.
CAP_KEYS = (
    "max_results_per_query",
    "max_total_results",
    "retmax",
    "record_cap",
    "retrieval_cap",
    "collection_cap",
)


def forbidden_caps(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines "- key: ..." whose key is a cap, with the key."""
    plain = F.trim(F.replace(F.trim(line), F.lit("`"), F.lit("")))
    key = F.regexp_extract(plain, r"^-?\s*([A-Za-z0-9_]+)\s*:", 1)
    return lines.withColumn("cap_key", key).where(~plain.startswith("#") & F.col("cap_key").isin(*CAP_KEYS))


def diagnostics_rows(hits: DataFrame, keys: Sequence[str] = ("run_id", "pass_number")) -> DataFrame:
    """The collection round's diagnostics, one row per query. Where the search
    service reported a total (``raw_count``), that is the raw hit count."""
    by = [*keys, "query_no", "query"]
    told = F.max("raw_count") if "raw_count" in hits.columns else F.lit(None).cast("bigint")
    per_paper = hits.groupBy(*by, "pmid").agg(told.alias("told"))
    counts = per_paper.groupBy(*by).agg(F.max("told").alias("told"), F.count("*").alias("collected_count"))
    return counts.select(
        *keys,
        F.lit("collection").alias("round_id"),
        F.concat(F.lit("q"), F.col("query_no")).alias("query_id"),
        "query",
        F.coalesce("told", "collected_count").alias("raw_hit_count"),
        "collected_count",
        F.lit("no").alias("truncated_by_constraint"),
        F.lit("accepted_for_collection").alias("decision"),
    )
