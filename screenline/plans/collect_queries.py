"""Registered queries on collection, ranking and state, with SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenline.operators import collect, match, ranking, runs, state
from screenline.plans import oracle as o
from screenline.plans.registry import Registry
from screenline.plans.text_queries import STOP
from screenline.plans.views import VENUE_RULES, papers, profile, table, venue_rules

query = Registry()
RUN = list(match.RUN_KEYS)


def line_hits(spark, sf):
    """Order lines as search hits: seven queries finding parts."""
    return table(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("query_no"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("query"),
        F.col("l_partkey").alias("pmid"),
    )


@query(
    "dedupe_with_provenance",
    """SELECT pmid, min(n) AS first_query_no, string_agg(query, '; ' ORDER BY n) AS source_query FROM (
    SELECT DISTINCT l_partkey AS pmid, l_linenumber AS n, 'line ' || l_linenumber AS query FROM lineitem) GROUP BY pmid""",
)
def _(spark, sf):
    d = collect.dedupe_with_provenance(line_hits(spark, sf))
    return d.select("pmid", "first_query_no", F.array_join("source_queries", "; ").alias("source_query"))


@query(
    "query_counts",
    "SELECT l_linenumber AS query_no, count(*) AS raw_hit_count, count(DISTINCT l_partkey) AS collected_count FROM lineitem GROUP BY 1",
)
def _(spark, sf):
    return collect.query_counts(line_hits(spark, sf))


@query(
    "diagnostics_rows",
    """SELECT 'run' AS run_id, 1 AS pass_number, 'collection' AS round_id, 'q' || l_linenumber AS query_id, 'line ' || l_linenumber AS query,
    count(DISTINCT l_partkey) AS raw_hit_count, count(DISTINCT l_partkey) AS collected_count, 'no' AS truncated_by_constraint,
    'accepted_for_collection' AS decision FROM lineitem GROUP BY l_linenumber""",
)
def _(spark, sf):
    h = line_hits(spark, sf).withColumn("run_id", F.lit("run")).withColumn("pass_number", F.lit(1))
    return collect.diagnostics_rows(h)


RULES = "rules(rule_no, match_type, match_value, rationale) AS (" + o.values([(i, *r) for i, r in enumerate(VENUE_RULES)]) + ")"
BLOCK = """blocking AS (
  SELECT p.paper_id, min(rule_no) AS rule_no FROM papers p JOIN rules r
  ON lower(p.journal) = lower(r.match_value) OR (r.match_type = 'journal_prefix' AND starts_with(lower(p.journal), lower(r.match_value)))
  GROUP BY p.paper_id)"""
_BLOCKED = o.sql(
    "SELECT paper_id, journal, match_type, match_value, rationale AS block_rationale FROM papers JOIN blocking USING (paper_id) JOIN rules USING (rule_no)",
    o.PAPERS,
    RULES,
    BLOCK,
)


@query("blocked_venues", _BLOCKED)
def _(spark, sf):
    marked = collect.block_venues(papers(spark, sf), venue_rules(spark))
    return ranking.sort_blocked(collect.blocked(marked)).select(
        "paper_id", "journal", "match_type", "match_value", "block_rationale"
    )


@query("blocked_venues_by_key", _BLOCKED)
def _(spark, sf):
    """The form for long rule lists."""
    marked = collect._block_by_key(papers(spark, sf), collect.read_rules(venue_rules(spark)), "journal")
    return collect.blocked(marked).select("paper_id", "journal", "match_type", "match_value", "block_rationale")


@query(
    "kept_papers",
    o.sql(
        "SELECT paper_id, year, journal FROM papers WHERE paper_id NOT IN (SELECT paper_id FROM blocking)",
        o.PAPERS,
        RULES,
        BLOCK,
    ),
)
def _(spark, sf):
    p = collect.kept(collect.block_venues(papers(spark, sf), venue_rules(spark)))
    return ranking.sort_manifest(p).select("paper_id", "year", "journal")


def label_state(spark, sf):
    return table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("pmid"),
        F.when(F.col("quality") == 0, "rejected").otherwise("advanced").alias("latest_status"),
    )


@query(
    "drop_rejected",
    o.sql(
        "SELECT paper_id, pass_number FROM papers WHERE pass_number = 1 OR doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)",
        o.PAPERS,
    ),
)
def _(spark, sf):
    return collect.drop_rejected(papers(spark, sf), label_state(spark, sf)).select("paper_id", "pass_number")


@query(
    "merge_details",
    "SELECT doc_id, source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)",
)
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    return collect.merge_details(d, table(spark, sf, "labels"), ["doc_id"])


def weekly(spark, sf):
    """Events as collected rows: a run per kind, a pass per week."""
    return table(spark, sf, "events").select(
        F.col("event_type").alias("run_id"), F.weekofyear("ts").cast("int").alias("pass_number"), "event_id"
    )


@query(
    "burden_change",
    """WITH n AS (SELECT event_type AS run_id, CAST(week(ts) AS INTEGER) AS pass_number, count(*) AS collected FROM events GROUP BY ALL)
    SELECT a.*, b.collected AS prior, coalesce(b.collected > 0 AND a.collected > floor(b.collected * 0.8), false) AS warn
    FROM n a LEFT JOIN n b ON a.run_id = b.run_id AND a.pass_number = b.pass_number + 1""",
)
def _(spark, sf):
    return collect.burden_change(weekly(spark, sf))


@query(
    "sample_precision",
    """SELECT *, CASE WHEN estimated_precision < 0.30 THEN 'refine' WHEN estimated_precision <= 0.60 THEN 'usable' ELSE 'accept' END AS band FROM (
    SELECT source AS query_id, count(quality) AS sample_size, count(*) FILTER (WHERE quality = 1) AS sampled_on_topic_count,
    count(*) FILTER (WHERE quality = 0) AS sampled_noise_count,
    CASE WHEN count(quality) = 0 THEN 0.0 ELSE count(*) FILTER (WHERE quality = 1) / count(quality) END AS estimated_precision
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source)""",
)
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("source").alias("query_id"))
    j = d.join(table(spark, sf, "labels"), "doc_id", "left").select("query_id", (F.col("quality") == 1).alias("on_topic"))
    return collect.sample_precision(j)


def term_hits(spark, sf):
    """Papers found by each profile term."""
    text = F.concat(F.col("title"), F.lit("\n"), F.col("abstract"))
    pairs = match.matched_pairs(papers(spark, sf), text, profile(spark))
    return pairs.select(F.col("term").alias("query_id"), F.regexp_replace("paper_id", "^pmid-", "").alias("pmid"))


TERM_HITS = "thits AS (SELECT DISTINCT term AS query_id, replace(paper_id, 'pmid-', '') AS pmid FROM hit)"
SEEDS = "seeds AS (SELECT CAST(doc_id AS VARCHAR) AS pmid FROM labels WHERE quality = 1)"


def seeds(spark, sf):
    return table(spark, sf, "labels").where("quality = 1").select(F.col("doc_id").cast("string").alias("pmid"))


@query(
    "seed_recall",
    o.sql(
        """SELECT query_id, count(s.pmid) AS found, (SELECT count(*) FROM seeds) AS seeds, count(s.pmid) / (SELECT count(*) FROM seeds) AS recall
        FROM thits LEFT JOIN seeds s USING (pmid) GROUP BY query_id""",
        o.PAPERS,
        o.PROF,
        o.MATCH,
        TERM_HITS,
        SEEDS,
    ),
)
def _(spark, sf):
    return collect.seed_recall(seeds(spark, sf), term_hits(spark, sf))


@query(
    "missed_seeds",
    o.sql("SELECT pmid FROM seeds WHERE pmid NOT IN (SELECT pmid FROM thits)", o.PAPERS, o.PROF, o.MATCH, TERM_HITS, SEEDS),
)
def _(spark, sf):
    return collect.missed_seeds(seeds(spark, sf), term_hits(spark, sf))


@query(
    "query_sample",
    """WITH h AS (SELECT DISTINCT event_type AS query_id, user_id AS pmid FROM events),
    n AS (SELECT query_id, count(*) AS hit_count FROM h GROUP BY 1),
    s AS (SELECT query_id, pmid, row_number() OVER (PARTITION BY query_id ORDER BY md5(CAST(pmid AS VARCHAR)), pmid) AS sample_no FROM h)
    SELECT query_id, pmid, sample_no, hit_count, CAST(CASE WHEN hit_count <= 200 THEN 40 WHEN hit_count <= 1000 THEN 50 ELSE 75 END AS INTEGER) AS sample_size
    FROM s JOIN n USING (query_id) WHERE sample_no <= CASE WHEN hit_count <= 200 THEN 40 WHEN hit_count <= 1000 THEN 50 ELSE 75 END""",
)
def _(spark, sf):
    h = table(spark, sf, "events").select(F.col("event_type").alias("query_id"), F.col("user_id").alias("pmid"))
    return ranking.query_sample(h).withColumn("sample_no", F.col("sample_no").cast("long"))


@query(
    "review_batches",
    """SELECT doc_id, run_id, (row_number() OVER (PARTITION BY run_id ORDER BY doc_id) - 1) // 15 + 1 AS batch_no
    FROM (SELECT doc_id, CASE WHEN lang IN ('en', 'de', 'fr') THEN 'hot' ELSE lang END AS run_id FROM documents)""",
)
def _(spark, sf):
    """One run has most of the rows."""
    run = F.when(F.col("lang").isin("en", "de", "fr"), "hot").otherwise(F.col("lang"))
    d = table(spark, sf, "documents").select("doc_id", run.alias("run_id"))
    return ranking.review_batches(d, 15, ["run_id"], "doc_id")


# Diagnostics rows from events: a collection round per click.
def diagnostics(spark, sf):
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf, "events").select(
        "event_id",
        F.when(kind == "click", "collection").when(kind == "view", "round_1").alias("round_id"),
        F.when(kind == "error", " ").otherwise(k.cast("string")).alias("raw_hit_count"),
        F.col("value").cast("int").cast("string").alias("collected_count"),
        F.when((kind == "click") & (k % 10 == 0), "yes").otherwise("no").alias("truncated_by_constraint"),
    )


@query(
    "is_truncated",
    """SELECT event_id FROM (SELECT event_id, CAST(props->>'k' AS INTEGER) AS k, CAST(trunc(value) AS INTEGER) AS v FROM events WHERE event_type = 'click')
    WHERE k % 10 = 0 OR v < k""",
)
def _(spark, sf):
    return diagnostics(spark, sf).where(collect.is_truncated()).select("event_id")


@query("prior_diagnostics", "SELECT event_id FROM events WHERE event_type <> 'click'")
def _(spark, sf):
    return collect.prior_diagnostics(diagnostics(spark, sf)).select("event_id")


@query(
    "forbidden_caps",
    r"""SELECT event_id, CASE event_type WHEN 'click' THEN 'retmax' ELSE 'record_cap' END AS cap_key FROM events WHERE event_type IN ('click', 'view')""",
)
def _(spark, sf):
    kind = F.col("event_type")
    line = (
        F.when(kind == "click", F.concat(F.lit("- `retmax`: "), F.col("props")))
        .when(kind == "view", F.lit("record_cap : 5"))
        .when(kind == "error", F.lit("# retmax: 5"))
        .otherwise(F.lit("- `page_size`: 10"))
    )
    return collect.forbidden_caps(table(spark, sf, "events").select("event_id", line.alias("value"))).select("event_id", "cap_key")


@query(
    "latest_per_key",
    "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1",
)
def _(spark, sf):
    e = table(spark, sf, "events")
    return ranking.latest_per_key(e, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query(
    "latest_row",
    """SELECT run_id, pass_number, event_id FROM (SELECT event_type AS run_id, CAST(week(ts) AS INTEGER) AS pass_number, event_id,
    row_number() OVER (PARTITION BY event_type ORDER BY week(ts) DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
)
def _(spark, sf):
    return ranking.latest_row(weekly(spark, sf), ["run_id"], ["pass_number", "event_id"])


@query(
    "seen_passes",
    """SELECT event_type AS run_id, 'pmid-' || user_id AS paper_id, CAST(min(week(ts)) AS INTEGER) AS first_seen_pass, CAST(max(week(ts)) AS INTEGER) AS last_seen_pass
    FROM events GROUP BY ALL""",
)
def _(spark, sf):
    return ranking.seen_passes(log_rows(spark, sf))


def log_rows(spark, sf):
    """The event log as rows per run, week and paper."""
    return table(spark, sf, "events").select(
        F.col("event_type").alias("run_id"),
        F.weekofyear("ts").cast("int").alias("pass_number"),
        F.concat(F.lit("pmid-"), F.col("user_id").cast("string")).alias("paper_id"),
        F.col("user_id").cast("string").alias("pmid"),
        "value",
        "event_id",
    )


# A decision log: one row per user and week. The last event of the week tells
# the decision: error stops, purchase and signup advance, others decide nothing.
def decision_log(spark, sf):
    e = table(spark, sf, "events").select(
        F.lit("run").alias("run_id"),
        F.weekofyear("ts").cast("int").alias("pass_number"),
        F.concat(F.lit("pmid-"), F.col("user_id").cast("string")).alias("paper_id"),
        F.col("user_id").cast("string").alias("pmid"),
        "event_id",
        "event_type",
    )
    last = ranking.latest_per_key(e, ["run_id", "pass_number", "paper_id"], ["event_id"])
    kind = F.col("event_type")
    stop, go = kind == "error", kind.isin("purchase", "signup")
    return last.select(
        "run_id",
        "pass_number",
        "paper_id",
        "pmid",
        F.concat(F.lit("10.5555/"), F.col("event_id").cast("string")).alias("doi"),
        kind.alias("title"),
        F.col("event_id").cast("string").alias("year"),
        F.when(stop, "stop").when(go, "advance_to_import").alias("promotion_decision"),
        F.when(stop, "confirm_exclude").when(go, "confirm_include").alias("second_pass_decision"),
        F.when(stop | go, kind).alias("second_pass_rationale"),
    )


LOG = """log AS (
  SELECT CAST(week(ts) AS INTEGER) AS pass_number, 'pmid-' || user_id AS paper_id, CAST(user_id AS VARCHAR) AS pmid, max(event_id) AS e, arg_max(event_type, event_id) AS kind
  FROM events GROUP BY ALL),
dec AS (SELECT *, kind = 'error' AS stop, kind IN ('purchase', 'signup') AS go FROM log)"""

STATE_SQL = o.sql(
    """SELECT 'run' AS run_id, paper_id, min(pmid) AS pmid, '10.5555/' || arg_max(e, pass_number) AS doi, arg_max(kind, pass_number) AS title,
      CAST(arg_max(e, pass_number) AS VARCHAR) AS year, min(pass_number) AS first_seen_pass, max(pass_number) AS last_seen_pass,
      CASE WHEN max(pass_number) FILTER (WHERE stop OR go) IS NULL THEN 'collected'
        WHEN arg_max(stop, pass_number) FILTER (WHERE stop OR go) THEN 'rejected'
        WHEN max(pass_number) > max(pass_number) FILTER (WHERE stop OR go) THEN 'collected' ELSE 'advanced' END AS latest_status,
      arg_max(CASE WHEN stop THEN 'confirm_exclude' ELSE 'confirm_include' END, pass_number) FILTER (WHERE stop OR go) AS latest_decision,
      arg_max(kind, pass_number) FILTER (WHERE stop OR go) AS latest_rationale FROM dec GROUP BY paper_id""",
    LOG,
)


@query("replay_state", STATE_SQL)
def _(spark, sf):
    return state.replay(decision_log(spark, sf))


def weeks(df, column):
    """The numbers of the weeks of a year that occur, in order."""
    return sorted(r[0] for r in df.select(column).distinct().collect())


def folded(spark, sf):
    """The same state by folding week after week."""
    log = decision_log(spark, sf)
    passes = weeks(log, "pass_number")
    p = spark.createDataFrame([], state.PAPERS)
    d = spark.createDataFrame([], state.DECISIONS)
    for n in passes:
        rows = log.where(F.col("pass_number") == n)
        p = state.fold_collected(p, rows, n)
        p, d = state.fold_triage(p, d, rows.where("promotion_decision is not null"), n)
    return p, d


@query("fold_passes", STATE_SQL)
def _(spark, sf):
    return folded(spark, sf)[0]


@query(
    "fold_decisions",
    o.sql(
        """SELECT 'run' AS run_id, pass_number, paper_id, pmid, 'abstract_triage' AS stage,
        CASE WHEN stop THEN 'confirm_exclude' ELSE 'confirm_include' END AS decision, CASE WHEN stop THEN 'rejected' ELSE 'advanced' END AS status,
        kind AS rationale FROM dec WHERE stop OR go""",
        LOG,
    ),
)
def _(spark, sf):
    return folded(spark, sf)[1]


@query(
    "supersede",
    o.sql(
        """, seen AS (SELECT paper_id, max(pass_number) AS last FROM log GROUP BY 1), latest AS (SELECT max(last) AS w FROM seen),
        again AS (SELECT DISTINCT 'pmid-' || user_id AS paper_id FROM events, latest WHERE week(ts) = w AND event_type <> 'view'),
        made AS (SELECT DISTINCT 'pmid-' || user_id AS paper_id, CAST(week(ts) AS INTEGER) AS pass_number FROM events)
        SELECT 'papers' AS side, paper_id, last AS pass_number, last = w AND paper_id NOT IN (SELECT paper_id FROM again) AS superseded FROM seen, latest
        UNION ALL SELECT 'decisions', paper_id, pass_number, pass_number = w AND paper_id NOT IN (SELECT paper_id FROM again) FROM made, latest""",
        LOG,
    ).replace("\n,", ",", 1),
)
def _(spark, sf):
    """The latest week collected again without views: papers and decisions."""
    papers_ = state.replay(decision_log(spark, sf))
    e = log_rows(spark, sf).withColumn("run_id", F.lit("run"))
    latest = papers_.agg(F.max("last_seen_pass")).first()[0]
    given = {"stage": "abstract_triage", "decision": "include", "status": "advanced", "rationale": "x"}
    made = e.select("run_id", "pass_number", "paper_id", "pmid").distinct().withColumns({k: F.lit(v) for k, v in given.items()})
    names = spark.createDataFrame([], state.DECISIONS).columns
    again = table(spark, sf, "events").where((F.weekofyear("ts") == latest) & (F.col("event_type") != "view"))
    m = again.select(F.lit("run").alias("run_id"), F.lit(None).cast("string").alias("paper_id"), F.col("user_id").cast("string").alias("pmid"))
    p, d = state.supersede(papers_, made.select(*names), m, latest)
    shown = lambda df, side, at, status: df.select(
        F.lit(side).alias("side"), "paper_id", F.col(at).alias("pass_number"), (F.col(status) == "superseded").alias("superseded")
    )
    return shown(p, "papers", "last_seen_pass", "latest_status").unionByName(shown(d, "decisions", "pass_number", "status"))


RECORDS = (
    "run_id string, pass_number int, paper_id string, pmid string, doi string, title string, journal string, year string, "
    "authors array<string>, source_queries array<string>, retrieval_batch string, sha256 string"
)


@query(
    "fold_records",
    """WITH r AS (SELECT week(ts) AS w, user_id, max(event_id) AS e FROM events GROUP BY ALL),
    f AS (SELECT 1 AS pass_number, user_id, arg_max(e, w) AS e FROM r GROUP BY user_id)
    SELECT pass_number, 'pmid-' || user_id AS paper_id, CAST(e AS VARCHAR) AS title, sha256('{"authors":["a","b"],"doi":"","journal":"j","paper_id":"pmid-' || user_id ||
      '","pmid":"' || user_id || '","retrieval_batch":"20240101","source_queries":["q"],"title":"' || e || '","year":"2024"}') AS sha256 FROM f""",
)
def _(spark, sf):
    """A pass collected again every week: later rows replace earlier ones."""
    e = table(spark, sf, "events").groupBy(F.weekofyear("ts").alias("w"), "user_id").agg(F.max("event_id").alias("e"))
    rec = e.select(
        "w",
        F.lit("run").alias("run_id"),
        F.lit(None).cast("string").alias("paper_id"),
        F.col("user_id").cast("string").alias("pmid"),
        F.lit("").alias("doi"),
        F.col("e").cast("string").alias("title"),
        F.lit("j").alias("journal"),
        F.lit("2024").alias("year"),
        F.array(F.lit("a"), F.lit("b")).alias("authors"),
        F.array(F.lit("q")).alias("source_queries"),
        F.lit("20240101").alias("retrieval_batch"),
    )
    r = spark.createDataFrame([], RECORDS)
    for w in weeks(rec, "w"):
        r = state.fold_records(r, rec.where(F.col("w") == w).drop("w"), 1)
    return r.select("pass_number", "paper_id", "title", "sha256")


def read_state(spark, sf):
    """Readings of the documents, odd ones in the second pass, folded."""
    s = spark.createDataFrame([], state.READ_STATE)
    p = papers(spark, sf)
    lab = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("pmid"), "quality", "toxic")
    d = p.join(lab, "pmid")
    rev = d.select(
        "run_id",
        "pass_number",
        "paper_id",
        "pmid",
        F.lit("").alias("pmcid"),
        "doi",
        "title",
        F.lit("pmc_xml").alias("normalized_source_type"),
        F.concat(F.lit("texts/"), F.col("paper_id")).alias("normalized_path"),
        F.when(F.col("quality") == 1, "keep").otherwise("drop").alias("fulltext_decision"),
        F.col("journal").alias("fulltext_rationale"),
    )
    ev = d.where("toxic = 0").select(
        "run_id",
        "pass_number",
        "paper_id",
        F.when(F.col("quality") == 1, "direct").otherwise("exclude").alias("evidence_tier"),
        F.lit("direct_target").alias("directness"),
        F.lit("central").alias("target_centrality"),
        F.when(F.col("quality") == 1, "none").otherwise("tighten_query").alias("query_feedback_signal"),
        F.when(F.col("quality") == 1, "direct_mechanistic").otherwise("exclude").alias("retention_role"),
    )
    # Pass one reads its papers; pass two reads its own and all good ones again.
    s = state.fold_read_state(s, rev.where("pass_number = 1"), ev, 1)
    return state.fold_read_state(s, rev.where("pass_number = 2 or fulltext_decision = 'keep'"), ev, 2)


READ_STATE_SQL = """SELECT 'pmid-' || doc_id AS paper_id, CAST(1 + doc_id % 2 AS INTEGER) AS first_read_pass,
    CASE WHEN doc_id % 2 = 1 OR quality = 1 THEN 2 ELSE 1 END AS last_read_pass, CASE WHEN quality = 1 THEN 'keep' ELSE 'drop' END AS latest_fulltext_decision,
    CASE WHEN toxic = 1 THEN '' WHEN quality = 1 THEN 'direct' ELSE 'exclude' END AS latest_evidence_tier,
    CASE WHEN toxic = 1 THEN '' WHEN quality = 1 THEN 'none' ELSE 'tighten_query' END AS latest_query_feedback_signal
    FROM labels JOIN documents USING (doc_id)"""


@query("fold_read_state", READ_STATE_SQL)
def _(spark, sf):
    return read_state(spark, sf).select(
        "paper_id", "first_read_pass", "last_read_pass", "latest_fulltext_decision", "latest_evidence_tier", "latest_query_feedback_signal"
    )


@query("read_state_before", f"SELECT paper_id FROM ({READ_STATE_SQL}) WHERE last_read_pass < 2")
def _(spark, sf):
    return state.read_state_before(read_state(spark, sf), 2).select("paper_id")


@query(
    "status_counts",
    f"SELECT run_id, latest_status, count(*) AS n FROM ({STATE_SQL}) GROUP BY ALL",
)
def _(spark, sf):
    return runs.status_counts(state.replay(decision_log(spark, sf)))
