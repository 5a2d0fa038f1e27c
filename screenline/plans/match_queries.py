"""Registered queries on term matching and triage, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenline.functions import text as tx
from screenline.operators import match, triage
from screenline.operators import phrases as ph
from screenline.operators.ranking import first_claim
from screenline.plans import oracle as o
from screenline.plans.registry import Registry
from screenline.plans.text_queries import STOP, _STOP
from screenline.plans.views import LANGS, papers, profile, profile_for, table
from screenline.session import spread

query = Registry()
RUN = list(match.RUN_KEYS)
SCOPE = match.SCOPE_ROLES + ("claim",)


def text():
    return F.concat(F.col("title"), F.lit("\n"), F.col("abstract"))


@query(
    "match_terms",
    o.sql(
        """SELECT paper_id, """
        + ", ".join(
            f"coalesce(string_agg(term, ';' ORDER BY -length(term), term) FILTER (WHERE role = '{r}'), '') AS terms_{r}"
            for r in SCOPE
        )
        + " FROM papers LEFT JOIN hit USING (paper_id) GROUP BY paper_id",
        o.PAPERS,
        o.PROF,
        o.MATCH,
    ),
)
def _(spark, sf):
    d = match.match_terms(papers(spark, sf), text(), profile(spark))
    return d.select("paper_id", *[F.array_join(f"terms_{r}", ";").alias(f"terms_{r}") for r in SCOPE])


@query(
    "matched_term_counts",
    o.sql(
        "SELECT run_id, pass_number, role, term, count(*) AS papers FROM hit JOIN papers USING (paper_id) GROUP BY ALL",
        o.PAPERS,
        o.PROF,
        o.MATCH,
    ),
)
def _(spark, sf):
    d = match.matched_pairs(papers(spark, sf), text(), profile(spark))
    return d.groupBy(*RUN, "role", "term").agg(F.count("*").alias("papers"))


FLAG_NAMES = list("pmocxre") + ["review", "claim", "direct", "contextual", "comparator"]


@query(
    "paper_flags",
    o.sql(
        "SELECT paper_id, " + ", ".join(FLAG_NAMES) + " FROM flags", o.PAPERS, o.PROF, o.MATCH, o.WINDOWS
    ),
)
def _(spark, sf):
    return match.paper_flags(papers(spark, sf), profile(spark)).select("paper_id", "flags.*")


# Phrases of two words that occur, read against titles and sentences.
PHRASES = {"primary": ["of the", "ertion"], "mechanism": ["is the", "erat"], "outcome": ["in the", "ering"], "claim": ["and the"]}


@query(
    "phrase_flags",
    o.sql(
        """SELECT paper_id, bool_or(p AND m AND (o OR e)) AS claim FROM (
        SELECT paper_id, contains(w, 'of the') OR list_contains(t, 'ertion') AS p, contains(w, 'is the') OR list_contains(t, 'erat') AS m,
          contains(w, 'in the') OR list_contains(t, 'ering') AS o, contains(w, 'and the') AS e
        FROM (SELECT paper_id, w, regexp_extract_all(w, '[a-z0-9+/-]+') AS t FROM win)) GROUP BY paper_id""",
        o.PAPERS,
        o.PROF,
        o.MATCH,
    ),
)
def _(spark, sf):
    prof = profile_for(spark, [(r, p) for r in LANGS for p in (1, 2)], PHRASES)
    d = match.paper_flags(papers(spark, sf).where(F.length("abstract") > 0), prof)
    return d.select("paper_id", F.col("flags.claim").alias("claim"))


@query(
    "first_claim",
    o.sql(
        "SELECT paper_id, min(window_no) AS window_no, md5(arg_min(w, window_no)) AS w FROM winf JOIN win USING (paper_id, window_no) "
        "WHERE p AND m AND (o OR e) GROUP BY paper_id",
        o.PAPERS,
        o.PROF,
        o.MATCH,
        o.WINDOWS,
    ),
)
def _(spark, sf):
    p = papers(spark, sf)
    w = p.select(*RUN, "paper_id", F.posexplode(tx.windows(F.col("title"), F.col("abstract"))).alias("window_no", "w"))
    m = match.match_terms(w, F.col("w"), profile(spark), ("paper_id", "window_no"))
    n = lambda r: F.size(f"terms_{r}") > 0
    m = m.where(n("primary") & n("mechanism") & (n("outcome") | n("claim")))
    d = first_claim(m.select("paper_id", "window_no", "w"), ["paper_id"])
    return d.select("paper_id", (F.col("window_no") + 1).cast("long").alias("window_no"), F.md5("w").alias("w"))


def _topic(spark, sf, n=80, pattern=tx.PRESCREEN_TOKEN):
    """Topic terms of a run: the frequent tokens of its texts."""
    d = papers(spark, sf)
    return match.frequent_terms(d, F.col("abstract"), n, RUN, STOP, pattern)


def _topic_sql(n: int, pattern: str = tx.PRESCREEN_TOKEN) -> str:
    return f"""ptok AS (SELECT run_id, pass_number, paper_id, unnest(regexp_extract_all(lower(abstract), '{pattern}')) AS term FROM papers),
    topic AS (SELECT run_id, pass_number, term, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY run_id, pass_number ORDER BY n DESC, term) AS rank
      FROM (SELECT run_id, pass_number, term, count(*) AS n FROM ptok WHERE term NOT IN {_STOP} GROUP BY ALL)) WHERE rank <= {n})"""


@query(
    "frequent_terms",
    o.sql("SELECT run_id, pass_number, term, n, rank FROM topic", o.PAPERS, _topic_sql(60, tx.TRIAGE_TOKEN)),
)
def _(spark, sf):
    return _topic(spark, sf, 60, tx.TRIAGE_TOKEN).withColumn("rank", F.col("rank").cast("long"))


@query(
    "prescreen",
    o.sql(
        """, over AS (SELECT t.paper_id, list_sort(list(DISTINCT t.term)) AS l FROM ptok t JOIN topic USING (run_id, pass_number, term) GROUP BY 1)
        SELECT paper_id, CASE WHEN len(l) >= 3 THEN 'possible_include' END AS prescreen_hint,
        CASE WHEN len(l) >= 3 THEN array_to_string(l[1:20], ';') END AS prescreen_overlap_terms FROM papers LEFT JOIN over USING (paper_id)""",
        o.PAPERS,
        _topic_sql(80),
    ).replace("\n,", ",", 1),
)
def _(spark, sf):
    d = triage.prescreen(papers(spark, sf), _topic(spark, sf).select(*RUN, "term"), STOP)
    return d.select("paper_id", "prescreen_hint", "prescreen_overlap_terms")


@query(
    "phrase_matches",
    rf"""WITH ph AS (SELECT DISTINCT phrase FROM (SELECT lower({o.squash('s')}) AS phrase FROM (SELECT unnest({o.sentences('text')}) AS s FROM benchmark)) WHERE phrase <> ''),
    tk AS (SELECT phrase, list_filter(regexp_extract_all(phrase, '{tx.TRIAGE_TOKEN}'), lambda x: x NOT IN {_STOP})[1:4] AS t FROM ph)
    SELECT doc_id, phrase FROM documents, tk WHERE contains(lower(text), phrase)
      OR (len(t) > 0 AND len(list_filter(t, lambda x: contains(lower(text), x))) = len(t))""",
)
def _(spark, sf):
    sentence = F.explode(F.split("text", tx.SENTENCE_GAP)).alias("s")
    phrases = table(spark, sf, "benchmark").select(sentence).select(F.lower(tx.squash(F.col("s"))).alias("phrase"))
    d = spread(table(spark, sf, "documents")).select("doc_id", "text")
    return ph.match_phrases(d, F.col("text"), phrases, STOP, keep=["doc_id"])


@query(
    "phrase_index",
    rf"""WITH {o.PAPERS},
    ph AS (SELECT DISTINCT phrase FROM (SELECT lower(title) AS phrase FROM papers UNION ALL
      SELECT lower({o.squash('s')}) FROM (SELECT unnest({o.sentences('text')}) AS s FROM benchmark)) WHERE phrase <> ''),
    tk AS (SELECT phrase, list_filter(regexp_extract_all(phrase, '{tx.TRIAGE_TOKEN}'), lambda x: x NOT IN {_STOP})[1:4] AS t FROM ph)
    SELECT doc_id, phrase FROM documents, tk WHERE contains(lower(text), phrase)
      OR (len(t) > 0 AND len(list_filter(t, lambda x: contains(lower(text), x))) = len(t))""",
)
def _(spark, sf):
    """Every title and benchmark sentence in every text, by the index at any size."""
    sentence = F.explode(F.split("text", tx.SENTENCE_GAP)).alias("s")
    listed = table(spark, sf, "benchmark").select(sentence).select(F.lower(tx.squash(F.col("s"))).alias("phrase"))
    listed = listed.unionByName(papers(spark, sf).select(F.lower("title").alias("phrase")))
    d = spread(table(spark, sf, "documents")).select("doc_id", "text")
    return ph.match_phrases(d, F.col("text"), listed, STOP, few=0, keep=["doc_id"])


# A profile learned from the data: frequent tokens per run, the role told by
# the kind of source.
def data_profile(spark, sf):
    roles = list(match.SCOPE_ROLES)
    role = F.get(F.array(*[F.lit(r) for r in roles]), (F.regexp_extract("journal", "([0-9]+)$", 1).cast("int") % 6))
    d = papers(spark, sf, 1).withColumn("role", role)
    top = match.frequent_terms(d, F.col("abstract"), 15, [*RUN, "role"], STOP)
    return top.select(*RUN, "role", "term")


DATA_PROFILE = f"""rtok AS (SELECT run_id, ['primary', 'mechanism', 'outcome', 'comparator', 'exclusion', 'review_frame'][1 + CAST(regexp_extract(journal, '([0-9]+)$', 1) AS INTEGER) % 6] AS role,
   unnest(regexp_extract_all(lower(abstract), '{tx.TRIAGE_TOKEN}')) AS term FROM papers),
 dprof AS (SELECT run_id, role, term FROM (SELECT *, row_number() OVER (PARTITION BY run_id, role ORDER BY n DESC, term) AS rank
   FROM (SELECT run_id, role, term, count(*) AS n FROM rtok WHERE term NOT IN {_STOP} GROUP BY ALL)) WHERE rank <= 15)"""


@query(
    "distinct_signal_terms",
    o.sql(
        """SELECT run_id, role, term FROM dprof a WHERE length(term) >= 4 AND role IN ('mechanism', 'outcome', 'comparator')
        AND NOT EXISTS (SELECT 1 FROM dprof b WHERE b.run_id = a.run_id AND b.term = a.term AND (b.role = 'primary' OR (a.role = 'outcome' AND b.role = 'mechanism')))""",
        o.PAPERS_ONE,
        DATA_PROFILE,
    ),
)
def _(spark, sf):
    return match.distinct_signal_terms(data_profile(spark, sf)).select("run_id", "role", "term")


@query(
    "hard_negative_terms",
    o.sql(
        """SELECT run_id, term FROM dprof a WHERE role = 'exclusion'
        AND NOT EXISTS (SELECT 1 FROM dprof b WHERE b.run_id = a.run_id AND b.term = a.term AND b.role <> 'exclusion')""",
        o.PAPERS_ONE,
        DATA_PROFILE,
    ),
)
def _(spark, sf):
    return match.hard_negative_terms(data_profile(spark, sf)).select("run_id", "term")


@query(
    "role_sets",
    o.sql(
        """SELECT run_id, term, 'all' AS kind FROM dprof WHERE role <> 'exclusion' GROUP BY ALL UNION ALL
        SELECT run_id, term, 'outcome_only' FROM dprof a WHERE role = 'outcome' AND NOT EXISTS
        (SELECT 1 FROM dprof b WHERE b.run_id = a.run_id AND b.term = a.term AND b.role IN ('primary', 'mechanism'))""",
        o.PAPERS_ONE,
        DATA_PROFILE,
    ),
)
def _(spark, sf):
    p = data_profile(spark, sf)
    every = match.role_union(p, [r for r in match.SCOPE_ROLES if r != "exclusion"]).withColumn("kind", F.lit("all"))
    only = match.role_minus(p, "outcome", ["primary", "mechanism"]).withColumn("kind", F.lit("outcome_only"))
    return every.unionByName(only).select("run_id", "term", "kind")


FLAGGED = (o.PAPERS, o.PROF, o.MATCH, o.WINDOWS)


def flagged(spark, sf, pass_number=None):
    return match.paper_flags(papers(spark, sf, pass_number), profile(spark))


def first_pass(spark, sf, pass_number=None):
    return triage.triage_first(flagged(spark, sf, pass_number))


@query(
    "triage_first",
    o.sql(
        "SELECT paper_id, decision AS first_pass_decision, reason AS first_pass_rationale, confidence AS first_pass_confidence, "
        "match AS topic_match_type, role AS synthesis_role FROM triage1",
        o.PAPERS_ONE,
        *FLAGGED[1:],
        o.FIRST,
    ),
)
def _(spark, sf):
    return first_pass(spark, sf, 1).select(
        "paper_id",
        "first_pass_decision",
        "first_pass_rationale",
        "first_pass_confidence",
        "topic_match_type",
        "synthesis_role",
    )


@query(
    "triage_reason_counts",
    o.sql("SELECT run_id, pass_number, reason, count(*) AS n FROM triage1 GROUP BY ALL", *FLAGGED, o.FIRST),
)
def _(spark, sf):
    d = first_pass(spark, sf)
    return d.groupBy(*RUN, F.col("first_pass_rationale").alias("reason")).agg(F.count("*").alias("n"))


@query(
    "rescue_verdict",
    o.sql("SELECT paper_id, rkeep AS keep, rconf AS confidence, rescue AS reason, rrole AS role FROM judged", *FLAGGED, o.FIRST, o.SECOND),
)
def _(spark, sf):
    return flagged(spark, sf).select("paper_id", triage.rescue_verdict().alias("v")).select("paper_id", "v.*")


@query(
    "adjudicate_verdict",
    o.sql("SELECT paper_id, jkeep AS keep, jconf AS confidence, judge AS reason FROM judged", *FLAGGED, o.FIRST, o.SECOND),
)
def _(spark, sf):
    d = flagged(spark, sf).select("paper_id", triage.adjudicate_verdict().alias("v"))
    return d.select("paper_id", "v.keep", "v.confidence", "v.reason")


def read_state(spark, sf):
    """Readings recorded in the first pass: low quality means a drop."""
    low = F.col("quality") == 0
    return table(spark, sf, "labels").select(
        F.concat(F.lit("pmid-"), F.col("doc_id").cast("string")).alias("paper_id"),
        F.lit(1).alias("last_read_pass"),
        F.when(low, "drop").otherwise("keep").alias("latest_fulltext_decision"),
        F.when(low, "exclude").otherwise("direct_mechanistic").alias("latest_retention_role"),
        F.when(low, "tighten_query").otherwise("none").alias("latest_query_feedback_signal"),
    )


def second_pass(spark, sf):
    return triage.triage_second(triage.flag_prior_drops(first_pass(spark, sf), read_state(spark, sf)))


@query(
    "triage_second",
    o.sql(
        "SELECT paper_id, decision AS first_pass_decision, decision2 AS second_pass_decision, reason2 AS second_pass_rationale, "
        "conf2 AS second_pass_confidence, promotion AS promotion_decision, role2 AS synthesis_role FROM second",
        *FLAGGED,
        o.FIRST,
        o.SECOND,
    ),
)
def _(spark, sf):
    return second_pass(spark, sf).select(
        "paper_id",
        "first_pass_decision",
        "second_pass_decision",
        "second_pass_rationale",
        "second_pass_confidence",
        "promotion_decision",
        "synthesis_role",
    )


@query(
    "flag_prior_drops",
    o.sql("SELECT paper_id, pass_number > 1 AND paper_id IN (SELECT 'pmid-' || doc_id FROM labels WHERE quality = 0) AS prior_drop FROM papers", o.PAPERS),
)
def _(spark, sf):
    return triage.flag_prior_drops(papers(spark, sf), read_state(spark, sf)).select("paper_id", "prior_drop")


@query(
    "carry_over",
    o.sql(
        """SELECT paper_id, CASE WHEN quality = 1 THEN 'include' WHEN quality = 0 THEN 'exclude' END AS decision,
        coalesce(CASE WHEN toxic = 1 THEN 'human' END, 'agent') AS triage_actor FROM papers LEFT JOIN labels USING (doc_id)""",
        o.PAPERS,
    ),
)
def _(spark, sf):
    fresh = papers(spark, sf).select(
        *RUN, "paper_id", F.lit(None).cast("string").alias("decision"), F.lit("agent").alias("triage_actor")
    )
    said = table(spark, sf, "labels").select(
        F.concat(F.lit("pmid-"), F.col("doc_id").cast("string")).alias("paper_id"),
        F.when(F.col("quality") == 1, "include").otherwise("exclude").alias("decision"),
        F.when(F.col("toxic") == 1, "human").otherwise(" ").alias("triage_actor"),
        F.lit(2).alias("row_no"),
    )
    # An older row of the same papers, to be overridden by the last one.
    both = said.unionByName(said.withColumn("decision", F.lit("old")).withColumn("row_no", F.lit(1)))
    d = triage.carry_over(fresh, both, ["decision", "triage_actor"], keys=("paper_id",))
    return d.select("paper_id", "decision", "triage_actor")
