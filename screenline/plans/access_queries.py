"""Registered queries on access, files and streams, with SQL twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from screenline.functions.text import SENTENCE_GAP, squash
from screenline.operators import access, linking, match, ranking, state
from screenline.plans import oracle as o
from screenline.plans.collect_queries import BLOCK, RULES, label_state
from screenline.plans.registry import Registry
from screenline.plans.stages import ctes, stage_tables
from screenline.plans.text_queries import STOP, _STOP
from screenline.plans.views import papers, table, venue_rules
from screenline.session import shared_dir, spread
from screenline.sources import stage
from screenline.streaming import streams

query = Registry()
S = "WITH " + ctes()
KEYS = ["run_id", "pass_number"]


def fresh(spark, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def _manifest(spark, sf):
    return papers(spark, sf).select(*KEYS, "paper_id", "title", "abstract", "year", F.col("journal").alias("source_query"), F.lit("Journal Article").alias("publication_types"))


_RUN_TERMS = f"""rt AS (SELECT run_id, term, rank FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY n DESC, term) AS rank FROM (
  SELECT run_id, term, count(*) AS n FROM (SELECT run_id, unnest(regexp_extract_all(lower(abstract), '[a-z][a-z0-9+/-]{{2,}}')) AS term FROM papers) WHERE term NOT IN {_STOP} GROUP BY ALL)) WHERE rank <= 24)"""
_SHORT = f"""{_RUN_TERMS},
ready AS (SELECT run_id FROM (SELECT run_id, count(*) AS n, arg_max(pdf_deferral_decision, pass_number) AS last FROM pmc_mechanism_feedback GROUP BY run_id) WHERE n >= 2 AND last = 'final_pdf_pass'),
txt AS (SELECT q.run_id, q.pass_number, q.paper_id, q.n_chars, coalesce(s.promotion_decision, '') AS promotion, q.title || chr(10) || p.abstract || chr(10) || p.journal AS t, lower(q.title || chr(10) || p.abstract || chr(10) || p.journal) AS low
  FROM manual_pdf_queue q JOIN ready USING (run_id) LEFT JOIN papers p USING (run_id, pass_number, paper_id) LEFT JOIN second_pass s USING (run_id, pass_number, paper_id)),
lm AS (SELECT paper_id, low, list_filter(['ertion', 'erat', 'anin'], lambda x: contains(low, x)) AS l, list_filter(['les'], lambda x: contains(low, x) AND x NOT IN {_STOP}) AS n FROM txt),
um AS (SELECT paper_id, list(term ORDER BY rank) AS u FROM txt JOIN rt USING (run_id) WHERE contains(low, term) GROUP BY paper_id),
short AS (SELECT t.*, l, n, coalesce(u, []) AS u, CASE WHEN len(n) > 0 AND len(l) = 0 THEN 'noise' WHEN promotion <> 'advance_to_import' THEN 'not_advanced' WHEN len(l) >= 2 AND len(coalesce(u, [])) > 0 THEN 'strong_learned_match'
  WHEN len(l) > 0 THEN 'possible_learned_match' WHEN len(coalesce(u, [])) > 0 AND len(n) = 0 THEN 'run_terms_only' ELSE 'no_match' END AS reason FROM txt t JOIN lm USING (paper_id) LEFT JOIN um USING (paper_id))"""
_PRIORITY = "CASE reason WHEN 'noise' THEN 'exclude' WHEN 'not_advanced' THEN 'exclude' WHEN 'strong_learned_match' THEN 'high' WHEN 'possible_learned_match' THEN 'medium' ELSE 'low' END"
_DECISION = "CASE WHEN reason IN ('noise', 'not_advanced') THEN 'do_not_request' WHEN reason = 'no_match' THEN 'defer_pdf' ELSE 'request_pdf' END"


def _shortlist(spark, sf):
    t = stage_tables(spark, sf, "manual_pdf_queue", "second_pass", "pmc_mechanism_feedback")
    rt = match.frequent_terms(papers(spark, sf), F.col("abstract"), 24, ["run_id"], STOP)
    return (
        access.shortlist(
            t["manual_pdf_queue"], _manifest(spark, sf), t["second_pass"], t["pmc_mechanism_feedback"], rt.select("run_id", "term", "rank"), STOP
        ),
        t,
    )


@query(
    "shortlist",
    S
    + f""",\n{o.PAPERS}, {_SHORT} SELECT paper_id, {_PRIORITY} AS priority, {_DECISION} AS shortlist_decision, reason AS shortlist_rationale,
    array_to_string(CASE reason WHEN 'noise' THEN n[1:8] WHEN 'not_advanced' THEN ['not_advanced'] WHEN 'strong_learned_match' THEN list_concat(l, u)[1:10] WHEN 'possible_learned_match' THEN l[1:10]
      WHEN 'run_terms_only' THEN u[1:8] ELSE ['none'] END, '; ') AS learned_criteria_matched FROM short""",
)
def _(spark, sf):
    d, _t = _shortlist(spark, sf)
    return ranking.sort_shortlist(d).select("paper_id", "priority", "shortlist_decision", "shortlist_rationale", "learned_criteria_matched")


@query(
    "request_list",
    S + f",\n{o.PAPERS}, {_SHORT} SELECT run_id, pass_number, paper_id, {_PRIORITY} AS priority FROM short WHERE {_DECISION} = 'request_pdf'",
)
def _(spark, sf):
    d, t = _shortlist(spark, sf)
    return access.request_list(d, t["pmc_mechanism_feedback"]).select(*KEYS, "paper_id", "priority")


@query(
    "enrich",
    o.sql(
        "SELECT q.paper_id, p.year, s.promotion_decision FROM manual_pdf_queue q LEFT JOIN papers p USING (paper_id) LEFT JOIN second_pass s USING (paper_id)",
        ctes(),
        o.PAPERS,
    ),
)
def _(spark, sf):
    t = stage_tables(spark, sf, "manual_pdf_queue", "second_pass")
    d = access.enrich(t["manual_pdf_queue"], _manifest(spark, sf), t["second_pass"])
    return d.select("paper_id", "year", "promotion_decision")


@query(
    "final_reading_list",
    S
    + """ SELECT paper_id, 'selected_for_reading' AS final_decision, 'readable' AS fulltext_access_status, 'why' AS final_rationale, 2001 AS year FROM fulltext_review WHERE fulltext_decision = 'keep'
    UNION ALL SELECT i.paper_id, 'abstract_relevant_fulltext_unavailable', CASE WHEN pdf_import_status = 'parser_pending' THEN 'parser_pending' ELSE 'unavailable' END, 'r fulltext_not_readable', 2001
    FROM import_status i JOIN second_pass s USING (run_id, pass_number, paper_id) WHERE run_id IN ('en', 'fr') AND normalized_path = '' AND s.promotion_decision = 'advance_to_import'""",
)
def _(spark, sf):
    t = stage_tables(spark, sf, "fulltext_review", "paper_manifest", "second_pass", "import_status", "settings")
    phase = t["settings"].select("run_id", F.try_element_at("settings", F.lit("access_phase")).alias("access_phase"))
    d = access.final_reading_list(t["fulltext_review"], t["paper_manifest"], t["second_pass"], t["import_status"], phase)
    return d.select("paper_id", "final_decision", "fulltext_access_status", "final_rationale", "year")


@query(
    "access_decision",
    S
    + """, c AS (SELECT lang AS run_id, (SELECT count(*) FROM manual_pdf_queue q WHERE q.run_id = lang) AS queue, (SELECT count(*) FROM pmc_mechanism_feedback f WHERE f.run_id = lang) AS loops,
      (SELECT arg_max(pdf_deferral_decision, pass_number) FROM pmc_mechanism_feedback f WHERE f.run_id = lang) AS last, EXISTS (SELECT 1 FROM pdf_download_shortlist s WHERE s.run_id = lang) AS short,
      CASE lang WHEN 'fr' THEN 3 ELSE 2 END AS need, lang IN ('de', 'es') AS learning, CASE lang WHEN 'en' THEN 'continue_pmc_only' WHEN 'de' THEN 'require_fulltext_completion' ELSE 'pause_for_user' END AS policy FROM (SELECT DISTINCT lang FROM documents)),
    r AS (SELECT *, loops >= need AND last = 'final_pdf_pass' AND short AS ready FROM c),
    v AS (SELECT run_id, coalesce(ready, false) AS ready, CASE WHEN queue = 0 THEN 'not_needed' WHEN learning AND NOT ready AND policy <> 'require_fulltext_completion' THEN 'deferred_for_pmc_learning'
      WHEN loops < need AND policy <> 'require_fulltext_completion' THEN 'deferred_for_pmc_learning' WHEN policy = 'pause_for_user' THEN 'paused_for_user' WHEN policy = 'require_fulltext_completion' THEN 'awaiting_pdf' ELSE 'continue_without_pdf' END AS status FROM r)
    SELECT run_id, ready AS final_shortlist_ready, status, CASE status WHEN 'not_needed' THEN 'continue_fulltext_review' WHEN 'deferred_for_pmc_learning' THEN 'continue_pmc_learning' WHEN 'awaiting_pdf' THEN 'provide_pdfs_then_continue' ELSE 'continue_pmc_only' END AS recommended_action FROM v""",
)
def _(spark, sf):
    t = stage_tables(spark, sf, "manual_pdf_queue", "pmc_mechanism_feedback", "pdf_download_shortlist", "settings")
    q = t["manual_pdf_queue"].groupBy("run_id").agg(F.count("*").alias("queue_count"))
    f = t["pmc_mechanism_feedback"].groupBy("run_id").agg(
        F.count("*").alias("loop_count"), F.max_by("pdf_deferral_decision", "pass_number").alias("latest_decision")
    )
    s = t["pdf_download_shortlist"].select("run_id").distinct().withColumn("has_shortlist", F.lit(True))
    return access.access_decision(t["settings"], q.join(f, "run_id", "full_outer").join(s, "run_id", "full_outer"))


@query(
    "merge_reports",
    """WITH e AS (SELECT CAST(week(ts) AS INTEGER) AS pass_number, 'pmid-' || user_id AS paper_id, bool_or(event_type = 'click') AS isnew, bool_or(event_type = 'view') AS isold, bool_or(event_type IN ('error', 'signup')) AS staged FROM events GROUP BY ALL)
    SELECT pass_number, paper_id, CASE WHEN isnew THEN 'new' WHEN isold THEN 'old' ELSE 'kept_from_earlier' END AS notes FROM e WHERE isnew OR staged""",
)
def _(spark, sf):
    """Every week is a pass."""
    events = table(spark, sf, "events").withColumn("pass_number", F.weekofyear("ts"))

    def part(*kinds):
        u = F.col("user_id").cast("string")
        d = events.where(F.col("event_type").isin(*kinds)).select("pass_number", u.alias("pmid")).distinct()
        return d.select(F.lit("r").alias("run_id"), "pass_number", F.concat(F.lit("pmid-"), F.col("pmid")).alias("paper_id"), "pmid", F.lit("").alias("doi"), F.lit("").alias("title"))

    def report(d, note):
        return d.select(
            "*",
            F.lit("staged").alias("import_status"),
            F.lit("pmid").alias("match_method"),
            F.lit(1.0).alias("match_score"),
            F.lit("").alias("source_filename"),
            F.lit("").alias("staged_pdf_path"),
            F.lit(note).alias("notes"),
        )

    staged = part("error", "signup").withColumn("pdf_import_status", F.lit("staged_from_user_download"))
    return access.merge_reports(report(part("click"), "new"), report(part("view"), "old"), staged).select("pass_number", "paper_id", "notes")


# Files named after pages, benchmark items and, in nine ways, the documents
# themselves: by an id in the name, the origin or the embedded title, by title,
# by embedded title, by author, venue and year.
def link_inputs(spark, sf):
    first = lambda c: squash(F.get(F.split(c, SENTENCE_GAP), F.lit(0)))
    d = spread(table(spark, sf, "documents"))
    way, no = F.col("doc_id") % 9, F.col("doc_id")
    queue = d.select(
        no.alias("queue_no"),
        F.concat(F.lit("pmid-"), no.cast("string")).alias("paper_id"),
        (no + 71000000).cast("string").alias("pmid"),
        F.when(way.isin(2, 3) | (F.col("source") == "src3"), F.concat(F.lit("PMC"), no + 9000000)).alias("pmcid"),
        F.concat(F.lit("10.5555/"), F.translate("source", "rc", ""), F.lit("."), (no + 4400000).cast("string")).alias("doi"),
        first(F.col("text")).alias("title"),
        F.concat_ws(" ", "source", "lang").alias("first_author"),
        F.concat(F.lit("Annals of "), "lang", F.lit("x")).alias("journal"),
        (2000 + F.col("n_chars") % 25).cast("string").alias("year"),
    )
    whole = F.col("doc_id") % 2 == 0
    doi = F.when(whole, F.translate("doi", "/", "_")).otherwise((no + 4400000).cast("string"))
    stem = (
        F.when(way == 0, F.concat(F.lit("Copy of "), "paper_id"))
        .when(way == 1, F.col("pmid"))
        .when(way == 2, F.concat(F.lit("full_"), "pmcid"))
        .when(way == 4, doi)
        .when(way == 6, F.concat("title", F.lit(" final")))
        .when(way == 8, F.concat_ws(" ", F.split("first_author", " ")[0], F.lit("annals"), "year", no.cast("string")))
        .otherwise(F.concat(F.lit("scan "), no.cast("string")))
    )
    own = queue.withColumn("doc_id", F.col("queue_no"))
    c = own.select(
        F.concat(F.lit("/in/d"), F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit(".pdf")).alias("path"),
        F.concat(stem, F.lit(".pdf")).alias("name"),
        stem.alias("stem"),
        F.when(way == 5, F.concat(F.lit("doi "), doi)).when(way == 7, F.col("title")).otherwise("").alias("meta_title"),
        F.when(way == 3, F.concat(F.lit("https://x.org/"), "pmcid", F.lit("/pdf"))).otherwise("").alias("origin"),
    )
    p = table(spark, sf, "pages")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    a = p.select(
        F.concat(F.lit("/in/p"), F.lpad(F.col("page_id").cast("string"), 9, "0"), F.lit(".pdf")).alias("path"),
        F.concat(F.lit("p"), F.lpad(F.col("page_id").cast("string"), 9, "0"), F.lit(".pdf")).alias("name"),
        title.alias("stem"),
        F.lit("").alias("meta_title"),
        F.concat(F.lit("pmc"), F.col("page_id") + 9000000).alias("origin"),
    )
    b = table(spark, sf, "benchmark").select(
        F.concat(F.lit("/in/b"), F.lpad(F.col("item_id").cast("string"), 9, "0"), F.lit(".pdf")).alias("path"),
        F.concat(F.lit("b"), F.lpad(F.col("item_id").cast("string"), 9, "0"), F.lit(".pdf")).alias("name"),
        F.lit("scan").alias("stem"),
        first(F.col("text")).alias("meta_title"),
        F.lit("").alias("origin"),
    )
    return queue, a.unionByName(b).unionByName(c)


def _words(c: str) -> str:
    return (
        f"list_distinct(list_filter(string_split(trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g')), ' '), "
        f"lambda x: length(x) > 2 AND x NOT IN {_STOP}))"
    )


def _compact(c: str) -> str:
    return f"regexp_replace(lower({c}), '[^a-z0-9]', '', 'g')"


_FIRST = f"{o.squash(o.sentences('text') + '[1]')}"
_DOI_HITS = "\n".join(f"WHEN contains(cname, k{i}) THEN {2 + 2 * i} WHEN contains(cmeta, k{i}) THEN {3 + 2 * i}" for i in (1, 2, 3, 4))
_LINK = f"""q AS (SELECT doc_id, doc_id AS queue_no, doc_id % 9 AS way, 'pmid-' || doc_id AS paper_id, CAST(doc_id + 71000000 AS VARCHAR) AS pmid,
  CASE WHEN doc_id % 9 IN (2, 3) OR source = 'src3' THEN 'PMC' || (doc_id + 9000000) END AS pmcid, translate(source, 'rc', '') || '.' || (doc_id + 4400000) AS suffix,
  CAST(doc_id + 4400000 AS VARCHAR) AS number, coalesce({_FIRST}, '') AS title, source AS author, 'Annals of ' || lang || 'x' AS journal,
  CAST(2000 + n_chars % 25 AS VARCHAR) AS year FROM documents),
dn AS (SELECT *, CASE WHEN doc_id % 2 = 0 THEN '10.5555_' || suffix ELSE number END AS shown FROM q),
df AS (SELECT doc_id, CASE way WHEN 0 THEN 'Copy of ' || paper_id WHEN 1 THEN pmid WHEN 2 THEN 'full_' || pmcid WHEN 4 THEN shown
    WHEN 6 THEN title || ' final' WHEN 8 THEN author || ' annals ' || year || ' ' || doc_id ELSE 'scan ' || doc_id END AS stem,
  CASE way WHEN 5 THEN 'doi ' || shown WHEN 7 THEN title ELSE '' END AS meta, CASE way WHEN 3 THEN 'https://x.org/' || pmcid || '/pdf' ELSE '' END AS origin FROM dn),
f0 AS (SELECT '/in/d' || lpad(CAST(doc_id AS VARCHAR), 9, '0') || '.pdf' AS path, stem || '.pdf' AS name, stem, meta, origin FROM df
  UNION ALL SELECT '/in/p' || lpad(CAST(page_id AS VARCHAR), 9, '0') || '.pdf', 'p' || lpad(CAST(page_id AS VARCHAR), 9, '0') || '.pdf',
    regexp_extract(html, '<title>([^<]*)</title>', 1), '', 'pmc' || (page_id + 9000000) FROM pages
  UNION ALL SELECT '/in/b' || lpad(CAST(item_id AS VARCHAR), 9, '0') || '.pdf', 'b' || lpad(CAST(item_id AS VARCHAR), 9, '0') || '.pdf', 'scan', {_FIRST}, '' FROM benchmark),
f AS (SELECT path, name, {_compact("name")} AS cname, {_compact("meta")} AS cmeta, {_compact("origin")} AS corigin, {_words("stem")} AS stem, {_words("meta")} AS meta FROM f0),
qq AS (SELECT queue_no, paper_id, {_compact("paper_id")} AS cpaper, pmid, lower(pmcid) AS cpmc, {_compact("'10.5555/' || suffix")} AS k1, {_compact("suffix")} AS k2,
  number AS k3, regexp_replace(suffix, '[^0-9]', '', 'g') AS k4, {_words("title")} AS ws, author, {_words("journal")} AS venue, year FROM q),
ir AS (SELECT queue_no, path, CASE WHEN contains(cname, cpaper) THEN 0 WHEN contains(cname, pmid) THEN 1 WHEN contains(cname, cpmc) THEN 2
    WHEN contains(corigin, cpmc) THEN 3 {_DOI_HITS} END AS rank FROM qq, f),
ids AS (SELECT queue_no, path, CASE WHEN rank < 4 THEN ['paper_id', 'pmid', 'pmcid', 'pdf_metadata_pmcid'][rank + 1]
    WHEN rank % 2 = 0 THEN 'doi' ELSE 'pdf_metadata_doi' END AS method, CASE WHEN rank < 6 THEN 1.0 ELSE 0.95 END::DOUBLE AS score FROM ir WHERE rank IS NOT NULL),
t AS (SELECT queue_no, path, coalesce(len(list_intersect(ws, stem)) / nullif(len(ws), 0), 0) AS s0, coalesce(len(list_intersect(ws, meta)) / nullif(len(ws), 0), 0) AS s1,
    CASE WHEN list_contains(stem, author) AND contains(name, year) AND list_has_any(venue, stem) THEN 0.7 ELSE 0 END AS s2
  FROM qq, f WHERE list_has_any(ws, stem) OR list_has_any(ws, meta) OR list_contains(stem, author)),
tt AS (SELECT queue_no, path, greatest(s0, s1, s2)::DOUBLE AS score, CASE WHEN s0 >= s1 AND s0 >= s2 THEN 'title_overlap' WHEN s1 >= s2 THEN 'pdf_metadata_title'
    ELSE 'author_year_journal' END AS method FROM t WHERE greatest(s0, s1, s2) >= 0.45)"""


@query(
    "link_candidates",
    o.sql(
        """SELECT q.queue_no, q.paper_id, c.path AS first_path, c.method, round(c.score, 3) AS score FROM q JOIN (
        SELECT *, row_number() OVER (PARTITION BY queue_no ORDER BY kind, s, path) AS r FROM (
          SELECT 0 AS kind, 0 AS s, * FROM ids UNION ALL BY NAME SELECT 1 AS kind, -score AS s, * FROM tt)) c ON c.queue_no = q.queue_no AND c.r = 1""",
        _LINK,
    ),
)
def _(spark, sf):
    return linking.link_candidates(*link_inputs(spark, sf), STOP)


@query(
    "assign_one_to_one",
    "WITH RECURSIVE "
    + _LINK
    + """,
    l AS MATERIALIZED (SELECT row_number() OVER (ORDER BY queue_no) AS n, queue_no, list(struct_pack(path := path, method := method, score := score) ORDER BY kind, s, path) AS c FROM (
      SELECT 0 AS kind, 0 AS s, * FROM ids UNION ALL BY NAME SELECT 1 AS kind, -score AS s, * FROM tt) GROUP BY queue_no),
    g AS (SELECT 0::BIGINT AS n, NULL::BIGINT AS queue_no, NULL::STRUCT(path VARCHAR, method VARCHAR, score DOUBLE) AS pick, []::VARCHAR[] AS used
      UNION ALL SELECT n, queue_no, pick, CASE WHEN pick IS NULL THEN used ELSE list_append(used, pick.path) END FROM (
        SELECT l.n, l.queue_no, list_filter(l.c, lambda x: NOT list_contains(g.used, x.path))[1] AS pick, g.used FROM g JOIN l ON l.n = g.n + 1))
    SELECT queue_no, pick.path AS path, pick.method AS method, round(pick.score, 3) AS score FROM g WHERE pick IS NOT NULL""",
)
def _(spark, sf):
    d = linking.assign_one_to_one(*link_inputs(spark, sf), STOP)
    return d.select("queue_no", "path", "method", "score")


STAGE_COLUMNS = [*KEYS, "paper_id", "title", "abstract", "year"]
STAGE_SCHEMA = "run_id string, pass_number int, paper_id string, title string, abstract string, year int"
_ROUND = o.sql("SELECT run_id, pass_number, paper_id, title, md5(abstract) AS abstract, year FROM papers", o.PAPERS)


def _shown(d):
    return d.withColumn("abstract", F.md5("abstract"))


@query("stage_csv", _ROUND)
def _(spark, sf):
    """Stage table written as CSV and read back."""
    path = fresh(spark, "csv")
    stage.write_stage(papers(spark, sf), path, STAGE_COLUMNS, "csv")
    return _shown(stage.read_stage(spark, path, STAGE_SCHEMA))


@query("stage_csv_quoted", _ROUND)
def _(spark, sf):
    path = fresh(spark, "quoted")
    stage.write_quoted(papers(spark, sf), path, STAGE_COLUMNS)
    return _shown(stage.read_stage(spark, path, STAGE_SCHEMA))


@query("read_passes", _ROUND)
def _(spark, sf):
    """Stage table partitioned by run and pass."""
    path = fresh(spark, "passes")
    stage.write_stage(papers(spark, sf), path, STAGE_COLUMNS)
    return _shown(stage.read_passes(spark, path, STAGE_SCHEMA)).select(*STAGE_COLUMNS)


@query("union_passes", "SELECT doc_id, pass_number, extra FROM (SELECT doc_id, 1 AS pass_number, CAST(NULL AS INTEGER) AS extra FROM documents UNION ALL SELECT doc_id, 2, quality FROM labels)")
def _(spark, sf):
    a = table(spark, sf, "documents").select("doc_id", F.lit(1).alias("pass_number"))
    b = table(spark, sf, "labels").select("doc_id", F.lit(2).alias("pass_number"), F.col("quality").alias("extra"))
    return stage.union_passes(a, b)


@query(
    "write_state_json",
    "SELECT lang AS run_id, count(*) AS n FROM documents GROUP BY lang",
)
def _(spark, sf):
    path = fresh(spark, "state")
    stage.write_state_json(table(spark, sf, "documents").groupBy(F.col("lang").alias("run_id")).agg(F.count("*").alias("n")), path)
    return spark.read.schema("run_id string, n bigint").json(path)


@query(
    "read_normalized",
    "SELECT 'pmid-' || doc_id AS paper_id, CASE WHEN lang = 'fr' THEN md5('') ELSE md5(lower(text)) END AS raw_text FROM documents",
)
def _(spark, sf):
    """Full texts stored as JSON; French ones have no text field."""
    path = fresh(spark, "normalized")
    text = F.when(F.col("lang") != "fr", F.col("text"))
    d = table(spark, sf, "documents").select(F.concat(F.lit("pmid-"), F.col("doc_id").cast("string")).alias("paper_id"), text.alias("raw_text"))
    d.write.mode("overwrite").json(path)
    return stage.read_normalized(spark, path).select("paper_id", F.md5("raw_text").alias("raw_text"))


@query(
    "compact_records",
    """SELECT lang AS run_id, CAST(1 + doc_id % 2 AS INTEGER) AS pass_number, 'pmid-' || doc_id AS paper_id,
    CASE WHEN lang = 'fr' THEN 'old' ELSE 'records/pass_00' || (1 + doc_id % 2) || '/pmid-' || doc_id END AS record_path FROM documents""",
)
def _(spark, sf):
    """Small records to one table; French passes lack records and keep theirs."""
    p = papers(spark, sf)
    src = fresh(spark, "records")
    p.where("run_id <> 'fr'").select(*KEYS, "paper_id", "title").write.json(src)
    rec = spark.read.schema("run_id string, pass_number int, paper_id string, title string").json(src)
    manifest = p.select(*KEYS, "paper_id", F.lit("old").alias("record_path"))
    d = stage.compact_records(rec, manifest, fresh(spark, "compacted"))
    return d.select(*KEYS, "paper_id", "record_path")


@query(
    "purge_prior_payloads",
    """SELECT event_type AS run_id, CAST(week(ts) AS INTEGER) AS pass_number, event_id FROM events WHERE event_type <> 'error'
      AND week(ts) >= CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 0 ELSE 5 END""",
)
def _(spark, sf):
    """A stored table purged and read again: one run keeps some weeks, one all,
    one has none of its active pass, the others keep their last week."""
    e = table(spark, sf, "events").select(F.col("event_type").alias("run_id"), F.weekofyear("ts").cast("int").alias("pass_number"), "event_id")
    path = fresh(spark, "payloads")
    e.write.partitionBy("run_id").parquet(path)
    run = F.col("run_id")
    at = F.when(run == "view", 2).when(run == "click", 0).when(run == "error", 99).otherwise(F.col("pass_number"))
    active = e.groupBy("run_id").agg(F.max("pass_number").alias("pass_number")).withColumn("pass_number", at)
    stage.purge_prior_payloads(spark, path, active)
    return spark.read.schema(e.schema).parquet(path).select("run_id", "pass_number", "event_id")


@query(
    "pdf_files",
    "SELECT doc_id, octet_length(encode('%PDF-1.4 ' || text)) AS length FROM documents WHERE lang <> 'de'",
)
def _(spark, sf):
    """Documents as file rows; German ones are not PDF."""
    body = F.when(F.col("lang") == "de", F.col("text")).otherwise(F.concat(F.lit("%PDF-1.4 "), F.col("text")))
    d = table(spark, sf, "documents").select(
        F.concat(F.lit("/in/"), F.col("doc_id"), F.lit(".pdf")).alias("path"),
        F.lit(None).cast("timestamp").alias("modificationTime"),
        F.octet_length(body).cast("bigint").alias("length"),
        body.cast("binary").alias("content"),
    )
    return stage.pdf_files(d).select(F.col("stem").cast("bigint").alias("doc_id"), "length")


# Fifty documents to a file, a line with its digest each. Of five files one has
# another ending and one another beginning.
_VOLUMES = """v AS (SELECT doc_id // 50 AS volume, '%PDF-1.7' || chr(10) || string_agg(md5(text) || chr(10), '' ORDER BY doc_id) AS body
  FROM documents WHERE doc_id // 50 % 5 NOT IN (1, 2) GROUP BY ALL)"""


def volumes(spark, sf):
    """A folder with these files."""
    d = table(spark, sf, "documents").select((F.col("doc_id") / 50).cast("long").alias("volume"), "doc_id", F.md5("text").alias("line"))
    begin = F.when(F.col("volume") % 5 == 2, "plain text").otherwise("%PDF-1.7")
    lines = d.unionByName(d.groupBy("volume").agg(F.min("doc_id").alias("doc_id")).select("volume", F.lit(-1).cast("long").alias("doc_id"), begin.alias("line")))
    path = fresh(spark, "volumes")
    lines = lines.repartition("volume").sortWithinPartitions("volume", "doc_id").select("line", "volume")
    other = F.col("volume") % 5 == 1
    for some, ending in ((~other, "pdf"), (other, "txt")):
        lines.where(some).write.mode("append").partitionBy("volume").option("extension", ending).csv(path)
    return path


def _volume():
    return F.regexp_extract("path", "/volume=([0-9]+)/", 1).cast("long").alias("volume")


@query("scan_files", o.sql("SELECT volume, octet_length(encode(body)) AS length, sha256(body) AS content_hash FROM v", _VOLUMES))
def _(spark, sf):
    """Files on disk, read by the binary reader; the hash is of their bytes."""
    return stage.scan_files(spark, volumes(spark, sf), hashed=True).select(_volume(), "length", "content_hash")


@query("stream_files", o.sql("SELECT volume, octet_length(encode(body)) AS length FROM v", _VOLUMES))
def _(spark, sf):
    """The same files taken in as a stream."""
    out = fresh(spark, "files")
    streams.run_available(streams.stream_files(spark, f"{volumes(spark, sf)}/*"), out, fresh(spark, "cp"))
    return spark.read.parquet(out).select(_volume(), "length")


CONTRACT = {
    "Primary entities": "primary",
    "Mechanism classes": "mechanism",
    "Outcomes": "outcome",
    "Comparators": "comparator",
    "Exclusions": "exclusion",
}


@query(
    "read_contract_terms",
    rf"""WITH l AS (SELECT item_id, CASE item_id % 5 WHEN 0 THEN 'primary' WHEN 1 THEN 'mechanism' WHEN 2 THEN 'outcome' WHEN 3 THEN 'comparator' ELSE 'exclusion' END AS role, unnest(regexp_split_to_array(text, '[,;\n|]+')) AS part FROM benchmark),
    n AS (SELECT item_id, role, part, list_filter(string_split(regexp_replace(lower(part), '[^a-z0-9+/-]+', ' ', 'g'), ' '), lambda x: x <> '' AND x NOT IN {_STOP}) AS ws FROM l),
    t AS (SELECT item_id, role, array_to_string(ws, ' ') AS term FROM n WHERE len(ws) > 0 UNION SELECT item_id, role, lower(a) FROM (SELECT item_id, role, unnest(regexp_extract_all(part, '[A-Za-z][A-Za-z0-9+/-]+')) AS a FROM n WHERE len(ws) > 1)
      WHERE regexp_matches(a, '[A-Z]{{2,}}|[0-9]|[-+/]') AND lower(a) NOT IN {_STOP})
    SELECT DISTINCT item_id, role, term FROM t""",
)
def _(spark, sf):
    """Benchmark items as scope contracts of one filled label each."""
    labels = list(CONTRACT)
    lead = F.get(F.array(*[F.lit(x) for x in labels]), (F.col("item_id") % 5).cast("int"))
    b = table(spark, sf, "benchmark").select(
        "item_id", F.concat(F.lit("# Scope\n- Notes:\n- "), lead, F.lit(": "), F.col("text"), F.lit("\n- Free notes: xx")).alias("value")
    )
    return stage.read_contract_terms(b, STOP, ["item_id"])


@query(
    "build_profile",
    o.sql(
        """SELECT run_id, role, term FROM (SELECT * FROM prim UNION SELECT * FROM mech UNION SELECT run_id, 'outcome', term FROM decl WHERE role = 'outcome'
        UNION SELECT run_id, 'outcome', term FROM mech WHERE run_id NOT IN (SELECT run_id FROM decl WHERE role = 'outcome') UNION SELECT * FROM decl WHERE role = 'comparator')""",
        o.PAPERS_ONE,
        f"""freq AS (SELECT run_id, term, rank FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY n DESC, term) AS rank FROM (SELECT run_id, term, count(*) AS n FROM
        (SELECT run_id, unnest(regexp_extract_all(lower(abstract), '[a-z][a-z0-9+/-]{{2,}}')) AS term FROM papers) WHERE term NOT IN {_STOP} GROUP BY ALL)) WHERE rank <= 70)""",
        """decl AS (SELECT run_id, ['primary', 'mechanism', 'outcome', 'comparator'][1 + rank % 4] AS role, term FROM freq WHERE (rank > 60 OR rank BETWEEN 10 AND 14)
          AND NOT (run_id = 'de' AND rank % 4 = 0) AND NOT (run_id = 'fr' AND rank % 4 = 1) AND NOT (run_id = 'es' AND rank % 4 < 3))""",
        """prim AS (SELECT run_id, role, term FROM decl WHERE role = 'primary' UNION SELECT run_id, 'primary', term FROM freq
          WHERE rank <= 20 AND run_id NOT IN (SELECT run_id FROM decl WHERE role = 'primary'))""",
        """mech AS (SELECT run_id, role, term FROM decl WHERE role = 'mechanism' UNION SELECT run_id, 'mechanism', term FROM freq f
          WHERE rank <= 60 AND run_id NOT IN (SELECT run_id FROM decl WHERE role = 'mechanism') AND NOT EXISTS (SELECT 1 FROM prim p WHERE p.run_id = f.run_id AND p.term = f.term))""",
    ),
)
def _(spark, sf):
    """Contracts that declare everything, no primary terms, no mechanisms, or
    comparators only; what is missing comes from the run's frequent words."""
    ranked = match.frequent_terms(papers(spark, sf, 1), F.col("abstract"), 70, KEYS, STOP)
    place, run = F.col("rank") % 4, F.col("run_id")
    role = F.get(F.array(*[F.lit(r) for r in ("primary", "mechanism", "outcome", "comparator")]), place)
    lacks = ((run == "de") & (place == 0)) | ((run == "fr") & (place == 1)) | ((run == "es") & (place < 3))
    declared = ranked.where(((F.col("rank") > 60) | F.col("rank").between(10, 14)) & ~lacks).select(*KEYS, role.alias("role"), "term")
    return match.build_profile(declared, ranked.where("rank <= 60")).select("run_id", "role", "term")


@query(
    "read_query_list",
    rf"""WITH l AS (SELECT conv_id, turn, role, {o.squash("replace(text, chr(10), ' ')")} AS t, coalesce(last_value(CASE WHEN role <> 'assistant' THEN role = 'user' END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), false) AS inside FROM conversations)
    SELECT conv_id, turn AS line_no, t AS query FROM l WHERE role = 'assistant' AND inside AND t <> ''""",
)
def _(spark, sf):
    """Conversations as strategy files: user turns open the query section,
    system turns another, assistant turns are numbered items."""
    t = squash(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")))
    role = F.col("role")
    line = (
        F.when(role == "user", "## Query set")
        .when(role == "system", "## Notes")
        .otherwise(F.concat(F.col("turn").cast("string"), F.lit(". `"), t, F.lit("`")))
    )
    d = table(spark, sf, "conversations").select("conv_id", F.col("turn").alias("line_no"), line.alias("line"))
    return stage.read_query_list(d, ["conv_id"])


@query(
    "read_settings",
    "SELECT event_id, CAST(props->>'k' AS VARCHAR) AS k, event_type AS kind FROM events",
)
def _(spark, sf):
    k = F.get_json_object("props", "$.k")
    text = F.concat(F.lit("# Run\n- `k`: `old`\n- `kind`: `"), F.col("event_type"), F.lit("`\n  - `k`: `"), k, F.lit("`\nend"))
    d = table(spark, sf, "events").select("event_id", stage.read_settings(text).alias("s"))
    return d.select("event_id", d.s["k"].alias("k"), d.s["kind"].alias("kind"))


@query("read_venue_rules", "SELECT row_number() OVER (ORDER BY s) - 1 AS n, s AS match_value, 'journal_exact' AS match_type, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) AS norm_value FROM (SELECT DISTINCT source || ', the' AS s FROM documents)")
def _(spark, sf):
    """Sources as a rule file; a row with no value is skipped."""
    path = fresh(spark, "rules")
    s = table(spark, sf, "documents").select(F.concat(F.col("source"), F.lit(", the")).alias("match_value")).distinct()
    blank = s.select(F.lit("").alias("match_value")).distinct()
    s.unionByName(blank).orderBy(F.col("match_value") == "", "match_value").coalesce(1).select(
        F.lit("journal_exact").alias("match_type"), "match_value", F.lit("r").alias("rationale")
    ).write.options(header="true", escape='"').csv(path)
    d = stage.read_venue_rules(spark, path)
    return d.select(F.col("rule_no").alias("n"), "match_value", "match_type", "norm_value")


# Streams: the table is put down as files, taken in, and compared with the
# batch answer.
def _as_stream(spark, df):
    path = fresh(spark, "in")
    df.repartition(4).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(path)


@query(
    "stream_intake",
    o.sql(
        "SELECT paper_id, journal FROM papers WHERE paper_id NOT IN (SELECT paper_id FROM blocking) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0 AND doc_id % 2 = 1)",
        o.PAPERS,
        RULES,
        BLOCK,
    ),
)
def _(spark, sf):
    s = _as_stream(spark, papers(spark, sf).select("paper_id", "pmid", "pass_number", "journal"))
    out = fresh(spark, "intake")
    streams.run_available(streams.stream_intake(s, venue_rules(spark), label_state(spark, sf)).select("paper_id", "journal"), out, fresh(spark, "cp"))
    return spark.read.parquet(out)


@query("stream_dedupe", "SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id")
def _(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    out = fresh(spark, "dedupe")
    streams.run_available(streams.stream_dedupe(_as_stream(spark, e), ["user_id", "event_type"], "ts", "60 days"), out, fresh(spark, "cp"))
    return spark.read.parquet(out).groupBy("user_id").agg(F.count("*").alias("n"))


@query(
    "stream_progress",
    "SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def _(spark, sf):
    """Counts per hour and status as they stand, the last hours too: the first
    half of the time in one run, the second in a later one."""
    e = table(spark, sf, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    low, high = e.agg(F.min("ts"), F.max("ts")).first()
    half = F.col("ts") < F.lit(low + (high - low) / 2)
    put, mark = fresh(spark, "in"), fresh(spark, "cp")
    keys = ["window_start", "event_type"]
    held = streams.PartitionedState(spark, fresh(spark, "progress"), "window_start timestamp, event_type string, n long", keys, 8)
    for some in (half, ~half):
        e.where(some).write.mode("append").parquet(put)
        stream = spark.readStream.schema(e.schema).parquet(put)
        streams.run_counts(streams.progress_counts(stream, "ts", "event_type", delay="2 hours"), held, mark)
    return held.read()


@query(
    "stream_fold",
    o.sql(
        "SELECT paper_id, min(pass_number) AS first_seen_pass, max(pass_number) AS last_seen_pass FROM (SELECT 'pmid-' || user_id AS paper_id, CAST(week(ts) AS INTEGER) AS pass_number FROM events) GROUP BY paper_id"
    ),
)
def _(spark, sf):
    """Seen passes per paper, folded batch by batch."""
    e = table(spark, sf, "events").select(F.concat(F.lit("pmid-"), F.col("user_id").cast("string")).alias("paper_id"), F.weekofyear("ts").cast("int").alias("pass_number"))

    def step(old, rows):
        new = rows.groupBy("paper_id").agg(F.min("pass_number").alias("first_seen_pass"), F.max("pass_number").alias("last_seen_pass"))
        merged = {
            "first_seen_pass": F.least("o.first_seen_pass", "n.first_seen_pass"),
            "last_seen_pass": F.greatest("o.last_seen_pass", "n.last_seen_pass"),
        }
        return state.fold(old, new, ["paper_id"], merged)

    s = streams.PartitionedState(spark, fresh(spark, "fold"), "paper_id string, first_seen_pass int, last_seen_pass int", ["paper_id"], 8)
    arriving, mark = _as_stream(spark, e), fresh(spark, "cp")
    streams.stream_fold(arriving, s, step, mark)
    # Stopped and started with nothing new, then from a fresh checkpoint folder.
    streams.stream_fold(arriving, s, step, mark)
    streams.stream_fold(arriving, s, step, fresh(spark, "cp"))
    return s.read()


