"""Registered queries on full texts and evidence, with SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenline.operators import evidence as ev
from screenline.operators import fulltext as ft
from screenline.operators import match
from screenline.plans import oracle as o
from screenline.plans.collect_queries import log_rows
from screenline.plans.registry import Registry
from screenline.plans.text_queries import EVIDENCE_WINDOWS
from screenline.plans.views import papers, profile, table
from screenline.session import cut
from screenline.sources import markup, responses

query = Registry()
RUN = list(match.RUN_KEYS)
IDS = [*RUN, "paper_id"]


def _escaped(c):
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def article_xml(spark, sf, kind: str):
    """Documents as article payloads: sections within sections, marked words
    within paragraphs. French ones are cut off, Spanish ones have no body."""
    p = papers(spark, sf)
    lines = F.split(_escaped(F.col("abstract")), "\n")
    marked = lambda x: F.regexp_replace(x, "(?s)^([^ ]+)(.*)$", "<i>$1</i>$2")
    paras = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("<p>"), marked(x), F.lit("</p>"))), "")
    t = _escaped(F.col("title"))
    if kind == "jats":
        inner = "<sec><title>Inner <i>part</i></title><fig><p>not its own</p></fig></sec><sec><p>plain <b>bold</b>\n text<!-- x --></p><p> </p></sec>"
        body = F.concat(F.lit("<sec><title>Lines</title>"), paras, F.lit(f"{inner}<sec/></sec>"))
        head = F.concat(F.lit("<article><front><article-title><b>"), t, F.lit("</b></article-title></front>"))
        end = "</article>"
    else:
        inner = F.concat(F.lit("<div><head>Lines</head>"), paras, F.lit("</div>"))
        body = F.concat(F.lit("<div><head>Outer</head>"), inner, F.lit("</div>"))
        head = F.concat(F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><title>'), t, F.lit("</title></teiHeader>"))
        end = "</TEI>"
    xml = (
        F.when(F.col("run_id") == "fr", F.concat(head, F.lit("<body>"), body))
        .when(F.col("run_id") == "es", F.concat(head, F.lit(end)))
        .otherwise(F.concat(head, F.lit("<body>"), body, F.lit(f"</body>{end}")))
    )
    return p.select(*IDS, F.lit("given").alias("title"), xml.alias("xml"))


def _normal_sql(lead: str, tail: str, sections: int, held: str) -> str:
    return o.sql(
        f"""SELECT paper_id, error, CASE WHEN error IS NULL THEN title ELSE 'given' END AS title, CASE WHEN error IS NULL THEN md5(raw) END AS raw,
        CASE WHEN error IS NULL THEN {sections} END AS sections, CASE WHEN error IS NULL THEN md5({held}) END AS body FROM (
        SELECT *, CASE WHEN run_id = 'fr' THEN 'parse_error' WHEN run_id = 'es' THEN 'no_body' WHEN length(raw) < 1000 THEN 'body_too_short' END AS error
        FROM (SELECT paper_id, run_id, title, {o.squash(f"'{lead} ' || abstract || '{tail}'")} AS raw,
          array_to_string(list_filter(list_transform(string_split(abstract, chr(10)), lambda x: {o.squash('x')}), lambda x: x <> ''), chr(10) || chr(10)) AS body FROM papers))""",
        o.PAPERS,
    )


def _normal(kind):
    def run(spark, sf):
        d = markup.normalize_articles(article_xml(spark, sf, kind), kind=kind)
        each = F.transform("sections", lambda s: F.concat(s["title"], F.lit("|"), s["text"]))
        return d.select(
            "paper_id",
            "error",
            "title",
            F.md5("raw_text").alias("raw"),
            F.when(F.col("error").isNull(), F.size("sections")).alias("sections"),
            F.md5(F.array_join(each, "#")).alias("body"),
        )

    return run


_INNER = " Inner part not its own plain bold text"
query("normalize_jats", _normal_sql("Lines", _INNER, 3, "'Lines|' || body || '#Inner part|#|plain bold text'"))(_normal("jats"))
query("normalize_tei", _normal_sql("Outer Lines", "", 2, "'Outer|#Lines|' || body"))(_normal("tei"))


@query(
    "cached_markup_ok",
    o.sql(f"SELECT paper_id, run_id IN ('en', 'de') AND length({o.squash(chr(39) + 'Outer Lines ' + chr(39) + ' || abstract')}) >= 1000 AS ok FROM papers", o.PAPERS),
)
def _(spark, sf):
    return article_xml(spark, sf, "tei").select("paper_id", markup.cached_markup_ok(F.col("xml")).alias("ok"))


@query(
    "parse_summaries",
    o.sql(
        """SELECT pmid, title, year || ' Mar 4' AS pubdate, CAST(year AS VARCHAR) AS year, journal, 'A B;C D' AS authors, doi FROM papers""", o.PAPERS
    ),
)
def _(spark, sf):
    p = papers(spark, sf)
    item = lambda n, c: F.concat(F.lit(f'<Item Name="{n}" Type="String">'), c, F.lit("</Item>"))
    people = '<Item Name="AuthorList" Type="List"><Item Name="Author" Type="String">A B</Item><Item Name="Author" Type="String">C D</Item></Item>'
    ids = F.concat(
        F.lit('<Item Name="ArticleIds" Type="List">'), item("pubmed", F.col("pmid")), item("doi", F.col("doi")), F.lit("</Item>")
    )
    xml = F.concat(
        F.lit("<eSummaryResult><DocSum><Id>"),
        F.col("pmid"),
        F.lit("</Id>"),
        item("Title", _escaped(F.col("title"))),
        item("PubDate", F.concat(F.col("year").cast("string"), F.lit(" Mar 4"))),
        item("FullJournalName", F.col("journal")),
        F.lit(people),
        ids,
        F.lit("</DocSum></eSummaryResult>"),
    )
    d = markup.parse_summaries(p.select(xml.alias("xml")))
    return d.select(
        "pmid", "title", "pubdate", "year", "journal", F.array_join("authors", ";").alias("authors"), d["article_ids"]["doi"].alias("doi")
    )


@query(
    "parse_article_details",
    o.sql(
        """SELECT pmid, md5('AIM: ' || title || chr(10) || chr(10) || trim(abstract, ' ' || chr(10))) AS abstract,
        CASE WHEN is_review THEN 'Journal Article;Review' ELSE 'Journal Article' END AS publication_types FROM papers WHERE trim(abstract, ' ' || chr(10)) <> ''""",
        o.PAPERS,
    ),
)
def _(spark, sf):
    p = papers(spark, sf)
    kinds = F.array_join(F.transform("publication_types", lambda k: F.concat(F.lit("<PublicationType>"), k, F.lit("</PublicationType>"))), "")
    xml = F.concat(
        F.lit("<Set><PubmedArticle><MedlineCitation><PMID>"),
        F.col("pmid"),
        F.lit('</PMID><Article><Abstract><AbstractText Label="AIM"><i>'),
        _escaped(F.col("title")),
        F.lit("</i></AbstractText><AbstractText> </AbstractText><AbstractText>"),
        F.regexp_replace(_escaped(F.col("abstract")), "(?s)^([^ ]+)(.*)$", "<sup>$1</sup>$2"),
        F.lit("</AbstractText></Abstract><Abstract><AbstractText>another</AbstractText></Abstract></Article><PublicationTypeList>"),
        kinds,
        F.lit("</PublicationTypeList></MedlineCitation></PubmedArticle><PubmedArticle/></Set>"),
    )
    d = markup.parse_article_details(p.select(xml.alias("xml")))
    return d.select("pmid", F.md5("abstract").alias("abstract"), F.array_join("publication_types", ";").alias("publication_types"))


@query(
    "read_id_crosswalk",
    "SELECT CAST(user_id AS VARCHAR) AS pmid, 'PMC' || max(event_id) AS pmcid FROM events GROUP BY user_id",
)
def _(spark, sf):
    e = table(spark, sf, "events")
    rec = F.to_json(
        F.struct(
            F.array(
                F.struct(F.col("user_id").cast("string").alias("pmid"), F.concat(F.lit("PMC"), F.col("event_id")).alias("pmcid"))
            ).alias("records")
        )
    )
    return responses.read_id_crosswalk(e.select(F.col("event_id").alias("response_no"), rec.alias("json")))


@query(
    "first_open_pdf",
    """SELECT page_id, CASE WHEN contains(url, 'https') THEN url ELSE url || '/alt.pdf' END AS pdf,
    CASE WHEN contains(url, 'https') THEN url ELSE '' END AS located FROM pages""",
)
def _(spark, sf):
    p = table(spark, sf, "pages")
    oa = F.when(F.contains(F.col("url"), F.lit("https")), "OA").otherwise("S")
    link = lambda a, k, u: F.struct(a.alias("availabilityCode"), F.lit(k).alias("documentStyle"), u.alias("url"))
    alt = F.concat(F.col("url"), F.lit("/alt.pdf"))
    links = F.to_json(F.array(link(F.lit("OA"), "html", alt), link(oa, "pdf", F.col("url")), link(F.lit("OA"), "pdf", alt)))
    place = F.struct(F.contains(F.col("url"), F.lit("https")).alias("is_oa"), F.col("url").alias("pdf_url"))
    empty = F.struct(F.lit(None).cast("boolean").alias("is_oa"), F.lit("").alias("pdf_url"))
    work = F.to_json(F.struct(empty.alias("best_oa_location"), place.alias("primary_location"), F.array(empty, place).alias("locations")))
    d = p.select("page_id", links.alias("l"), work.alias("w"))
    return d.select(
        "page_id",
        responses.first_open_pdf(responses.parse_links(F.col("l"))).alias("pdf"),
        responses.first_open_location(responses.parse_work(F.col("w"))).alias("located"),
    )


_W = ", ".join(f"coalesce(bool_or(role = '{r}'), false) AS {o.LETTER[r]}" for r in o.ROLES)
_TERMS = ", ".join(
    f"coalesce(list(term ORDER BY -length(term), term) FILTER (WHERE role = '{r}'), []) AS t{o.LETTER[r]}" for r in o.ROLES
)
READING = f"""ewtok AS (SELECT DISTINCT paper_id, window_no, unnest(regexp_extract_all(w, '[a-z0-9+/-]+')) AS term FROM ewin),
ewhit AS (SELECT paper_id, window_no, role, term FROM ewtok JOIN prof USING (term)),
ewf AS (SELECT paper_id, window_no, {_W}, {_TERMS} FROM ewhit GROUP BY ALL),
tl AS (SELECT paper_id, {_TERMS} FROM hit GROUP BY paper_id),
esum AS (
  SELECT paper_id, min(window_no) FILTER (WHERE p AND m AND (o OR e)) AS first_no,
    count(*) FILTER (WHERE p AND (m OR o OR e)) AS supporting, bool_or(window_no = 1 AND p) AS tp_, bool_or(window_no = 1 AND (m OR o OR e)) AS tany
  FROM ewf GROUP BY paper_id),
reading AS (
  SELECT q.run_id, q.pass_number, q.paper_id, q.doc_id, d.* EXCLUDE (paper_id), tl.* EXCLUDE (paper_id), s.first_no,
    CASE WHEN s.first_no IS NOT NULL THEN 'direct'
      WHEN d.p AND d.m AND (d.o OR d.e) AND ((s.tp_ AND s.tany) OR s.supporting >= 2 OR (s.tp_ AND d.c AND (d.m OR d.o))) THEN 'distributed'
      WHEN d.p AND d.m AND d.o AND d.r THEN 'review_frame' WHEN d.x THEN 'exclusion' WHEN d.p OR (d.m AND d.c) THEN 'partial' ELSE 'weak' END AS branch
  FROM papers q JOIN docf d USING (paper_id) LEFT JOIN tl USING (paper_id) LEFT JOIN esum s USING (paper_id)),
outcome({", ".join(("branch",) + ev.OUTCOME_FIELDS)}) AS ({o.values([(b, *v) for b, v in ev.OUTCOMES.items()])}),
review AS (SELECT r.*, x.* EXCLUDE (branch) FROM reading r JOIN outcome x USING (branch))"""

READ = (o.PAPERS, o.PROF, o.MATCH, EVIDENCE_WINDOWS, READING)


def texts(spark, sf):
    return papers(spark, sf).select(*IDS, "pmid", "doi", "title", F.col("abstract").alias("raw_text"))


def reviewed(spark, sf):
    return ev.review_fulltext(texts(spark, sf), profile(spark))


_LOC = """CASE r.branch WHEN 'direct' THEN f.locator || ': matched ' || array_to_string(list_concat(list_concat(w.tp, w.tm), list_concat(w.t_o, w.te))[1:8], ';')
  WHEN 'distributed' THEN 'document: ' || array_to_string(list_concat(list_concat(r.tp, r.tm), list_concat(r.t_o, r.tc))[1:10], ';')
  WHEN 'review_frame' THEN 'review frame: ' || array_to_string(list_concat(list_concat(r.tp, r.tm), list_concat(r.t_o, r.tr))[1:8], ';')
  WHEN 'exclusion' THEN 'exclusion: ' || array_to_string(r.tx[1:6], ';')
  WHEN 'partial' THEN 'matched: ' || array_to_string(list_concat(list_concat(r.tp, r.tm), r.tc)[1:8], ';') ELSE 'weak overlap' END"""
# "to" is a keyword.
READING = READING.replace(" AS to,", " AS t_o,")
READ = READ[:-1] + (READING,)


@query(
    "review_fulltext",
    o.sql(
        f"""SELECT r.paper_id, {", ".join("r." + f for f in ev.OUTCOME_FIELDS)}, r.branch AS fulltext_rationale, {_LOC} AS supporting_text_locator
        FROM review r LEFT JOIN ewin f ON f.paper_id = r.paper_id AND f.window_no = r.first_no
        LEFT JOIN ewf w ON w.paper_id = r.paper_id AND w.window_no = r.first_no""",
        *READ,
    ),
)
def _(spark, sf):
    return reviewed(spark, sf).select("paper_id", *ev.OUTCOME_FIELDS, "fulltext_rationale", "supporting_text_locator")


def _first4(t: str) -> str:
    return f"CASE WHEN coalesce(len({t}), 0) = 0 THEN 'none' ELSE array_to_string({t}[1:4], '; ') END"


@query(
    "extract_evidence",
    o.sql(
        f"""SELECT paper_id, evidence_tier, retention_role, CASE WHEN fulltext_decision = 'keep' THEN 'retain' WHEN branch = 'partial' THEN 'calibrate_reviewer'
          ELSE 'demote_or_exclude' END AS topic_learning_signal,
        'primary=' || {_first4('tp')} || '; mechanism=' || {_first4('tm')} || '; outcome=' || {_first4('t_o')} || '; comparator=' || {_first4('tc')} ||
          CASE WHEN branch IN ('exclusion', 'weak') THEN '; exclusion=' || {_first4('tx')} ELSE '' END AS scientific_note FROM review""",
        *READ,
    ),
)
def _(spark, sf):
    d = ev.extract_evidence(reviewed(spark, sf))
    return d.select("paper_id", "evidence_tier", "retention_role", "topic_learning_signal", "scientific_note")


def said_reviews(spark, sf):
    """Readings decided by people: low quality is a drop."""
    lab = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("pmid"), "quality")
    p = papers(spark, sf).join(lab, "pmid")
    return p.select(
        *IDS,
        F.when(F.col("quality") == 1, "keep").otherwise("drop").alias("fulltext_decision"),
        F.lit("said").alias("fulltext_rationale"),
        F.lit("low").alias("mechanistic_relevance"),
        F.lit("low").alias("objective_relevance"),
        F.lit("incidental").alias("topic_centrality"),
        F.lit("low").alias("review_confidence"),
    )


RESCUED = "low AS (SELECT doc_id FROM labels WHERE quality = 0), rescued AS (SELECT * FROM review JOIN low USING (doc_id))"


@query(
    "rescue_fulltext",
    o.sql(
        """SELECT paper_id, CASE WHEN fulltext_decision = 'keep' THEN 'overturn_to_keep' ELSE 'confirm_drop' END AS rescue_decision,
        fulltext_decision AS final_fulltext_decision, branch AS rescue_rationale, fulltext_decision = 'keep' AS positive_signal_found,
        fulltext_decision = 'keep' AND x AS negative_signal_overridden FROM rescued""",
        *READ,
        RESCUED,
    ),
)
def _(spark, sf):
    d = ev.rescue_fulltext(said_reviews(spark, sf), texts(spark, sf), profile(spark))
    return d.select(
        "paper_id", "rescue_decision", "final_fulltext_decision", "rescue_rationale", "positive_signal_found", "negative_signal_overridden"
    )


@query(
    "apply_rescue",
    o.sql(
        """SELECT 'pmid-' || doc_id AS paper_id, CASE WHEN quality = 1 THEN 'keep' ELSE coalesce(r.fulltext_decision, 'drop') END AS fulltext_decision,
        CASE WHEN quality = 0 AND r.fulltext_decision = 'keep' THEN r.mechanistic_relevance ELSE 'low' END AS mechanistic_relevance
        FROM labels LEFT JOIN rescued r USING (doc_id)""",
        *READ,
        RESCUED,
    ),
)
def _(spark, sf):
    said = said_reviews(spark, sf)
    d = ev.apply_rescue(said, ev.rescue_fulltext(said, texts(spark, sf), profile(spark)))
    return d.select("paper_id", "fulltext_decision", "mechanistic_relevance")


LEARNED = """lhit AS (SELECT run_id, pass_number, paper_id, role, term, fulltext_decision = 'keep' AS k FROM hit JOIN review USING (paper_id) WHERE role <> 'claim'),
learned AS (SELECT run_id, pass_number, bucket, term, count(DISTINCT paper_id) AS papers FROM (
  SELECT *, CASE WHEN NOT k THEN 'noise' WHEN role IN ('primary', 'mechanism') THEN 'direct' WHEN role IN ('comparator', 'review_frame') THEN 'supporting' END AS bucket FROM lhit)
  WHERE bucket IS NOT NULL GROUP BY ALL)"""


def reading(spark, sf):
    """Decision and matched terms per paper, as a stored stage table: the texts
    are read once for all that is learned from them."""
    r = ev.review_fulltext(texts(spark, sf), profile(spark), keep_terms=True)
    return cut(r.select(*IDS, "fulltext_decision", *[f"terms_{x}" for x in match.SCOPE_ROLES]))


def learned(read):
    return ev.learn_terms(ev.reading_pairs(read), read)


@query("learn_terms", o.sql("SELECT * FROM learned", *READ, LEARNED))
def _(spark, sf):
    return learned(reading(spark, sf))


def feedback(spark, sf):
    read = reading(spark, sf)
    return ev.feedback(learned(read), read, profile(spark))


_RANKED = """runs AS (SELECT run_id, pass_number, count(*) AS n FROM review GROUP BY ALL),
spare(bucket, role) AS (VALUES ('direct', 'primary'), ('direct', 'mechanism'), ('supporting', 'comparator'), ('supporting', 'review_frame'), ('noise', 'exclusion'), ('missing', 'mechanism')),
fill AS (SELECT run_id, pass_number, bucket, list(term ORDER BY -length(term), term) AS l FROM runs, spare JOIN prof USING (role) GROUP BY ALL),
got AS (SELECT run_id, pass_number, bucket, list(term ORDER BY papers DESC, term) AS l FROM learned GROUP BY ALL),
best AS (SELECT run_id, pass_number, f.bucket, array_to_string(coalesce(g.l, f.l)[1:CASE WHEN f.bucket IN ('direct', 'supporting') THEN 12 ELSE 10 END], '; ') AS s
  FROM fill f LEFT JOIN got g USING (run_id, pass_number, bucket))"""


@query(
    "feedback",
    o.sql(
        """SELECT run_id, pass_number, 'loop_00' || pass_number AS loop_id, any_value(n) AS source_paper_count,
        max(s) FILTER (WHERE bucket = 'direct') AS direct_mechanisms, max(s) FILTER (WHERE bucket = 'supporting') AS supporting_mechanisms,
        max(s) FILTER (WHERE bucket = 'noise') AS noise_keyword_families, max(s) FILTER (WHERE bucket = 'missing') AS missing_keyword_families,
        CASE WHEN pass_number >= 2 THEN 'final_pdf_pass' ELSE 'defer_pdfs' END AS pdf_deferral_decision
        FROM best JOIN runs USING (run_id, pass_number) GROUP BY run_id, pass_number""",
        *READ,
        LEARNED,
        _RANKED,
    ),
)
def _(spark, sf):
    return feedback(spark, sf).select(
        *RUN,
        "loop_id",
        "source_paper_count",
        "direct_mechanisms",
        "supporting_mechanisms",
        "noise_keyword_families",
        "missing_keyword_families",
        "pdf_deferral_decision",
    )


# Import rows over passes: a row per kind, week and user of the event log.
def log_imports(spark, sf):
    e = log_rows(spark, sf)
    last = e.groupBy(*IDS).agg(F.max("event_id").alias("e"), F.max("value").alias("v"))
    return last.select(
        *IDS,
        F.concat(F.lit("PMC"), F.col("e").cast("string")).alias("pmcid"),
        F.lit("ncbi_pmc_xml").alias("fulltext_access_route"),
        F.lit("").alias("fulltext_xml_url"),
        F.lit("").alias("fulltext_pdf_url"),
        F.when(F.col("v") > 20, "available").otherwise("missing").alias("pmc_access_status"),
        F.when(F.col("v") > 60, "usable").otherwise("unusable").alias("pmc_parse_status"),
        F.concat(F.lit("texts/"), F.col("e").cast("string")).alias("normalized_path"),
    )


@query(
    "prior_usable",
    """WITH i AS (SELECT event_type AS run_id, user_id, CAST(week(ts) AS INTEGER) AS pass_number, 'pmid-' || user_id AS paper_id, max(event_id) AS e, max(value) AS v FROM events GROUP BY ALL),
    said AS (SELECT run_id, paper_id, min(pass_number) + 1 AS read_pass FROM i WHERE user_id % 7 = 0 GROUP BY ALL),
    a AS (SELECT * FROM (SELECT DISTINCT run_id, pass_number FROM i) JOIN (SELECT DISTINCT run_id, paper_id FROM i) USING (run_id)),
    p AS (SELECT a.run_id, a.pass_number, a.paper_id, arg_max(b.e, b.pass_number) AS e, any_value(s.read_pass) AS read_pass
      FROM a LEFT JOIN i b ON b.run_id = a.run_id AND b.paper_id = a.paper_id AND b.pass_number < a.pass_number AND b.v > 60
      LEFT JOIN said s ON s.run_id = a.run_id AND s.paper_id = a.paper_id AND s.read_pass < a.pass_number GROUP BY ALL)
    SELECT run_id, pass_number, paper_id, CASE WHEN read_pass IS NULL THEN 'PMC' || e ELSE 'PMC-read' END AS pmcid,
      CASE WHEN read_pass IS NULL THEN 'texts/' || e ELSE 'read/' || paper_id END AS path FROM p WHERE e IS NOT NULL OR read_pass IS NOT NULL""",
)
def _(spark, sf):
    """Every paper of a run in every pass of it, imported in that pass or not."""
    imports = log_imports(spark, sf)
    every = imports.select("run_id", "pass_number").distinct().join(imports.select("run_id", "paper_id").distinct(), "run_id")
    seen = imports.where("cast(substring(paper_id, 6) as long) % 7 = 0").groupBy("run_id", "paper_id")
    said = seen.agg((F.min("pass_number") + 1).alias("last_read_pass")).select(
        "*", F.lit("PMC-read").alias("pmcid"), F.concat(F.lit("read/"), "paper_id").alias("normalized_path")
    )
    d = ft.prior_usable(every, imports, said)
    return d.select(*IDS, "prior.pmcid", F.col("prior.normalized_path").alias("path"))


@query(
    "usable_import",
    """SELECT event_type AS run_id, CAST(week(ts) AS INTEGER) AS pass_number, 'pmid-' || user_id AS paper_id FROM events GROUP BY ALL HAVING max(value) > 60""",
)
def _(spark, sf):
    return log_imports(spark, sf).where(ft.usable_import()).select(*IDS)


SETTINGS = {
    "en": {"access_phase": "final_access"},
    "de": {"fulltext_lookup_mode": "exhaustive_oa"},
    "fr": {"fulltext_lookup_mode": "pmc_only", "access_phase": "final_access"},
    "es": {"access_phase": "pmc_learning"},
}


def settings(spark, sf):
    """Settings of the runs the documents belong to."""
    maps = F.create_map(
        *[
            x
            for lang, kv in SETTINGS.items()
            for x in (F.lit(lang), F.create_map(*[F.lit(y) for pair in kv.items() for y in pair]).cast("map<string,string>"))
        ]
    )
    runs = papers(spark, sf).select(*RUN).distinct()
    return runs.withColumn("settings", F.element_at(maps, F.col("run_id")))


@query(
    "use_alternate_lookup",
    "SELECT DISTINCT lang AS run_id, CAST(1 + doc_id % 2 AS INTEGER) AS pass_number, lang IN ('en', 'de') AS alternate FROM documents",
)
def _(spark, sf):
    return settings(spark, sf).select(*RUN, ft.use_alternate_lookup(F.col("settings")).alias("alternate"))


def routed(spark, sf):
    p = papers(spark, sf)
    lab = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("pmid"), "quality", "toxic")
    n = F.length("abstract")
    selected = p.select(
        *IDS, "pmid", "doi", "title", F.when(n >= 500, "advance_to_import").otherwise("stop").alias("promotion_decision")
    )
    crosswalk = lab.where("quality = 1").select("pmid", F.concat(F.lit("PMC"), F.col("pmid")).alias("pmcid"))
    s = F.col("journal")
    url = lambda lead: F.concat(F.lit(lead), F.col("pmid"))
    lookups = p.select(
        "pmid",
        F.when(s.isin("src2", "src4"), url("PMCA")).alias("alt_pmcid"),
        F.when(s == "src2", url("x/")).alias("alt_xml_url"),
        F.when(s.isin("src4", "src5"), url("p/")).alias("alt_pdf_url"),
        F.when(s == "src6", url("o/")).alias("oa_pdf_url"),
    )
    t = F.lit("").alias
    prior = p.join(lab.where("toxic = 1"), "pmid").select(
        *IDS,
        F.struct(
            F.lit("PMCX").alias("pmcid"),
            F.lit(None).cast("string").alias("fulltext_access_route"),
            t("fulltext_xml_url"),
            t("fulltext_pdf_url"),
            F.concat(F.lit("texts/"), F.col("pmid")).alias("normalized_path"),
        ).alias("prior"),
    )
    return ft.route_imports(selected, crosswalk, lookups, prior, settings(spark, sf))


ROUTED = """rbase AS (SELECT p.*, l.quality, l.toxic, coalesce(l.toxic = 1, false) AS reused, coalesce(l.quality = 1, false) AS cross_,
    p.run_id IN ('en', 'de') AS alt FROM papers p LEFT JOIN labels l USING (doc_id) WHERE length(abstract) >= 500),
rroute AS (SELECT *, alt AND NOT reused AND NOT cross_ AS asked, CASE WHEN reused OR cross_ THEN 'ncbi_pmc_xml' WHEN alt AND journal = 'src2' THEN 'europe_pmc_xml'
    WHEN alt AND journal IN ('src4', 'src5', 'src6') THEN 'oa_pdf' ELSE 'none' END AS route FROM rbase),
routed AS (SELECT run_id, pass_number, paper_id, pmid, route AS fulltext_access_route,
    CASE WHEN reused THEN 'PMCX' WHEN cross_ THEN 'PMC' || pmid WHEN asked AND journal IN ('src2', 'src4') THEN 'PMCA' || pmid ELSE '' END AS pmcid,
    CASE WHEN asked AND journal = 'src2' THEN 'x/' || pmid ELSE '' END AS fulltext_xml_url,
    CASE WHEN reused THEN '' WHEN asked AND journal IN ('src4', 'src5') THEN 'p/' || pmid WHEN asked AND journal = 'src6' THEN 'o/' || pmid ELSE '' END AS fulltext_pdf_url,
    CASE WHEN route IN ('ncbi_pmc_xml', 'europe_pmc_xml') THEN 'available' ELSE 'missing' END AS pmc_access_status,
    CASE WHEN reused THEN 'usable' ELSE 'not_attempted' END AS pmc_parse_status, route NOT IN ('ncbi_pmc_xml', 'europe_pmc_xml') AS pdf_needed,
    CASE WHEN route = 'none' THEN 'missing' ELSE 'not_attempted' END AS pdf_import_status, CASE WHEN reused THEN 'texts/' || pmid ELSE '' END AS normalized_path,
    CASE WHEN reused THEN 'reused_prior_text' WHEN cross_ THEN 'id_crosswalk' WHEN route = 'europe_pmc_xml' THEN 'alternate_pmcid'
      WHEN asked AND journal IN ('src4', 'src5') THEN 'alternate_pdf' WHEN asked AND journal = 'src6' THEN 'open_location_pdf' WHEN asked THEN 'no_source' ELSE 'lookup_deferred' END AS notes
    FROM rroute)"""
IMPORT_SHOWN = (
    "paper_id",
    "pmcid",
    "fulltext_access_route",
    "fulltext_xml_url",
    "fulltext_pdf_url",
    "pmc_access_status",
    "pmc_parse_status",
    "pdf_needed",
    "pdf_import_status",
    "normalized_path",
    "notes",
)


@query("route_imports", o.sql(f"SELECT {', '.join(IMPORT_SHOWN)} FROM routed", o.PAPERS, ROUTED))
def _(spark, sf):
    return routed(spark, sf).select(*IMPORT_SHOWN)


@query(
    "manual_queue",
    o.sql(
        """SELECT paper_id, CASE WHEN fulltext_access_route = 'oa_pdf' THEN 'open_pdf_without_xml' ELSE 'no_automated_source' END AS queue_reason,
        CASE WHEN fulltext_access_route = 'oa_pdf' THEN 'open_access_pdf' ELSE 'publisher_pdf_or_user_download' END AS preferred_source FROM routed WHERE pdf_needed""",
        o.PAPERS,
        ROUTED,
    ),
)
def _(spark, sf):
    return ft.manual_queue(routed(spark, sf)).select("paper_id", "queue_reason", "preferred_source")


def fetched(spark, sf):
    """What came back: articles for papers of the first ten sources, short
    ones unusable; files for every link, German ones are not PDF."""
    p = papers(spark, sf)
    late = F.regexp_extract("journal", "([0-9]+)$", 1).cast("int") >= 10
    err = F.when(F.length("abstract") < 1000, "body_too_short")
    a = p.where(~late).select(F.explode(F.array(*[F.concat(F.lit(x), F.col("pmid")) for x in ("PMC", "PMCA")])).alias("pmcid"), err.alias("error"))
    body = F.when(F.col("run_id") == "de", F.lit(b"<html>")).otherwise(F.lit(b"\n%PDF-1.7 ..."))
    f = p.select(F.explode(F.array(*[F.concat(F.lit(x), F.col("pmid")) for x in ("p/", "o/")])).alias("fulltext_pdf_url"), body.alias("content"))
    return a, f


OUTCOME = """got AS (SELECT r.*, CAST(regexp_extract(p.journal, '([0-9]+)$', 1) AS INTEGER) < 10 AS have, length(p.abstract) < 1000 AS short_, p.run_id <> 'de' AS good
    FROM routed r JOIN papers p USING (paper_id)),
cased AS (SELECT *, fulltext_access_route IN ('ncbi_pmc_xml', 'europe_pmc_xml') AND normalized_path = '' AS byxml, CASE WHEN normalized_path <> '' THEN 'present'
    WHEN fulltext_access_route IN ('ncbi_pmc_xml', 'europe_pmc_xml') AND have AND NOT short_ THEN 'xml_usable'
    WHEN fulltext_access_route IN ('ncbi_pmc_xml', 'europe_pmc_xml') AND fulltext_pdf_url = '' THEN CASE WHEN have THEN 'xml_unusable' ELSE 'xml_missing' END
    WHEN fulltext_pdf_url <> '' AND good THEN 'pdf_imported' WHEN fulltext_pdf_url <> '' THEN 'pdf_failed' ELSE 'no_route' END AS c FROM got)"""


@query(
    "import_outcome",
    o.sql(
        """SELECT paper_id, CASE WHEN c LIKE 'pdf%' THEN 'oa_pdf' ELSE fulltext_access_route END AS fulltext_access_route,
        CASE WHEN c IN ('present', 'xml_usable') THEN 'available' ELSE 'missing' END AS pmc_access_status,
        CASE WHEN c IN ('present', 'xml_usable') THEN 'usable' WHEN c LIKE 'xml%' THEN 'unusable' WHEN c = 'pdf_failed' THEN CASE WHEN byxml THEN 'unusable' ELSE pmc_parse_status END ELSE 'not_attempted' END AS pmc_parse_status,
        c NOT IN ('present', 'xml_usable') AS pdf_needed, CASE WHEN c IN ('present', 'xml_usable') THEN 'not_attempted' WHEN c = 'pdf_imported' THEN 'imported' ELSE 'missing' END AS pdf_import_status,
        CASE c WHEN 'present' THEN normalized_path WHEN 'xml_usable' THEN 'PMC_XML/normalized/' || pmcid || '.json' ELSE '' END AS normalized_path,
        notes || ' ' || c AS notes, CASE WHEN c NOT IN ('present', 'xml_usable') THEN c END AS queue_reason FROM cased""",
        o.PAPERS,
        ROUTED,
        OUTCOME,
    ),
)
def _(spark, sf):
    d = ft.import_outcome(routed(spark, sf), *fetched(spark, sf))
    return d.select(
        "paper_id",
        "fulltext_access_route",
        "pmc_access_status",
        "pmc_parse_status",
        "pdf_needed",
        "pdf_import_status",
        "normalized_path",
        "notes",
        "queue_reason",
    )


@query(
    "import_queue",
    o.sql(
        """SELECT paper_id, c AS queue_reason, CASE WHEN c = 'pdf_imported' THEN 'open_access_pdf' ELSE 'publisher_pdf_or_user_download' END AS preferred_source
        FROM cased WHERE c NOT IN ('present', 'xml_usable')""",
        o.PAPERS,
        ROUTED,
        OUTCOME,
    ),
)
def _(spark, sf):
    d = ft.import_queue(ft.import_outcome(routed(spark, sf), *fetched(spark, sf)))
    return d.select("paper_id", "queue_reason", "preferred_source")


@query(
    "prepare_review",
    o.sql(
        """SELECT paper_id, CASE WHEN c = 'present' THEN 'missing' ELSE 'pmc_xml' END AS normalized_source_type FROM cased WHERE c IN ('present', 'xml_usable')""",
        o.PAPERS,
        ROUTED,
        OUTCOME,
    ),
)
def _(spark, sf):
    d = ft.prepare_review(ft.import_outcome(routed(spark, sf), *fetched(spark, sf)))
    return d.select("paper_id", "normalized_source_type")


def file_imports(spark, sf):
    """Imports waiting for a parsed file, from the event log."""
    kind = F.col("event_type")
    e = table(spark, sf, "events")
    imports = e.select(
        kind.alias("run_id"),
        F.lit(1).alias("pass_number"),
        F.concat(F.lit("pmid-"), F.col("event_id").cast("string")).alias("paper_id"),
        F.when(kind != "view", F.col("event_id").cast("string")).alias("pmid"),
        F.lit("").alias("doi"),
        F.lit("").alias("title"),
        F.when(kind == "signup", "oa_pdf").otherwise("none").alias("fulltext_access_route"),
        F.lit("missing").alias("pmc_access_status"),
        F.lit("not_attempted").alias("pmc_parse_status"),
        F.lit(True).alias("pdf_needed"),
        F.when(kind == "error", "staged_from_user_download").when(kind == "purchase", "missing").otherwise("imported").alias("pdf_import_status"),
        F.lit("").alias("normalized_path"),
        F.lit("n").alias("notes"),
    )
    v = F.col("value")
    name = F.when(kind == "view", F.concat(F.lit("pmid-"), F.col("event_id"), F.lit(".pdf"))).otherwise(F.concat(F.lit("PMID "), F.col("event_id"), F.lit(".pdf")))
    files = e.where(v > 20).select(name.alias("name"))
    parsed = e.where(v > 40).select(
        F.concat(F.lit("pmid-"), F.col("event_id").cast("string")).alias("paper_id"), F.when(v < 80, "body_too_short").alias("error")
    )
    return imports, files, parsed


PARSED = """pin AS (SELECT 'pmid-' || event_id AS paper_id, event_type AS kind, CASE WHEN event_type = 'purchase' THEN NULL WHEN value <= 20 THEN 'missing_pdf'
  WHEN value <= 40 THEN 'parser_pending' WHEN value >= 80 THEN 'normalized' ELSE 'parse_failed' END AS s FROM events)"""


@query(
    "parse_outcome",
    o.sql(
        """SELECT paper_id, s AS parse_status, CASE WHEN s IS NULL OR s = 'missing_pdf' THEN 'missing' ELSE s END AS pdf_import_status,
        s IS NULL OR s <> 'normalized' AS pdf_needed, CASE WHEN kind = 'signup' AND s = 'normalized' THEN 'usable' WHEN kind = 'signup' AND s = 'parse_failed' THEN 'unusable' ELSE 'not_attempted' END AS pmc_parse_status,
        CASE WHEN s = 'normalized' THEN 'PDF/normalized/' || paper_id || '.json' ELSE '' END AS normalized_path,
        CASE WHEN s = 'parse_failed' THEN 'n body_too_short' WHEN s IN ('normalized') THEN 'n' WHEN s = 'parser_pending' THEN 'n parser_pending' ELSE 'n' END AS notes FROM pin""".replace(
            "WHEN s IN ('normalized') THEN 'n'", "WHEN s = 'normalized' THEN 'n normalized'"
        ),
        PARSED,
    ),
)
def _(spark, sf):
    d = ft.parse_outcome(*file_imports(spark, sf), F.lit(True))
    return d.select("paper_id", "parse_status", "pdf_import_status", "pdf_needed", "pmc_parse_status", "normalized_path", "notes")


@query("parse_report", o.sql("SELECT paper_id, s AS parse_status FROM pin WHERE s IS NOT NULL AND kind <> 'error'", PARSED))
def _(spark, sf):
    d = ft.parse_report(ft.parse_outcome(*file_imports(spark, sf), F.lit(False)))
    return d.select("paper_id", "parse_status")
