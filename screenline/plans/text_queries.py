"""Registered queries on text and field functions, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenline.functions import fields as fl
from screenline.functions import text as tx
from screenline.operators.ranking import heading_fill
from screenline.plans.oracle import MATCH, PAPERS, PROF, sentences, sql, squash
from screenline.plans.registry import Registry
from screenline.plans.views import papers, table
from screenline.session import spread

STOP = ("the", "and", "that", "was", "with", "les", "des", "und", "der", "que", "del")
_STOP = "(" + ", ".join(f"'{s}'" for s in STOP) + ")"

query = Registry()


def docs(spark, sf):
    return spread(table(spark, sf, "documents"))


@query(
    "norm_venue",
    r"SELECT page_id, trim(regexp_replace(lower(url), '[^a-z0-9]+', ' ', 'g')) AS venue FROM pages",
)
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.norm_venue(F.col("url")).alias("venue"))


@query("squash", f"SELECT doc_id, md5({squash('text')}) AS squashed, length({squash('text')}) AS n FROM documents")
def _(spark, sf):
    s = tx.squash(F.col("text"))
    return docs(spark, sf).select("doc_id", F.md5(s).alias("squashed"), F.length(s).cast("long").alias("n"))


@query(
    "squash_all",
    f"SELECT doc_id, md5({squash('text')}) AS text, {squash('lang')} AS lang, {squash('source')} AS source FROM documents",
)
def _(spark, sf):
    """Every string column of a table at once; the text is shown as its hash."""
    d = tx.squash_all(table(spark, sf, "documents").select("doc_id", "text", "lang", "source"))
    return d.withColumn("text", F.md5("text"))


@query("compact_key", "SELECT page_id, regexp_replace(lower(url), '[^a-z0-9]', '', 'g') AS key FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.compact_key(F.col("url")).alias("key"))


def _token_sql(pattern: str) -> str:
    found = f"list_filter(regexp_extract_all(lower(text), '{pattern}'), lambda x: x NOT IN {_STOP})"
    return f"SELECT doc_id, len({found}) AS n, md5(array_to_string({found}, ' ')) AS toks FROM documents"


def _tokens(pattern):
    def run(spark, sf):
        t = tx.tokens(F.col("text"), STOP, pattern)
        return docs(spark, sf).select("doc_id", t.alias("t")).select(
            "doc_id", F.size("t").cast("long").alias("n"), F.md5(F.array_join("t", " ")).alias("toks")
        )

    return run


query("tokens_triage", _token_sql(tx.TRIAGE_TOKEN))(_tokens(tx.TRIAGE_TOKEN))
query("tokens_prescreen", _token_sql(tx.PRESCREEN_TOKEN))(_tokens(tx.PRESCREEN_TOKEN))


@query(
    "token_set",
    f"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(lower(text),
    '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: length(x) > 2 AND x NOT IN {_STOP}))), ' ') AS words FROM documents""",
)
def _(spark, sf):
    w = F.array_sort(tx.token_set(F.col("text"), STOP))
    return docs(spark, sf).select("doc_id", F.array_join(w, " ").alias("words"))


@query(
    "declared_terms",
    rf"""WITH part AS (SELECT item_id, unnest(regexp_split_to_array(text, '[,;\n|]+')) AS part FROM benchmark),
    norm AS (SELECT item_id, part, list_filter(string_split(regexp_replace(lower(part), '[^a-z0-9+/-]+', ' ', 'g'), ' '),
      lambda x: x <> '' AND x NOT IN {_STOP}) AS ws FROM part),
    terms AS (SELECT item_id, array_to_string(ws, ' ') AS term FROM norm WHERE len(ws) > 0
      UNION SELECT item_id, lower(a) FROM (SELECT item_id, unnest(regexp_extract_all(part, '[A-Za-z][A-Za-z0-9+/-]+')) AS a
        FROM norm WHERE len(ws) > 1) WHERE regexp_matches(a, '[A-Z]{{2,}}|[0-9]|[-+/]') AND lower(a) NOT IN {_STOP})
    SELECT DISTINCT item_id, term FROM terms""",
)
def _(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", F.explode(tx.declared_terms(F.col("text"), STOP)).alias("term"))


@query(
    "feedback_phrases",
    rf"""WITH part AS (SELECT item_id, generate_subscripts(l, 1) AS i, unnest(l) AS part FROM
      (SELECT item_id, regexp_split_to_array(replace(text, ',', ';'), '[;\n|]+') AS l FROM benchmark)),
    cleaned AS (SELECT item_id, i, lower(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(part, '\([^)]*\)', ' ', 'g'),
      '[^A-Za-z0-9:/+_. -]+', ' ', 'g'), '\s+', ' ', 'g')), '^[ .,:;-]+|[ .,:;-]+$', '', 'g')) AS phrase FROM part),
    firsts AS (SELECT item_id, phrase, min(i) AS i FROM cleaned WHERE length(phrase) >= 3 AND phrase NOT IN {_STOP} GROUP BY ALL)
    SELECT item_id, phrase, row_number() OVER (PARTITION BY item_id ORDER BY i) AS place FROM firsts""",
)
def _(spark, sf):
    p = tx.feedback_phrases(F.replace(F.col("text"), F.lit(","), F.lit(";")), STOP)
    d = table(spark, sf, "benchmark").select("item_id", F.posexplode(p).alias("place", "phrase"))
    return d.withColumn("place", (F.col("place") + 1).cast("long"))


_DOI_SQL = """CASE lang WHEN 'en' THEN 'https://doi.org/' WHEN 'de' THEN ' doi:' WHEN 'fr' THEN 'http://doi.org/' ELSE '' END"""
_DOI_PREFIX = {"en": "https://doi.org/", "de": " doi:", "fr": "http://doi.org/"}


def _doi_column():
    pre = F.when(F.col("run_id") == "en", _DOI_PREFIX["en"])
    for lang in ("de", "fr"):
        pre = pre.when(F.col("run_id") == lang, _DOI_PREFIX[lang])
    return F.concat(pre.otherwise(""), F.col("doi"))


@query(
    "norm_doi",
    f"""WITH {PAPERS}, d AS (SELECT paper_id, {_DOI_SQL.replace('lang', 'run_id')} || doi AS raw FROM papers)
    SELECT paper_id, raw, regexp_replace(regexp_replace(regexp_replace(trim(raw), '^https://doi\\.org/', ''),
      '^http://doi\\.org/', ''), '^doi:', '') AS doi FROM d""",
)
def _(spark, sf):
    d = papers(spark, sf).select("paper_id", _doi_column().alias("raw"))
    return d.select("paper_id", "raw", fl.norm_doi(F.col("raw")).alias("doi"))


@query(
    "doi_keys",
    rf"""WITH {PAPERS}, s AS (SELECT paper_id, doi, regexp_replace(doi, '^[^/]*/', '') AS suf FROM papers),
    k AS (SELECT paper_id, regexp_replace(lower(doi), '[^a-z0-9]', '', 'g') AS key FROM s
      UNION SELECT paper_id, regexp_replace(lower(suf), '[^a-z0-9]', '', 'g') FROM s
      UNION SELECT paper_id, lower(t) FROM (SELECT paper_id, unnest(regexp_split_to_array(suf, '[^A-Za-z0-9]+')) AS t FROM s) WHERE length(t) >= 5
      UNION SELECT paper_id, regexp_replace(suf, '[^0-9]', '', 'g') FROM s WHERE length(regexp_replace(suf, '[^0-9]', '', 'g')) >= 5)
    SELECT paper_id, key FROM k WHERE key <> ''""",
)
def _(spark, sf):
    return papers(spark, sf).select("paper_id", F.explode(fl.doi_keys(F.col("doi"))).alias("key"))


@query(
    "year_of",
    r"""WITH d AS (SELECT event_id, CASE event_type WHEN 'click' THEN strftime(ts, '%Y/%m/%d') WHEN 'view' THEN strftime(ts, '%Y-%m')
      WHEN 'purchase' THEN strftime(ts, '%d %b %Y') WHEN 'signup' THEN strftime(ts, '%Y%m%d') ELSE 'Spring' END AS pubdate FROM events)
    SELECT event_id, pubdate, coalesce(list_filter(regexp_split_to_array(regexp_replace(pubdate, '[/-]', ' ', 'g'), '\s+'),
      lambda x: regexp_full_match(x, '[0-9]{4}'))[1], '') AS year FROM d""",
)
def _(spark, sf):
    ts, kind = F.col("ts"), F.col("event_type")
    d = (
        F.when(kind == "click", F.date_format(ts, "yyyy/MM/dd"))
        .when(kind == "view", F.date_format(ts, "yyyy-MM"))
        .when(kind == "purchase", F.date_format(ts, "dd MMM yyyy"))
        .when(kind == "signup", F.date_format(ts, "yyyyMMdd"))
        .otherwise("Spring")
    )
    e = table(spark, sf, "events").select("event_id", d.alias("pubdate"))
    return e.withColumn("year", fl.year_of(F.col("pubdate")))


@query(
    "record_fields",
    f"""WITH {PAPERS} SELECT paper_id, 'records/pass_' || lpad(CAST(pass_number AS VARCHAR), 3, '0') || '/' || paper_id AS record_path,
    'https://pubmed.ncbi.nlm.nih.gov/' || pmid || '/' AS link_record, 'https://doi.org/' || doi AS link_publisher,
    CASE WHEN run_id = 'es' THEN paper_id || '.pdf' ELSE 'PMID ' || pmid || '.pdf' END AS file_name,
    CASE WHEN run_id = 'es' THEN 'DOI:"' || doi || '"' ELSE 'EXT_ID:' || pmid || ' AND SRC:MED' END AS lookup FROM papers""",
)
def _(spark, sf):
    p = papers(spark, sf).withColumn("shown", F.when(F.col("run_id") != "es", F.col("pmid")))
    link = fl.links(F.col("pmid"), F.col("doi"))
    return p.select(
        fl.paper_id(F.col("pmid")).alias("paper_id"),
        fl.record_uri(F.col("pass_number"), F.col("paper_id")).alias("record_path"),
        link["pubmed"].alias("link_record"),
        link["publisher"].alias("link_publisher"),
        fl.stored_name(F.col("shown"), F.col("paper_id")).alias("file_name"),
        fl.lookup_query(F.col("shown"), F.col("doi")).alias("lookup"),
    )


@query(
    "list_fields",
    rf"""WITH p AS (SELECT item_id, regexp_split_to_array(text, '\.') AS l FROM benchmark),
    i AS (SELECT item_id, list_filter(list_transform(regexp_split_to_array(text, '[;\n]'), lambda x: {squash('x')}), lambda x: x <> '') AS s FROM benchmark)
    SELECT item_id, array_to_string(list_filter(list_transform(l, lambda x: trim(x, ' ' )), lambda x: x <> ''), ';') AS joined,
    coalesce(l[1], '') AS first_author, array_to_string(l[1:2], '; ') AS top,
    CASE WHEN len(s) = 0 THEN 'none' ELSE array_to_string(s[1:2], ' | ') END AS summary FROM p JOIN i USING (item_id)""",
)
def _(spark, sf):
    parts = F.split("text", r"\.")
    return table(spark, sf, "benchmark").select(
        "item_id",
        fl.join_clean(parts).alias("joined"),
        fl.first_author(parts).alias("first_author"),
        fl.top_terms(parts, 2).alias("top"),
        F.array_join(fl.summary_items(F.col("text"), 2), " | ").alias("summary"),
    )


@query(
    "access_fields",
    """WITH e AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'run/PMC_XML/' || user_id || '.json' WHEN 'click' THEN 'run/PDF/' || user_id
      WHEN 'signup' THEN 'cache/grobid/' || user_id ELSE '' END AS path,
      CASE WHEN value < 20 THEN 'parser_pending' WHEN value < 60 THEN 'parse_failed' ELSE 'missing' END AS status FROM events)
    SELECT event_id, path, status, CASE WHEN contains(path, 'PMC_XML') THEN 'pmc_xml' WHEN contains(path, 'PDF') OR contains(path, 'grobid')
      THEN 'pdf_grobid' ELSE 'missing' END AS source_type,
      CASE WHEN path <> '' THEN 'readable' WHEN status <> 'missing' THEN status ELSE 'unavailable' END AS access FROM e""",
)
def _(spark, sf):
    user, kind, v = F.col("user_id").cast("string"), F.col("event_type"), F.col("value")
    path = (
        F.when(kind == "view", F.concat(F.lit("run/PMC_XML/"), user, F.lit(".json")))
        .when(kind == "click", F.concat(F.lit("run/PDF/"), user))
        .when(kind == "signup", F.concat(F.lit("cache/grobid/"), user))
        .otherwise("")
    )
    status = F.when(v < 20, "parser_pending").when(v < 60, "parse_failed").otherwise("missing")
    e = table(spark, sf, "events").select("event_id", path.alias("path"), status.alias("status"))
    return e.withColumn("source_type", fl.source_type(F.col("path"))).withColumn(
        "access", fl.access_status(F.col("path"), F.col("status"))
    )


@query(
    "append_note",
    """SELECT event_id, CASE WHEN value < 50 THEN event_type ELSE event_type || ' ' || left(event_type, 4) END AS always,
    event_type AS once FROM events""",
)
def _(spark, sf):
    kind = F.col("event_type")
    extra = F.when(F.col("value") >= 50, F.substring(kind, 1, 4))
    return table(spark, sf, "events").select(
        "event_id", fl.append_note(kind, extra).alias("always"), fl.append_note(kind, extra, once=True).alias("once")
    )


@query(
    "payload_hash",
    """SELECT doc_id, sha256('{"doc_id":' || doc_id || ',"lang":"' || lang || '","n_chars":' || n_chars || ',"source":"' || source || '"}')
    AS sha256 FROM documents""",
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", fl.payload_hash("source", "doc_id", "lang", "n_chars").alias("sha256"))


@query(
    "settings_fields",
    """WITH e AS (SELECT event_id, CAST(props->>'k' AS VARCHAR) AS k, event_type FROM events),
    s AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'k' || k ELSE k END AS v FROM e)
    SELECT event_id, CASE WHEN regexp_full_match(v, '[0-9]+') THEN CAST(v AS INTEGER) ELSE -1 END AS k,
    CASE WHEN regexp_full_match(v, '[0-9]+') THEN CASE WHEN CAST(v AS INTEGER) = 0 THEN 0.0 ELSE 100.0 / CAST(v AS INTEGER) END ELSE 0.0 END AS ratio FROM s""",
)
def _(spark, sf):
    k = F.get_json_object("props", "$.k")
    v = F.when(F.col("event_type") == "error", F.concat(F.lit("k"), k)).otherwise(k)
    e = table(spark, sf, "events").select("event_id", F.create_map(F.lit("k"), v).alias("s"))
    n = fl.int_setting(F.col("s"), "k", -1)
    return e.select("event_id", n.alias("k"), fl.ratio(F.lit(100.0), F.greatest(n, F.lit(0))).alias("ratio"))


@query(
    "windows",
    sql("SELECT paper_id, window_no, md5(w) AS w FROM win", PAPERS, PROF, MATCH),
)
def _(spark, sf):
    w = tx.windows(F.col("title"), F.col("abstract"))
    d = papers(spark, sf).select("paper_id", F.posexplode(w).alias("n", "w"))
    return d.select("paper_id", (F.col("n") + 1).cast("long").alias("window_no"), F.md5("w").alias("w"))


# Text lines as evidence windows; used again by the full-text queries.
EVIDENCE_WINDOWS = rf"""lines AS (
  SELECT paper_id, title, generate_subscripts(l, 1) AS line_no, unnest(l) AS line FROM (
    SELECT paper_id, title, list_filter(list_transform(string_split(lower(abstract), chr(10)), lambda x: {squash('x')}), lambda x: x <> '') AS l FROM papers)),
headed AS (
  SELECT *, coalesce(last_value(CASE WHEN length(line) <= 120 AND NOT line LIKE '%.' THEN left(line, 80) END IGNORE NULLS)
    OVER (PARTITION BY paper_id ORDER BY line_no ROWS UNBOUNDED PRECEDING), 'full text') AS locator FROM lines),
pieces AS (
  SELECT paper_id, line_no, locator, CASE WHEN len(s) = 1 AND length(line) > 800
    THEN list_transform(range(0, length(line), 800), lambda i: substr(line, CAST(i AS BIGINT) + 1, 800)) ELSE s END AS s
  FROM (SELECT *, {sentences('line')} AS s FROM headed)),
ewin AS (
  SELECT paper_id, row_number() OVER (PARTITION BY paper_id ORDER BY line_no, k) AS window_no, locator, w FROM (
    SELECT paper_id, 0 AS line_no, 0 AS k, 'title' AS locator, lower(title) AS w FROM papers WHERE title <> ''
    UNION ALL SELECT paper_id, line_no, generate_subscripts(s, 1), locator, unnest(s) FROM pieces) WHERE w <> '')"""


@query("evidence_windows", sql("SELECT paper_id, window_no, locator, md5(w) AS w FROM ewin", PAPERS, EVIDENCE_WINDOWS))
def _(spark, sf):
    w = tx.evidence_windows(F.col("title"), F.lower("abstract"))
    d = papers(spark, sf).select("paper_id", F.posexplode(w).alias("n", "e"))
    return d.select("paper_id", (F.col("n") + 1).cast("long").alias("window_no"), "e.locator", F.md5("e.window").alias("w"))


@query(
    "heading_fill",
    """SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN left(text, 80) END IGNORE NULLS)
    OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS heading FROM conversations""",
)
def _(spark, sf):
    head = F.when(F.col("role") == "user", F.substring("text", 1, 80))
    d = heading_fill(table(spark, sf, "conversations"), head, ["conv_id"], ["turn"])
    return d.select("conv_id", "turn", "role", "heading")
