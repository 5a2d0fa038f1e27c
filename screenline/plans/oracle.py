"""Shared pieces of the SQL twins: the driver's tables as papers, term flags
in documents and windows. Written for an independent SQL engine."""

from __future__ import annotations

from screenline.plans.views import PROFILE_TERMS


def values(rows) -> str:
    lit = lambda v: "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"
    return "VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


SQUASH = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"
SENTENCES = r"string_split(regexp_replace({0}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"


def squash(c: str) -> str:
    return SQUASH.format(c)


def sentences(c: str) -> str:
    return SENTENCES.format(c)


PAPERS = f"""papers AS (
  SELECT doc_id, n_chars, lang AS run_id, CAST(1 + doc_id % 2 AS INTEGER) AS pass_number,
         'pmid-' || doc_id AS paper_id, CAST(doc_id AS VARCHAR) AS pmid,
         '10.5555/' || source || '.' || lpad(CAST(doc_id AS VARCHAR), 7, '0') AS doi,
         {squash(sentences('text') + '[1]')} AS title, text AS abstract,
         doc_id % 5 = 0 AS is_review, CAST(2000 + n_chars % 25 AS INTEGER) AS year, source AS journal
  FROM documents)"""

# The same with every document in the first pass.
PAPERS_ONE = PAPERS.replace("CAST(1 + doc_id % 2 AS INTEGER)", "1")

ROLES = ("primary", "mechanism", "outcome", "comparator", "exclusion", "review_frame", "claim")
LETTER = dict(zip(ROLES, "pmocxre"))

PROF = "prof(role, term) AS (" + values([(r, t) for r, ts in PROFILE_TERMS.items() for t in ts]) + ")"

OWN = """own(role, term) AS (
  SELECT role, term FROM prof a WHERE length(term) >= 4 AND (
    (role IN ('mechanism', 'comparator') AND term NOT IN (SELECT term FROM prof WHERE role = 'primary'))
    OR (role = 'outcome' AND term NOT IN (SELECT term FROM prof WHERE role IN ('primary', 'mechanism')))))"""

_DOC = ", ".join(f"coalesce(bool_or(role = '{r}'), false) AS {LETTER[r]}" for r in ROLES)
_WIN = ", ".join(f"coalesce(bool_or(h.role = '{r}'), false) AS {LETTER[r]}" for r in ROLES)
_OWN = ", ".join(
    f"coalesce(bool_or(o.role = '{r}'), false) AS {n}"
    for r, n in (("mechanism", "m2"), ("outcome", "o2"), ("comparator", "c2"))
)

MATCH = f"""tok AS (
  SELECT DISTINCT paper_id, unnest(regexp_extract_all(lower(title || chr(10) || abstract), '[a-z0-9+/-]+')) AS term FROM papers),
hit AS (SELECT paper_id, role, term FROM tok JOIN prof USING (term)),
docf AS (SELECT papers.paper_id, {_DOC} FROM papers LEFT JOIN hit USING (paper_id) GROUP BY papers.paper_id),
winlist AS (
  SELECT paper_id, list_concat(CASE WHEN title <> '' THEN [lower(title)] ELSE [] END,
    list_filter(list_transform({sentences('abstract')}, lambda s: lower({squash('s')})), lambda s: s <> '')) AS l FROM papers),
win AS (SELECT paper_id, unnest(range(1, len(l) + 1)) AS window_no, unnest(l) AS w FROM winlist)"""

WINDOWS = f"""{OWN},
wtok AS (SELECT DISTINCT paper_id, window_no, unnest(regexp_extract_all(w, '[a-z0-9+/-]+')) AS term FROM win),
winf AS (
  SELECT t.paper_id, t.window_no, {_WIN}, {_OWN}
  FROM wtok t LEFT JOIN prof h ON t.term = h.term LEFT JOIN own o ON t.term = o.term AND h.role = o.role
  GROUP BY t.paper_id, t.window_no),
winsum AS (
  SELECT paper_id, bool_or(p AND m AND (o OR e)) AS claim, bool_or(p AND m2 AND (o2 OR e)) AS direct,
    bool_or(p AND NOT (m2 AND (o2 OR e)) AND e AND (m2 OR o2)) AS contextual,
    bool_or(p AND c2 AND (m2 OR o2 OR e)) AS comparator
  FROM winf GROUP BY paper_id),
flags AS (
  SELECT d.*, q.run_id, q.pass_number, q.is_review AS review, coalesce(s.claim, false) AS claim,
    coalesce(s.direct, false) AS direct, coalesce(s.contextual, false) AS contextual,
    coalesce(s.comparator, false) AS comparator
  FROM docf d JOIN papers q USING (paper_id) LEFT JOIN winsum s USING (paper_id))"""

FIRST = """first AS (
  SELECT *, CASE WHEN (p AND m AND o) OR claim THEN 'direct_claim' WHEN review AND p AND (m OR o) AND r THEN 'review_frame'
    WHEN pass_number = 1 AND p AND o AND m::INT + o::INT + c::INT + r::INT >= 2 THEN 'learning_probe'
    WHEN x THEN 'exclusion' ELSE 'no_claim' END AS reason FROM flags),
triage1 AS (
  SELECT *, CASE WHEN reason IN ('direct_claim', 'review_frame', 'learning_probe') THEN 'include' ELSE 'exclude' END AS decision,
    CASE reason WHEN 'direct_claim' THEN 'high' WHEN 'learning_probe' THEN 'low' ELSE 'medium' END AS confidence,
    CASE reason WHEN 'direct_claim' THEN 'direct' WHEN 'learning_probe' THEN 'indirect' ELSE 'background_only' END AS match,
    CASE reason WHEN 'review_frame' THEN 'field_synthesis' ELSE 'none' END AS role FROM first)"""

SECOND = """verdicts AS (
  SELECT *, CASE WHEN x AND NOT (p AND ((m AND o) OR claim)) THEN 'excluded' WHEN p AND ((m AND o) OR claim) THEN 'claim'
    WHEN p AND c AND (m OR o) THEN 'comparator' WHEN review AND p AND (m OR o OR r) THEN 'review' ELSE 'no_signal' END AS rescue,
    CASE WHEN x AND NOT (direct OR comparator) THEN 'exclusion_stronger' WHEN direct THEN 'direct'
    WHEN contextual THEN 'contextual' WHEN comparator THEN 'comparator' ELSE 'no_claim' END AS judge FROM triage1),
drops AS (SELECT doc_id FROM labels WHERE quality = 0),
judged AS (
  SELECT v.*, rescue IN ('claim', 'comparator', 'review') AS rkeep, judge IN ('direct', 'contextual', 'comparator') AS jkeep,
    CASE rescue WHEN 'excluded' THEN 'high' WHEN 'comparator' THEN 'low' WHEN 'review' THEN 'low' ELSE 'medium' END AS rconf,
    CASE judge WHEN 'exclusion_stronger' THEN 'high' WHEN 'direct' THEN 'high' ELSE 'medium' END AS jconf,
    CASE rescue WHEN 'review' THEN 'field_synthesis' ELSE 'none' END AS rrole,
    pass_number > 1 AND d.doc_id IS NOT NULL AS prior_drop
  FROM verdicts v LEFT JOIN drops d ON v.paper_id = 'pmid-' || d.doc_id),
triage2 AS (
  SELECT *, CASE WHEN decision = 'include' AND pass_number >= 2 THEN jkeep WHEN decision = 'include' THEN true
      WHEN prior_drop AND rkeep THEN jkeep ELSE rkeep END AS keep,
    CASE WHEN decision = 'include' AND pass_number >= 2 THEN jconf WHEN decision = 'include' THEN confidence
      WHEN prior_drop AND rkeep THEN jconf ELSE rconf END AS conf2,
    CASE WHEN decision = 'include' AND pass_number >= 2 THEN judge || CASE WHEN prior_drop AND NOT jkeep THEN '+prior_drop' ELSE '' END
      WHEN decision = 'include' THEN 'confirmed' WHEN prior_drop AND rkeep THEN judge || '+prior_drop' ELSE rescue END AS reason2,
    CASE WHEN decision = 'include' AND pass_number >= 2 THEN 'none' WHEN decision = 'include' THEN role
      WHEN prior_drop AND rkeep THEN 'none' ELSE rrole END AS role2 FROM judged),
second AS (
  SELECT *, CASE WHEN decision = 'include' AND keep THEN 'confirm_include' WHEN decision = 'include' THEN 'overturn_to_exclude'
    WHEN keep THEN 'overturn_to_include' ELSE 'confirm_exclude' END AS decision2,
    CASE WHEN keep THEN 'advance_to_import' ELSE 'stop' END AS promotion FROM triage2)"""


def sql(select: str, *ctes: str) -> str:
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + select
