"""Column functions on record fields: ids, dates, notes, settings, counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from screenline.functions.text import compact_key, feedback_phrases, is_blank, squash, text_of


def norm_doi(c: Column) -> Column:
    out = F.trim(text_of(c))
    for prefix in ("^https://doi\\.org/", "^http://doi\\.org/", "^doi:"):
        out = F.regexp_replace(out, prefix, "")
    return F.trim(out)


def doi_keys(c: Column) -> Column:
    """Keys under which a DOI may show up in a file name."""
    doi = text_of(c)
    suffix = F.regexp_replace(doi, "(?s)^[^/]*/", "")
    pieces = F.transform(F.split(suffix, "[^A-Za-z0-9]+"), F.lower)
    digits = F.regexp_replace(suffix, "[^0-9]", "")
    whole = F.array(compact_key(doi))
    more = F.concat(
        F.array(compact_key(suffix)),
        F.filter(pieces, lambda x: F.length(x) >= 5),
        F.when(F.length(digits) >= 5, F.array(digits)).otherwise(F.array(F.lit(""))),
    )
    keys = F.when(doi.contains("/"), F.concat(whole, more)).otherwise(whole)
    return F.array_distinct(F.filter(keys, lambda x: x != ""))


def year_of(c: Column) -> Column:
    parts = F.split(F.regexp_replace(text_of(c), "[/-]", " "), r"(?U)\s+")
    return F.coalesce(F.get(F.filter(parts, lambda x: x.rlike("^[0-9]{4}$")), F.lit(0)), F.lit(""))


def paper_id(pmid: Column) -> Column:
    return F.concat(F.lit("pmid-"), F.trim(pmid))


def id_or_pmid(pid: Column, pmid: Column) -> Column:
    """The paper id, else one made from the pmid, else null."""
    return F.when(~is_blank(pid), F.trim(pid)).when(~is_blank(pmid), paper_id(pmid))


def record_uri(pass_number: Column, pid: Column) -> Column:
    return F.concat(F.lit("records/pass_"), F.lpad(pass_number.cast("string"), 3, "0"), F.lit("/"), pid)


def links(pmid: Column, doi: Column) -> Column:
    return F.struct(
        F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), pmid, F.lit("/")).alias("pubmed"),
        F.when(text_of(doi) != "", F.concat(F.lit("https://doi.org/"), doi)).otherwise(F.lit("")).alias("publisher"),
    )


def join_clean(arr: Column, sep: str = ";") -> Column:
    return F.array_join(F.filter(F.transform(arr, lambda x: F.trim(text_of(x))), lambda x: x != ""), sep)


def source_type(path: Column) -> Column:
    p = text_of(path)
    return (
        F.when(p.contains("PMC_XML"), "pmc_xml")
        .when(p.contains("PDF") | p.contains("grobid"), "pdf_grobid")
        .otherwise("missing")
    )


def access_status(normalized_path: Column, file_status: Column) -> Column:
    return (
        F.when(~is_blank(normalized_path), "readable")
        .when(file_status.isin("parser_pending", "parse_failed"), file_status)
        .otherwise("unavailable")
    )


def append_note(a: Column, b: Column, once: bool = False) -> Column:
    """``a b``; with ``once`` a note already contained in ``a`` is not added."""
    old, new = F.trim(text_of(a)), F.trim(text_of(b))
    both = F.concat_ws(" ", old, new)
    out = F.when(old == "", new).when(new == "", old)
    if once:
        out = out.when(F.contains(old, new), old)
    return out.otherwise(both)


def payload_hash(*cols: str) -> Column:
    """SHA-256 over the columns as one JSON object, keys sorted."""
    return F.sha2(F.to_json(F.struct(*sorted(cols)), {"ignoreNullFields": "false"}), 256)


def first_author(authors: Column) -> Column:
    return F.coalesce(F.get(authors, F.lit(0)), F.lit(""))


def summary_items(c: Column, n: int = 10) -> Column:
    items = F.filter(F.transform(F.split(text_of(c), "[;\n]"), squash), lambda x: x != "")
    return F.when(F.size(items) == 0, F.array(F.lit("none"))).otherwise(F.slice(items, 1, n))


def top_terms(arr: Column, n: int = 8, sep: str = "; ") -> Column:
    return F.when(F.size(arr) == 0, "none").otherwise(F.array_join(F.slice(arr, 1, n), sep))


def ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def int_setting(settings: Column, key: str, default: int) -> Column:
    v = F.trim(F.coalesce(F.try_element_at(settings, F.lit(key)), F.lit("")))
    return F.when(v.rlike("^[0-9]+$"), v.cast("int")).otherwise(F.lit(default))


def text_setting(settings: Column, key: str, default: str) -> Column:
    v = F.trim(F.try_element_at(settings, F.lit(key)))
    return F.when(is_blank(v), F.lit(default)).otherwise(v)


def stored_name(pmid: Column, pid: Column) -> Column:
    return F.when(is_blank(pmid), F.concat(F.trim(text_of(pid)), F.lit(".pdf"))).otherwise(
        F.concat(F.lit("PMID "), F.trim(pmid), F.lit(".pdf"))
    )


def lookup_query(pmid: Column, doi: Column) -> Column:
    return (
        F.when(~is_blank(pmid), F.concat(F.lit("EXT_ID:"), pmid, F.lit(" AND SRC:MED")))
        .when(~is_blank(doi), F.concat(F.lit('DOI:"'), F.replace(doi, F.lit('"'), F.lit("")), F.lit('"')))
        .otherwise("")
    )


def feedback_phrases_of(cells: list[Column], stop=()) -> Column:
    """Phrases of several feedback cells in turn, repeats dropped."""
    return feedback_phrases(F.concat_ws(";", *[text_of(c) for c in cells]), stop)
