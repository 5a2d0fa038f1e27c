"""Getting full texts: how each paper's text is to be reached, what became of
the fetched payloads, what became of the parsed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenline.functions.fields import append_note, norm_doi, source_type, stored_name, text_setting
from screenline.functions.text import is_blank, strip, text_of
from screenline.operators.ranking import latest_per_key
from screenline.session import small

KEYS = ("run_id", "pass_number")
IDS = (*KEYS, "paper_id")
XML_ROUTES = ("ncbi_pmc_xml", "europe_pmc_xml")


def usable_import() -> Column:
    return (
        (F.trim("pmc_access_status") == "available")
        & (F.trim("pmc_parse_status") == "usable")
        & ~is_blank(F.col("normalized_path"))
    )


def use_alternate_lookup(settings: Column) -> Column:
    """Are the other open-access sources asked in this phase?"""
    mode = text_setting(settings, "fulltext_lookup_mode", "pmc_then_oa_final")
    final = (text_setting(settings, "access_phase", "pmc_learning") == "final_access") | (
        text_setting(settings, "pdf_policy", "continue_pmc_only") == "require_fulltext_completion"
    )
    return F.when(mode == "pmc_only", F.lit(False)).when(mode == "exhaustive_oa", F.lit(True)).otherwise(final)


def parseable(status: Column, allow_staged: Column) -> Column:
    return F.when(status == "staged_from_user_download", allow_staged).otherwise(
        F.coalesce(status.isin("imported", "parser_pending", "parse_failed"), F.lit(False))
    )


def staged_allowed(settings: Column, has_shortlist: Column, latest_decision: Column) -> Column:
    final = (text_setting(settings, "access_phase", "pmc_learning") == "final_access") | (
        text_setting(settings, "pdf_policy", "") == "require_fulltext_completion"
    )
    return final | (has_shortlist & F.coalesce(latest_decision == "final_pdf_pass", F.lit(False)))


def prior_usable(asked: DataFrame, imports: DataFrame, read_state: DataFrame | None = None) -> DataFrame:
    """For each (run_id, pass_number, paper_id) asked for, the latest usable
    import of an earlier pass as ``prior``; a reading recorded in an earlier pass
    takes precedence. Papers without either have no row.

    Questions, imports and readings of a paper are one stream in pass order, and
    the last value before each question is carried to it, so the rows are those
    of the tables, however many passes there are."""
    cols = ("pmcid", "fulltext_access_route", "fulltext_xml_url", "fulltext_pdf_url", "normalized_path")
    prior = F.struct(*[F.col(c).cast("string").alias(c) for c in cols])
    kind = "struct<" + ",".join(f"{c}:string" for c in cols) + ">"

    def rows(df: DataFrame, **given: Column) -> DataFrame:
        held = {"_asked": F.lit(False), "_import": F.lit(None).cast(kind), "_said": F.lit(None).cast(kind)} | given
        return df.select(*IDS, *[c.alias(n) for n, c in held.items()])

    ok = latest_per_key(imports.where(usable_import() & ~is_blank(F.col("paper_id"))), IDS, ["normalized_path"])
    stream = rows(asked.select(*IDS).distinct(), _asked=F.lit(True)).unionByName(rows(ok, _import=prior))
    if read_state is not None:
        said = read_state.where(~is_blank(F.col("normalized_path"))).withColumn("pass_number", F.col("last_read_pass").cast("int"))
        none = F.lit(None).cast("string")
        bare = said.select(*IDS, "pmcid", *[none.alias(c) for c in cols[1:4]], "normalized_path")
        stream = stream.unionByName(rows(latest_per_key(bare, IDS, ["normalized_path"]), _said=prior))
    before = W.partitionBy("run_id", "paper_id").orderBy("pass_number").rangeBetween(W.unboundedPreceding, -1)
    last = F.coalesce(F.last("_said", True).over(before), F.last("_import", True).over(before))
    return stream.withColumn("prior", last).where("_asked and prior is not null").select(*IDS, "prior")


def route_imports(
    selected: DataFrame, crosswalk: DataFrame, lookups: DataFrame, prior: DataFrame, settings: DataFrame
) -> DataFrame:
    """Import rows of the advanced papers. ``crosswalk`` is (pmid, pmcid),
    ``lookups`` is (pmid, alt_pmcid, alt_xml_url, alt_pdf_url, oa_pdf_url),
    one row per pmid each; ``settings`` is (run_id, pass_number, settings)."""
    d = selected.where(F.trim("promotion_decision") == "advance_to_import")
    d = d.join(crosswalk.groupBy("pmid").agg(F.max("pmcid").alias("_pmcid")), "pmid", "left")
    d = d.join(lookups.dropDuplicates(["pmid"]), "pmid", "left")
    d = d.join(prior, list(IDS), "left").join(small(settings), list(KEYS), "left")
    alt = F.coalesce(use_alternate_lookup(F.coalesce("settings", F.create_map().cast("map<string,string>"))), F.lit(False))
    has = lambda c: ~is_blank(F.col(c))
    reused = ~is_blank(F.col("prior.normalized_path"))
    route = (
        F.when(reused, F.when(is_blank(F.col("prior.fulltext_access_route")), "ncbi_pmc_xml").otherwise(F.col("prior.fulltext_access_route")))
        .when(has("_pmcid"), "ncbi_pmc_xml")
        .when(alt & has("alt_pmcid") & has("alt_xml_url"), "europe_pmc_xml")
        .when(alt & (has("alt_pdf_url") | has("oa_pdf_url")), "oa_pdf")
        .otherwise("none")
    )
    d = d.withColumns({"_alt": alt & ~reused & ~has("_pmcid"), "_reused": reused, "_route": route})
    xml = F.col("_route").isin(*XML_ROUTES)
    available = F.col("_reused") | xml
    reason = (
        F.when(F.col("_reused"), "reused_prior_text")
        .when(F.col("_route") == "ncbi_pmc_xml", "id_crosswalk")
        .when(F.col("_route") == "europe_pmc_xml", "alternate_pmcid")
        .when(has("alt_pdf_url") & F.col("_alt"), "alternate_pdf")
        .when(has("oa_pdf_url") & F.col("_alt"), "open_location_pdf")
        .when(F.col("_alt"), "no_source")
        .otherwise("lookup_deferred")
    )
    given = lambda c: text_of(F.col(c))
    pick = lambda p, new: F.when(F.col("_reused"), given(f"prior.{p}")).otherwise(new)
    pdf = F.when(F.col("_route") == "oa_pdf", F.when(has("alt_pdf_url"), given("alt_pdf_url")).otherwise(given("oa_pdf_url"))).when(
        F.col("_alt"), given("alt_pdf_url")
    ).otherwise("")
    pmcid = F.when(has("_pmcid"), F.col("_pmcid")).when(F.col("_alt"), given("alt_pmcid")).otherwise("")
    return d.select(
        *IDS,
        "pmid",
        pick("pmcid", pmcid).alias("pmcid"),
        norm_doi(F.col("doi")).alias("doi"),
        "title",
        F.col("_route").alias("fulltext_access_route"),
        pick("fulltext_xml_url", F.when(F.col("_alt"), given("alt_xml_url")).otherwise("")).alias("fulltext_xml_url"),
        pick("fulltext_pdf_url", pdf).alias("fulltext_pdf_url"),
        F.when(available, "available").otherwise("missing").alias("pmc_access_status"),
        F.when(F.col("_reused"), "usable").otherwise("not_attempted").alias("pmc_parse_status"),
        (~available).alias("pdf_needed"),
        F.when(F.col("_route") == "none", "missing").otherwise("not_attempted").alias("pdf_import_status"),
        pick("normalized_path", F.lit("")).alias("normalized_path"),
        reason.alias("notes"),
    )


def manual_queue(imports: DataFrame) -> DataFrame:
    """Papers whose file must come by hand."""
    oa = F.col("fulltext_access_route") == "oa_pdf"
    return imports.where("pdf_needed").select(
        *IDS,
        "pmid",
        F.lit("").alias("pmcid"),
        "doi",
        "title",
        F.when(oa, "open_pdf_without_xml").otherwise("no_automated_source").alias("queue_reason"),
        F.when(oa, "open_access_pdf").otherwise("publisher_pdf_or_user_download").alias("preferred_source"),
        F.lit("").alias("notes"),
    )


def import_outcome(imports: DataFrame, articles: DataFrame, files: DataFrame, text_root: str = "PMC_XML/normalized") -> DataFrame:
    """Import rows after fetching. ``articles`` is (pmcid, error), one row per
    fetched XML, error null when it was normalised; ``files`` is
    (fulltext_pdf_url, content), the fetched files. Adds ``queue_reason``,
    null when no file is wanted."""
    a = articles.groupBy("pmcid").agg(F.max_by(F.struct(F.lit(True).alias("got"), F.col("error")), F.col("error").isNull()).alias("_a"))
    f = files.groupBy("fulltext_pdf_url").agg(F.max(_has_mark()).alias("_file_ok"))
    d = imports.join(a, "pmcid", "left").join(f, "fulltext_pdf_url", "left")
    route = F.col("fulltext_access_route")
    there = ~is_blank(F.col("normalized_path"))
    by_xml = ~there & route.isin(*XML_ROUTES) & ~is_blank(F.col("pmcid"))
    xml_ok = by_xml & F.col("_a.got").isNotNull() & F.col("_a.error").isNull()
    has_url = ~is_blank(F.col("fulltext_pdf_url"))
    xml_bad = by_xml & ~xml_ok
    by_pdf = has_url & ((~there & ~by_xml & (route == "oa_pdf")) | xml_bad)
    pdf_ok = by_pdf & F.coalesce("_file_ok", F.lit(False))
    case = (
        F.when(there, "present")
        .when(xml_ok, "xml_usable")
        .when(xml_bad & ~has_url, F.when(F.col("_a.got").isNull(), "xml_missing").otherwise("xml_unusable"))
        .when(pdf_ok, "pdf_imported")
        .when(by_pdf, "pdf_failed")
        .otherwise("no_route")
    )
    d = d.withColumns({"_case": case, "_bad": xml_bad, "_bypdf": by_pdf})
    c = F.col("_case")
    usable = c.isin("present", "xml_usable")
    pdf_parse = F.when(F.col("_bad"), "unusable").otherwise(F.col("pmc_parse_status"))
    path = F.concat(F.lit(f"{text_root}/"), F.col("pmcid"), F.lit(".json"))
    out = {
        "fulltext_access_route": F.when(F.col("_bypdf"), "oa_pdf").otherwise(route),
        "pmc_access_status": F.when(usable, "available").otherwise("missing"),
        "pmc_parse_status": F.when(usable, "usable")
        .when(c.isin("xml_missing", "xml_unusable"), "unusable")
        .when(c == "pdf_failed", pdf_parse)
        .otherwise("not_attempted"),
        "pdf_needed": ~usable,
        "pdf_import_status": F.when(usable, "not_attempted").when(c == "pdf_imported", "imported").otherwise("missing"),
        "normalized_path": F.when(c == "present", F.col("normalized_path")).when(c == "xml_usable", path).otherwise(""),
        "notes": append_note(F.col("notes"), c),
    }
    rest = [F.col(x) if x not in out else out[x].alias(x) for x in imports.columns]
    return d.select(*rest, F.when(~usable, c).alias("queue_reason"))


def _has_mark() -> Column:
    """A file is good when the PDF mark stands in its first 1024 bytes."""
    head = F.hex(F.substring("content", 1, 1024))
    # Hex digits pair up per byte, so the mark must start at an even offset.
    return head.rlike("^(?:[0-9A-F]{2})*?255044462D")


def import_queue(outcome: DataFrame) -> DataFrame:
    d = outcome.where("queue_reason is not null")
    oa = F.col("queue_reason") == "pdf_imported"
    return d.select(
        *IDS,
        "pmid",
        "pmcid",
        "doi",
        "title",
        "queue_reason",
        F.when(oa, "open_access_pdf").otherwise("publisher_pdf_or_user_download").alias("preferred_source"),
        "notes",
    )


def reconcile_open_files(imports: DataFrame) -> DataFrame:
    """Status columns of papers reached by an open file, after parsing."""
    oa = F.trim("fulltext_access_route") == "oa_pdf"
    done = oa & (F.trim("pdf_import_status") == "normalized") & ~is_blank(F.col("normalized_path"))
    failed = oa & (F.trim("pdf_import_status") == "parse_failed")
    d = imports.withColumns({"_done": done, "_failed": failed})
    new = {
        "pmc_access_status": F.when(F.col("_done") | F.col("_failed"), "available").otherwise(F.col("pmc_access_status")),
        "pmc_parse_status": F.when(F.col("_done"), "usable").when(F.col("_failed"), "unusable").otherwise(F.col("pmc_parse_status")),
        "pdf_needed": F.when(F.col("_done"), F.lit(False)).when(F.col("_failed"), F.lit(True)).otherwise(F.col("pdf_needed")),
    }
    return d.withColumns(new).select(*imports.columns)


def parse_outcome(imports: DataFrame, files: DataFrame, parsed: DataFrame, allow_staged: Column, text_root: str = "PDF/normalized") -> DataFrame:
    """Import rows after parsing, with ``parse_status`` (null where nothing was
    to be parsed). ``files`` is (paper_id or stored name as ``name``), the files
    at hand; ``parsed`` is (paper_id, error), null error meaning normalised; a
    file with no parser result is pending."""
    d = reconcile_open_files(imports)
    names = files.select(F.col("name").alias("_name")).distinct()
    d = d.withColumn("_by_pmid", stored_name(F.col("pmid"), F.col("paper_id")))
    d = d.withColumn("_by_id", F.concat(F.col("paper_id"), F.lit(".pdf")))
    # A file may be kept under either name; two equality lookups.
    one = names.select(F.col("_name").alias("_by_pmid"), F.lit(True).alias("_f1"))
    two = names.select(F.col("_name").alias("_by_id"), F.lit(True).alias("_f2"))
    d = d.join(one, "_by_pmid", "left").join(two, "_by_id", "left")
    p = parsed.groupBy("paper_id").agg(
        F.max_by(F.struct(F.lit(True).alias("got"), F.col("error")), F.col("error").isNull()).alias("_p")
    )
    d = d.join(p, "paper_id", "left")
    at_hand = F.col("_f1").isNotNull() | F.col("_f2").isNotNull()
    status = F.when(
        parseable(F.col("pdf_import_status"), allow_staged),
        F.when(~at_hand, "missing_pdf")
        .when(F.col("_p.got").isNull(), "parser_pending")
        .when(F.col("_p.error").isNull(), "normalized")
        .otherwise("parse_failed"),
    )
    d = d.withColumn("parse_status", status)
    s, oa = F.col("parse_status"), F.trim("fulltext_access_route") == "oa_pdf"
    note = F.when(s == "parse_failed", F.col("_p.error")).when(s.isin("parser_pending", "normalized"), s)
    new = {
        "pdf_import_status": F.when(s == "missing_pdf", "missing").when(s.isNotNull(), s).otherwise(F.col("pdf_import_status")),
        "pdf_needed": F.when(s == "normalized", F.lit(False)).otherwise(F.col("pdf_needed")),
        "pmc_parse_status": F.when(oa & (s == "normalized"), "usable").when(oa & (s == "parse_failed"), "unusable").otherwise(F.col("pmc_parse_status")),
        "normalized_path": F.when(s == "normalized", F.concat(F.lit(f"{text_root}/"), F.col("paper_id"), F.lit(".json"))).otherwise(F.col("normalized_path")),
        "notes": append_note(F.col("notes"), text_of(note), once=True),
    }
    return d.select(*[new[c].alias(c) if c in new else F.col(c) for c in imports.columns], "parse_status")


def parse_report(outcome: DataFrame) -> DataFrame:
    d = outcome.where("parse_status is not null")
    return d.select(*IDS, "pmid", "doi", "title", "normalized_path", "parse_status", "notes")


def prepare_review(imports: DataFrame) -> DataFrame:
    """Review rows for every readable import."""
    return imports.where(~is_blank(F.col("normalized_path"))).select(
        *IDS,
        "pmid",
        "pmcid",
        "doi",
        "title",
        source_type(F.col("normalized_path")).alias("normalized_source_type"),
        strip(F.col("normalized_path")).alias("normalized_path"),
    )
