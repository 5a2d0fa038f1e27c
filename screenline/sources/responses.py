"""Stored lookup responses (JSON text) to id and link columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenline.functions.text import strip, text_of

CROSSWALK = "records array<struct<pmid:string,pmcid:string>>"
LINKS = "array<struct<availabilityCode:string,documentStyle:string,url:string>>"
LOCATION = "struct<is_oa:boolean,pdf_url:string>"
WORK = f"struct<best_oa_location:{LOCATION},primary_location:{LOCATION},locations:array<{LOCATION}>>"


def read_id_crosswalk(df: DataFrame, json: str = "json") -> DataFrame:
    """Responses of the id converter to (pmid, pmcid); the last answer for a
    pmid counts when ``response_no`` tells the order."""
    order = F.col("response_no") if "response_no" in df.columns else F.lit(0)
    d = df.select(order.alias("n"), F.posexplode(F.from_json(F.col(json), CROSSWALK)["records"]).alias("i", "r"))
    rows = d.select("n", "i", text_of(F.col("r.pmid")).alias("pmid"), text_of(F.col("r.pmcid")).alias("pmcid"))
    return rows.where("pmid <> ''").groupBy("pmid").agg(F.max_by("pmcid", F.struct("n", "i")).alias("pmcid"))


def first_open_pdf(links: Column) -> Column:
    """First open-access PDF link with an address."""
    ok = F.filter(
        links,
        lambda x: (x["availabilityCode"] == "OA") & (x["documentStyle"] == "pdf") & (strip(text_of(x["url"])) != ""),
    )
    return F.coalesce(strip(F.get(ok, F.lit(0))["url"]), F.lit(""))


def first_open_location(work: Column) -> Column:
    """Best, primary, then other places: the first not closed with a PDF."""
    none = F.array().cast(f"array<{LOCATION}>")
    lead = F.filter(F.array(work["best_oa_location"], work["primary_location"]), lambda x: x.isNotNull())
    every = F.concat(lead, F.coalesce(work["locations"], none))
    ok = F.filter(
        every, lambda x: F.coalesce(x["is_oa"], F.lit(True)) & (strip(text_of(x["pdf_url"])) != "")
    )
    return F.coalesce(strip(F.get(ok, F.lit(0))["pdf_url"]), F.lit(""))


def parse_links(json: Column) -> Column:
    return F.from_json(json, LINKS)


def parse_work(json: Column) -> Column:
    return F.from_json(json, WORK)
