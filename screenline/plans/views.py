"""The driver's tables seen as stage tables: documents are papers, languages
are runs, labels are decisions by people, events are a decision log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenline.functions.text import SENTENCE_GAP, squash
from screenline.session import local_table, spread

# Terms chosen by how many documents hold them.
PROFILE_TERMS = {
    "primary": ["ertion", "erhe", "ered", "erly"],
    "mechanism": ["erat", "erer", "erble", "onthe"],
    "outcome": ["ering", "oning", "onon", "onst"],
    "comparator": ["anin", "anou"],
    "exclusion": ["worthless", "stupid"],
    "review_frame": ["reed", "rely"],
    "claim": ["erou", "onre", "onhe", "onnd"],
}

# Venue rules over documents.source; the last never wins.
VENUE_RULES = [
    ("journal_exact", "Src3", "exact_three"),
    ("journal_exact", "src7", "exact_seven"),
    ("journal_prefix", "src1", "prefix_one"),
    ("journal_exact", "src1", "exact_one"),
]

LANGS = ("en", "de", "fr", "es")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def profile_for(spark: SparkSession, runs, terms=None) -> DataFrame:
    """The same terms for each (run_id, pass_number)."""
    rows = [(r, p, role, t) for r, p in runs for role, ts in (terms or PROFILE_TERMS).items() for t in ts]
    return local_table(spark, rows, "run_id string, pass_number int, role string, term string")


def profile(spark: SparkSession) -> DataFrame:
    return profile_for(spark, [(r, p) for r in LANGS for p in (1, 2)])


def venue_rules(spark: SparkSession) -> DataFrame:
    rows = [(i, *r) for i, r in enumerate(VENUE_RULES)]
    return local_table(spark, rows, "rule_no int, match_type string, match_value string, rationale string")


def papers(spark: SparkSession, sf_dir: str, pass_number: int | None = None) -> DataFrame:
    """One row per document. Runs are languages; with no pass given, odd
    documents are the second pass."""
    d = spread(table(spark, sf_dir, "documents"))
    pmid = F.col("doc_id").cast("string")
    number = F.lit(pass_number) if pass_number else (1 + F.col("doc_id") % 2)
    kinds = F.when(F.col("doc_id") % 5 == 0, F.array(F.lit("Journal Article"), F.lit("Review"))).otherwise(
        F.array(F.lit("Journal Article"))
    )
    return d.select(
        F.col("lang").alias("run_id"),
        number.cast("int").alias("pass_number"),
        F.concat(F.lit("pmid-"), pmid).alias("paper_id"),
        pmid.alias("pmid"),
        F.concat(F.lit("10.5555/"), F.col("source"), F.lit("."), F.lpad(pmid, 7, "0")).alias("doi"),
        squash(F.get(F.split("text", SENTENCE_GAP), F.lit(0))).alias("title"),
        F.col("text").alias("abstract"),
        kinds.alias("publication_types"),
        (2000 + F.col("n_chars") % 25).cast("int").alias("year"),
        F.col("source").alias("journal"),
    )
