"""Newest rows, numbering, samples and report orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from screenline.session import cut, small


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key by the order columns. An aggregate, not a window:
    each task keeps one row per key before the shuffle, so a hot key costs no
    more than any other."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def latest_row(df: DataFrame, keys: Sequence[str] = ("run_id",), order: Sequence[str] = ("pass_number", "row_no")) -> DataFrame:
    """Last row over all passes of a run."""
    return latest_per_key(df, keys, order)


def first_claim(windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per document the first window (lowest window_no), with its fields."""
    rest = [c for c in windows.columns if c not in keys]
    return (
        windows.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.col("window_no")).alias("_row"))
        .select(*keys, "_row.*")
    )


def seen_passes(df: DataFrame, keys: Sequence[str] = ("run_id", "paper_id")) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min("pass_number").alias("first_seen_pass"), F.max("pass_number").alias("last_seen_pass")
    )


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: str, name: str = "row_no", parts: int | None = None
) -> DataFrame:
    """Number rows 1..n per key in the order of a unique column (null first),
    with no task holding a whole key. Rows are dealt to value ranges once, sorted
    there by key, and stored; a row's place in its range, less the place where
    its key begins there, plus the key's rows in earlier ranges is its number.
    The input is read twice: once to find the ranges, once to deal it."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stored = cut(df.repartitionByRange(parts, order).sortWithinPartitions(*keys, order))
    # The upper half of such an id is the partition, the lower the row's place.
    at = stored.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))
    sizes = at.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    named = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    shift = sizes.select(*named, F.col("_part").alias("_in"), (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    same = F.col("_part") == F.col("_in")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    return at.join(small(shift), same).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(name))


def review_batches(df: DataFrame, size: int, keys: Sequence[str] = ("run_id",), order: str = "paper_id") -> DataFrame:
    """Numbered batches of ``size`` rows per run, in id order."""
    n = row_numbers(df, keys, order, "_rn")
    return n.withColumn("batch_no", F.floor((F.col("_rn") - 1) / size).cast("long") + 1).drop("_rn")


# How many records of a query are looked at, by its hit count.
SAMPLE_SIZES = ((200, 40), (1000, 50), (None, 75))


def sample_size(hits: Column) -> Column:
    out = None
    for upto, n in SAMPLE_SIZES:
        if upto is None:
            return out.otherwise(n)
        out = F.when(hits <= upto, n) if out is None else out.when(hits <= upto, n)


def query_sample(hits: DataFrame, keys: Sequence[str] = ("query_id",), pmid: str = "pmid") -> DataFrame:
    """The records of each query to be judged: the sample size follows the
    query's hit count, the rows are those with the lowest hash."""
    most = max(n for _, n in SAMPLE_SIZES)
    distinct = hits.select(*keys, pmid).distinct()
    w = W.partitionBy(*keys).orderBy(F.md5(F.col(pmid).cast("string")), F.col(pmid))
    first = distinct.withColumn("sample_no", F.row_number().over(w)).where(F.col("sample_no") <= most)
    counts = distinct.groupBy(*keys).agg(F.count("*").alias("hit_count"))
    return (
        first.join(counts, list(keys))
        .withColumn("sample_size", sample_size(F.col("hit_count")))
        .where(F.col("sample_no") <= F.col("sample_size"))
    )


def sort_manifest(df: DataFrame) -> DataFrame:
    """Newest year first, then pmid, both as text."""
    return df.orderBy(F.desc(F.coalesce(F.col("year").cast("string"), F.lit(""))), F.desc(F.col("pmid").cast("string")))


def sort_blocked(df: DataFrame) -> DataFrame:
    return df.orderBy(F.lower("journal"), F.col("pmid").cast("string"))


# Shortlist priorities in order.
PRIORITIES = ("high", "medium", "low", "exclude")


def priority_rank(c: Column) -> Column:
    out = F.when(c == PRIORITIES[0], 0)
    for i, p in enumerate(PRIORITIES[1:], 1):
        out = out.when(c == p, i)
    return out.otherwise(9)


def sort_shortlist(df: DataFrame) -> DataFrame:
    year = F.col("year").cast("string")
    return df.orderBy(
        priority_rank(F.col("priority")), F.when(F.coalesce(year, F.lit("")) == "", "0000").otherwise(year), "title"
    )


def heading_fill(df: DataFrame, heading: Column, keys: Sequence[str], order: Sequence[str], name: str = "heading") -> DataFrame:
    """Carry the last non-null heading down the lines of one document."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.withColumn(name, F.last(heading, ignorenulls=True).over(w))
