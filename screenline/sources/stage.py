"""Stage tables on files: CSV at the edge, partitioned parquet inside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenline.functions.fields import record_uri
from screenline.functions.text import declared_terms, is_blank, norm_venue
from screenline.operators.match import RUN_KEYS
from screenline.operators.ranking import heading_fill, latest_per_key
from screenline.session import cut, small

CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_stage(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A header CSV, quoted newlines included; no file is an empty table."""
    shape = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    try:
        return spark.read.schema(shape).options(**CSV).csv(path)
    except AnalysisException as e:
        if not _missing(e):
            raise
        return spark.createDataFrame([], shape)


def read_passes(spark: SparkSession, path: str, schema: str | T.StructType, run_id: str | None = None) -> DataFrame:
    """A stage table over all runs and passes (partition columns)."""
    shape = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    try:
        d = spark.read.schema(shape).parquet(path)
    except AnalysisException as e:
        if not _missing(e):
            raise
        d = spark.createDataFrame([], shape)
    return d.where(F.col("run_id") == run_id) if run_id is not None else d


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """run_id, pass_number and columns of each CSV file of a stage table kept in
    folders by run and pass. Of a large file only the first split is read."""
    d = spark.read.option("basePath", path).text(path)
    d = d.where(F.col("_metadata.file_block_start") == 0).select(
        F.col("run_id").cast("string"),
        F.col("pass_number").cast("int"),
        F.col("_metadata.file_path").alias("file"),
        "value",
        F.monotonically_increasing_id().alias("line"),
    )
    first = d.groupBy(*RUN_KEYS, "file").agg(F.min_by("value", "line").alias("header"))
    names = F.transform(F.split("header", ","), lambda c: F.btrim(c, F.lit('" ')))
    return first.select(*RUN_KEYS, names.alias("columns"))


def union_passes(*passes: DataFrame) -> DataFrame:
    out = passes[0]
    for p in passes[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def flags_as_text(df: DataFrame) -> DataFrame:
    """Booleans as yes and no, nulls as empty cells: the CSV convention."""
    out = []
    for n, t in df.dtypes:
        c = F.col(f"`{n}`")
        if t == "boolean":
            c = F.when(c, "yes").when(~c, "no")
        elif t.startswith("array<string>"):
            c = F.array_join(c, "; ")
        out.append(F.coalesce(c.cast("string"), F.lit("")).alias(n))
    return df.select(*out)


def write_stage(df: DataFrame, path: str, columns: Sequence[str], form: str = "parquet", quoted: bool = False) -> None:
    """Overwrite with a fixed column order; other columns are dropped. Every
    CSV part has the header; an empty table still writes one."""
    shown = df.select(*columns)
    if form == "csv":
        opts = {"header": "true", "quote": '"', "escape": '"', "quoteAll": str(quoted).lower(), "emptyValue": ""}
        flags_as_text(shown).write.mode("overwrite").options(**opts).csv(path)
        return
    parts = [c for c in RUN_KEYS if c in columns]
    writer = shown.write.mode("overwrite")
    (writer.partitionBy(*parts) if parts else writer).parquet(path)


def write_quoted(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    write_stage(df, path, columns, "csv", quoted=True)


def write_state_json(df: DataFrame, path: str) -> None:
    """One JSON object per run."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


# A replacement of partitions is first written here, below the table; readers
# pass over names that begin so.
NEXT = "_next"


def _fs(spark: SparkSession, path: str):
    """The path and its file system, as Spark sees them."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    at, fs = _fs(spark, path)
    return fs.exists(at)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write a table's rows over the partitions they belong to; other partitions
    stay. The rows may come from the table itself: they are written in full
    before any partition is touched, and a replacement that is cut short is
    completed by ``finish_replacement``."""
    finish_replacement(df.sparkSession, path)
    # Written as a whole, so that its end is marked.
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(f"{path}/{NEXT}")
    finish_replacement(df.sparkSession, path)


def finish_replacement(spark: SparkSession, path: str) -> None:
    """Put what was written in full beside the table over its partitions, and
    let go of what was not. Run again it gives the same."""
    beside = f"{path}/{NEXT}"
    at, fs = _fs(spark, beside)
    if not fs.exists(at):
        return
    by = _partition_columns(spark, beside)
    if by and path_exists(spark, f"{beside}/_SUCCESS"):
        # Folder names stay as they are: 007 is no number.
        guess = "spark.sql.sources.partitionColumnTypeInference.enabled"
        before = spark.conf.get(guess)
        spark.conf.set(guess, "false")
        try:
            staged = spark.read.parquet(beside)
        finally:
            spark.conf.set(guess, before)
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    fs.delete(at, True)


def _partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns that name a table's folders, from the outermost one in."""
    out = []
    while True:
        found = _fs(spark, path)[1].globStatus(_fs(spark, f"{path}/*=*")[0])
        folders = [s.getPath() for s in found if s.isDirectory()]
        if not folders:
            return out
        out.append(folders[0].getName().split("=", 1)[0])
        path = str(folders[0].toString())


def current_payloads(payloads: DataFrame, active: DataFrame) -> DataFrame:
    """Payload rows without those of passes before the run's active one."""
    a = active.select("run_id", F.col("pass_number").alias("_active"))
    d = payloads.join(small(a), "run_id", "left")
    return d.where(F.col("_active").isNull() | (F.col("pass_number") >= F.col("_active"))).drop("_active")


def purge_prior_payloads(spark: SparkSession, path: str, active: DataFrame) -> None:
    """Take the payloads of passes before each run's active one out of the
    stored table (partitioned by run_id). Only runs that have such payloads are
    written anew; a run with nothing else loses its folder."""
    finish_replacement(spark, path)
    stored = spark.read.parquet(path)
    kept = current_payloads(stored, active)
    a = active.select("run_id", F.col("pass_number").alias("_active"))
    stale = stored.join(small(a), "run_id").where(F.col("pass_number") < F.col("_active"))
    runs = cut(stale.select("run_id").distinct())
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    emptied = runs.join(kept.select("run_id").distinct(), "run_id", "left_anti")
    where = spark.read.parquet(path).withColumn("_folder", folder).join(emptied, "run_id", "left_semi")
    gone = [r[0] for r in where.select("_folder").distinct().collect()]
    if not runs.isEmpty():
        replace_partitions(kept.join(small(runs), "run_id", "left_semi"), path, ["run_id"])
    for f in gone:
        at, fs = _fs(spark, f)
        fs.delete(at, True)


def read_venue_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules with their place (file by file in order of name, then row by row)
    and normal form."""
    schema = "match_type string, match_value string, rationale string"
    d = spark.read.schema(schema).options(**CSV).csv(path)
    # A file is one task, which reads its rows in order; files go by name.
    d = d.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_row"))
    files = d.groupBy("_file").agg(F.min("_row").alias("_first"))
    files = files.withColumn("_nth", F.row_number().over(Window.orderBy("_file")) - 1)
    d = d.join(small(files), "_file")
    rule_no = F.col("_nth") * F.lit(1 << 33) + F.col("_row") - F.col("_first")
    d = d.withColumn("rule_no", rule_no.cast("long")).drop("_file", "_row", "_first", "_nth")
    ok = ~is_blank(F.col("match_type")) & ~is_blank(F.col("match_value"))
    return d.where(ok).withColumn("norm_value", norm_venue(F.col("match_value")))


def numbered_lines(text: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Whole texts to lines with their number."""
    parts = F.split(F.col(value), r"\R")
    return text.select(*keys, F.posexplode(parts).alias("line_no", "line")).withColumn("line_no", F.col("line_no") + 1)


def read_settings(lines: Column) -> Column:
    """Lines like "- `key`: `value`" of one text to a map; the last wins."""
    found = F.regexp_extract_all(lines, F.lit("(?m)^\\s*-\\s+`([^`]+)`:\\s+`([^`]+)`"), 0)
    pairs = F.transform(
        found,
        lambda s: F.struct(
            F.regexp_extract(s, "`([^`]+)`:", 1).alias("k"), F.regexp_extract(s, ":\\s+`([^`]+)`", 1).alias("v")
        ),
    )
    last = F.filter(
        pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda q: q["k"] == p["k"])
    )
    return F.map_from_entries(last)


def read_query_list(lines: DataFrame, keys: Sequence[str], section: str = "query set") -> DataFrame:
    """Numbered items under the section's heading, in order, without the
    enclosing backticks; placeholders are skipped."""
    t = F.trim("line")
    d = lines.withColumn("_t", t)
    head = F.when(F.startswith(F.col("_t"), F.lit("## ")), F.lower(F.trim(F.expr("substring(_t, 4)"))))
    d = heading_fill(d, head, keys, ["line_no"], "_head").where(F.col("_head") == section)
    item = F.trim(F.regexp_extract("_t", r"^\d+\.\s+(.*)$", 1))
    item = F.when(item.rlike("^`.*`$") & (F.length(item) >= 2), F.trim(F.expr("substring(_i, 2, length(_i) - 2)"))).otherwise(item)
    d = d.withColumn("_i", F.trim(F.regexp_extract("_t", r"^\d+\.\s+(.*)$", 1))).withColumn("query", item)
    d = d.where((F.col("query") != "") & ~F.col("query").rlike("^<.*query.*>$"))
    return d.select(*keys, "line_no", "query")


# Labels of a scope contract and the role their terms take.
LABEL_ROLES = {
    "primary": (
        "primary entities",
        "primary entity",
        "entities",
        "targets",
        "genes",
        "proteins",
        "drugs",
        "pathways",
        "systems",
    ),
    "mechanism": (
        "declared mechanism classes for pubmed retrieval",
        "declared mechanism classes",
        "mechanism classes",
        "evidence goal",
        "desired evidence types",
        "evidence types",
    ),
    "outcome": (
        "declared outcomes or required evidence claims",
        "declared outcomes",
        "required evidence claims",
        "outcome terms",
        "outcomes",
        "response variables",
        "phenotypes",
        "endpoints",
    ),
    "comparator": (
        "authorized comparator entities or systems",
        "authorized comparator",
        "allowed comparator scope",
        "comparators",
        "model systems",
    ),
    "exclusion": (
        "exclusions",
        "exclude",
        "deprioritize",
        "durable exclusions",
        "adjacent biology deferred from first-pass retrieval",
        "evidence insufficient by itself",
        "evidence that should not be treated as sufficient",
        "evidence that should reduce ambiguity by triggering exclusion or demotion",
    ),
    "review_frame": (
        "review and synthesis framing",
        "review/synthesis framing",
        "parent field",
        "introduction background scope",
        "foundational concepts or older terminology to preserve",
        "review-architecture paper types worth retaining",
        "perspective questions",
        "controversies or unresolved gaps",
    ),
}


def read_contract_terms(contracts: DataFrame, stop: Sequence[str] = (), keys: Sequence[str] = RUN_KEYS, text: str = "value") -> DataFrame:
    """Scope contracts (one text per run and pass) to (role, term). A value
    stays on its label's line or goes on in lines that carry no label; a blank
    label declares nothing."""
    lines = numbered_lines(contracts, keys, text)
    label = F.lower(F.trim(F.regexp_extract("line", r"(?i)^\s*[-*]?\s*([a-z][a-z0-9 /_-]{2,}?)\s*:", 1)))
    d = lines.withColumn("_label", F.when(F.startswith(F.trim("line"), F.lit("#")), "#").otherwise(F.nullif(label, F.lit(""))))
    value = F.when(F.col("_label").isNull(), F.col("line")).otherwise(
        F.regexp_replace("line", r"(?i)^\s*[-*]?\s*[a-z][a-z0-9 /_-]{2,}?\s*:", "")
    )
    d = heading_fill(d.withColumn("_value", value), F.col("_label"), keys, ["line_no"], "_of")
    roles = F.create_map(*[F.lit(x) for r, ls in LABEL_ROLES.items() for label_ in ls for x in (label_, r)])
    d = d.withColumn("role", F.try_element_at(roles, F.col("_of"))).where("role is not null")
    cleaned = F.regexp_replace("_value", r"^\s*[-*]\s+", "")
    return d.select(*keys, "role", F.explode(declared_terms(cleaned, stop)).alias("term")).distinct()


def compact_records(records: DataFrame, manifest: DataFrame, path: str) -> DataFrame:
    """Many small records to one partitioned table. The table is used only if
    it holds at least as many records per pass as the manifest; the returned
    manifest then points into it."""
    keys = [*RUN_KEYS, "paper_id"]
    rest = [c for c in records.columns if c not in keys]
    one = latest_per_key(records, keys, rest).join(manifest.select(*keys).distinct(), keys, "left_semi")
    one.write.mode("overwrite").partitionBy(*RUN_KEYS).parquet(path)
    spark = records.sparkSession
    stored = spark.read.schema(one.schema).parquet(path).groupBy(*RUN_KEYS).agg(F.count("*").alias("_stored"))
    wanted = manifest.groupBy(*RUN_KEYS).agg(F.count("*").alias("_wanted"))
    gate = wanted.join(stored, list(RUN_KEYS), "left")
    gate = gate.select(*RUN_KEYS, (F.coalesce("_stored", F.lit(0)) >= F.col("_wanted")).alias("compacted"))
    d = manifest.join(small(gate), list(RUN_KEYS), "left")
    uri = record_uri(F.col("pass_number"), F.col("paper_id"))
    return d.withColumn("record_path", F.when(F.col("compacted"), uri).otherwise(F.col("record_path")))


def read_normalized(spark: SparkSession, path: str) -> DataFrame:
    """Stored full texts, lower case; an unreadable payload has empty text."""
    schema = (
        "paper_id string, pmid string, title string, raw_text string, "
        "sections array<struct<title:string,text:string>>, _corrupt_record string"
    )
    d = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    return d.drop("_corrupt_record").withColumn("raw_text", F.coalesce(F.lower("raw_text"), F.lit("")))


def scan_files(spark: SparkSession, folder: str, hashed: bool = False) -> DataFrame:
    """PDF files of a folder, told by their first bytes, in path order."""
    d = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").option("recursiveFileLookup", "true").load(folder)
    return pdf_files(d, hashed).orderBy("path")


def pdf_files(d: DataFrame, hashed: bool = False) -> DataFrame:
    """Keep rows whose content starts like a PDF; the content is dropped where
    it is read, on request after its SHA-256 is taken."""
    name = F.regexp_extract("path", "([^/]+)$", 1)
    digest = [F.sha2("content", 256).alias("content_hash")] if hashed else []
    return d.where(F.substring("content", 1, 5) == F.lit(b"%PDF-")).select(
        "path", name.alias("name"), F.regexp_replace(name, r"(?i)\.pdf$", "").alias("stem"), "length", "modificationTime", *digest
    )
