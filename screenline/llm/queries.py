"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenline.llm import (
    decontaminate,
    fill_middle,
    language_id,
    license_scan,
    merge_index,
    mixing,
    near_dedup,
    quality_rules,
    recurrent_lm,
    secret_scan,
    sharding,
    spelling,
    sql,
    token_counts,
)


def _vocabulary(name: str) -> str:
    """Where the tokenizer files' package has a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return sharding.place(docs.select("doc_id"), ["doc_id"])


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    out = quality_rules.judged(docs.select("doc_id", "text"), quality_rules.learned_rules(docs, labels))
    return out.select("_row.doc_id", *quality_rules.BASE, "base_failed", "kept", "rule")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.find_licenses(_read(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score(_read(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _vocabulary("byte_bpe_50k.json")
    out = token_counts.prefix_table(_read(spark, sf_dir, "documents"), path)
    limit = F.col("n_tokens") > token_counts.LIMIT
    return out.select("doc_id", "n_bytes", "n_tokens", limit.alias("over_limit"), "fit_chars")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.learn(docs))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.train(docs))


def op11_merge_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merge_index.round_trip(_read(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))
    ids, text = F.sha2("ids", 256), F.sha2(F.encode("decoded", "UTF-8"), 256)
    return out.select("doc_id", "n_tokens", ids.alias("ids_sha256"), text.alias("decoded_sha256"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle.transformed(_read(spark, sf_dir, "documents"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    digest = lambda text: F.sha2(F.encode(text, "UTF-8"), 256)
    return out.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(back).alias("restored_sha256"),
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_sharding,
        op3_quality_rules,
        op4_mixing,
        op5_license_scan,
        op6_lm_scoring,
        op7_token_counts,
        op8_language_id,
        op9_near_dedup,
        op10_secret_scan,
        op11_merge_index,
        op12_fill_middle,
        op13_spelling,
    )
}
ORACLES = {
    "op1_decontamination": sql.CONTAINED_ITEMS,
    "op5_license_scan": sql.licenses(),
    "op12_fill_middle": sql.FILL_MIDDLE,
    "op13_spelling": sql.SPELLING,
}
