"""The registered query of every operator, over whole tables with production settings."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthmill.llm import aligned_tokens, curve_packing, fingerprints, hard_negatives, leaks, licenses, maxent, preferences, quality_votes, repeats, token_files, url_rules, warc_derivatives

#: Vocabulary files are named here and read where they lie.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
#: The pages don't tell when they were captured.
CAPTURED = "2024-01-01T00:00:00Z"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents").select("doc_id", "text")


def op1_curve_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = curve_packing.packed(_documents(spark, folder), WORD_BPE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.read_digests(token_files.write_files(_documents(spark, folder), BYTE_BPE))


def op3_maxent(spark: SparkSession, folder: str) -> DataFrame:
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    found = maxent.scored(_documents(spark, folder), held)
    return found.withColumnRenamed("id", "doc_id")


def op4_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licensed(_documents(spark, folder))


def op5_preferences(spark: SparkSession, folder: str) -> DataFrame:
    pairs = preferences.preference_pairs(preferences.swapped_replies(_table(spark, folder, "conversations")))
    return pairs.withColumn("chosen_spans", preferences.spans_text("chosen_spans")).withColumn("rejected_spans", preferences.spans_text("rejected_spans"))


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.without_repeats(_documents(spark, folder)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_quality_votes(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_votes.judged(_documents(spark, folder))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("quality", 6).alias("quality"))


def op8_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    return warc_derivatives.derivatives(warc_derivatives.responses_of(_table(spark, folder, "pages"), CAPTURED))


def op9_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    found = fingerprints.near_copies(_documents(spark, folder))
    return found.select(F.col("id").alias("doc_id"), fingerprints.hexadecimal().alias("fingerprint"), F.col("component").alias("component_id"))


def op10_leaks(spark: SparkSession, folder: str) -> DataFrame:
    found = leaks.leaked(_documents(spark, folder), _table(spark, folder, "benchmark"))
    return found.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).drop("text", "spans", "items")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(_table(spark, folder, "embeddings").select("vec_id", "label", "embedding"), F.col("vec_id") % 100 == 0, label)


def op12_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    index = url_rules.build(url_rules.rule_table(spark, url_rules.RULES))
    return url_rules.judged(_table(spark, folder, "pages").select("page_id", "url"), index).drop("url")


def op13_aligned_tokens(spark: SparkSession, folder: str) -> DataFrame:
    found = aligned_tokens.aligned(_documents(spark, folder), BYTE_BPE, PIECE_BPE)
    return found.withColumn("groups_sha256", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")).drop("groups")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query of the subpackage by name."""
    import corpus_pipeline

    own = (
        op1_curve_packing,
        op2_token_files,
        op3_maxent,
        op4_licenses,
        op5_preferences,
        op6_substring_dedup,
        op7_quality_votes,
        op8_warc_derivatives,
        op9_near_copies,
        op10_leaks,
        op11_hard_negatives,
        op12_url_rules,
        op13_aligned_tokens,
    )
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """SQL twins, where SQL can say it; the others are tested against plain versions."""
    return {"op5_preferences": preferences.ORACLE_SQL, "op11_hard_negatives": hard_negatives.ORACLE_SQL, "op12_url_rules": url_rules.ORACLE_SQL}
