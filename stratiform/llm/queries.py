"""One production query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm import alignment, bestfit, filter_audit, fingerprint, jaccard, language, licences, mixing, naming, packing, suffixes, superkmers, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def token_file(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer file the queries use; installed on every node."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op1_toxicity_crf")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op2_multiset_fingerprint")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_check(documents(spark, sf_dir))


@query("op3_jaccard_regions")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir))


@query("op4_super_kmers")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmers.remove_repeated_words(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op5_source_mixing", mixing.oracle())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


@query("op6_concatenate_and_cut")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.concatenate_and_cut(documents(spark, sf_dir), token_file()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op7_suffix_array")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeated_bytes(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256")
    )


@query("op8_cross_parsing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


@query("op9_best_fit_rows")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.packed_rows(documents(spark, sf_dir), token_file()).select(
        "shard", "row", "n_tokens", F.crc32("input_ids").alias("ids_crc32"), F.crc32("position_ids").alias("positions_crc32"), "cu_seqlens", "doc_ids", "doc_starts"
    )


@query("op10_block_naming", naming.ORACLE)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.exact_groups(documents(spark, sf_dir))


@query("op11_pointer_jumping")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return alignment.align_tokens(documents(spark, sf_dir), token_file("byte_bpe_50k.json"), token_file("piece_bpe_32k.model"), groups=digest).withColumnRenamed("groups", "groups_sha256")


@query("op12_filter_audit", filter_audit.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op13_rare_word_licences", licences.oracle())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(documents(spark, sf_dir)).drop("places")
