"""Registered queries of the subpackage: thin reads of the tables around each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from headway.llm import ads_search, collocations, conversation_repair, decontaminate, hmm, line_dedup, mixing, ngram_quality, order_minhash, sharding, suffix_dedup, template_extraction, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_adaptive_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads_search.search(table(spark, sf_dir, "embeddings"))


def op2_ngram_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_warc_gzip_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(spark, table(spark, sf_dir, "pages"))


def op4_seed_align_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.hmm_scores(table(spark, sf_dir, "documents"))


def op6_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_extraction.extract_main_text(table(spark, sf_dir, "pages"))


def op7_byte_prefix_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.byte_prefix_shards(table(spark, sf_dir, "documents"))


def op8_order_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_suffix_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op10_budget_prefix_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.budget_prefix_mix(table(spark, sf_dir, "documents")).drop("source")


def op11_auction_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.conversation_repair(table(spark, sf_dir, "conversations"))


def op12_misra_gries_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_adaptive_dimension_scan,
        op2_ngram_ftrl_quality,
        op3_warc_gzip_normalise,
        op4_seed_align_decontamination,
        op5_hmm_scoring,
        op6_template_extraction,
        op7_byte_prefix_shards,
        op8_order_minhash_dedup,
        op9_suffix_tree_dedup,
        op10_budget_prefix_mix,
        op11_auction_conversation_repair,
        op12_misra_gries_collocations,
        op13_line_dedup,
    )
}

#: DuckDB SQL where SQL can express the operator.
ORACLES: dict[str, str] = {
    "op3_warc_gzip_normalise": warc.ORACLE_WARC,
    "op9_suffix_tree_dedup": suffix_dedup.ORACLE_SUFFIX,
    "op10_budget_prefix_mix": mixing.ORACLE_MIX,
    "op11_auction_conversation_repair": conversation_repair.ORACLE_REPAIR,
    "op12_misra_gries_collocations": collocations.ORACLE_COLLOCATIONS,
    "op13_line_dedup": line_dedup.ORACLE_LINES,
}
