"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starmart.llm import (
    best_fit_packing, bpe_prefix, collocations, conversation_repair, decontaminate, exact_dedup, language_id, repair_ids, simhash_dedup, substring_dedup, suffix_array_dedup,
    tag_paths, viterbi_counts,
)
from starmart.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_repair_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_ids.write_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_html_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.extract(table(spark, sf_dir, "pages"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.cluster(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(table(spark, sf_dir, "documents"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, with the item and how similar they are."""
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "first_word")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_spans(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op9_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_prefix.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(table(spark, sf_dir, "conversations"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_repair_token_ids, op2_html_tag_paths, op3_simhash_near_dedup, op4_exact_dedup, op5_suffix_array_dedup,
        op6_benchmark_decontamination, op7_substring_dedup, op8_language_id, op9_bpe_encode_decode, op10_token_counts, op11_best_fit_packing,
        op12_conversation_repair, op13_phrase_collocations,
    )
}
