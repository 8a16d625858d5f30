"""The registered queries of the operators, one for each, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veritrail.llm import ann, html_extract, lm_scoring, mixing, oracles, packing, phrases, quality, runs, sharding, simhash, suffix_dedup, token_store, url_filter
from veritrail.llm.common import table, tokenizer_path


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_store.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return token_store.read_tokens(spark, path)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats_report(table(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.runs_report(table(spark, sf_dir, "documents"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_output, op2_quality_rules, op3_html_extraction, op4_simhash, op5_suffix_dedup, op6_nearest_neighbours, op7_url_filter, op8_source_mixing, op9_best_fit_packing, op10_lm_scoring,
        op11_sharding, op12_periodic_runs, op13_phrase_mining,
    )
}
ORACLES: dict[str, str] = oracles.ORACLES
