"""The registered query of each corpus operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerspark.llm import (
    htmltext,
    jaccard,
    licenses,
    mixing,
    nearest,
    packing,
    pii,
    quality,
    sharding,
    simhash,
    trie,
    urlfilter,
    whitening,
)
from layerspark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.draw(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_documents(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The contract asks for a long, which holds the deviation up to about a billion vectors.
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def registry() -> dict[str, Query]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_mix_sources": op2_mix_sources,
        "op3_personal_data": op3_personal_data,
        "op4_html_extraction": op4_html_extraction,
        "op5_quality_rules": op5_quality_rules,
        "op6_url_filters": op6_url_filters,
        "op7_nearest_neighbours": op7_nearest_neighbours,
        "op8_packing": op8_packing,
        "op9_simhash_near_dedup": op9_simhash_near_dedup,
        "op10_sharding": op10_sharding,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_ngram_join": op12_ngram_join,
        "op13_embedding_whitening": op13_embedding_whitening,
    }
