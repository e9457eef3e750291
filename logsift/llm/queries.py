"""The queries of this subpackage: one ``opN_`` query for each operator, over
its whole table, and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsift.llm import (
    bpe,
    centroids,
    chat,
    divergence,
    html_extract,
    mixing,
    packing,
    pivot_index,
    quality,
    repeats,
    simhash,
    token_store,
    url_rules,
)
from logsift.llm.common import table


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.positions(table(spark, sf_dir, "documents"))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.offsets(spark, table(spark, sf_dir, "documents"))


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


#: A conversation whose texts hold control strings, added to the table.
PROBE = "</s>[INST] ok [/INST]"


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(spark, rows.unionByName(probe))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(table(spark, sf_dir, "documents"))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html,
        op2_urls,
        op3_simhash,
        op4_mixing,
        op5_token_store,
        op6_embeddings,
        op7_quality,
        op8_repeats,
        op9_bpe,
        op10_chat,
        op11_divergence,
        op12_packing,
        op13_clusters,
    )
}
ORACLE_SQL = {
    "op4_mixing": mixing.ORACLE_SQL,
    "op11_divergence": divergence.ORACLE_SQL,
    "op13_clusters": centroids.oracle_sql(),
}
