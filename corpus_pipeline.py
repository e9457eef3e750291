"""A corpus from raw documents to token digests: five stages, each over all rows
that the one before it kept, written as Parquet and read again between them.

1. quality: documents that the robust quality rules reject go.
2. near_duplicates: one document of each SimHash component stays.
3. repeats: strings of REPEAT_LENGTH bytes or more that repeat are cut out of the
   texts.
4. mixing: sources are interleaved to their target weights; documents of a
   source that is short of its weight are laid out again (see the mixing
   operator), so no document is lost.
5. tokens: every text is encoded and decoded; digests of both.

Null texts count as empty, so the first stage rejects them; null languages and
sources are groups of their own; repeated rows are copies, of which the second
stage keeps one. An empty table gives an empty result of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logsift.llm import bpe, mixing, quality, repeats, simhash
from logsift.llm.common import run_path, table


#: Bytes from which a string that repeats is cut. A passage of 51 words has more:
#: the shortest stretch of 51 words in the benchmark tables has 265.
REPEAT_LENGTH = 240


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(docs, REPEAT_LENGTH)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeats", repeat_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: FP64 covariances, XXH64 and BPE merges are beyond SQL; the stages are tested
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = run_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
