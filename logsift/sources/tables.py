"""Table scans. Reads are lazy and untyped by us: Catalyst prunes columns and
pushes filters into the Parquet scan."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..operators.partitioning import spread

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Store schemas (the log store and the match-result store).
LOGS_SCHEMA = "log_id string, source string, timestamp timestamp_ntz, content string, processed boolean"
RESULTS_SCHEMA = "log_id string, regex_id string, line_number int, match string, line_content string"


# Declared schemas of the supplied tables this library reads (never
# inferred: no footer-reading job per scan).
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str, spread_small: bool = True) -> DataFrame:
    """One supplied table. A scan with fewer partitions than the cluster has
    cores is spread round-robin first (see ``operators.partitioning``)."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    df = reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(df) if spread_small else df


def read_store(spark: SparkSession, path: str, schema: str = LOGS_SCHEMA) -> DataFrame:
    """A store written by ``logsift.operators.store`` (Parquet, declared
    schema, never inferred)."""
    return spark.read.schema(schema).parquet(path)
