"""Read-side views of the stores: pending logs, results per log, the error
view and the ``get_log_matches`` table function."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.patterns import ERROR_REGEX_ID
from .joins import MAX_BROADCAST_KEYS, key_set, semi_join_keys
from .skew import HOT_KEY_ROWS, hot_keys, salted_join
from .store import RESULT_SALT_COLS

PENDING_LIMIT = 100


def pending_logs(logs: DataFrame, limit: int = PENDING_LIMIT) -> DataFrame:
    """Ids of the newest unprocessed logs (``processed = FALSE``, newest
    first, ties by id). A distributed top-k: each task keeps its best
    ``limit`` rows and one merge picks the final ones."""
    return (
        logs.filter(F.col("processed") == F.lit(False))
        .orderBy(F.desc("timestamp"), F.asc("log_id"))
        .limit(limit)
        .select("log_id")
    )


def results_for_log(results: DataFrame, log_id: str) -> DataFrame:
    """One log's results ordered by line then id (``GET /results/<id>``)."""
    return (
        results.filter(F.col("log_id") == F.lit(log_id))
        .select("regex_id", "line_number", "match", "line_content")
        .orderBy("line_number", "regex_id")
    )


def results_for_logs(
    results: DataFrame,
    ids: DataFrame,
    max_broadcast_keys: int | None = MAX_BROADCAST_KEYS,
    hot_key_rows: int | None = HOT_KEY_ROWS,
) -> DataFrame:
    """``results_for_log`` for a set of ids at once: the results of every
    requested log, ordered by log, line, id."""
    keys, small = key_set(ids, "log_id", max_broadcast_keys)
    if small:
        hit = semi_join_keys(results, keys, "log_id", small)
    else:
        hit = salted_join(results, keys, "log_id", "left_semi", RESULT_SALT_COLS, hot_keys(results, "log_id", hot_key_rows))
    return (
        hit.select("log_id", "regex_id", "line_number", "match", "line_content")
        .orderBy("log_id", "line_number", "regex_id")
    )


def error_logs(
    logs: DataFrame, results: DataFrame, regex_id: str = ERROR_REGEX_ID, hot_key_rows: int | None = HOT_KEY_ROWS
) -> DataFrame:
    """Results of one pattern id joined to their log's source and timestamp,
    newest log first. The filter reaches the results scan; only the three
    small log columns take part in the join, never the content. A log with
    very many error rows is salted across tasks."""
    r = results.filter(F.col("regex_id") == F.lit(regex_id)).select("log_id", "line_number", "match", "line_content")
    lg = logs.select("log_id", "source", "timestamp")
    hot = hot_keys(r, "log_id", hot_key_rows)
    return (
        salted_join(r, lg, "log_id", "inner", ["line_number", "match"], hot)
        .select("log_id", "source", "timestamp", "line_number", "match", "line_content")
        .orderBy(F.desc("timestamp"), F.asc("line_number"), F.asc("log_id"), F.asc("match"))
    )


def register_sql(spark: SparkSession, logs: DataFrame, results: DataFrame, prefix: str = "") -> None:
    """Expose the stores to SQL: views ``logs``, ``regex_results``,
    ``error_logs`` and the table function ``get_log_matches(log_id)``."""
    logs.createOrReplaceTempView(f"{prefix}logs")
    results.createOrReplaceTempView(f"{prefix}regex_results")
    error_logs(logs, results).createOrReplaceTempView(f"{prefix}error_logs")
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {prefix}get_log_matches(log_id_param STRING)
        RETURNS TABLE (regex_id STRING, line_number INT, match STRING, line_content STRING)
        RETURN SELECT r.regex_id, r.line_number, r.match, r.line_content
               FROM {prefix}regex_results r
               WHERE r.log_id = log_id_param
               ORDER BY r.line_number
        """
    )


def log_content_sql(spark: SparkSession, log_id: str, prefix: str = "") -> DataFrame:
    """``GET /logs/<id>`` as parameterised SQL over the registered views (the
    id is bound, never pasted into the text). No row when the id is unknown."""
    return spark.sql(f"SELECT log_id, content FROM {prefix}logs WHERE log_id = :id", args={"id": log_id})


def results_for_log_sql(spark: SparkSession, log_id: str, prefix: str = "") -> DataFrame:
    """``GET /results/<id>`` as parameterised SQL over the registered views."""
    return spark.sql(
        f"SELECT regex_id, line_number, match, line_content FROM {prefix}regex_results "
        "WHERE log_id = :id ORDER BY line_number, regex_id",
        args={"id": log_id},
    )

