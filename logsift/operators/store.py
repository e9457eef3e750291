"""The log store and the match-result store as DataFrame transforms.

logs:          log_id (key), source, timestamp, content, processed
regex_results: log_id, regex_id, line_number, match, line_content

The reference keeps these in a relational database. Here each maintenance
step is a transform that returns the new table; ``write_table`` persists it.
Rewrites that touch few keys first split the store by a broadcast key set
(checked size) so untouched rows are scanned, not shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.patterns import MAX_REGEX_ID_LENGTH
from .joins import MAX_BROADCAST_KEYS, at_most, key_set, semi_join_keys
from .skew import HOT_KEY_ROWS, hot_keys, salted_join

MAX_LOG_ID_LENGTH = 255
DEFAULT_SOURCE = "unknown"

# FIXED VALUES: reject reasons, in the order constraints are checked.
REASON_NULL_LOG_ID = "log_id is null"
REASON_NULL_REGEX_ID = "regex_id is null"
REASON_NULL_LINE_NUMBER = "line_number is null"
REASON_NULL_MATCH = "match is null"
REASON_LONG_REGEX_ID = "regex_id longer than 50"
REASON_LONG_LOG_ID = "log_id longer than 255"
REASON_UNKNOWN_LOG = "log_id not in logs"
REASON_LONG_SOURCE = "source longer than 255"

# Columns that spread one log's result rows over salts.
RESULT_SALT_COLS = ["regex_id", "line_number", "match"]


def results_rows(matches: DataFrame) -> DataFrame:
    """Match rows in the result store's shape: ``regexId`` -> ``regex_id``,
    ``matched_text`` -> ``match``, ``line_content`` is the cleaned line
    (``''`` when absent)."""
    line = F.col("line_content") if "line_content" in matches.columns else F.col("matched_text")
    extra = [c for c in matches.columns if c not in ("log_id", "regexId", "line_number", "matched_text", "line_content")]
    return matches.select(
        "log_id",
        F.col("regexId").alias("regex_id"),
        "line_number",
        F.col("matched_text").alias("match"),
        F.coalesce(line, F.lit("")).alias("line_content"),
        *extra,
    )


def check_results(results: DataFrame, logs: DataFrame, hot_key_rows: int | None = HOT_KEY_ROWS) -> DataFrame:
    """Result rows with ``reject_reason`` (null when the row satisfies every
    constraint of the result store: not-null columns, id lengths, and the
    foreign key to ``logs``). The distinct ids of the results are joined to those of
    the logs; the ids that no log has are broadcast to the results where they are
    few, so the results are not shuffled. Else the results are joined on ``log_id``,
    and a log id holding very many of them is salted across tasks."""
    reason = (
        F.when(F.col("log_id").isNull(), F.lit(REASON_NULL_LOG_ID))
        .when(F.col("regex_id").isNull(), F.lit(REASON_NULL_REGEX_ID))
        .when(F.col("line_number").isNull(), F.lit(REASON_NULL_LINE_NUMBER))
        .when(F.col("match").isNull(), F.lit(REASON_NULL_MATCH))
        .when(F.length("regex_id") > MAX_REGEX_ID_LENGTH, F.lit(REASON_LONG_REGEX_ID))
        .when(F.length("log_id") > MAX_LOG_ID_LENGTH, F.lit(REASON_LONG_LOG_ID))
    )
    known = logs.select("log_id").distinct().withColumn("_known", F.lit(True))
    checked = results.withColumn("reject_reason", reason)
    asked = results.select("log_id").filter(F.col("log_id").isNotNull()).distinct()
    unknown = asked.join(known, "log_id", "left_anti").withColumn("_unknown", F.lit(True))
    if not results.isStreaming and at_most(unknown, MAX_BROADCAST_KEYS):
        return (
            checked.join(F.broadcast(unknown), "log_id", "left")
            .withColumn("reject_reason", F.coalesce("reject_reason", F.when(F.col("_unknown"), F.lit(REASON_UNKNOWN_LOG))))
            .drop("_unknown")
        )
    hot = hot_keys(checked, "log_id", hot_key_rows)
    return (
        salted_join(checked, known, "log_id", "left", RESULT_SALT_COLS, hot)
        .withColumn(
            "reject_reason",
            F.coalesce(
                "reject_reason",
                F.when(F.col("_known").isNull(), F.lit(REASON_UNKNOWN_LOG)),
            ),
        )
        .drop("_known")
    )


def results_accepted(results: DataFrame, logs: DataFrame) -> DataFrame:
    return check_results(results, logs).filter(F.col("reject_reason").isNull()).drop("reject_reason")


def results_rejected(results: DataFrame, logs: DataFrame) -> DataFrame:
    return check_results(results, logs).filter(F.col("reject_reason").isNotNull())


def cascade_delete(
    logs: DataFrame,
    results: DataFrame,
    deleted_ids: DataFrame,
    max_broadcast_keys: int | None = MAX_BROADCAST_KEYS,
    hot_key_rows: int | None = HOT_KEY_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Delete logs by id; their results go with them. Returns the surviving
    (logs, results)."""
    ids, small = key_set(deleted_ids, "log_id", max_broadcast_keys)
    if small:
        kept = semi_join_keys(results, ids, "log_id", small, how="left_anti")
    else:
        kept = salted_join(results, ids, "log_id", "left_anti", RESULT_SALT_COLS, hot_keys(results, "log_id", hot_key_rows))
    return semi_join_keys(logs, ids, "log_id", small, how="left_anti"), kept


def mark_processed(logs: DataFrame, results: DataFrame, max_broadcast_keys: int | None = None) -> DataFrame:
    """Every log with at least one result gets ``processed = TRUE``; others
    keep their flag; result ids without a log change nothing.

    For a batch of results (a micro-batch) pass ``max_broadcast_keys``: the
    distinct ids are counted and, under the bound, broadcast so the store is
    only scanned. By default (results of a whole table) the join shuffles,
    with the ids pre-aggregated map-side; counting first would run the
    results' whole lineage twice."""
    ids, small = key_set(results, "log_id", max_broadcast_keys)
    hit = ids.withColumn("_hit", F.lit(True))
    return (
        logs.join(F.broadcast(hit) if small else hit, "log_id", "left")
        .withColumn("processed", F.when(F.col("_hit"), F.lit(True)).otherwise(F.col("processed")))
        .select(*logs.columns)
    )


def check_writes(writes: DataFrame) -> DataFrame:
    """``writes`` plus ``reject_reason``: null for those that ``upsert_logs``
    stores, else why the log table cannot hold the id or the source."""
    reason = (
        F.when(F.col("log_id").isNull(), F.lit(REASON_NULL_LOG_ID))
        .when(F.length("log_id") > MAX_LOG_ID_LENGTH, F.lit(REASON_LONG_LOG_ID))
        .when(F.length("source") > MAX_LOG_ID_LENGTH, F.lit(REASON_LONG_SOURCE))
    )
    return writes.withColumn("reject_reason", reason)


def upsert_logs(
    store: DataFrame, writes: DataFrame, max_broadcast_keys: int | None = MAX_BROADCAST_KEYS
) -> DataFrame:
    """Insert-or-update logs by ``log_id``, in the order of ``writes.seq``.

    A new id is inserted from its first write (source defaults to
    ``'unknown'``, processed false); every later write, and every write to an
    existing id, replaces only ``content`` (null included). ``source``,
    ``timestamp`` and ``processed`` keep their first values, so an updated,
    processed log is not queued again. A new log without a timestamp gets the
    time of writing. Writes that ``check_writes`` rejects are dropped.

    The store splits into untouched rows (anti-join, passed through without
    a shuffle when the written ids are few enough to broadcast) and touched
    rows, which are merged with their writes by one aggregate per id whose
    partial step combines a hot id's writes map-side.
    """
    now = F.current_timestamp().cast("timestamp_ntz")
    w = check_writes(writes).filter(F.col("reject_reason").isNull()).select(
        "log_id",
        F.coalesce("source", F.lit(DEFAULT_SOURCE)).alias("source"),
        F.coalesce("timestamp", now).alias("timestamp"),
        "content",
        F.lit(False).alias("processed"),
        F.struct(F.lit(1).alias("origin"), F.col("seq").cast("long").alias("seq")).alias("_order"),
    )
    ids, small = key_set(w, "log_id", max_broadcast_keys)
    untouched = semi_join_keys(store, ids, "log_id", small, how="left_anti")
    touched = semi_join_keys(store, ids, "log_id", small, how="left_semi").select(
        "log_id",
        "source",
        "timestamp",
        "content",
        "processed",
        F.struct(F.lit(0).alias("origin"), F.lit(0).cast("long").alias("seq")).alias("_order"),
    )
    merged = (
        touched.unionByName(w)
        .groupBy("log_id")
        .agg(
            F.min_by(F.struct("source", "timestamp", "processed"), "_order").alias("first"),
            F.max_by("content", "_order").alias("content"),
        )
        .select("log_id", "first.source", "first.timestamp", "content", "first.processed")
    )
    return untouched.select(*merged.columns).unionByName(merged)
