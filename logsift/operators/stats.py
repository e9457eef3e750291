"""Store statistics. Every aggregate is one pass with a map-side partial
step; the one-row record combines them with scalar subqueries (no cross
join)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stats(logs: DataFrame, results: DataFrame) -> DataFrame:
    """``total_logs, processed_logs, total_matches``."""
    total_matches = results.select(F.count(F.lit(1)).alias("total_matches")).scalar()
    return logs.agg(
        F.count(F.lit(1)).alias("total_logs"),
        F.count_if(F.col("processed")).alias("processed_logs"),
    ).select("total_logs", "processed_logs", total_matches.alias("total_matches"))


def matches_by_type(results: DataFrame) -> DataFrame:
    """``regex_id, n`` sorted by count descending (ties by id)."""
    return results.groupBy("regex_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc("regex_id"))


def stats_record(logs: DataFrame, results: DataFrame) -> DataFrame:
    """The full record: the three counts plus ``matches_by_type`` as a map.
    The map has one entry per id (a catalogue id, so as many as the catalogue)."""
    by_type = results.groupBy("regex_id").agg(F.count(F.lit(1)).alias("n"))
    # Entries sorted by id, so the map (and its JSON) is deterministic.
    as_map = by_type.select(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("regex_id", "n")))).alias("matches_by_type")
    ).scalar()
    return stats(logs, results).select("*", as_map.alias("matches_by_type"))


def stats_json(logs: DataFrame, results: DataFrame) -> DataFrame:
    """The stats record with ``matches_by_type`` as a JSON object, the shape
    the statistics endpoint returns."""
    rec = stats_record(logs, results)
    return rec.select("total_logs", "processed_logs", "total_matches", F.to_json("matches_by_type").alias("matches_by_type"))

