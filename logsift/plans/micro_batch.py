"""One batch of requested log ids, end to end:

    ids -> lookup (semi-join to the store) -> lines -> clean -> match
        -> match rows, result rows, not-found quarantine

Used by the streaming job for each micro-batch and by batch mode. Each
output is a lazy DataFrame; sinks decide what to materialise.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import lines, lookup, matching, store
from ..operators.joins import MAX_BROADCAST_KEYS


@dataclass
class BatchOutputs:
    found: DataFrame  # log_id, content for requested ids that exist
    matches: DataFrame  # regexId, log_id, line_number, matched_text
    results: DataFrame  # result-store shape
    not_found: DataFrame  # requested ids missing from the store
    observations: dict = field(default_factory=dict)  # name -> Observation

    def metrics(self) -> dict:
        """Counts observed while ``matches`` ran (call after the action)."""
        return {k: o.get.get("rows", 0) for k, o in self.observations.items()}


def process_ids(
    ids: DataFrame,
    logs_store: DataFrame,
    patterns=None,
    max_broadcast_keys: int | None = MAX_BROADCAST_KEYS,
    bucket_count: int | None = None,
    observe: bool = False,
) -> BatchOutputs:
    """Match the logs named by ``ids`` (column ``log_id``; duplicates allowed).

    The reference deduplicates match rows after the fact; here the id set is
    deduplicated before the lookup, which gives the same rows because the
    store holds one row per id.
    """
    found = plain_found = lookup.found_logs(ids, logs_store, max_broadcast_keys, bucket_count)
    obs = {}
    if observe:
        # Counted as a side effect of the one action that writes the matches
        # (the reference runs a separate count job for each).
        tag = uuid.uuid4().hex[:12]  # unique per batch: concurrent streams must not share names
        obs = {k: Observation(f"{k}_{tag}") for k in ("found", "cleaned_lines", "matches")}
        found = found.observe(obs["found"], F.count(F.lit(1)).alias("rows"))
        cleaned = lines.clean_lines(found).observe(obs["cleaned_lines"], F.count(F.lit(1)).alias("rows"))
        matches = matching.match_cleaned_lines(cleaned, patterns).observe(
            obs["matches"], F.count(F.lit(1)).alias("rows")
        )
    else:
        matches = matching.match_lines(found, patterns)
    # Missing ids: requested minus found. Both sides are bounded by the id
    # set, so no store-sized data is shuffled, and only the store's log_id
    # column is read for it.
    missing = (
        ids.select("log_id")
        .filter(F.col("log_id").isNotNull())
        .distinct()
        .join(plain_found.select("log_id"), "log_id", "left_anti")
    )
    return BatchOutputs(
        found=found, matches=matches, results=store.results_rows(matches), not_found=missing, observations=obs
    )


def batch_match(logs_store: DataFrame, patterns=None) -> DataFrame:
    """Batch mode: every log in the store, as result-store rows."""
    return store.results_rows(matching.match_lines(logs_store, patterns))


def batch_match_table(spark, logs: "StoreTable", out_path: str, patterns=None) -> "StoreTable":
    """Batch mode over a bucketed log store, written as a bucketed result
    store. Each scan task reads files of one bucket, so its result rows carry
    that bucket and are written under it directly: scan, match and write
    form one stage with no shuffle."""
    from ..sources.stores import BUCKET_COL, StoreTable
    from ..sources.tables import RESULTS_SCHEMA

    rows = store.results_rows(matching.match_lines(logs.read(spark), patterns, carry=(BUCKET_COL,)))
    rows.write.mode("overwrite").partitionBy(BUCKET_COL).parquet(out_path)
    return StoreTable(out_path, logs.bucket_count, RESULTS_SCHEMA)
