"""Outbound records and per-batch metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import match as M
from .joins import MAX_BROADCAST_KEYS

PAYLOAD_FIELDS = ("regexId", "log_id", "line_number", "matched_text")


def kafka_payload(matches: DataFrame) -> DataFrame:
    """``value``: JSON of ``regexId, log_id, line_number, matched_text`` in
    that order (null fields omitted). No key."""
    return matches.select(F.to_json(F.struct(*PAYLOAD_FIELDS)).alias("value"))


def batch_metrics(lookup: DataFrame, lines: DataFrame, matches: DataFrame) -> DataFrame:
    """One row of batch counts: ``fetched`` lookup rows, ``valid`` contents,
    ``cleaned_lines``, ``matches``. Each count is its own aggregate pass;
    combined with scalar subqueries."""
    n_lines = lines.select(F.count(F.lit(1))).scalar()
    n_matches = matches.select(F.count(F.lit(1))).scalar()
    return lookup.agg(
        F.count(F.lit(1)).alias("fetched"),
        F.count("content").alias("valid"),
    ).select("fetched", "valid", n_lines.alias("cleaned_lines"), n_matches.alias("matches"))


def batch_metrics_single_pass(
    requests: DataFrame, store: DataFrame, patterns=None, max_broadcast_keys: int | None = MAX_BROADCAST_KEYS
) -> DataFrame:
    """``batch_metrics`` for a batch of requested ids in one pass over the
    lines. Requests are counted per id and joined to the found logs once;
    each cleaned line carries its id's request count, so ``cleaned_lines``
    counts a line once per request while ``matches`` counts it once (the
    match rows of a batch are deduplicated). Matching ids per line are a sum
    of 0/1 predicates, which stays in generated code."""
    from ..sources.patterns import Pattern, catalogue
    from .lines import clean_lines
    from .lookup import found_logs

    pats = list(patterns) if patterns and all(isinstance(p, Pattern) for p in patterns) else catalogue(patterns)
    req = requests.groupBy("log_id").agg(F.count(F.lit(1)).alias("_n"))
    found = found_logs(req, store, max_broadcast_keys)
    per_id = req.join(found, "log_id", "left")
    head = per_id.agg(
        F.sum("_n").alias("fetched"),
        F.sum(F.when(F.col("content").isNotNull(), F.col("_n")).otherwise(F.lit(0))).alias("valid"),
    )
    hits = sum(F.when(pred, F.lit(1)).otherwise(F.lit(0)) for _, pred in M.id_predicates("cleaned_line", pats))
    lines = clean_lines(per_id, carry=("_n",)).select("_n", hits.alias("_k"))
    tail = lines.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("cleaned_lines"),
        F.coalesce(F.sum("_k"), F.lit(0)).cast("long").alias("matches"),
    )
    both = tail.select(F.struct("cleaned_lines", "matches")).scalar()
    return head.select("fetched", "valid", both["cleaned_lines"].alias("cleaned_lines"), both["matches"].alias("matches"))

