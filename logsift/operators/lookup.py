"""Event decoding and the bulk content lookup.

The reference collects each micro-batch's ids to the driver and asks the
store with an ``IN (...)`` list. Here the ids stay a DataFrame and the
lookup is a join, so nothing passes through the driver:

1. requests counted per id (map-side pre-aggregation: copies of a hot id are
   one row per task);
2. ``found = store ⋉ ids``, a semi-join that broadcasts the id set when a
   count proved it small, so the store is scanned but not shuffled;
3. ``counts ⟕ found``: unique keys on both sides, so no key is hot; then each
   id's row is repeated once per request (``skew.expand_counts``).

A found log with null content has no status; a missing id has null content
and ``status = 'not_found'`` (told apart by a marker column, not by null
content).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.stores import BUCKET_COL, POINT_IDS, StoreTable, bucket_profile, prune_to_buckets
from .joins import MAX_BROADCAST_KEYS, key_set, semi_join_keys
from .skew import expand_counts

# Schema of an event message value (all strings; only log_id is used).
EVENT_SCHEMA = "log_id string, timestamp string, source string"
NOT_FOUND = "not_found"


def decode_events(envelope: DataFrame, value_col: str = "value") -> DataFrame:
    """Kafka-style envelope -> ``log_id``. Malformed JSON and missing, null or
    empty ids are dropped; ``' '`` is kept (no trimming)."""
    data = F.from_json(F.col(value_col).cast("string"), EVENT_SCHEMA)
    return (
        envelope.select(data.alias("data"))
        .select(F.col("data.log_id").alias("log_id"))
        .filter(F.col("log_id").isNotNull() & (F.col("log_id") != ""))
    )


# FIXED VALUES: why an event message names no log.
REASON_NULL_VALUE = "value is null"
REASON_NOT_JSON = "not a JSON object"
REASON_NO_LOG_ID = "log_id is missing or null"
REASON_EMPTY_LOG_ID = "log_id is empty"


def check_events(envelope: DataFrame, value_col: str = "value", carry: tuple[str, ...] = ()) -> DataFrame:
    """``log_id, value, reject_reason`` of every event message: the reason is null
    for those that ``decode_events`` keeps. The parser keeps the text of a broken
    record, which tells it from an object without a log_id."""
    text = F.col(value_col).cast("string")
    data = F.from_json(text, f"{EVENT_SCHEMA}, _broken string", {"columnNameOfCorruptRecord": "_broken"})
    log_id = F.col("data.log_id")
    reason = (
        F.when(F.col("value").isNull(), F.lit(REASON_NULL_VALUE))
        .when(F.col("data").isNull() | F.col("data._broken").isNotNull(), F.lit(REASON_NOT_JSON))
        .when(log_id.isNull(), F.lit(REASON_NO_LOG_ID))
        .when(log_id == "", F.lit(REASON_EMPTY_LOG_ID))
    )
    parsed = envelope.select(text.alias("value"), data.alias("data"), *carry)
    return parsed.select(log_id.alias("log_id"), "value", reason.alias("reject_reason"), *carry)


def rejected_events(envelope: DataFrame, value_col: str = "value", carry: tuple[str, ...] = ()) -> DataFrame:
    """``value, reject_reason`` of the messages that name no log. The reference
    drops them without a trace."""
    checked = check_events(envelope, value_col, carry)
    return checked.filter(F.col("reject_reason").isNotNull()).select("value", "reject_reason", *carry)


def found_logs(
    request_ids: DataFrame,
    store: DataFrame,
    max_broadcast_keys: int | None = MAX_BROADCAST_KEYS,
    bucket_count: int | None = None,
) -> DataFrame:
    """Store rows (``log_id, content``) for the requested ids, one per id.

    ``store`` is a DataFrame or a bucketed ``StoreTable``. For a table only
    the buckets the ids fall in are listed and read; for a DataFrame of a
    bucketed store pass its ``bucket_count`` to prune its partitions."""
    if isinstance(store, StoreTable):
        # One aggregation gives the touched buckets and the id count.
        buckets, n_ids = bucket_profile(request_ids, bucket_count or store.bucket_count)
        ids = request_ids.select("log_id").filter(F.col("log_id").isNotNull()).distinct()
        small = max_broadcast_keys is not None and n_ids <= max_broadcast_keys
        table = store.read_buckets(request_ids.sparkSession, buckets)
        if n_ids <= POINT_IDS:
            # Few ids: as values they choose row groups and pages in the reader.
            table = table.filter(F.col("log_id").isin([r.log_id for r in ids.collect()]))
        return semi_join_keys(table.select("log_id", "content"), ids, "log_id", small)
    ids, small = key_set(request_ids, "log_id", max_broadcast_keys)
    if bucket_count and BUCKET_COL in store.columns:
        store = prune_to_buckets(store, ids, bucket_count)
    return semi_join_keys(store.select("log_id", "content"), ids, "log_id", small)


def bulk_lookup(
    requests: DataFrame,
    store: DataFrame,
    max_broadcast_keys: int | None = MAX_BROADCAST_KEYS,
    bucket_count: int | None = None,
) -> DataFrame:
    """``log_id, content, status``: one row per requested id, in no order.

    Copies of an id are counted map-side first, the lookup joins unique keys
    to unique keys, and the copies are restored at the end (a heavily
    repeated id is expanded in chunks over many tasks)."""
    req = requests.groupBy("log_id").agg(F.count(F.lit(1)).alias("_n"))
    found = found_logs(req, store, max_broadcast_keys, bucket_count).withColumn("_found", F.lit(True))
    joined = req.join(found, "log_id", "left").select(
        "log_id",
        "content",
        F.when(F.col("_found").isNull(), F.lit(NOT_FOUND)).alias("status"),
        "_n",
    )
    return expand_counts(joined, "_n", "log_id")


def not_found_ids(lookup: DataFrame) -> DataFrame:
    """The quarantine side of a lookup: requested ids the store lacks."""
    return lookup.filter(F.col("status") == NOT_FOUND).select("log_id")


def log_by_id(store: DataFrame, ids: DataFrame, max_broadcast_keys: int | None = MAX_BROADCAST_KEYS) -> DataFrame:
    """Content of each requested log that exists (``GET /logs/<id>`` for a
    set of ids; unknown ids have no row)."""
    return found_logs(ids, store, max_broadcast_keys)
