"""Store maintenance as jobs over versioned, bucketed tables.

The reference's write endpoints (create/update a log, store results and flag
their logs, delete a log with its results) become jobs over bucketed
tables. Upserts and processed flags rewrite only the buckets their ids fall
in (staged in the shared folder, then swapped in by dynamic partition
overwrite); results are appended; a delete writes a new version of both
stores into fresh directories. Each job's plan starts at files, so repeated
maintenance never builds a long lineage.

Statistics are kept as partial counts of each bucket: a job names the buckets it
changes, changes the stores, counts those buckets again and takes the names back.
``stored_stats`` adds the partial counts up and reads no store; buckets that an
interrupted job has left named are counted first.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import store as S
from ..operators.joins import MAX_BROADCAST_KEYS
from ..session import scratch_path
from ..sources.stores import (
    BUCKET_COL,
    DEFAULT_BUCKETS,
    StoreTable,
    append_bucketed,
    bucket_groups,
    buckets_of,
    drop_path,
    in_buckets,
    path_exists,
    rewrite_buckets,
    swap_buckets,
    write_bucketed,
    write_version,
    write_within_buckets,
)
from ..sources.tables import LOGS_SCHEMA, RESULTS_SCHEMA


@dataclass
class LogStores:
    """The log store and the result store under one base folder."""

    base: str
    logs: StoreTable
    results: StoreTable

    @classmethod
    def create(
        cls, base: str, logs: DataFrame, results: DataFrame, bucket_count: int = DEFAULT_BUCKETS
    ) -> "LogStores":
        lt = write_bucketed(logs.select(*_cols(LOGS_SCHEMA)), os.path.join(base, "logs", "v-initial"), bucket_count)
        rt = write_bucketed(
            results.select(*_cols(RESULTS_SCHEMA)),
            os.path.join(base, "results", "v-initial"),
            bucket_count,
            schema=RESULTS_SCHEMA,
        )
        stores = cls(base, lt, rt)
        count_buckets(logs.sparkSession, stores, list(range(bucket_count)))
        return stores

    def read_logs(self, spark: SparkSession) -> DataFrame:
        return self.logs.read(spark).drop("bucket")

    def read_results(self, spark: SparkSession) -> DataFrame:
        return self.results.read(spark).drop("bucket")

    def _next_logs(self, df: DataFrame) -> "LogStores":
        t = write_version(df, os.path.join(self.base, "logs"), self.logs.bucket_count, LOGS_SCHEMA)
        return LogStores(self.base, t, self.results)


def _cols(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(",")]


def post_logs(spark: SparkSession, stores: LogStores, writes: DataFrame, in_place: bool = True) -> LogStores:
    """Upsert a batch of log writes (``log_id, source, timestamp, content,
    seq``). In place, only the buckets the written ids fall in are rewritten;
    otherwise the whole store is written as a new version."""
    buckets = buckets_of(writes.filter("log_id IS NOT NULL"), stores.logs.bucket_count)
    named = name_buckets(spark, stores, buckets)
    if not in_place:
        stores = stores._next_logs(S.upsert_logs(stores.read_logs(spark), writes))
    else:
        rewrite_buckets(
            spark,
            stores.logs,
            buckets,
            lambda current: S.upsert_logs(current, writes).select(*_cols(LOGS_SCHEMA)),
            scratch_path(spark, "staging", "logs"),
        )
    count_buckets(spark, stores, buckets, named)
    return stores


def post_results(spark: SparkSession, stores: LogStores, batch: DataFrame) -> tuple[LogStores, DataFrame]:
    """Store a batch of result rows. Rows that satisfy the constraints are
    appended to the result store (new files only: results are append-only,
    as in the reference) and their logs are flagged processed (only their
    buckets are rewritten). The rejected rows, with a reason, are written to
    a quarantine table and returned."""
    # The batch is worked out once; all that follows reads it from files.
    taken = scratch_path(spark, "staging", "results")
    batch.select(*_cols(RESULTS_SCHEMA)).write.parquet(taken)
    batch = spark.read.schema(RESULTS_SCHEMA).parquet(taken)
    checked = S.check_results(batch, stores.read_logs(spark))
    accepted = checked.filter("reject_reason IS NULL").drop("reject_reason")
    rejected = checked.filter("reject_reason IS NOT NULL")
    buckets = buckets_of(accepted.select("log_id"), stores.logs.bucket_count)
    named = name_buckets(spark, stores, buckets)
    append_bucketed(accepted.select(*_cols(RESULTS_SCHEMA)), stores.results)
    # Rejects go to a quarantine table before the logs change underneath.
    quarantine = scratch_path(spark, "quarantine", "results")
    rejected.write.parquet(quarantine)
    rejected = spark.read.schema(f"{RESULTS_SCHEMA}, reject_reason string").parquet(quarantine)
    # Flag the logs of this batch: only their buckets are rewritten.
    flag_logs(spark, stores, buckets)
    count_buckets(spark, stores, buckets, named)
    return stores, rejected


def flag_logs(spark: SparkSession, stores: LogStores, buckets: list[int]) -> None:
    """Flag the logs of ``buckets`` that have results, some buckets at a time: as many
    as have ids that may be broadcast, so no content is shuffled."""
    count = stores.logs.bucket_count
    staged = StoreTable(scratch_path(spark, "staging", "logs"), count)
    hits = stores.results.read_buckets(spark, buckets).select("log_id")
    for group in bucket_groups(hits, count, MAX_BROADCAST_KEYS):
        current = stores.logs.read_buckets(spark, group)
        of = stores.results.read_buckets(spark, group)
        write_within_buckets(S.mark_processed(current, of, MAX_BROADCAST_KEYS), staged.path)
    swap_buckets(spark, stores.logs, staged)


def delete_logs(spark: SparkSession, stores: LogStores, ids: DataFrame) -> LogStores:
    """Delete logs by id; their results go with them."""
    buckets = buckets_of(ids.filter("log_id IS NOT NULL"), stores.logs.bucket_count)
    named = name_buckets(spark, stores, buckets)
    count = stores.logs.bucket_count
    fresh = [os.path.join(stores.base, name, f"v-{uuid.uuid4().hex}") for name in ("logs", "results")]
    # Rows stay in their buckets, and only the ids of some buckets at a time are needed.
    for group in bucket_groups(ids, count, MAX_BROADCAST_KEYS, every=True):
        olds = [t.read_buckets(spark, group) for t in (stores.logs, stores.results)]
        for rows, path in zip(S.cascade_delete(*olds, in_buckets(ids, count, group)), fresh, strict=True):
            write_within_buckets(rows, path)
    stores = LogStores(stores.base, StoreTable(fresh[0], count), StoreTable(fresh[1], stores.results.bucket_count, RESULTS_SCHEMA))
    count_buckets(spark, stores, buckets, named)
    return stores


# --- statistics ---------------------------------------------------------------

#: Partial counts of a bucket: of its logs (``regex_id`` null) and of its results.
PARTIAL_SCHEMA = "regex_id string, n long, processed long"


def _stats_path(stores: LogStores, *parts: str) -> str:
    return os.path.join(stores.base, "stats", *parts)


def name_buckets(spark: SparkSession, stores: LogStores, buckets: list[int]) -> str:
    """Write down that the counts of ``buckets`` are about to change."""
    path = _stats_path(stores, "named", uuid.uuid4().hex)
    spark.createDataFrame([(b,) for b in buckets], f"{BUCKET_COL} int").coalesce(1).write.parquet(path)
    return path


def count_buckets(spark: SparkSession, stores: LogStores, buckets: list[int], named: str | None = None) -> None:
    """Count ``buckets`` again, replace their partial counts and take back that
    they were named. Each bucket has a row of its logs, so an empty one is replaced
    as well."""
    every = spark.createDataFrame([(b,) for b in buckets], f"{BUCKET_COL} int")
    of_logs = (
        stores.logs.read_buckets(spark, buckets)
        .groupBy(BUCKET_COL)
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("processed").alias("processed"))
    )
    zero = F.lit(0).cast("long")
    logs = every.join(of_logs, BUCKET_COL, "left").select(
        F.lit(None).cast("string").alias("regex_id"),
        F.coalesce("n", zero).alias("n"),
        F.coalesce("processed", zero).alias("processed"),
        BUCKET_COL,
    )
    results = (
        stores.results.read_buckets(spark, buckets)
        .groupBy(BUCKET_COL, "regex_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("regex_id", "n", zero.alias("processed"), BUCKET_COL)
    )
    (
        logs.unionByName(results)
        .repartition(BUCKET_COL)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET_COL)
        .parquet(_stats_path(stores, "counts"))
    )
    if named is not None:
        drop_path(spark, named)


def stored_stats(spark: SparkSession, stores: LogStores) -> DataFrame:
    """The record of ``stats_json`` from the partial counts alone: a row for each
    bucket and id, whatever the stores hold."""
    left = _stats_path(stores, "named")
    if path_exists(spark, left):
        rows = spark.read.schema(f"{BUCKET_COL} int").option("recursiveFileLookup", "true").parquet(left).distinct().collect()
        if rows:  # a job was interrupted
            count_buckets(spark, stores, [r[0] for r in rows])
            drop_path(spark, left)
    counts = spark.read.schema(f"{PARTIAL_SCHEMA}, {BUCKET_COL} int").parquet(_stats_path(stores, "counts"))
    by_id = counts.where("regex_id is not null").groupBy("regex_id").agg(F.sum("n").alias("n"))
    as_map = by_id.select(F.map_from_entries(F.array_sort(F.collect_list(F.struct("regex_id", "n")))).alias("m")).scalar()
    of_logs, zero = F.col("regex_id").isNull(), F.lit(0).cast("long")
    return counts.agg(
        F.coalesce(F.sum(F.when(of_logs, F.col("n"))), zero).alias("total_logs"),
        F.coalesce(F.sum(F.when(of_logs, F.col("processed"))), zero).alias("processed_logs"),
        F.coalesce(F.sum(F.when(~of_logs, F.col("n"))), zero).alias("total_matches"),
    ).select("total_logs", "processed_logs", "total_matches", F.to_json(as_map).alias("matches_by_type"))
