"""The streaming job: event ids in, match rows out.

    readStream (Kafka, or files for tests) -> decode -> foreachBatch:
        lookup against the store -> split/clean/match -> sinks

Delivery. The reference writes each batch to Kafka (at least once) and
silently drops a batch when its lookup fails. Here a failed store read fails
the batch, so Spark retries it from the checkpointed offsets, and the table
sink overwrites the batch's own ``batch_id`` folder, so a replayed batch
replaces its earlier output instead of duplicating it, with nothing too. Ids missing from the
store go to a quarantine table instead of vanishing.

The store is read again inside every batch (``store_loader``): a Parquet
DataFrame's file list is fixed when it is created, so a frame made once would
never see logs written after the stream started. A loader that returns a
bucketed ``StoreTable`` lets each batch list and read only the buckets its
ids fall in.
"""

from __future__ import annotations

import json
import logging
import os
from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import MAX_BROADCAST_KEYS
from ..operators.lookup import check_events, decode_events
from ..operators.matching import match_lines
from ..operators.payload import kafka_payload
from ..plans.micro_batch import process_ids
from ..plans.versioned import STORED_RESULTS_SCHEMA, VersionedStores, stamped
from ..session import scratch_path
from ..sources.stores import BUCKET_COL, StoreTable, buckets_of, path_exists

log = logging.getLogger(__name__)

DEFAULT_TRIGGER = "30 seconds"
# Batches whose counts the writer remembers.
HISTORY = 1000


def kafka_events(
    spark: SparkSession,
    brokers: str,
    topic: str,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """The event topic as a stream (needs the spark-sql-kafka connector on
    the classpath). Starts at the latest offsets; lost offsets are skipped,
    not fatal."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        # A hot topic partition is split over several tasks.
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.load()


def file_events(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Files as an event stream (tests and replays)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def write_kafka(matches: DataFrame, brokers: str, topic: str) -> None:
    kafka_payload(matches).write.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).save()


def write_partition(df: DataFrame, path: str, batch_id: int) -> None:
    """Overwrite this batch's folder (idempotent on replay: a replay without
    rows leaves an empty folder, not the rows of before). The rebalance lets
    adaptive execution size the files (no file per task for a small batch, no
    huge task for a skewed one)."""
    df.hint("rebalance").write.mode("overwrite").parquet(batch_path(path, batch_id))


def batch_path(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


class MatchBatchWriter:
    """The ``foreachBatch`` function."""

    def __init__(
        self,
        store_loader: Callable[[], "DataFrame | StoreTable"],
        results_path: str,
        not_found_path: str,
        patterns=None,
        kafka: tuple[str, str] | None = None,
        max_broadcast_keys: int | None = MAX_BROADCAST_KEYS,
        bucket_count: int | None = None,
    ):
        self.bucket_count = bucket_count
        self.store_loader = store_loader
        self.results_path = results_path
        self.not_found_path = not_found_path
        self.patterns = patterns
        self.kafka = kafka
        self.max_broadcast_keys = max_broadcast_keys
        self.wrote = False
        self.history: deque[dict] = deque(maxlen=HISTORY)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # The id batch is read several times (key count, semi-join, missing
        # ids); keep it in memory for the batch instead of re-reading the
        # source. Lost blocks are recomputed from the batch's offsets.
        ids = batch.select("log_id").persist()
        try:
            if ids.isEmpty():  # nothing decodable in this batch: no lookup, no writes
                self.history.append({"batch_id": batch_id, "found": 0, "cleaned_lines": 0, "matches": 0})
                return
            out = process_ids(
                ids, self.store_loader(), self.patterns, self.max_broadcast_keys, self.bucket_count, observe=True
            )
            # The match plan runs once, into the table sink; Kafka (if any)
            # re-reads the written partition rather than re-matching.
            self.wrote = True
            write_partition(out.matches, self.results_path, batch_id)
            write_partition(out.not_found, self.not_found_path, batch_id)
            metrics = out.metrics()
            n = metrics.get("matches", 0)
            if self.kafka and n > 0:
                written = batch.sparkSession.read.schema(out.matches.schema).parquet(batch_path(self.results_path, batch_id))
                write_kafka(written, *self.kafka)
            self.history.append({"batch_id": batch_id, **metrics})
            log.info("batch %s: %s", batch_id, metrics)
        finally:
            ids.unpersist()


def stream_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint keeps of its query. A new checkpoint, in the same
    place too, has a new one; a restart has the old one."""
    line = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(line)["id"]


def claim_output(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Batch numbers start anew with a checkpoint, so the folders of one stream must
    not be written by another: the first stream leaves its id in ``path``, and
    any other one is refused."""
    marker, own = f"{path.rstrip('/')}/_stream", stream_id_of(spark, checkpoint)
    if not path_exists(spark, marker):
        spark.createDataFrame([(own,)], "value string").coalesce(1).write.text(marker)
        return
    owner = spark.read.text(marker).first()[0]
    if owner != own:
        raise ValueError(f"{path} holds the batches of another checkpoint (stream {owner}); take a new folder")


class StoreBatchWriter:
    """The ``foreachBatch`` function that stores results: a batch's match rows
    become rows of the result store, its logs are processed from then on, and what
    could not be decoded or found is kept beside them (``plans.versioned``). All of
    it is one attempt, which a replay replaces."""

    def __init__(
        self,
        stores: VersionedStores,
        checkpoint: str,
        patterns=None,
        kafka: tuple[str, str] | None = None,
        max_broadcast_keys: int | None = MAX_BROADCAST_KEYS,
    ):
        self.stores, self.checkpoint = stores, checkpoint
        self.patterns, self.kafka, self.max_broadcast_keys = patterns, kafka, max_broadcast_keys

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stores = VersionedStores(spark, self.stores.base, self.stores.bucket_count)
        events = batch.select("log_id", "value", "reject_reason").persist()
        try:
            ids = events.filter("reject_reason IS NULL").select("log_id")
            rejected = events.filter("reject_reason IS NOT NULL").select("value", "reject_reason")
            n = events.agg(F.count(F.lit(1)).alias("events"), F.count("reject_reason").alias("rejected")).first()
            if not n.events:
                return
            # Only the buckets of the batch's ids are read, less what is deleted.
            buckets = buckets_of(ids, stores.bucket_count)
            version = stores.current()
            logs = stores.logs_table(version).read_buckets(spark, buckets).drop(BUCKET_COL)
            logs = stores.without_deleted(logs, version)
            out = process_ids(ids, logs, self.patterns, self.max_broadcast_keys, observe=True)
            missing = Observation()
            lost = out.not_found.observe(missing, F.count(F.lit(1)).alias("rows"))

            def counts() -> dict:
                seen = {"found": 0, "cleaned_lines": 0, "matches": 0} | out.metrics()
                return {"events": n.events, "rejected": n.rejected, "not_found": missing.get.get("rows", 0), **seen}

            parts = {"results": stamped(out.results), "rejected": rejected, "not_found": lost}
            path = stores.write_batch(stream_id_of(spark, self.checkpoint), batch_id, parts, counts)
            if self.kafka:
                rows = spark.read.schema(STORED_RESULTS_SCHEMA).parquet(path)
                if not rows.isEmpty():
                    named = rows.withColumnsRenamed({"regex_id": "regexId", "match": "matched_text"})
                    write_kafka(named, *self.kafka)
        finally:
            events.unpersist()


def start_store_stream(
    envelope: DataFrame,
    writer: StoreBatchWriter,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
    once_within: str | None = None,
):
    """Check ``envelope``'s messages and run ``writer`` on each micro-batch.

    With ``once_within`` (such as ``"10 minutes"``) an id that comes again within that
    time, in any batch and after a restart, is matched once: the ids are keyed state.
    Its clock is the arrival of the messages, so none of them is ever late. Messages
    that name no log all pass."""
    checked = check_events(envelope)
    if once_within:
        # Without an id the message itself, and its place in the stream, is the key.
        nth = F.when(F.col("reject_reason").isNotNull(), F.expr("uuid()"))
        checked = checked.withColumn("arrived", F.current_timestamp()).withColumn("nth", nth)
        checked = checked.withWatermark("arrived", once_within).dropDuplicatesWithinWatermark(["log_id", "nth"])
    w = checked.writeStream.foreachBatch(writer).option("checkpointLocation", writer.checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def start_match_stream(
    envelope: DataFrame,
    writer: MatchBatchWriter,
    checkpoint: str,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
):
    """Decode ``envelope`` (a stream with a ``value`` column) and run
    ``writer`` on each micro-batch. The writer's folder is refused where it holds
    the batches of another checkpoint."""
    ids = decode_events(envelope)

    def run(batch: DataFrame, batch_id: int) -> None:
        claim_output(batch.sparkSession, writer.results_path, checkpoint)
        writer(batch, batch_id)

    w = ids.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def run_to_completion(
    spark: SparkSession,
    envelope: DataFrame,
    store_loader: Callable[[], DataFrame],
    patterns=None,
    base: str | None = None,
    bucket_count: int | None = None,
) -> tuple[DataFrame, MatchBatchWriter, str]:
    """Process everything available now, then return the match rows written
    (without the ``batch_id`` column)."""
    base = base or scratch_path(spark, "stream_match")
    writer = MatchBatchWriter(
        store_loader,
        os.path.join(base, "results"),
        os.path.join(base, "not_found"),
        patterns,
        bucket_count=bucket_count,
    )
    q = start_match_stream(envelope, writer, os.path.join(base, "checkpoint"), available_now=True)
    q.awaitTermination()
    exc = q.exception()
    if exc is not None:
        raise exc
    results_path = os.path.join(base, "results")
    if not writer.wrote:
        none = spark.createDataFrame([], "log_id string, content string")
        return match_lines(none, patterns), writer, base
    return spark.read.parquet(results_path).drop("batch_id"), writer, base


def store_events(
    spark: SparkSession, stores: VersionedStores, parts: list[DataFrame], base: str, patterns=None
) -> StoreBatchWriter:
    """Feed frames of event messages (column ``value``) to the stream one after the
    other, each as a batch of a stream that is stopped and started again between
    them. Returns the writer."""
    events = os.path.join(base, "events")
    writer = StoreBatchWriter(stores, os.path.join(base, "checkpoint"), patterns)
    for part in parts:
        part.select("value").write.mode("append").parquet(events)
        q = start_store_stream(file_events(spark, events, "value binary"), writer, available_now=True)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return writer
