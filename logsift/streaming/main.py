"""Command line for spark-submit.

    spark-submit --py-files logsift.zip submit.py stream --brokers kafka:9092 \\
        --topic log-events --store /shared/stores/logs --buckets 1024 \\
        --out /shared/matches [--kafka-out regex-matches] [--trigger "30 seconds"]

    spark-submit --py-files logsift.zip submit.py batch --store ... --out ...

    spark-submit --py-files logsift.zip submit.py stream --stores /shared/stores ...
    spark-submit --py-files logsift.zip submit.py batch --stores /shared/stores
    spark-submit --py-files logsift.zip submit.py fold --stores /shared/stores

(``python -m logsift.streaming.main ...`` for a local run.)

``stream`` runs the event stream (Kafka, or ``--events-dir`` for files)
against the bucketed log store; ``batch`` matches every log in the store
into a bucketed result store. The checkpoint lives below the session's
``spark.checkpoint.dir`` unless ``--checkpoint`` is given.

With ``--stores`` (see ``plans.versioned``) the results go to the result store and
the logs are flagged; ``batch`` then matches the logs that are pending, and
``fold`` moves the finished batches of streams to the results table.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from ..plans.versioned import VersionedStores
from ..sources import stores
from ..sources.tables import LOGS_SCHEMA
from . import job


def _args(argv=None):
    ap = argparse.ArgumentParser(prog="logsift")
    sub = ap.add_subparsers(dest="mode", required=True)
    s = sub.add_parser("stream")
    s.add_argument("--brokers")
    s.add_argument("--topic", default="log-events")
    s.add_argument("--events-dir", help="read event messages (one per line) from files instead of Kafka")
    s.add_argument("--store")
    s.add_argument("--stores", help="base folder of versioned stores, instead of --store and --out")
    s.add_argument("--once-within", help="match an id that comes again within this time only once (with --stores)")
    s.add_argument("--buckets", type=int, default=stores.DEFAULT_BUCKETS)
    s.add_argument("--out")
    s.add_argument("--kafka-out", help="also publish matches to this topic")
    s.add_argument("--trigger", default=job.DEFAULT_TRIGGER)
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--max-offsets-per-trigger", type=int)
    s.add_argument("--checkpoint")
    b = sub.add_parser("batch")
    b.add_argument("--store")
    b.add_argument("--stores")
    b.add_argument("--buckets", type=int, default=stores.DEFAULT_BUCKETS)
    b.add_argument("--out")
    f = sub.add_parser("fold")
    f.add_argument("--stores", required=True)
    f.add_argument("--buckets", type=int, default=stores.DEFAULT_BUCKETS)
    a = ap.parse_args(argv)
    if not a.stores and not (a.store and a.out):
        ap.error("give --stores, or --store and --out")
    return a


def main(argv=None, spark: SparkSession | None = None):
    a = _args(argv)
    spark = spark or SparkSession.builder.appName(f"logsift-{a.mode}").getOrCreate()
    both = VersionedStores(spark, a.stores, a.buckets) if a.stores else None
    if both and a.mode != "stream":
        return both.fold() if a.mode == "fold" else both.match_pending()
    table = stores.StoreTable(a.store, a.buckets, LOGS_SCHEMA)
    if a.mode == "batch":
        from ..plans.micro_batch import batch_match_table

        return batch_match_table(spark, table, a.out)

    if a.events_dir:
        envelope = job.file_events(spark, a.events_dir, "value string", fmt="text")
    else:
        envelope = job.kafka_events(spark, a.brokers, a.topic, a.max_offsets_per_trigger)
    from ..session import checkpoint_root

    checkpoint = a.checkpoint or os.path.join(checkpoint_root(spark), "logsift-stream", a.topic)
    kafka = (a.brokers, a.kafka_out) if a.kafka_out else None
    if both:
        writer = job.StoreBatchWriter(both, checkpoint, kafka=kafka)
        q = job.start_store_stream(envelope, writer, a.trigger, a.available_now, a.once_within)
        return _finish(q, writer)
    writer = job.MatchBatchWriter(
        lambda: table,
        os.path.join(a.out, "results"),
        os.path.join(a.out, "not_found"),
        kafka=kafka,
        bucket_count=a.buckets,
    )
    q = job.start_match_stream(envelope, writer, checkpoint, trigger=a.trigger, available_now=a.available_now)
    return _finish(q, writer)


def _finish(q, writer):
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return writer


if __name__ == "__main__":
    main()
