"""The log store and the result store behind one commit point.

``VersionedStores`` keeps, below one base folder:

* ``versions``: a row for each version; it names the logs table, the parts of the
  results table, flags and tombstones. The row with the highest version is the state
  of both stores, so whatever it changes, changes at once or not at all.
* ``commits``: a row for each finished attempt of a stream's micro-batch, with its
  counts. Of a batch only the last attempt counts, so a replay replaces results,
  flags, rejects and counts of the attempt before it as one unit.

A batch is written to folders of its own (stream, batch, attempt) and is seen once
its commit row is there. Flags are not written at all: a log is processed if its row
says so or a result of a batch that counts names it. ``fold`` moves finished
batches to the results table, as new files; the newest batch of each stream stays, as
only that one can come again. A delete writes the ids and hides their rows on reading;
``compact`` drops them, and the only step whose cost grows with the stores is this one.

Rows are written by Spark's own committers, one file a row, so no store needs more
than they do. There may be any number of streams; maintenance is done by one job at a
time.
"""

from __future__ import annotations

import os
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators import store as S
from ..operators.joins import MAX_BROADCAST_KEYS, key_set, semi_join_keys
from ..operators.matching import match_lines
from ..session import scratch_path
from ..sources.stores import BUCKET_COL, DEFAULT_BUCKETS, StoreTable, buckets_of, path_exists, rewrite_buckets, write_bucketed
from ..sources.tables import LOGS_SCHEMA, RESULTS_SCHEMA

STORED_RESULTS_SCHEMA = f"{RESULTS_SCHEMA}, timestamp timestamp_ntz"
REJECTS_SCHEMA = "value string, reject_reason string"
NOT_FOUND_SCHEMA = "log_id string"
ID_SCHEMA = "log_id string"
VERSION_SCHEMA = (
    "version long, logs string, results array<string>, flags array<string>, tombstones array<string>, "
    "folded map<string,long>"
)
COUNTS = ("events", "rejected", "found", "not_found", "cleaned_lines", "matches")
COMMIT_SCHEMA = "stream_id string, batch_id long, attempt string, committed_at long, " + ", ".join(f"{c} long" for c in COUNTS)
BATCH_PARTS = {"results": STORED_RESULTS_SCHEMA, "rejected": REJECTS_SCHEMA, "not_found": NOT_FOUND_SCHEMA}


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


@dataclass(frozen=True)
class Version:
    version: int
    logs: str
    results: list[str] = field(default_factory=list)
    flags: list[str] = field(default_factory=list)
    tombstones: list[str] = field(default_factory=list)
    folded: dict[str, int] = field(default_factory=dict)


class VersionedStores:
    def __init__(self, spark: SparkSession, base: str, bucket_count: int = DEFAULT_BUCKETS):
        self.spark, self.base, self.bucket_count = spark, base.rstrip("/"), bucket_count

    @classmethod
    def create(
        cls, spark: SparkSession, base: str, logs: DataFrame, results: DataFrame | None = None, bucket_count: int = DEFAULT_BUCKETS
    ) -> "VersionedStores":
        """New stores from frames; results get the time of writing where they have
        no timestamp."""
        stores = cls(spark, base, bucket_count)
        if path_exists(spark, stores._path("versions")):
            raise ValueError(f"{base} holds stores already")
        parts = [] if results is None else [stores._write_results(results)]
        stores._commit(Version(1, stores._write_logs(logs), parts))
        return stores

    # --- paths and rows -------------------------------------------------------

    def _path(self, *parts: str) -> str:
        return os.path.join(self.base, *parts)

    def _fresh(self, name: str) -> str:
        return self._path(name, f"v-{uuid.uuid4().hex}")

    def _write_logs(self, logs: DataFrame) -> str:
        return write_bucketed(logs.select(*_names(LOGS_SCHEMA)), self._fresh("logs"), self.bucket_count).path

    def _write_results(self, results: DataFrame) -> str:
        rows = stamped(results).select(*_names(STORED_RESULTS_SCHEMA))
        return write_bucketed(rows, self._fresh("results"), self.bucket_count, schema=STORED_RESULTS_SCHEMA).path

    def _append_row(self, name: str, row: Row | dict, schema: str) -> None:
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode("append").json(self._path(name))

    def _commit(self, v: Version) -> None:
        self._append_row("versions", v.__dict__, VERSION_SCHEMA)

    def current(self) -> Version:
        rows = self.spark.read.schema(VERSION_SCHEMA).json(self._path("versions"))
        return Version(**rows.orderBy(F.desc("version")).first().asDict())

    def commits(self) -> DataFrame:
        """The attempt that counts of every batch, folded ones included."""
        if not path_exists(self.spark, self._path("commits")):
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        rows = self.spark.read.schema(COMMIT_SCHEMA).json(self._path("commits"))
        last = F.max_by(F.struct("*"), F.struct("committed_at", "attempt"))
        return rows.groupBy("stream_id", "batch_id").agg(last.alias("r")).select("r.*")

    def metrics_history(self) -> DataFrame:
        """``stream_id, batch_id`` and the counts of every batch that counts."""
        return self.commits().select("stream_id", "batch_id", *COUNTS)

    def _live(self, v: Version) -> list[Row]:
        """Commits since the last fold: a row a batch."""
        rows = self.commits().select("stream_id", "batch_id", "attempt").collect()
        return sorted((r for r in rows if r.batch_id > v.folded.get(r.stream_id, -1)), key=lambda r: (r.stream_id, r.batch_id))

    def _batch_path(self, part: str, stream_id: str, batch_id: int, attempt: str) -> str:
        return self._path("stream", part, f"stream_id={stream_id}", f"batch_id={batch_id}", f"attempt={attempt}")

    def _batches(self, part: str, live: list[Row]) -> DataFrame:
        schema = BATCH_PARTS[part]
        paths = [self._batch_path(part, *r) for r in live]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # --- reading --------------------------------------------------------------

    def logs_table(self, v: Version | None = None) -> StoreTable:
        return StoreTable((v or self.current()).logs, self.bucket_count, LOGS_SCHEMA)

    def without_deleted(self, rows: DataFrame, v: Version | None = None) -> DataFrame:
        v = v or self.current()
        if not v.tombstones:
            return rows
        ids, small = key_set(self.spark.read.schema(ID_SCHEMA).parquet(*v.tombstones), "log_id")
        return semi_join_keys(rows, ids, "log_id", small, how="left_anti")

    def _stored_results(self, v: Version) -> DataFrame:
        if not v.results:
            return self.spark.createDataFrame([], STORED_RESULTS_SCHEMA)
        parts = [StoreTable(p, self.bucket_count, STORED_RESULTS_SCHEMA).read(self.spark) for p in v.results]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out.drop(BUCKET_COL)

    def read_results(self) -> DataFrame:
        """Every result once: the results table and the batches that count."""
        v = self.current()
        rows = self._stored_results(v).unionByName(self._batches("results", self._live(v)))
        return self.without_deleted(rows, v)

    def read_logs(self) -> DataFrame:
        """The logs, processed where a result of the stream names them."""
        v = self.current()
        logs = self.logs_table(v).read(self.spark).drop(BUCKET_COL)
        hits = self._batches("results", self._live(v)).select("log_id")
        if v.flags:
            hits = hits.unionByName(self.spark.read.schema(ID_SCHEMA).parquet(*v.flags))
        # Counted and broadcast where they are few: then the logs are only scanned.
        return S.mark_processed(self.without_deleted(logs, v), hits, MAX_BROADCAST_KEYS)

    def read_rejected(self) -> DataFrame:
        """``value, reject_reason`` of the messages that named no log."""
        return self._batches("rejected", self.commits().select("stream_id", "batch_id", "attempt").collect())

    def read_not_found(self) -> DataFrame:
        return self._batches("not_found", self.commits().select("stream_id", "batch_id", "attempt").collect())

    # --- writing --------------------------------------------------------------

    def write_batch(self, stream_id: str, batch_id: int, parts: dict[str, DataFrame], counts) -> str:
        """Write one attempt of a batch and commit it. ``counts`` is called when the
        parts are written (observed counts are known then). Returns the folder of
        its results."""
        attempt = uuid.uuid4().hex
        for part, rows in parts.items():
            path = self._batch_path(part, stream_id, batch_id, attempt)
            rows.select(*_names(BATCH_PARTS[part])).hint("rebalance").write.parquet(path)
        row = {"stream_id": stream_id, "batch_id": batch_id, "attempt": attempt, "committed_at": time.time_ns()}
        self._append_row("commits", row | counts(), COMMIT_SCHEMA)
        return self._batch_path("results", stream_id, batch_id, attempt)

    def fold(self) -> Version:
        """Move the batches before the newest of each stream to the results table
        and their log ids to the flags; the cost is theirs alone."""
        v = self.current()
        live = self._live(v)
        newest = {r.stream_id: r.batch_id for r in live}
        done = [r for r in live if r.batch_id < newest[r.stream_id]]
        if not done:
            return v
        rows = self.without_deleted(self._batches("results", done), v)
        path = self._write_results(rows)
        flags = self._write_flags(path)
        folded = v.folded | {r.stream_id: r.batch_id for r in done}
        new = Version(v.version + 1, v.logs, [*v.results, path], [*v.flags, flags], v.tombstones, folded)
        self._commit(new)
        return new

    def match_pending(self, patterns=None) -> Version:
        """Batch mode: match every log that is not processed; its results and its
        flag appear at one commit. Logs without a match stay pending."""
        v = self.current()
        pending = self.read_logs().where(~F.coalesce("processed", F.lit(False)))
        path = self._write_results(S.results_rows(match_lines(pending, patterns)))
        new = Version(v.version + 1, v.logs, [*v.results, path], [*v.flags, self._write_flags(path)], v.tombstones, v.folded)
        self._commit(new)
        return new

    def _write_flags(self, results: str) -> str:
        """The log ids of a part of the results table."""
        path = self._fresh("flags")
        rows = StoreTable(results, self.bucket_count, STORED_RESULTS_SCHEMA).read(self.spark)
        rows.select("log_id").distinct().write.parquet(path)
        return path

    def delete(self, ids: DataFrame) -> Version:
        """Delete logs by id with their results: one row of state hides both."""
        v = self.current()
        path = self._fresh("tombstones")
        ids.select("log_id").where("log_id is not null").distinct().write.parquet(path)
        new = Version(v.version + 1, v.logs, v.results, v.flags, [*v.tombstones, path], v.folded)
        self._commit(new)
        return new

    def compact(self) -> Version:
        """Rewrite both stores without what is deleted, flags and folded batches
        included, as one new version. Batches of the stream that are not folded yet
        lose their deleted rows as well, in a commit of their own each."""
        self.fold()
        v = self.current()
        live = self._live(v)
        if v.tombstones:
            for r in live:
                self._rewrite_batch(r, v)
        logs = self._write_logs(self._flagged(v))
        results = [self._write_results(self.without_deleted(self._stored_results(v), v))] if v.results else []
        new = Version(v.version + 1, logs, results, [], [], v.folded)
        self._commit(new)
        return new

    def _flagged(self, v: Version) -> DataFrame:
        logs = self.without_deleted(self.logs_table(v).read(self.spark).drop(BUCKET_COL), v)
        if not v.flags:
            return logs
        return S.mark_processed(logs, self.spark.read.schema(ID_SCHEMA).parquet(*v.flags), MAX_BROADCAST_KEYS)

    def _rewrite_batch(self, r: Row, v: Version) -> None:
        of = self.commits().where((F.col("stream_id") == r.stream_id) & (F.col("batch_id") == r.batch_id)).first()
        parts = {part: self._batches(part, [r]) for part in BATCH_PARTS}
        parts["results"] = self.without_deleted(parts["results"], v)
        self.write_batch(r.stream_id, r.batch_id, parts, lambda: {c: of[c] for c in COUNTS})

    def upsert(self, writes: DataFrame) -> DataFrame:
        """Insert or update logs (``log_id, source, timestamp, content, seq``); only
        the buckets of the written ids are rewritten. Returns the rejected writes with
        a reason. An id that was deleted comes back as a new log, so the stores are
        compacted first where a written id is among the deleted ones."""
        checked = S.check_writes(writes)
        good = checked.filter("reject_reason IS NULL").drop("reject_reason")
        v = self.current()
        if v.tombstones:
            gone, small = key_set(self.spark.read.schema(ID_SCHEMA).parquet(*v.tombstones), "log_id")
            if not semi_join_keys(good.select("log_id"), gone, "log_id", small).isEmpty():
                v = self.compact()
        table = self.logs_table(v)
        buckets = buckets_of(good, self.bucket_count)
        rewrite_buckets(
            self.spark,
            table,
            buckets,
            lambda current: S.upsert_logs(current, good).select(*_names(LOGS_SCHEMA)),
            scratch_path(self.spark, "staging", "logs"),
        )
        return checked.filter("reject_reason IS NOT NULL")


def stamped(results: DataFrame) -> DataFrame:
    """Results with a timestamp: the time of writing where there is none."""
    now = F.current_timestamp().cast("timestamp_ntz")
    return results.withColumn("timestamp", F.coalesce("timestamp", now) if "timestamp" in results.columns else now)
