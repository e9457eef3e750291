"""On-disk layout of the log store and the result store.

Both are Parquet tables partitioned by ``bucket = pmod(xxhash64(log_id), N)``
and sorted by ``log_id`` inside each file. A lookup for a batch of ids
computes the batch's buckets (at most N small integers) and filters the
store on them, which Spark turns into partition pruning at the scan; inside
a bucket the sort keeps Parquet min/max statistics on ``log_id`` tight. A
micro-batch of ids therefore reads the buckets it needs, not the store.

Every rewrite (upsert, processed flags, deletes) writes a new version
directory and is read back from there; the new table's plan starts at the
files, so lineage does not grow across rewrites.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from .tables import LOGS_SCHEMA, RESULTS_SCHEMA

DEFAULT_BUCKETS = 1024
BUCKET_COL = "bucket"
# So many ids are looked up as values, which reach the Parquet reader.
POINT_IDS = 10
# Files are sorted by log_id. Small row groups keep a point lookup small, and a Bloom
# filter on log_id leaves out those whose range holds an id that they lack.
ROW_GROUP_BYTES = 16 << 20


def bucket_of(log_id, bucket_count: int) -> Column:
    c = F.col(log_id) if isinstance(log_id, str) else log_id
    return F.pmod(F.xxhash64(c), F.lit(bucket_count)).cast("int")


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def drop_path(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@dataclass(frozen=True)
class StoreTable:
    """A bucketed table: where it lives and how many buckets it has."""

    path: str
    bucket_count: int = DEFAULT_BUCKETS
    schema: str = LOGS_SCHEMA

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{self.schema}, {BUCKET_COL} int").parquet(self.path)

    def read_buckets(self, spark: SparkSession, buckets: list[int]) -> DataFrame:
        """Only the given buckets. Their directories are the only ones listed
        (one glob), so a lookup's file listing grows with the buckets it
        touches, not with the table."""
        schema = f"{self.schema}, {BUCKET_COL} int"
        existing = self._existing_buckets(spark, buckets)
        if not existing:
            return spark.createDataFrame([], schema)
        glob = os.path.join(self.path, f"{BUCKET_COL}={{{','.join(str(b) for b in sorted(existing))}}}")
        return spark.read.schema(schema).option("basePath", self.path).parquet(glob)

    def _existing_buckets(self, spark: SparkSession, buckets: list[int]) -> list[int]:
        # One listing of the table's top directory (at most bucket_count
        # entries), not one call per bucket.
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(conf)
        if not fs.exists(root):
            return []
        prefix = f"{BUCKET_COL}="
        present = set()
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith(prefix) and name[len(prefix):].isdigit():
                present.add(int(name[len(prefix):]))
        return [b for b in buckets if b in present]


def _writer(rows: DataFrame) -> DataFrameWriter:
    out = rows.write.option("parquet.block.size", str(ROW_GROUP_BYTES))
    return out.option("parquet.bloom.filter.enabled#log_id", "true").option("parquet.bloom.filter.adaptive.enabled", "true")


def write_bucketed(
    df: DataFrame,
    path: str,
    bucket_count: int = DEFAULT_BUCKETS,
    files_per_bucket: int = 1,
    schema: str = LOGS_SCHEMA,
) -> StoreTable:
    """Write ``df`` partitioned by bucket, ``files_per_bucket`` files per
    bucket (raise it with the table size so files stay a few hundred MB)."""
    sub = F.pmod(F.xxhash64(F.col("log_id"), F.lit(1)), F.lit(files_per_bucket))
    rows = (
        df.withColumn(BUCKET_COL, bucket_of("log_id", bucket_count))
        .withColumn("_sub", sub)
        .hint("rebalance", BUCKET_COL, "_sub")
        .drop("_sub")
        .sortWithinPartitions("log_id")
    )
    _writer(rows).mode("overwrite").partitionBy(BUCKET_COL).parquet(path)
    return StoreTable(path, bucket_count, schema)


def append_bucketed(df: DataFrame, table: StoreTable) -> None:
    """Add rows to a bucketed table as new files (nothing is rewritten). The
    rebalance groups rows by bucket and lets adaptive execution split a
    bucket that a hot log id makes large, so no task writes it alone."""
    rows = df.withColumn(BUCKET_COL, bucket_of("log_id", table.bucket_count)).hint("rebalance", BUCKET_COL)
    _writer(rows.sortWithinPartitions("log_id")).mode("append").partitionBy(BUCKET_COL).parquet(table.path)


def write_version(df: DataFrame, base: str, bucket_count: int = DEFAULT_BUCKETS, schema: str = LOGS_SCHEMA) -> StoreTable:
    """A new version of a store under ``base`` (a fresh directory)."""
    return write_bucketed(df.select(*[c.split()[0] for c in schema.split(",")]), os.path.join(base, f"v-{uuid.uuid4().hex}"), bucket_count, schema=schema)


def bucket_profile(ids: DataFrame, bucket_count: int) -> tuple[list[int], int]:
    """The buckets holding ``ids`` and the number of distinct ids, from one
    aggregation (at most ``bucket_count`` rows reach the driver). A log id
    lives in one bucket, so per-bucket distinct counts add up exactly."""
    rows = (
        ids.filter(F.col("log_id").isNotNull())
        .groupBy(bucket_of("log_id", bucket_count).alias("b"))
        .agg(F.count_distinct("log_id").alias("n"))
        .collect()
    )
    return [r.b for r in rows], sum(r.n for r in rows)


def buckets_of(ids: DataFrame, bucket_count: int) -> list[int]:
    """The buckets holding ``ids``: at most ``bucket_count`` small integers,
    a configured bound."""
    return [r[0] for r in ids.select(bucket_of("log_id", bucket_count).alias("b")).distinct().collect()]


def bucket_groups(ids: DataFrame, bucket_count: int, most: int, every: bool = False) -> list[list[int]]:
    """The buckets of ``ids`` (or ``every`` bucket) in groups that hold at most
    ``most`` distinct ids each, or one bucket. So the ids of a group may be broadcast
    where those of the table may not, and its rows need no shuffle."""
    of = ids.filter(F.col("log_id").isNotNull()).groupBy(bucket_of("log_id", bucket_count).alias("b"))
    sizes = {r.b: r.n for r in of.agg(F.count_distinct("log_id").alias("n")).collect()}
    groups: list[list[int]] = []
    room = -1
    for b in range(bucket_count) if every else sorted(sizes):
        n = sizes.get(b, 0)
        if n > room:
            groups.append([])
            room = most
        groups[-1].append(b)
        room -= n
    return groups


def in_buckets(rows: DataFrame, bucket_count: int, buckets: list[int]) -> DataFrame:
    """The rows whose log ids fall in ``buckets``."""
    return rows.filter(bucket_of("log_id", bucket_count).isin(buckets))


def write_within_buckets(rows: DataFrame, path: str) -> None:
    """Add rows that carry the bucket they were read with. A scan task has files of few
    buckets, so they are written from where they are."""
    _writer(rows.sortWithinPartitions(BUCKET_COL, "log_id")).mode("append").partitionBy(BUCKET_COL).parquet(path)


def rewrite_buckets(spark: SparkSession, table: StoreTable, buckets: list[int], transform, staging: str) -> None:
    """Rewrite only ``buckets`` of ``table``: read them, apply ``transform``
    (rows without the bucket column in, rows out), stage the result under
    ``staging`` and replace exactly those bucket directories. The cost grows with
    the touched buckets, not with the table. For transforms that never drop a
    bucket's last row (upsert, processed flags); a delete writes a new version
    instead."""
    current = table.read_buckets(spark, buckets).drop(BUCKET_COL)
    swap_buckets(spark, table, write_bucketed(transform(current), staging, table.bucket_count, schema=table.schema))


def swap_buckets(spark: SparkSession, table: StoreTable, staged: StoreTable) -> None:
    """Replace the buckets of ``table`` that ``staged`` holds. Their folders are moved
    into their place; only where the stores are on different file systems they are
    copied. A failure before this step leaves the table as it was."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root, new = of(table.path), of(staged.path)
    fs = root.getFileSystem(conf)
    if not fs.getUri().equals(new.getFileSystem(conf).getUri()):
        swap = _writer(staged.read(spark)).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        swap.partitionBy(BUCKET_COL).parquet(table.path)
        return
    fs.mkdirs(root)
    for b in staged._existing_buckets(spark, list(range(table.bucket_count))):
        name = f"{BUCKET_COL}={b}"
        old = of(root, name)
        fs.delete(old, True)
        if not fs.rename(of(new, name), old):
            raise OSError(f"{staged.path}/{name} could not be moved to {table.path}")


def prune_to_buckets(store, ids: DataFrame, bucket_count: int) -> DataFrame:
    """Keep only the store partitions that can hold ``ids``. Given a
    ``StoreTable``, only those bucket directories are read; given a
    DataFrame, a partition filter prunes its (already listed) files."""
    buckets = buckets_of(ids, bucket_count)
    if isinstance(store, StoreTable):
        return store.read_buckets(ids.sparkSession, buckets)
    return store.filter(F.col(BUCKET_COL).isin(buckets))


RESULTS_STORE_SCHEMA = RESULTS_SCHEMA
