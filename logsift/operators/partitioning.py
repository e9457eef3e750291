"""Partition sizing before expensive narrow work.

Splitting, cleaning and matching are narrow: they run in the task that read
the row. A scan that yields fewer partitions than the cluster has cores
(one small file, one row group) would leave cores idle for the whole
expansion, so such an input is first spread round-robin. A scan of a large
table already has more partitions than cores and is left alone: no shuffle
is added at scale. Applied where tables are read (``sources.tables``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that one task is to hold when it makes rows distinct.
PART_BYTES = 32 << 20


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Call on a plain scan: counting partitions only plans it. (On a plan
    with exchanges, adaptive execution would run stages to answer.)"""
    if df.isStreaming:
        return df
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # no RDD access (e.g. a remote session): leave the scan as is
        return df
    if current >= target:
        return df
    return df.repartition(target)


def parts_for(df: DataFrame, text: Column, part_bytes: int = PART_BYTES) -> int:
    """Partitions for work that holds the rows of its task: by the bytes of ``text``
    (one pass, a sum from each task), so a task's share does not grow with the
    input."""
    session = df.sparkSession
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(math.ceil(size / part_bytes), int(session.conf.get("spark.sql.shuffle.partitions")))
