"""Hot keys: one id may hold a third of all rows (a log whose results were
appended many times, an id requested over and over).

Adaptive execution splits a skewed partition only when both join inputs are
plain shuffles; an aggregated key side (distinct ids) rules that out. So hot
keys are handled in the plan:

- ``hot_keys`` finds all keys above a row threshold with one pre-aggregated
  count (map-side partial counts). There are at most (rows / threshold) of
  them; none is left out.
- ``salted_join`` joins on ``(key, salt)``: rows of a hot key on the large
  side get a deterministic salt from a hash of other columns, and the key's
  row(s) on the small side are repeated once per salt value. Other keys keep
  salt 0. Results equal the plain join for inner, left, semi and anti joins.
- ``expand_counts`` turns ``(key, n)`` rows back into ``n`` rows each, cut into
  chunks that are spread over tasks first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is split.
HOT_KEY_ROWS = 1_000_000
# Rows generated per chunk when expanding counts.
EXPAND_CHUNK = 100_000

SALT_COL = "_salt"


def hot_keys(df: DataFrame, key: str, hot_key_rows: int | None = HOT_KEY_ROWS) -> dict:
    """``{key: ways}`` for every key with more than ``hot_key_rows``
    rows (empty when ``hot_key_rows`` is None)."""
    if hot_key_rows is None or df.isStreaming:
        return {}
    rows = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter((F.col("_n") > hot_key_rows) & F.col(key).isNotNull())
        .collect()
    )
    return {r[0]: math.ceil(r[1] / hot_key_rows) for r in rows}


def _ways(key: str, hot: dict) -> Column:
    pairs = []
    for k, w in hot.items():
        pairs += [F.lit(k), F.lit(w)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(key)), F.lit(1))


def salted_join(
    large: DataFrame, small: DataFrame, key: str, how: str, salt_cols: list[str], hot: dict
) -> DataFrame:
    """``large.join(small, key, how)`` with hot keys split ``hot[key]`` ways."""
    if not hot:
        return large.join(small, key, how)
    ways = _ways(key, hot)
    large_s = large.withColumn(SALT_COL, F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), ways).cast("int"))
    small_s = small.withColumn(SALT_COL, F.explode(F.sequence(F.lit(0), (ways - 1).cast("int"))))
    return large_s.join(small_s, [key, SALT_COL], how).drop(SALT_COL)


def expand_counts(df: DataFrame, count_col: str, key: str, chunk: int = EXPAND_CHUNK) -> DataFrame:
    """Each row repeated ``count_col`` times (the column is dropped).

    A row is first cut into chunks of ``chunk`` copies by its own count, the
    chunks are dealt out by (key, chunk), and each is expanded where it lands;
    so no task expands a heavy key alone, and no list of keys is needed."""
    n, c = F.col(count_col), F.col("_c")
    chunks = df.withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / chunk))))
    # A given number of partitions: adaptive execution would merge them by their
    # size before the copies are made.
    session = df.sparkSession
    parts = max(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    chunks = chunks.repartition(parts, key, "_c")
    copies = F.sequence(F.lit(1).cast("long"), F.least(F.lit(chunk).cast("long"), n - c * chunk))
    return chunks.withColumn("_i", F.explode(copies)).drop("_c", "_i", count_col)
