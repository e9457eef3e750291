"""Join helpers with explicit size checks.

A side is broadcast only after counting it against a bound; past the bound
the join is left to a shuffle, where AQE's skew handling splits a hot key's
partition across tasks (``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Distinct keys we are willing to ship to every executor (about 100 bytes
# each with overhead, so ~200 MB at the bound).
MAX_BROADCAST_KEYS = 2_000_000


def at_most(df: DataFrame, n: int) -> bool:
    """True when ``df`` has no more than ``n`` rows: a partial count on every
    task, one number from each."""
    return df.count() <= n


def key_set(df: DataFrame, key: str, max_broadcast_keys: int | None = MAX_BROADCAST_KEYS) -> tuple[DataFrame, bool]:
    """Distinct keys of ``df`` (pre-aggregated map side, so a hot key costs one
    row per task) and whether they passed the broadcast bound."""
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    small = max_broadcast_keys is not None and not df.isStreaming and at_most(keys, max_broadcast_keys)
    return keys, small


def semi_join_keys(big: DataFrame, keys: DataFrame, key: str, small: bool, how: str = "left_semi") -> DataFrame:
    """``big`` filtered by membership in ``keys``: broadcast when ``small``
    was proven, otherwise a shuffle join."""
    return big.join(F.broadcast(keys) if small else keys, key, how)
