"""Removal of what the operators leave in the shared folder.

An operator's result is read from the tables that it has written there, so they stay
until the caller has written the result. ``clean`` removes all of them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from logsift.session import checkpoint_root
from logsift.sources.stores import drop_path, path_exists


def clean(spark: SparkSession) -> bool:
    """Delete the intermediate tables of every operator that ran with this shared
    folder, of other sessions too; call it when their results are written. Returns
    whether there were any."""
    path = f"{checkpoint_root(spark).rstrip('/')}/llm"
    found = path_exists(spark, path)
    if found:
        drop_path(spark, path)
    return found
