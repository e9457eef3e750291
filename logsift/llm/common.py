"""Helpers shared by the operators of this subpackage.

Intermediate tables that are read more than once are written as Parquet below
the shared checkpoint folder (``materialise``), so a lost executor costs a
re-read and not a recomputation of everything before it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsift.session import checkpoint_root

#: Rows in an Arrow batch sent to Python workers. Texts are long, so the
#: default of 10,000 rows would put hundreds of MB into one batch.
ARROW_ROWS = 500
ARROW_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: White space of the word rule ``[^\x20\x09-\x0D]+``.
WORD_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of a Python worker by sending it short Arrow batches."""
    if int(spark.conf.get(ARROW_CONF)) > ARROW_ROWS:
        spark.conf.set(ARROW_CONF, str(ARROW_ROWS))


def run_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; unique for each call."""
    return f"{checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back with its schema."""
    spark = df.sparkSession
    path = run_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table from ``materialise`` that is no longer read."""
    sc = df.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path
    for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
        at = path(name)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def text_of(column: str = "text") -> Column:
    """A text column with null as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))
