"""Connected components of an undirected edge table.

Alternates the large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014) until no edge changes. Every step
is a shuffle of the edges on one end with partial aggregation of the minimum;
each round is written to the shared folder, which cuts the lineage. The
number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import discard, materialise


def _star(directed: DataFrame) -> DataFrame:
    """Each (u, v): v linked to the smallest node among u and its neighbours."""
    least = directed.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return directed.join(least, "u").select(F.col("v"), F.col("m"), F.col("u"))


def components(edges: DataFrame, src: str = "u", dst: str = "v") -> DataFrame:
    """(node, root) for every node of ``edges``; root is the smallest node of
    its component. Nulls and loops in the edges are ignored; an empty table
    gives an empty result."""
    e = (
        edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
        .where(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst)))
        .distinct()
    )
    e = materialise(e, "edges")
    before = None
    while True:
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.where(F.col("u") != F.col("v")).distinct(), "large")
        small = _star(large)
        small = (
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(small.select(F.col("u"), F.col("m").alias("v")))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        small = materialise(small, "small")
        # A star forest: every node has one edge and no root is a node.
        state = small.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        discard(large)
        discard(e)
        e = small
        if before == state:
            break
        before = state
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
