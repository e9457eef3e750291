"""Centroid clustering by bisector tournaments (operator 13).

A vector x is nearer to centroid a than to b on one side of their bisector:

    |x - a|^2 <= |x - b|^2   if and only if   2 x.(b - a) <= |b|^2 - |a|^2

For every pair of centroids the integer normal ``b - a`` and the threshold
``|b|^2 - |a|^2`` are worked out once a round. A vector's champion starts as
centroid 0 and meets 1, 2, ... in turn; the sign of one linear test eliminates
one of the two, and zero keeps the champion, which has the smaller number. After
k - 1 tests the champion is the nearest centroid, ties to the smaller number, and
only its distance is worked out.

All arithmetic is exact. A component x is the integer floor(256 * x), ``LIMIT``
bounds it so that tests and distances fit 64 bits, and tests are done in doubles
where a bound on them shows that doubles hold them exactly. Sums over vectors are
partial sums of each task, added up as decimals; k * (dims + 1) numbers reach the
driver in a round, which is no function of the number of vectors.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import materialise

CENTROIDS, ROUNDS, DIMS = 40, 5, 64
SCALE = 256
#: Components of this size or more would let a distance leave 64 bits.
LIMIT = float(1 << 18)
#: Vectors that meet the centroids together.
BLOCK = 4096
PREFIX = "2:"


class Tournament:
    """The bisectors of all pairs of ``centroids`` (k rows of integers)."""

    def __init__(self, centroids: list[list[int]]):
        c = self.centroids = np.array(centroids, dtype=np.int64)
        self.normals = c[None, :, :] - c[:, None, :]  # of a and b: b - a
        size = (c * c).sum(1)
        self.thresholds = size[None, :] - size[:, None]
        self.in_doubles = self.normals.astype(np.float64)
        self.widest, self.largest = (int(np.abs(a).max(initial=0)) for a in (self.normals, c))

    def champions(self, x: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each row of ``x``."""
        reach = 2 * x.shape[1] * self.widest * max(self.largest, int(np.abs(x).max(initial=0)))
        exact = 2 * reach < 1 << 53
        normals, rows = (self.in_doubles, x.astype(np.float64)) if exact else (self.normals, x)
        best = np.zeros(len(x), dtype=np.int64)
        for b in range(1, len(self.centroids)):
            side = 2 * np.einsum("nd,nd->n", rows, normals[best, b]) - self.thresholds[best, b]
            best[side > 0] = b
        return best

    def distances(self, x: np.ndarray, best: np.ndarray) -> np.ndarray:
        apart = x - self.centroids[best]
        return np.einsum("nd,nd->n", apart, apart)


def kept_vectors(vectors: DataFrame, dims: int = DIMS) -> DataFrame:
    """(vec_id, v): vectors of ``dims`` components that are all present, finite
    and under ``LIMIT``, as little-endian 32-bit integers floor(256 * x)."""
    x = F.col("embedding")
    good = (F.size(x) == dims) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < LIMIT))
    rows = vectors.where(x.isNotNull() & good).select("vec_id", x.cast("array<double>").alias("x"))

    def run(batches):
        for b in batches:
            column = b.column("x")
            whole = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE).astype("<i4")
            raw = whole.tobytes()
            step = 4 * dims
            packed = [raw[i : i + step] for i in range(0, len(raw), step)]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(packed, pa.binary())], names=["vec_id", "v"])

    return rows.mapInArrow(run, rows.select("vec_id").schema.add("v", "binary"))


def _blocks(batches, dims: int):
    """(ids, vectors) of about ``BLOCK`` rows from Arrow batches of any length."""
    held, count = [], 0
    for b in batches:
        for begin in range(0, b.num_rows, BLOCK):
            part = b.slice(begin, BLOCK)
            held.append(part)
            count += part.num_rows
            if count >= BLOCK:
                yield _block(held, dims)
                held, count = [], 0
    if count:
        yield _block(held, dims)


def _block(parts: list, dims: int):
    rows = pa.Table.from_batches(parts).combine_chunks()
    raw = b"".join(rows.column("v").to_pylist())
    return rows.column("vec_id").combine_chunks(), np.frombuffer(raw, "<i4").reshape(-1, dims).astype(np.int64)


def first_centroids(kept: DataFrame, k: int, dims: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest sha256 of their prefixed vec_id."""
    name = F.concat(F.lit(PREFIX), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = kept.orderBy(F.sha2(name, 256), "v").limit(k).select("v").collect()
    return [np.frombuffer(r.v, "<i4").tolist() for r in rows]


def _moved(kept: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """The centroids after a round: the floored means of their vectors."""

    def run(batches):
        field = Tournament(centroids)
        sums = np.zeros((len(centroids), dims + 1), dtype=np.int64)  # the last column counts
        for _, x in _blocks(batches, dims):
            best = field.champions(x)
            order = np.argsort(best, kind="stable")
            won, begins, counts = np.unique(best[order], return_index=True, return_counts=True)
            sums[won, :dims] += np.add.reduceat(x[order], begins)
            sums[won, dims] += counts
        cluster, dim = np.nonzero(sums)
        columns = [cluster.astype(np.int32), dim.astype(np.int32), sums[cluster, dim]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cluster", "dim", "total"])

    parts = kept.mapInArrow(run, "cluster int, dim int, total long")
    sums = parts.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {(r.cluster, r.dim): int(r.total) for r in sums.collect()}
    moved = []
    for c, at in enumerate(centroids):
        n = found.get((c, dims))
        moved.append([found.get((c, d), 0) // n for d in range(dims)] if n else at)
    return moved


def _assigned(kept: DataFrame, centroids: list[list[int]], dims: int) -> DataFrame:
    def run(batches):
        field = Tournament(centroids) if centroids else None  # none without vectors
        for ids, x in _blocks(batches, dims):
            best = field.champions(x)
            columns = [ids, pa.array(best.astype(np.int32)), pa.array(field.distances(x, best))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    schema = kept.select("vec_id").schema.add("cluster", "integer").add("distance", "long")
    return kept.mapInArrow(run, schema)


def clusters(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of
    every kept vector of ``vectors`` (vec_id, embedding).

    Null vectors, vectors of another length, and vectors with a null or
    non-finite component, or one of ``LIMIT`` or more in size, are left out. A
    null vec_id is hashed as an empty one; rows with one vec_id are vectors of
    their own, in an order fixed by their components where the hashes tie. With fewer than
    ``k`` vectors there are as many clusters as vectors; equal vectors go to the
    smaller number, so clusters may be empty. An inertia beyond 64 bits is null.
    An empty table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    kept = materialise(kept_vectors(vectors.select("vec_id", "embedding"), dims), "vectors")
    centroids = first_centroids(kept, k, dims)
    for _ in range(rounds if centroids else 0):
        centroids = _moved(kept, centroids, dims)
    # Written, as the sums over all rows are a column of every row.
    rows = materialise(_assigned(kept, centroids, dims), "clusters")
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    long = lambda n: n if n < 1 << 63 else None
    every = long(sum(int(r.total) for r in sums))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    lines = [(r.cluster, long(int(r.total)), every, digest[r.cluster]) for r in sums]
    totals = spark.createDataFrame(lines, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # A row for each of at most k clusters.
    return rows.join(F.broadcast(totals), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def oracle_sql(k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS) -> str:
    """The same in DuckDB SQL, one pair of subqueries a round."""
    parts = [
        f"""vecs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dims}
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs(x) < {int(LIMIT)})))""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('{PREFIX}' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM vecs ORDER BY h, v LIMIT {k}))""",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (
  SELECT r, first(vec_id) AS vec_id, first(v) AS v, arg_min(c, d * {k} + c) AS c, min(d) AS d
  FROM (SELECT r, vec_id, vecs.v, c,
      list_sum(list_transform(list_zip(vecs.v, c{i}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM vecs CROSS JOIN c{i})
  GROUP BY r)"""
        )
        if i < rounds:
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT old.c, coalesce(new.v, old.v) AS v
  FROM c{i} old LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY p) AS v
    FROM (SELECT c, p, sum(x) AS s, count(*) AS n
      FROM (SELECT c, unnest(v) AS x, unnest(range({dims})) AS p FROM a{i}) GROUP BY c, p)
    GROUP BY c) new ON old.c = new.c)"""
            )
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} m ON a.c = m.c"""
    )
