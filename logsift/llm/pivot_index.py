"""Embedding near-duplicates by a pivot-permutation index (operator 6).

A vector is described by its ``NEAREST`` nearest reference points (pivots), in
order. Inverted lists by label and pivot hold the vectors that have the pivot
in their description; any two vectors of a list are verified by their cosine. A
pair is looked at in the list of its first shared pivot only, so every link
counts once.

Pivots are drawn from the vectors by a hash; their number is at most about the
square root of the number of vectors, between ``LEAST_PIVOTS`` and
``MOST_PIVOTS`` (this is the bounded sample), which keeps lists short as the
table grows. A vector closer than ``APART`` to a pivot is passed over, so a large
group of noisy copies holds one pivot or a few, which all its members share.

A vector y with the nearest pivot q can have a link to a vector whose nearest
pivot is p only if y is within the link's angle of the half space that is nearer
to p than to q. Where no pivot outside the description meets this bound, the
description is cut to those that do, and every link of y is found for certain.
Where more do (vectors far from all pivots), both ends of a link must share one
of their ``NEAREST`` pivots.

Every vector is indexed. Lists are compared in blocks of ``BLOCK`` by matrix
products; a block pair gives link counts by vector and a spanning forest of its
links, not the pairs. Equal vectors of one label are one member with a count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import materialise
from logsift.llm.components import components

THRESHOLD = 0.93
NEAREST = 8
LEAST_PIVOTS, MOST_PIVOTS = 64, 2048
#: Largest cosine of two pivots, and vectors looked at for each pivot wanted.
APART = 0.8
LOOKED_AT = 4
BLOCK = 512
NONE = np.iinfo(np.int64).max


def valid(embedding: str = "embedding"):
    """Not null, not zero, all components finite."""
    e = F.col(embedding)
    finite = F.forall(e, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(e, lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def spread(unit: np.ndarray, wanted: int) -> np.ndarray:
    """The first ``wanted`` rows that are not within ``APART`` of one before."""
    chosen = np.empty((min(wanted, len(unit)), unit.shape[1]))
    n = 0
    for u in unit:
        if n == len(chosen):
            break
        if n == 0 or (chosen[:n] @ u).max() < APART:
            chosen[n] = u
            n += 1
    return chosen[:n]


def describe(unit: np.ndarray, pivots: np.ndarray) -> list[np.ndarray]:
    """Numbers of the nearest pivots of each row, nearest first."""
    near = unit @ pivots.T
    k = min(NEAREST, near.shape[1])
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    top = np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable"), 1)
    # Sine of the angle to the half space nearer to a pivot than to the nearest.
    first = top[:, 0]
    apart = np.sqrt(np.maximum(2 - 2 * (pivots @ pivots.T)[first], 1e-12))
    away = (near[np.arange(len(unit)), first][:, None] - near) / apart
    possible = away <= np.sqrt(1 - THRESHOLD**2) + 1e-9
    own = np.take_along_axis(possible, top, 1)
    whole = own.sum(1) == possible.sum(1)
    return [t[o] if w else t for t, o, w in zip(top, own, whole, strict=True)]


def _indexed(members: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """One row for each member and pivot of its description."""

    def run(batches):
        for b in batches:
            label, rep, count = (b.column(c).to_pylist() for c in ("label", "rep", "count"))
            by_size: dict[int, list] = {}
            for k, e in enumerate(b.column("embedding").to_pylist()):
                by_size.setdefault(len(e), []).append((k, e))
            rows = []
            for size, some in by_size.items():
                unit = _unit(np.array([e for _, e in some], dtype=np.float64))
                # Vectors of a size without pivots share one list.
                order = describe(unit, pivots[size]) if size in pivots else [np.array([-1])] * len(some)
                for (k, _), u, o in zip(some, unit, order, strict=True):
                    o = o.astype("<i4")
                    rows += [(label[k], size, p, rep[k], count[k], u.tobytes(), o.tobytes()) for p in o.tolist()]
            cols = list(zip(*rows, strict=True)) or [()] * 7
            kinds = (b.schema.field("label").type, pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            arrays = [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["label", "size", "pivot", "rep", "count", "unit", "pivots"])

    kind = members.schema["label"].dataType.simpleString()
    return members.mapInArrow(run, f"label {kind}, size int, pivot int, rep long, count long, unit binary, pivots binary")


def _incidence(order: list[np.ndarray], numbers: np.ndarray) -> np.ndarray:
    """A row for each description: 1 where it holds one of ``numbers``."""
    out = np.zeros((len(order), len(numbers)), dtype=np.float32)
    row, flat = np.repeat(np.arange(len(order)), [len(o) for o in order]), np.concatenate(order)
    held = np.isin(flat, numbers)
    out[row[held], np.searchsorted(numbers, flat[held])] = 1
    return out


def _linked(a: dict, b: dict, pivot: int, same: bool) -> np.ndarray:
    """Which members of block a link with which of block b, by their pairs that
    have ``pivot`` as their first shared pivot."""
    near = a["unit"] @ b["unit"].T >= THRESHOLD
    lower = np.intersect1d(np.concatenate(a["order"]), np.concatenate(b["order"]))
    lower = lower[lower < pivot]
    if len(lower) and near.any():
        near &= (_incidence(a["order"], lower) @ _incidence(b["order"], lower).T) == 0
    if same:
        np.fill_diagonal(near, False)
    return near


def _links(lists: DataFrame) -> DataFrame:
    """(u, n, v): of member u, links found in one block pair, and the smallest
    member that they join it with."""
    on = ["label", "size", "pivot"]
    sizes = materialise(lists.groupBy(on).agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).where("blocks > 1"), "blocks")
    # Short lists are one block; longer ones are dealt out by a hash.
    block = F.coalesce(F.pmod(F.xxhash64("rep"), F.col("blocks")), F.lit(0)).cast("int")
    dealt = lists.join(sizes, on, "left").withColumn("block", block).withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    grouped = materialise(
        dealt.groupBy(*on, "block").agg(
            F.max("blocks").alias("blocks"), F.collect_list(F.struct("rep", "count", "unit", "pivots")).alias("members")
        ),
        "grouped",
    )
    alone = grouped.where("blocks = 1").select("pivot", "members", F.lit(None).cast(grouped.schema["members"].dataType).alias("others"))
    several = grouped.where("blocks > 1")
    right = several.select(*on, F.col("block").alias("other"), F.col("members").alias("others"))
    pairs = several.join(right, on).where("block <= other")
    pairs = pairs.select("pivot", "members", F.when(F.col("block") != F.col("other"), F.col("others")).alias("others"))

    def block_of(rows: list) -> dict:
        return {
            "rep": np.array([r["rep"] for r in rows], dtype=np.int64),
            "count": np.array([r["count"] for r in rows], dtype=np.int64),
            "unit": np.stack([np.frombuffer(r["unit"]) for r in rows]),
            "order": [np.frombuffer(r["pivots"], "<i4") for r in rows],
        }

    def run(batches):
        for batch in batches:
            u, n, v = [], [], []
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                a = block_of(row["members"])
                b = a if row["others"] is None else block_of(row["others"])
                near = _linked(a, b, row["pivot"], b is a)
                if not near.any():
                    continue
                at_a, at_b = a["rep"].copy(), b["rep"].copy()
                while True:  # labels sink to the least of their neighbours
                    new_a = np.minimum(at_a, np.where(near, at_b[None, :], NONE).min(1))
                    base_b = new_a if b is a else at_b
                    new_b = np.minimum(base_b, np.where(near, new_a[:, None], NONE).min(0))
                    if b is a:
                        new_a = new_b
                    if (new_a == at_a).all() and (new_b == at_b).all():
                        break
                    at_a, at_b = new_a, new_b
                found = [(a["rep"], near @ b["count"], at_a)]
                if b is not a:
                    found.append((b["rep"], near.T @ a["count"], at_b))
                for rep, count, least in found:
                    hit = np.flatnonzero(count)
                    u.append(rep[hit])
                    n.append(count[hit])
                    v.append(least[hit])
            arrays = [pa.array(np.concatenate(x) if x else np.array([], dtype=np.int64)) for x in (u, n, v)]
            yield pa.RecordBatch.from_arrays(arrays, names=["u", "n", "v"])

    return alone.unionByName(pairs).mapInArrow(run, "u long, n long, v long")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``.

    Rows link if their labels are equal and not null and the cosine is
    ``THRESHOLD`` or more. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, nor do vectors of different
    lengths. Repeated rows link with each other; component_id is the smallest
    vec_id reachable, kept marks the rows that have it. A null vec_id links
    like others but names no component while another vec_id does. An empty
    table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "embedding", "label")
    good = rows.where(valid() & F.col("label").isNotNull())
    # rep stands for a member where vec_ids may be null or repeat.
    member = F.xxhash64("label", "embedding").alias("rep")
    ids = materialise(good.select(member, "vec_id"), "ids")
    members = good.groupBy("label", "embedding").agg(F.count("*").alias("count")).select("label", "embedding", "count", member)
    members = materialise(members, "members")
    n = members.count()
    wanted = min(MOST_PIVOTS, max(LEAST_PIVOTS, 1 << (max(n, 1).bit_length() // 2)))
    sample = members.select("embedding").orderBy(F.xxhash64("rep"), "rep").limit(wanted * LOOKED_AT).toArrow()
    by_size: dict[int, list] = {}
    for e in sample.column("embedding"):
        by_size.setdefault(len(e), []).append(e.values.to_numpy(zero_copy_only=False))
    pivots = {size: spread(_unit(np.array(v, dtype=np.float64)), wanted) for size, v in by_size.items()}
    found = materialise(_links(_indexed(members, pivots)), "links")
    links = found.groupBy("u").agg(F.sum("n").alias("links"))
    roots = components(found, "u", "v")
    info = ids.groupBy("rep").agg(F.count("*").alias("count"), F.min("vec_id").alias("least"))
    info = info.join(links, F.col("rep") == F.col("u"), "left").join(roots, F.col("rep") == F.col("node"), "left")
    info = info.select(
        "rep", (F.coalesce("links", F.lit(0)) + F.col("count") - 1).alias("n_links"), "least", F.coalesce("root", "rep").alias("root")
    )
    info = materialise(info, "info")
    named = materialise(info.groupBy("root").agg(F.min("least").alias("component_id")), "named")
    info = materialise(info.join(named, "root").select("rep", "n_links", "component_id"), "judged")
    linked = ids.join(info, "rep").select("vec_id", "n_links", "component_id")
    rest = rows.where(~(valid() & F.col("label").isNotNull()))
    alone = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
