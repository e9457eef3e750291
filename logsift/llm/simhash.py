"""SimHash near-duplicates by tiled exact comparison (operator 3).

Every distinct fingerprint is compared, none is sampled. Fingerprints are put
into tiles by the population counts of their four 16-bit quarters. If two
fingerprints differ in r bits, these counts differ by r in sum at most, so
tile pairs further apart are skipped; the others are compared in full with
numpy's exclusive or and bit counts.

A tile pair gives a spanning forest of the links found in it, not all links:
components stay the same, and a large group of near copies gives as many rows
as it has members. Equal fingerprints are one fingerprint here, so groups of
exact copies cost nothing.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import materialise, small_batches, text_of
from logsift.llm.components import components

WORDS = 3
RADIUS = 2
SEED = 42
#: Fingerprints in one piece of a tile; two pieces are compared at once.
TILE_ROWS = 2048
#: Shingle hashes whose bits are counted at once.
BLOCK = 1 << 15
NONE = np.iinfo(np.int64).max


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit fingerprint of a whole text: a bit is 1 if it is set in over half
    the hashes of the shingles, repeats included. No word: 0."""
    # bytes.lower and bytes.split work on ASCII letters and white space only.
    w = (text or "").encode("utf-8").lower().split()
    if not w:
        return 0
    whole = b" ".join(w)
    ends = np.cumsum([len(x) + 1 for x in w])
    starts = ends - [len(x) + 1 for x in w]
    if len(w) >= words:
        starts, ends = starts[: len(w) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    n = len(starts)
    for k in range(0, n, BLOCK):
        pairs = zip(starts[k : k + BLOCK].tolist(), (ends[k : k + BLOCK] - 1).tolist(), strict=True)
        h = np.array([digest(whole[a:b], SEED) for a, b in pairs], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, text: str = "text", key: str | None = None) -> DataFrame:
    """(doc_id, fp) of every row, and the string column ``key`` if one is named;
    fp as a signed 64-bit number. Null and empty texts have fingerprint 0."""
    small_batches(docs.sparkSession)
    more = [key] if key else []

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], dtype=np.uint64)
            columns = [b.column(0), pa.array(fps.view(np.int64)), *(b.column(c) for c in more)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", *more])

    return docs.select("doc_id", text, *more).mapInArrow(run, ", ".join(["doc_id long, fp long", *(f"{c} string" for c in more)]))


def _quarters(fp: str) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(F.col(fp), 16 * k).bitwiseAND(F.lit(0xFFFF))).cast("int") for k in range(4)]


def _tile(counts: list) -> Column:
    """Four counts from 0 to 16 in one number; others than those give -1."""
    inside = F.lit(True)
    for c in counts:
        inside = inside & c.between(0, 16)
    key = counts[0]
    for c in counts[1:]:
        key = key * 17 + c
    return F.when(inside, key).otherwise(-1)


def _steps(radius: int) -> list[tuple]:
    """Half of the count differences within the radius: each tile pair once."""
    near = [s for s in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, s)) <= radius]
    return [s for s in near if s >= (0, 0, 0, 0)]


def _forest(a: np.ndarray, b: np.ndarray, radius: int):
    """Links between a and b as (node, smaller node) rows that join up the same
    nodes: labels sink to the least of their neighbours until none changes."""
    near = np.empty((len(a), len(b)), dtype=bool)
    for k in range(0, len(a), 256):
        near[k : k + 256] = np.bitwise_count(a[k : k + 256, None] ^ b[None, :]) <= radius
    rows, cols = near.any(1), near.any(0)
    if not rows.any():
        return None
    a, b, near = a[rows].view(np.int64), b[cols].view(np.int64), near[np.ix_(rows, cols)]
    at_a, at_b = a.copy(), b.copy()
    while True:
        new_a = np.minimum(at_a, np.where(near, at_b[None, :], NONE).min(1))
        new_b = np.minimum(at_b, np.where(near, new_a[:, None], NONE).min(0))
        if (new_a == at_a).all() and (new_b == at_b).all():
            break
        at_a, at_b = new_a, new_b
    nodes, least = np.concatenate((a, b)), np.concatenate((at_a, at_b))
    keep = nodes != least
    return nodes[keep], least[keep]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v) rows that connect all fingerprints ``fp`` within ``radius`` bits."""
    tiled = distinct.select("fp", _tile(_quarters("fp")).alias("tile"))
    sizes = materialise(tiled.groupBy("tile").agg(F.ceil(F.count("*") / TILE_ROWS).alias("pieces")), "tile_sizes")
    pieces = materialise(
        tiled.join(sizes, "tile")
        .groupBy("tile", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int").alias("piece"))
        .agg(F.collect_list("fp").alias("fps")),
        "tiles",
    )
    digits = [F.floor(F.col("tile") / 17**k).cast("int") % 17 for k in (3, 2, 1, 0)]
    near = F.array(*[_tile([d + s for d, s in zip(digits, step, strict=True)]) for step in _steps(radius)])
    left = pieces.select(F.explode(near).alias("near"), F.col("tile").alias("own"), F.col("piece").alias("part"), "fps")
    left = left.where("near >= 0")
    right = pieces.select(F.col("tile").alias("near"), "piece", F.col("fps").alias("others"))
    pairs = left.join(right, "near").where("own != near or part <= piece")

    def run(batches):
        for pdf in batches:
            out = []
            for a, b in zip(pdf["fps"], pdf["others"], strict=True):
                a, b = (np.asarray(x, dtype=np.int64).view(np.uint64) for x in (a, b))
                if (found := _forest(a, b, radius)) is not None:
                    out.append(found)
            if out:
                yield pd.DataFrame({"u": np.concatenate([x for x, _ in out]), "v": np.concatenate([x for _, x in out])})

    return pairs.select("fps", "others").mapInPandas(run, "u long, v long")


def _named(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, root, component_id) of every fingerprint: the smallest fingerprint
    and the smallest doc_id of its component."""
    distinct = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct.select("fp"), radius))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return materialise(rooted.join(least, "root").select("fp", "root", "component_id"), "named")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``.

    Two rows link if their fingerprints differ in ``radius`` bits at most;
    component_id is the smallest doc_id reachable over links, the row's own
    included. Null and empty texts have fingerprint zero, linked like any
    other. Repeated rows come out repeated. A null doc_id takes part in links;
    a component without any doc_id has component_id null.
    """
    fps = materialise(fingerprints(docs, words), "fingerprints")
    named = _named(fps, radius)
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest
    doc_id (of the component's rows with that doc_id, the first by text). Where
    a component has no doc_id, its first row by text stays."""
    # doc_id and text tell a row's component; a doc_id alone, null or repeated, does not.
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), text_of()))
    k_key, k_root = (_free(name, docs.columns) for name in ("k_key", "k_root"))
    keyed = docs.withColumn(k_key, key)
    fps = materialise(fingerprints(keyed, words, key=k_key), "fingerprints")
    found = fps.join(_named(fps, radius), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Written, so that rows with one doc_id and text can be split in the join.
    chosen = materialise(found.select(k_key, F.col("root").alias(k_root)).distinct(), "chosen")
    kept = keyed.join(chosen, k_key)
    once = kept.groupBy(k_root).agg(F.min(F.struct(*[F.col(c) for c in ordered(docs)])).alias("row"))
    return once.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def _free(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column has it."""
    lower = {c.lower() for c in taken}
    while name in lower:
        name += "_"
    return name


def ordered(df: DataFrame) -> list[str]:
    """Columns in the order that decides between rows with one doc_id."""
    first = [c for c in ("doc_id", "text") if c in df.columns]
    return first + [c for c in df.columns if c not in first]
