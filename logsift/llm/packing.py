"""Best-fit packing of documents into token sequences (operator 12).

1. Every text is encoded, ``END_ID`` is put behind it, and only what is longer than
   a sequence is cut into pieces of a whole sequence and a rest. The pieces are
   written once with the number of the writing task and their rank among the
   task's pieces of that length.
2. The histogram of lengths, a row for each length up to ``CAPACITY``, decides
   the bins: the configuration program of ``config_lp``. That is all that reaches
   the driver, whatever the number of documents.
3. A run of equal bins takes a range of the ranks of each of its lengths. The
   rank of a piece among all pieces of its length is its rank in its task plus the
   tasks before it, and a binary search of the ranges gives its sequence and its
   place there. So no length is gathered in one task, however common it is.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logsift.llm.common import materialise, small_batches, text_of
from logsift.llm.config_lp import Run, bins
from logsift.llm.word_ids import word_ids
from logsift.operators.joins import at_most

CAPACITY, END_ID = 4096, 1
RANK_BITS = 48
PIECE = "piece integer, start long, length integer, part integer, nth long, ids_crc32 long, width integer, ids binary"
#: Rows (of three numbers) that may be broadcast: a task and a length each.
FEW_ROWS = 100_000


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, its ids (little-endian,
    ``width`` bytes each) and the crc32 of them as 32-bit integers, the task that
    made it and its rank there (see above)."""
    small_batches(docs.sparkSession)
    vocabulary = vocabulary or vocabulary_path()
    rows = docs.select("doc_id", text_of().alias("text"))
    schema = rows.select("doc_id").schema
    names = ["doc_id", *(c.split()[0] for c in PIECE.split(", "))]

    def run(batches):
        encoder, part = word_ids(vocabulary), TaskContext.get().partitionId()
        width = encoder.width
        end, step = END_ID.to_bytes(width, "little"), capacity * encoder.width
        ranks: Counter = Counter()
        for b in batches:
            owner, cols = [], ([], [], [], [], [], [])
            for k, ids in enumerate(encoder.batch(b.column("text").to_pylist())):
                ids += end
                for n, at in enumerate(range(0, len(ids), step)):
                    cut = ids[at : at + step]
                    length = len(cut) // width
                    owner.append(k)
                    crc = zlib.crc32(np.frombuffer(cut, encoder.kind).astype("<u4"))
                    for column, v in zip(cols, (n, at // width, length, ranks[length], crc, cut), strict=True):
                        column.append(v)
                    ranks[length] += 1
            piece, start, length, nth, crc, cut = cols
            same = lambda v: pa.array([v] * len(owner), pa.int32())
            arrays = [b.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64())]
            arrays += [pa.array(length, pa.int32()), same(part), pa.array(nth, pa.int64()), pa.array(crc, pa.int64())]
            arrays += [same(width), pa.array(cut, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    for c in PIECE.split(", "):
        schema = schema.add(*c.split())
    return rows.mapInArrow(run, schema)


class Places:
    """Where the pieces of a length go: ranges of ranks, in one sorted array."""

    def __init__(self, runs: list[Run]):
        rows, sequence = [], 0
        taken: dict[int, int] = defaultdict(int)
        for count, content in runs:
            offset = 0
            for length, copies in content:
                rows.append((length << RANK_BITS | taken[length], taken[length], sequence, copies, offset))
                taken[length] += count * copies
                offset += length * copies
            sequence += count
        rows.sort()
        table = np.array(rows, dtype=np.int64).reshape(-1, 5)
        self.keys, self.first, self.sequence, self.copies, self.offset = np.ascontiguousarray(table.T)

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces with these lengths and ranks."""
        at = np.searchsorted(self.keys, (length << RANK_BITS) | rank, side="right") - 1
        bin_, copy = np.divmod(rank - self.first[at], self.copies[at])
        return self.sequence[at] + bin_, self.offset[at] + copy * length


def packed(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Every piece with its place: doc_id, piece, start, length, ids_crc32, ids (and
    their ``width`` in bytes; only ``with_ids``), sequence_id, offset.

    A null text counts as empty, so every document has an id at least; a null
    doc_id stays null; repeated rows are documents of their own. An empty table
    gives an empty result; other columns are not read.
    """
    cut = materialise(pieces(docs, vocabulary, capacity), "pieces")
    sizes = materialise(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[r.length] = r.n
    runs, _ = bins(histogram, capacity)
    places = Places(runs)
    # A row a task for each length: as many as the pieces were written by.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("begin"))
    few = at_most(sizes, FEW_ROWS)
    ranked = cut.join(F.broadcast(begins) if few else begins, ["length", "part"])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["width", "ids"] if with_ids else [])]
    rows = ranked.select(*columns, (F.col("begin") + F.col("nth")).alias("rank"))
    schema = rows.drop("rank").schema.add("sequence_id", "long").add("offset", "long")

    def run(batches):
        for b in batches:
            length, rank = (b.column(c).to_numpy().astype(np.int64) for c in ("length", "rank"))
            sequence, offset = places.of(length, rank)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sequence), pa.array(offset)], names=schema.names)

    return rows.mapInArrow(run, schema)


def sequences(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The sequences themselves: sequence_id, n_tokens, ids, and the begin of each
    piece in ``begins``. A group is one sequence, so ``capacity`` ids at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    rows = packed(docs, vocabulary, capacity).groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda out, p: F.concat(out, p["ids"]))
    return rows.select("sequence_id", "n_tokens", joined.alias("ids"), F.col("parts.offset").alias("begins"))


def digests(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every
    piece of ``packed``."""
    return packed(docs, vocabulary, capacity, with_ids=False)
