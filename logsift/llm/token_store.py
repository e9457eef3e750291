"""Token ids in binary blocks with Elias-Fano document boundaries (operator 5).

File format: a Parquet table of blocks, one row each, so that Spark's writer
commits them and any store that Spark reads can hold them.

========== ======================================================================
shard      number of the range partition; shards ascend with doc_id
block      number of the block in its shard
first      ids of the shard before this block
n_ids      ids in the block
docs       doc_id of the block's documents, ascending (null first)
ids        all ids of the block, little-endian; 2 bytes each if every id of the
           vocabulary fits, else 4 (``width``)
width      bytes of an id
low, low_bits, high, marks
           Elias-Fano form of the document ends: the low ``low_bits`` bits of
           each end packed in ``low``, the rest in unary in the bit vector
           ``high``; ``marks`` has the bit position of every 256th one, so that
           a select looks at a bounded stretch
========== ======================================================================

A block ends with a document. It is closed at ``BLOCK_IDS`` ids, so a task
holds one block and one document at most.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logsift.llm.bpe import vocabulary_path
from logsift.llm.common import run_path, small_batches, text_of
from logsift.llm.word_ids import word_ids

BLOCK_IDS = 1 << 20
#: Ones of the high bit vector between two recorded positions.
MARK_EVERY = 256
END_ID = 0
BLOCK_SCHEMA = (
    "shard int, block int, first long, n_ids long, docs array<long>, ids binary, width int, "
    "low binary, low_bits int, high binary, marks binary"
)
KINDS = {"int": pa.int32(), "long": pa.int64(), "array<long>": pa.list_(pa.int64()), "binary": pa.binary()}
BLOCK = pa.schema([(n, KINDS[t]) for n, t in (c.split() for c in BLOCK_SCHEMA.split(", "))])


class EliasFano:
    """A non-decreasing sequence of n numbers below ``universe`` in about
    n * (2 + log2(universe / n)) bits."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, marks: bytes):
        self.n, self.low_bits = n, low_bits
        self.low, self.high, self.marks = low, high, marks

    @classmethod
    def build(cls, values) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8), bitorder="little")
        ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        bits[ones] = 1
        high = np.packbits(bits, bitorder="little")
        return cls(n, low_bits, low.tobytes(), high.tobytes(), ones[::MARK_EVERY].astype("<u4").tobytes())

    def _low(self, i: int) -> int:
        at = i * self.low_bits
        raw = int.from_bytes(self.low[at // 8 : (at + self.low_bits + 7) // 8], "little")
        return (raw >> (at % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th number: the place of the i-th one, found from its mark."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(np.frombuffer(self.marks, "<u4")[i // MARK_EVERY])
        left = i % MARK_EVERY
        byte, word = at // 8, self.high[at // 8] >> (at % 8) << (at % 8)
        while (here := word.bit_count()) <= left:
            left -= here
            byte += 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        one = byte * 8 + (word & -word).bit_length() - 1
        return ((one - i) << self.low_bits) | self._low(i)

    def all(self) -> np.ndarray:
        """Every number, in one pass over the bit vector."""
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        high = np.flatnonzero(bits)[: self.n] - np.arange(self.n)
        low = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.n * self.low_bits]
        weights = 1 << np.arange(self.low_bits, dtype=np.int64)
        return (high << self.low_bits) + low.reshape(self.n, self.low_bits).astype(np.int64) @ weights


def _block(shard: int, number: int, first: int, width: int, docs: list, parts: list[bytes]) -> pa.RecordBatch:
    ends = np.cumsum([len(p) // width for p in parts])
    ef = EliasFano.build(ends)
    row = (shard, number, first, int(ends[-1]), docs, b"".join(parts), width, ef.low, ef.low_bits, ef.high, ef.marks)
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, BLOCK, strict=True)], schema=BLOCK)


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, shards: int | None = None) -> None:
    """Encode every whole text (null: empty), append ``END_ID`` to each document
    and write the blocks to ``path`` in ascending doc_id order.

    Documents are dealt out by ranges of (doc_id, hash of the text), so a
    doc_id that many rows share is spread too. Rows with a null doc_id come
    first; repeated rows are all written. An empty table writes no block.
    """
    spark = docs.sparkSession
    small_batches(spark)
    vocabulary = vocabulary or vocabulary_path()
    shards = shards or max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select("doc_id", text_of().alias("text"))
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(shards, *keys).sortWithinPartitions(*keys)

    def run(batches):
        encoder, shard = word_ids(vocabulary), TaskContext.get().partitionId()
        end = END_ID.to_bytes(encoder.width, "little")
        number = first = held = 0
        names: list = []
        parts: list[bytes] = []
        for b in batches:
            for name, ids in zip(b.column("doc_id").to_pylist(), encoder.batch(b.column("text").to_pylist()), strict=True):
                names.append(name)
                parts.append(ids + end)
                held += len(ids) // encoder.width + 1
                if held >= BLOCK_IDS:
                    yield _block(shard, number, first, encoder.width, names, parts)
                    number, first, held, names, parts = number + 1, first + held, 0, [], []
        if parts:
            yield _block(shard, number, first, encoder.width, names, parts)

    rows.mapInArrow(run, BLOCK_SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a written store: (doc_id, start, n_tokens, ids), where
    start counts the ids of all documents before it and ids holds the
    document's ids with the end id as little-endian 32-bit integers."""
    return _read(spark, path, "doc_id long, start long, n_tokens long, ids binary", lambda ids: ids.astype("<u4").tobytes())


def _read(spark: SparkSession, path: str, schema: str, value) -> DataFrame:
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    # One row a shard, so as many rows as the store was written with shards.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    starts = sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    name = schema.split(", ")[-1].split()[0]
    kind = KINDS[schema.split()[-1]]

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                ids = np.frombuffer(row["ids"], f"<u{row['width']}")
                ends = EliasFano(len(row["docs"]), row["low_bits"], row["low"], row["high"], row["marks"]).all()
                begins = np.concatenate(([0], ends[:-1]))
                values = [value(ids[a:b]) for a, b in zip(begins, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["docs"], pa.int64()),
                        pa.array(begins + row["base"] + row["first"], pa.int64()),
                        pa.array(ends - begins, pa.int64()),
                        pa.array(values, kind),
                    ],
                    names=["doc_id", "start", "n_tokens", name],
                )

    return blocks.join(F.broadcast(starts), "shard").mapInArrow(run, schema)


def offsets(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write all documents, read the files back and return (doc_id, start,
    n_tokens, ids_crc32) of each."""
    path = run_path(spark, "tokens")
    write_tokens(docs, path, vocabulary)
    return _read(
        spark,
        path,
        "doc_id long, start long, n_tokens long, ids_crc32 long",
        lambda ids: zlib.crc32(ids.astype("<u4").tobytes()),
    )
