"""Large catalogues: lines against an index of the patterns' required texts.

A catalogue of some dozens of patterns is unrolled into the plan
(``functions.match``). With thousands the plan, and the work on every line, would
grow with the catalogue. Here the catalogue is a table with an index:

* Every match of a pattern holds the pattern's required literal. One substring of
  ``GRAM`` characters of it is the pattern's key, chosen so that few patterns share
  it. Literals of ``SHORT_GRAM`` to ``GRAM`` characters are their own key; patterns
  with less than that have the empty key.
* A line has those keys of the index that are substrings of it, and the empty one;
  numpy looks all places of a batch of lines up at once. An equi-join on the key
  gives the candidates; only on those the literal is looked for, and only on what is
  left the regex runs.

Each pattern has one key and each key of a line counts once, so a (line, pattern)
pair is a candidate once at most: there is no distinct over the match rows. Of
entries that share an id the first that matches makes the row: an entry carries
the patterns before it with its id, and is dropped where one of them matches.

The index is broadcast behind a check of its size, so matching stays one narrow
stage; beyond the bound a line has the keys of all its substrings and the join
shuffles on the key. The plan has the same size for any catalogue.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..sources.patterns import Pattern, grouped, validate
from .joins import at_most
from .lines import clean_lines

GRAM, SHORT_GRAM = 6, 3
#: Places of lines that are looked up at once, and bits of the table that sorts out most.
PLACES, TABLE_BITS = 1 << 20, 22
#: Index rows that may be broadcast (about 300 bytes each).
MAX_BROADCAST_PATTERNS = 500_000
INDEX_SCHEMA = "key string, position int, regexId string, pattern string, literal string, plain boolean, earlier array<string>"


def _grams(text: str) -> list[str]:
    size = min(len(text), GRAM)
    return [text[i : i + size] for i in range(len(text) - size + 1)] if size >= SHORT_GRAM else []


def index_rows(patterns: list[Pattern]) -> list[tuple]:
    """The index of a catalogue: rows of ``INDEX_SCHEMA``."""
    validate(patterns)
    literals = [p.literal() or p.required_literal() or "" for p in patterns]
    shared = Counter(g for text in literals for g in set(_grams(text)))
    earlier = {id(p): [q.pattern for q in members[:k]] for _, members in grouped(patterns) for k, p in enumerate(members)}
    out = []
    for k, (p, text) in enumerate(zip(patterns, literals, strict=True)):
        # The rarest key of the catalogue; the first of equals.
        key = min(_grams(text), key=lambda g: shared[g], default="")
        out.append((key, k, p.regex_id, p.pattern, text or None, p.literal() is not None, earlier[id(p)]))
    return out


def index_frame(spark: SparkSession, patterns: list[Pattern]) -> DataFrame:
    # Entries are configuration; equal ones are told apart by their place.
    return spark.createDataFrame(index_rows([Pattern(p.regex_id, p.pattern, p.fields) for p in patterns]), INDEX_SCHEMA)


def line_keys(line: Column) -> Column:
    """The distinct keys that a line can have candidates for."""

    def grams(size: int) -> Column:
        # Overlapping substrings in one pass over the line.
        return F.regexp_extract_all(line, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))

    return F.array_distinct(F.concat(F.array(F.lit("")), *[grams(n) for n in range(SHORT_GRAM, GRAM + 1)]))


class KeyFinder:
    """Which of some keys the lines of an Arrow array hold: a key counts once a line.
    Keys are found by their first bytes, as many as they have characters, so one
    beyond ASCII may be named where only its beginning is; the join asks for the
    whole literal anyway."""

    def __init__(self, keys: list[str]):
        self.keys = sorted(set(keys))
        self.names = pa.array(self.keys, pa.string())
        begins: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for k, key in enumerate(self.keys):
            if key:
                begins[len(key)][int.from_bytes(key.encode()[: len(key)], "little")].append(k)
        self.sizes = []
        for size, codes in begins.items():
            code = np.array(sorted(codes), dtype=np.uint64)
            table = np.zeros(1 << TABLE_BITS, dtype=bool)
            table[self._slot(code)] = True
            owners = [codes[int(c)] for c in code]
            first = np.cumsum([0] + [len(o) for o in owners])
            self.sizes.append((size, code, table, first, np.concatenate(owners)))

    @staticmethod
    def _slot(code: np.ndarray) -> np.ndarray:
        return (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)

    def _hits(self, text: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Numbers (line times keys plus key) of what is found in joined lines."""
        found = [np.empty(0, dtype=np.int64)]
        for at in range(0, len(text), PLACES):
            part = text[at : at + PLACES + GRAM - 1].astype(np.uint64)
            for size, code, table, first, owner in self.sizes:
                n = min(len(part) - size + 1, PLACES)
                if n <= 0:
                    continue
                here = part[:n].copy()
                for j in range(1, size):
                    here |= part[j : j + n] << np.uint64(8 * j)
                place = np.flatnonzero(table[self._slot(here)])
                here = here[place]
                k = np.minimum(np.searchsorted(code, here), len(code) - 1)
                line = np.searchsorted(ends, at + place, side="right")
                ok = code[k] == here
                ok &= at + place + size <= ends[np.minimum(line, len(ends) - 1)]
                k, line = k[ok], line[ok]
                copies = first[k + 1] - first[k]
                which = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
                key = owner[np.repeat(first[k], copies) + which]
                found.append(np.unique(np.repeat(line, copies) * len(self.keys) + key))
        return np.concatenate(found)

    def __call__(self, lines: pa.Array) -> pa.Array:
        lines = lines.cast(pa.large_string())
        _, offsets, data = lines.buffers()
        marks = np.frombuffer(offsets, dtype=np.int64)[lines.offset : lines.offset + len(lines) + 1]
        text = np.frombuffer(data or b"", dtype=np.uint8)[marks[0] : marks[-1]]
        numbers = [self._hits(text, marks[1:] - marks[0])]
        if self.keys and not self.keys[0]:
            numbers.append(np.flatnonzero(np.asarray(lines.is_valid())) * len(self.keys))
        line, key = np.divmod(np.unique(np.concatenate(numbers)), max(len(self.keys), 1))
        begins = np.searchsorted(line, np.arange(len(lines) + 1))
        return pa.ListArray.from_arrays(pa.array(begins, pa.int32()), self.names.take(pa.array(key)))


def with_keys(lines: DataFrame, line_col: str, keys: list[str]) -> DataFrame:
    """``lines`` with ``_keys``, the distinct ones of ``keys`` that a line can have
    candidates for."""
    schema = StructType([*lines.schema, StructField("_keys", ArrayType(StringType()))])

    def run(batches):
        finder = KeyFinder(keys)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, finder(b.column(line_col))], names=schema.names)

    return lines.mapInArrow(run, schema)


def match_indexed(
    lines: DataFrame,
    index: DataFrame,
    id_col: str = "log_id",
    line_col: str = "cleaned_line",
    max_broadcast: int = MAX_BROADCAST_PATTERNS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``regexId, <id>, line_number, matched_text`` as ``match_cleaned_lines``
    gives, for an index of any length."""
    entries = index.select(*[F.col(c).alias(f"_{c}") for c in index.columns])
    probes = lines.select(id_col, "line_number", F.col(line_col).alias("matched_text"), *carry)
    few = at_most(index, max_broadcast)
    if few:
        probes = with_keys(probes, "matched_text", [r.key for r in index.select("key").distinct().collect()])
    else:
        probes = probes.withColumn("_keys", line_keys(F.col("matched_text")))
    probes = probes.withColumn("_key", F.explode("_keys")).drop("_keys")
    line, literal = F.col("matched_text"), F.col("_literal")
    found = F.coalesce(line.contains(literal), F.lit(True)) & (F.col("_plain") | F.call_function("rlike", line, F.col("_pattern")))
    before = F.exists("_earlier", lambda p: F.call_function("rlike", line, p))
    hit = probes.join(F.broadcast(entries) if few else entries, "_key").where(found & ~before)
    return hit.select(F.col("_regexId").alias("regexId"), id_col, "line_number", "matched_text", *carry)


def match_lines_indexed(contents: DataFrame, patterns: list[Pattern], id_col: str = "log_id", content_col: str = "content") -> DataFrame:
    """Contents to match rows: split, clean, match by the index."""
    index = index_frame(contents.sparkSession, patterns)
    return match_indexed(clean_lines(contents, id_col, content_col), index, id_col)
