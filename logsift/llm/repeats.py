"""Repeated byte strings by column-wise suffix sorting (operator 8).

Removes every byte that lies in a string of ``length`` bytes (a parameter;
``LENGTH`` unless given) that also starts anywhere else in the collection. The order of the collection's suffixes is
built one column a round, from the last column to the first: each round puts
one symbol in front of every member, sorts the members stably by it (the new
column of the collection's Burrows-Wheeler transform) and renews the common
prefixes of neighbours. A window is repeated if its common prefix with a
neighbour reaches the length.

One collection of everything would take as many rounds as the longest text has
bytes, so the collection is first dealt into parts that cannot share a string:

* A window's anchor is its ``gram``-byte substring with the least hash (the
  leftmost of equals). Equal windows have equal anchors at equal places, so
  only windows with one anchor string are compared, aligned at the anchor.
  That bounds the columns by 2 * length - gram, whatever the texts' lengths.
* Neighbouring windows with one anchor form a run. Runs that agree in all their
  bytes are one member with a count; a count over one settles it. Anchor
  strings whose runs all agree, which is what the inside of a shared passage
  gives, need no sorting. Only the rest is sorted: the edges of passages.
* A part with more than ``PART`` different members is dealt again by ``DEAL``
  windows and the bytes that all of these share, at last by single windows;
  so no task holds an unbounded part, and nothing is left out.

What passes from round to round between tasks are Spark's shuffle files and
Parquet tables in the shared folder, read and written in sequence; inside a
task only the columns of a bounded part are held.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import materialise, small_batches, text_of

LENGTH = 400
#: Different members of a part that are sorted together.
PART = 512
DEAL = (30, 1)
#: Bytes whose windows are hashed at once.
CHUNK = 1 << 20
#: Bytes of an Arrow batch that become Python objects at once.
PIECE = 1 << 20
END = 256  # the symbol after the end of a member; equal to nothing
MEMBER = "g long, f long, data binary, off int, n int"


@dataclass(frozen=True)
class Sizes:
    """Bytes of a window, and what follows from them: bytes of an anchor, anchors
    of a window, columns of aligned members. A stretch of ``DEAL`` windows must
    share bytes, so a window has 64 at least."""

    length: int

    def __post_init__(self):
        if not 64 <= self.length <= CHUNK // 4:
            raise ValueError(f"length must be from 64 to {CHUNK // 4}, not {self.length}")

    @property
    def gram(self) -> int:
        return self.length * 2 // 5

    @property
    def windows(self) -> int:
        return self.length - self.gram + 1

    @property
    def columns(self) -> int:
        return 2 * self.length - self.gram


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


_TABLES: list = []


def _tables() -> list:
    if not _TABLES:
        values = np.frombuffer(b"".join(hashlib.sha256(bytes([b])).digest()[:8] for b in range(256)), "<u8")
        _TABLES.extend((values, *_powers(CHUNK)))
    return _TABLES


def _window_anchors(data: np.ndarray, size: Sizes) -> np.ndarray:
    """For each window of ``data``: the anchor's hash above, its place in the
    low 24 bits."""
    values, power, inverse = _tables()
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values[data] * power[:n], out=sums[1:])
    grams = (sums[size.gram:] - sums[: n - size.gram + 1]) * inverse[: n - size.gram + 1]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    packed = (grams & ~np.uint64(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
    # Least of the anchors of every window, from the running minima of blocks.
    count = len(packed) - size.windows + 1
    blocks = np.full((-(-len(packed) // size.windows), size.windows), ~np.uint64(0))
    blocks.reshape(-1)[: len(packed)] = packed
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:count], ahead[size.windows - 1 : size.windows - 1 + count])


def _runs(texts: list[bytes], sizes: Sizes):
    """(text number, first window, windows, place of the anchor in the first
    window) of every run in the texts."""
    held, size, length = [], 0, sizes.length
    for k, t in enumerate(texts):
        for begin in range(0, max(1, len(t) - length + 1), CHUNK - length):
            part = t[begin : begin + CHUNK - 1]
            if len(part) < length:
                continue
            if size + len(part) > CHUNK:
                yield from _chunk_runs(held, sizes)
                held, size = [], 0
            held.append((k, begin, part))
            size += len(part)
    yield from _chunk_runs(held, sizes)


def _chunk_runs(held: list, size: Sizes):
    if not held:
        return
    data = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
    least = _window_anchors(data, size)
    sizes = np.array([len(p) for _, _, p in held])
    begins = np.cumsum(sizes) - sizes
    starts = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    # A run ends at the next one or at its text's last window.
    starts = np.unique(np.concatenate((starts, begins[begins < len(least)])))
    owner = np.searchsorted(begins, starts, side="right") - 1
    last = begins + sizes - size.length + 1
    ends = np.minimum(np.concatenate((starts[1:], [len(least)])), last[owner])
    good = ends > starts
    starts, ends, owner = starts[good], ends[good], owner[good]
    places = (least[starts] & np.uint64(0xFFFFFF)).astype(np.int64)
    # A part that is not its text's last leaves the windows of the overlap to the next.
    for s, e, o, p in zip(starts.tolist(), ends.tolist(), owner.tolist(), places.tolist(), strict=True):
        k, begin, _ = held[o]
        yield k, begin + s - int(begins[o]), e - s, p - s


def _pieces(batches):
    """The batches in slices of about ``PIECE`` bytes, a row at least."""
    for b in batches:
        rows = max(1, b.num_rows * PIECE // max(1, b.nbytes))
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def text_key(text: str = "text") -> Column:
    """Sixteen bytes that stand for a text."""
    return F.substring(F.unhex(F.sha2(text_of(text), 256)), 1, 16)


def _occurrences(docs: DataFrame, size: Sizes) -> DataFrame:
    """One row for each run of each text: g and f are hashes of its anchor and
    of all its bytes, key its text, at and n its windows, off the anchor."""

    def run(batches):
        for b in _pieces(batches):
            keys = b.column("key").to_pylist()
            texts = [t.encode("utf-8") for t in b.column("text").to_pylist()]
            g, f, key, at, n, off = [], [], [], [], [], []
            for k, s, windows, place in _runs(texts, size):
                data, p = texts[k], s + place
                g.append(xxhash.xxh64_intdigest(data[p : p + size.gram]))
                f.append(xxhash.xxh64_intdigest(data[s : s + windows - 1 + size.length], place + 1))
                key.append(keys[k])
                at.append(s)
                n.append(windows)
                off.append(place)
            hashes = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (g, f)]
            ints = [pa.array(x, pa.int32()) for x in (at, n, off)]
            yield pa.RecordBatch.from_arrays(
                [*hashes, pa.array(key, pa.binary()), *ints], names=["g", "f", "key", "at", "n", "off"]
            )

    rows = docs.select(text_key().alias("key"), text_of().alias("text")).where(F.octet_length("text") >= size.length)
    return rows.mapInArrow(run, "g long, f long, key binary, at int, n int, off int")


def _sorted_windows(data: list[bytes], off: list[int], n: list[int], group: np.ndarray, size: Sizes) -> np.ndarray:
    """For members of parts (``group``, ascending): which windows are repeated,
    as a matrix by the first column of the window."""
    m = len(data)
    columns = np.full((size.columns, m), END, dtype=np.int32)
    for i, (d, o) in enumerate(zip(data, off, strict=True)):
        columns[size.windows - 1 - o : size.windows - 1 - o + len(d), i] = np.frombuffer(d, np.uint8)
    base = group.astype(np.int64) * (END + 1)
    order = np.arange(m)
    common = np.zeros(m + 1, dtype=np.int32)  # of order[i - 1] and order[i]
    found = np.zeros((size.windows, m), dtype=bool)
    for c in range(size.columns - 1, -1, -1):
        symbol = columns[c][order]
        key = base[order] + symbol
        into = np.argsort(key, kind="stable")
        key = key[into]
        same = np.flatnonzero((key[1:] == key[:-1]) & (symbol[into[1:]] != END))
        renewed = np.zeros(m + 1, dtype=np.int32)
        if len(same):
            spans = np.empty(2 * len(same), dtype=np.int64)
            spans[::2], spans[1::2] = into[same] + 1, into[same + 1] + 1
            renewed[same + 1] = np.minimum.reduceat(common, spans)[::2] + 1
        order, common = order[into], renewed
        if c < size.windows:
            long = common >= size.length
            found[c, order] = long[:-1] | long[1:]
    return found


def _sort_parts(members: DataFrame, size: Sizes) -> DataFrame:
    """(g, f, lo, hi): ranges of repeated windows of the members of parts that
    hold ``PART`` members at most. The parts of a task follow each other in its
    rows, so it holds those that are sorted together and no more."""
    most = 8 * PART

    def found(g, f, data, off, n, group) -> pa.RecordBatch:
        out: list[tuple] = []
        hits = _sorted_windows(data, off, n, np.array(group), size)
        for i in np.flatnonzero(hits.any(0)).tolist():
            begin = size.windows - 1 - off[i]
            hit = np.diff(np.concatenate(([0], hits[begin : begin + n[i], i].astype(np.int8), [0])))
            lows, highs = np.flatnonzero(hit == 1).tolist(), (np.flatnonzero(hit == -1) - 1).tolist()
            out += [(g[i], f[i], lo, hi) for lo, hi in zip(lows, highs, strict=True)]
        cols = list(zip(*out, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["g", "f", "lo", "hi"])

    def run(batches):
        held: list[list] = [[], [], [], [], [], []]
        for b in _pieces(batches):
            for row in zip(*(b.column(c).to_pylist() for c in ("g", "f", "data", "off", "n")), strict=True):
                g, group = held[0], held[-1]
                other = not g or g[-1] != row[0]
                if other and len(g) >= most:
                    yield found(*held)
                    held = [[], [], [], [], [], []]
                    group = held[-1]
                for column, v in zip(held, (*row, group[-1] + other if group else 0), strict=True):
                    column.append(v)
        if held[0]:
            yield found(*held)

    rows = members.select("g", "f", "data", "off", "n").repartition("g").sortWithinPartitions("g")
    return rows.mapInArrow(run, "g long, f long, lo int, hi int")


def _dealt(members: DataFrame, width: int, size: Sizes) -> DataFrame:
    """Members cut into stretches of ``width`` windows; their new part is named
    by the bytes that all windows of the stretch share."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [()] * 8
        signed = lambda x: pa.array(np.array(x, dtype=np.uint64).view(np.int64))
        ints = lambda x: pa.array(x, pa.int32())
        arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), ints(cols[2]), signed(cols[3]), signed(cols[4])]
        arrays += [pa.array(cols[5], pa.binary()), ints(cols[6]), ints(cols[7])]
        return pa.RecordBatch.from_arrays(arrays, names=["of_g", "of_f", "base", "g", "f", "data", "off", "n"])

    most = 8 * PART

    def run(batches):
        rows: list[tuple] = []
        for b in _pieces(batches):
            for r in b.to_pylist():
                data, off, n = r["data"], r["off"], r["n"]
                for d in range((off - n + 1) // width, off // width + 1):
                    near, far = d * width, min((d + 1) * width - 1, size.windows - 1)
                    lo, hi = max(0, off - far), min(n - 1, off - near)
                    g = xxhash.xxh64_intdigest(data[off - near : off - far + size.length], d * 1000 + width)
                    cut = data[lo : hi + size.length]
                    f = xxhash.xxh64_intdigest(cut, off - lo + 1)
                    rows.append((r["g"], r["f"], lo, g, f, cut, off - lo, hi - lo + 1))
                # A member gives a row for each of its windows at the most.
                if len(rows) >= most:
                    yield batch(rows)
                    rows = []
        if rows:
            yield batch(rows)

    return members.mapInArrow(run, f"of_g long, of_f long, base int, {MEMBER}")


def _repeated_windows(members: DataFrame, size: Sizes, deal: tuple = DEAL) -> DataFrame:
    """(g, f, lo, hi) of members that are different within their part."""
    # Written first, so that both sides of the join are plain shuffles, which
    # Spark can split where an anchor is common.
    sizes = materialise(members.groupBy("g").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    sized = members.join(sizes, "g")
    out = _sort_parts(sized.where(F.col("size") <= PART).drop("size"), size)
    large = materialise(sized.where(F.col("size") > PART).drop("size"), "large")
    if not deal or large.isEmpty():
        return out
    cut = materialise(_dealt(large, deal[0], size), "dealt")
    counted = cut.groupBy("g", "f").agg(
        F.count("*").alias("count"), F.first("data").alias("data"), F.first("off").alias("off"), F.first("n").alias("n")
    )
    counted = materialise(counted, "counted")
    deeper = _repeated_windows(counted.drop("count"), size, deal[1:])
    settled = counted.where("count > 1").select("g", "f", F.lit(0).alias("lo"), (F.col("n") - 1).alias("hi"))
    found = deeper.unionAll(settled)
    back = cut.select("g", "f", "of_g", "of_f", "base").join(found, ["g", "f"])
    return out.unionAll(
        back.select(F.col("of_g").alias("g"), F.col("of_f").alias("f"), (F.col("base") + F.col("lo")).alias("lo"), (F.col("base") + F.col("hi")).alias("hi"))
    )


def _packed(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns``, key and the text as compressed UTF-8, which makes the
    shuffles of whole texts smaller."""

    def run(batches):
        press = zstandard.ZstdCompressor(level=3)
        for b in _pieces(batches):
            packed = pa.array([press.compress(t.encode("utf-8")) for t in b.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], packed], names=[*b.schema.names[:-1], "packed"])

    rows = docs.select(*columns, text_key().alias("key"), text_of().alias("text"))
    schema = rows.drop("text").schema.add("packed", "binary")
    return rows.mapInArrow(run, schema)


def _members(docs: DataFrame, runs: DataFrame, size: Sizes) -> DataFrame:
    """The bytes of one run of each (g, f) in ``runs``."""
    chosen = runs.groupBy("g", "f").agg(F.min(F.struct("key", "at", "n", "off")).alias("r"))
    by_text = chosen.groupBy("r.key").agg(F.collect_list(F.struct("g", "f", "r.at", "r.n", "r.off")).alias("runs"))
    texts = _packed(docs, "doc_id")
    # One row of each group of copies.
    firsts = docs.groupBy(text_key().alias("key")).agg(F.min("doc_id").alias("doc_id"))
    wanted = by_text.join(firsts, "key")
    pairs = texts.join(wanted.withColumnRenamed("doc_id", "first_id"), "key").where("doc_id <=> first_id")

    def run(batches):
        unpress = zstandard.ZstdDecompressor()
        for b in _pieces(batches):
            cols: list[list] = [[], [], [], [], []]
            for packed, rows in zip(b.column("packed").to_pylist(), b.column("runs").to_pylist(), strict=True):
                data = unpress.decompress(packed)
                for r in rows:
                    cut = data[r["at"] : r["at"] + r["n"] - 1 + size.length]
                    for c, v in zip(cols, (r["g"], r["f"], cut, r["off"], r["n"]), strict=True):
                        c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["g", "f", "data", "off", "n"]
            )

    return pairs.select("packed", "runs").mapInArrow(run, MEMBER).dropDuplicates(["g", "f"])


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, spans): for each text with repeated windows of ``length`` bytes, the
    ranges (lo, hi) of their first bytes."""
    small_batches(docs.sparkSession)
    size = Sizes(length)
    runs = materialise(_occurrences(docs, size), "runs")
    anchors = materialise(
        runs.groupBy("g")
        .agg(F.count("*").alias("count"), F.min("f").alias("least"), F.max("f").alias("most"))
        .where("count > 1")
        .select("g", (F.col("least") == F.col("most")).alias("agree")),
        "anchors",
    )
    shared = materialise(runs.join(anchors, "g"), "shared")
    differ = shared.where("not agree")
    counts = differ.groupBy("g", "f").agg(F.count("*").alias("count"), F.first("n").alias("n"))
    whole = counts.where("count > 1").select("g", "f", F.lit(0).alias("lo"), (F.col("n") - 1).alias("hi"))
    members = materialise(_members(docs, differ, size), "members")
    found = materialise(_repeated_windows(members, size).unionAll(whole), "found")
    edges = differ.join(found, ["g", "f"]).select(
        "key", (F.col("at") + F.col("lo")).alias("lo"), (F.col("at") + F.col("hi")).alias("hi")
    )
    inside = shared.where("agree").select("key", F.col("at").alias("lo"), (F.col("at") + F.col("n") - 1).alias("hi"))
    spans = edges.unionAll(inside).groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    return materialise(spans, "spans")


def _covered(spans: list | None, length: int) -> list[tuple[int, int]]:
    """Maximal covered byte ranges (begin, end)."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((s["lo"], s["hi"] + length) for s in spans or ()):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _kept(data: bytes, cut: list[tuple[int, int]]) -> bytes:
    ends = [0, *(e for _, e in cut)]
    begins = [*(b for b, _ in cut), len(data)]
    return b"".join(data[a:b] for a, b in zip(ends, begins, strict=True))


def _joined(docs: DataFrame, length: int, *columns: str) -> DataFrame:
    return _packed(docs, *columns).join(repeated_spans(docs, length), "key", "left").drop("key")


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row.

    A null text counts as empty; texts under ``length`` bytes are kept whole.
    Repeated rows are copies of each other: from ``length`` bytes on, all of
    their bytes go. An empty table gives an empty result.
    """

    def run(batches):
        unpress = zstandard.ZstdDecompressor()
        for b in _pieces(batches):
            rows = []
            for packed, spans in zip(b.column("packed").to_pylist(), b.column("spans").to_pylist(), strict=True):
                data = unpress.decompress(packed)
                cut = _covered(spans, length)
                digest = hashlib.sha256(_kept(data, cut)).hexdigest()
                rows.append((len(data), sum(e - s for s, e in cut), len(cut), digest))
            cols = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            arrays = [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *arrays], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )

    return _joined(docs, length, "doc_id").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text`` (bytes of a character
    that was cut apart go too) and n_chars, where there is one, counted anew.
    All rows stay; a text without repeats stays as it is, null included."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    renamed = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)], "text")
    missing = docs.schema["text"].nullable
    rows = renamed.withColumn("was_null", F.col("text").isNull())

    def run(batches):
        unpress = zstandard.ZstdDecompressor()
        for b in _pieces(batches):
            texts = []
            for packed, spans in zip(b.column("packed").to_pylist(), b.column("spans").to_pylist(), strict=True):
                data = unpress.decompress(packed)
                texts.append(_kept(data, _covered(spans, length)).decode("utf-8", "ignore"))
            kept = [b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=[*names, "text"])

    names = [*[f"c{i}" for i in range(len(others))], "was_null"]
    joined = _joined(rows.withColumn("doc_id", F.col(f"c{others.index('doc_id')}")), length, *names)
    out = joined.mapInArrow(run, joined.select(*names).schema.add("text", "string"))
    text = F.when(F.col("was_null"), None).otherwise(F.col("text")) if missing else F.col("text")
    value = {c: F.col(f"c{i}") for i, c in enumerate(others)} | {"text": text, "n_chars": F.length(text).cast("long")}
    return out.select(*[value[c].alias(c) for c in docs.columns])
