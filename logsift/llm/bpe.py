"""Byte-level BPE encoding and decoding (operator 9).

A text is cut into pieces at which no merge can cross, each distinct piece is
merged once, and the ids of a text are the concatenated ids of its pieces.

Merging uses a priority queue of (merge rank, position) over a doubly linked
list of symbols: the best pair is popped, skipped if one of its ends has
changed since (stale), and otherwise joined, which queues the two new pairs.
Decoding concatenates the vocabulary strings and maps them back to bytes.

The vocabulary file is a parameter; every Python worker reads it once.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from logsift.llm.common import small_batches

#: Distinct pieces, and pre-tokens in each of two generations, that a worker
#: keeps; they bound its memory.
CACHE_PIECES, CACHE_TOKENS = 250_000, 300_000
#: Longer pieces and pre-tokens are not kept.
CACHE_LENGTH = 64
#: Fixed value: the byte-level split pattern of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1
    bytes stand for themselves, the others follow from 256 on."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in keep else extra))
        extra += b not in keep
    return out

class Uneven(Exception):
    """A piece ends in white space that goes on after it."""


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        symbols = byte_symbols()
        self.first = [vocab[s] for s in symbols]
        #: by left id: right id -> rank; rank -> joined id
        self.ranks, self.joined = [{} for _ in range(max(vocab.values()) + 1)], []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[a]][vocab[b]] = rank
            self.joined.append(vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        order = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, order)) + ")") if order else None
        back = {s: b for b, s in enumerate(symbols)}
        self.strings = {i: bytes(back[c] for c in s) for s, i in vocab.items() if all(c in back for c in s)}
        self.strings |= {i: s.encode() for s, i in self.special.items()}
        self.split = regex.compile(PATTERN)
        self.pieces: dict[str, bytes] = {}
        self.tokens: dict[str, bytes] = {}
        self.older_tokens: dict[str, bytes] = {}

    def merged(self, data: bytes) -> bytes:
        """Little-endian 32-bit ids of one pre-token."""
        first, ranks, joined = self.first, self.ranks, self.joined
        ids = [first[b] for b in data]
        n = len(ids)
        # A queue entry is rank * n + position, so that entries compare by
        # rank and then from left to right.
        queue = []
        for i in range(n - 1):
            rank = ranks[ids[i]].get(ids[i + 1])
            if rank is not None:
                queue.append(rank * n + i)
        if queue:
            left, right = list(range(-1, n - 1)), [*range(1, n), -1]
            heapify(queue)
            while queue:
                rank, i = divmod(heappop(queue), n)
                a, j = ids[i], right[i]
                if a < 0 or j < 0 or ranks[a].get(ids[j]) != rank:
                    continue  # stale: an end was joined with something else
                ids[i] = a = joined[rank]
                ids[j] = -1
                right[i] = k = right[j]
                if k >= 0:
                    left[k] = i
                    rank = ranks[a].get(ids[k])
                    if rank is not None:
                        heappush(queue, rank * n + i)
                h = left[i]
                if h >= 0:
                    rank = ranks[ids[h]].get(a)
                    if rank is not None:
                        heappush(queue, rank * n + h)
            ids = [x for x in ids if x >= 0]
        return array("I", ids).tobytes()

    def token(self, text: str) -> bytes:
        """Ids of one pre-token, kept for the next time."""
        got = self.tokens.get(text)
        if got is None:
            got = self.older_tokens.get(text) or self.merged(text.encode("utf-8"))
            if len(text) <= CACHE_LENGTH:
                self.tokens[text] = got
        return got

    def piece(self, w: str) -> bytes:
        """Ids of what stands between two cuts of ``plain``: a line's first
        word with its line end, or a word without the space before it."""
        raw = w if w[0] == "\n" else " " + w
        if w[-1].isspace():
            raise Uneven
        if w.isalpha():
            got = self.token(raw)
        elif w[:-1].isalpha() and w[-1] in ".,":
            got = self.token(raw[:-1]) + self.token(w[-1])
        else:
            got = b"".join(map(self.token, self.split.findall(raw)))
        if len(w) <= CACHE_LENGTH:
            self.pieces[w] = got
        return got

    def plain(self, text: str) -> bytes:
        if len(self.pieces) >= CACHE_PIECES:
            self.pieces = {}
        if len(self.tokens) >= CACHE_TOKENS:
            self.older_tokens, self.tokens = self.tokens, {}
        # A pre-token starts at each space or line end that follows another
        # character, so the text may be cut there.
        words = text.replace("\n", " \n").split(" ")
        get, piece = self.pieces.get, self.piece
        try:
            if "" in words:
                raise Uneven
            ids = [get(w) or piece(w) for w in words[1:]]
        except Uneven:
            return b"".join(map(self.token, self.split.findall(text)))
        start = b"".join(map(self.token, self.split.findall(words[0])))
        return start + b"".join(ids)

    def encode(self, text: str) -> bytes:
        """All ids of a text, each as a little-endian unsigned 32-bit integer."""
        if self.cut is None:
            return self.plain(text)
        parts = self.cut.split(text)
        return b"".join(
            self.special[p].to_bytes(4, "little") if k % 2 else self.plain(p) if p else b"" for k, p in enumerate(parts)
        )

    def decode(self, ids: bytes) -> str:
        strings = self.strings
        return b"".join([strings[i] for i in memoryview(ids).cast("I")]).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, path: str | None = None, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a binary column ``ids`` (little-endian 32-bit ids of the
    whole text). A null text counts as empty and has no ids; special tokens
    spelled out in a text become their id. Other columns pass through; an
    existing column called ``ids`` is replaced."""
    path = path or vocabulary_path()
    small_batches(docs.sparkSession)
    kept = docs.drop(ids)
    out = kept.schema.add(ids, "binary", True)

    def run(batches):
        c = codec(path)
        for b in batches:
            found = pa.array([c.encode(t or "") for t in b.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, found], names=[*b.schema.names, ids])

    at = kept.columns.index(text)
    return kept.mapInArrow(run, out)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: encodes the
    whole text, decodes the ids again and hashes both. One row per input row,
    repeated rows included; a null text counts as empty."""
    path = path or vocabulary_path()
    small_batches(docs.sparkSession)

    def run(batches):
        c = codec(path)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for b in batches:
            ids = [c.encode(t or "") for t in b.column("text").to_pylist()]
            found = {
                "n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64()),
                "ids_sha256": pa.array([sha(i) for i in ids], pa.string()),
                "decoded_sha256": pa.array([sha(c.decode(i).encode("utf-8")) for i in ids], pa.string()),
            }
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *found.values()], names=["doc_id", *found])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
