"""Token ids of whole texts by the tokenizers library, a word at a time.

Both public vocabularies used here split a text at white space before they
merge, so the ids of a text are those of its words, one after the other, and a
word that comes again need not be encoded again. What may be split off is told
by the vocabulary's own pre-tokenizer:

* byte-level, no normalizer: a word takes the single space before it along, and
  a line end is a word of its own if no white space touches it;
* white space removed, ``</w>`` at word ends: every word stands alone.

Texts that do not fit these rules are encoded whole. Words are kept in two
generations, so what a worker holds is bounded by ``KEPT_BYTES``, and the words
in use survive when the older generation is given up.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain, islice

import numpy as np

#: Bytes of kept words and their ids in one generation, with an entry's overhead.
KEPT_BYTES, ENTRY_BYTES = 120 << 20, 220
#: Longer words are encoded but not kept.
KEPT_LENGTH = 64
#: Characters of texts that are cut into words at once.
SLICE = 1 << 22
#: Words that are encoded as one text.
JOINED = 1024
#: A word of Latin letters may end in one of these, which are tokens of their own.
STOPS = frozenset(".,;:!?)")


def _latin(text: str) -> bool:
    """Whether a text has characters of Latin-1 only."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordIds:
    """Encoder of one vocabulary file; ``width`` is the bytes of an id."""

    def __init__(self, path: str):
        # One thread a task: Spark has a task on every core already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Their strings are found in a text before it is split.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        pre = self.tokenizer.pre_tokenizer
        cut = [p for p, _ in pre.pre_tokenize_str("ab c,\nd")] if pre is not None else []
        self.alone = cut == ["ab", "c", ",", "d"]
        self.spaced = cut == ["ab", "Ġc", ",", "Ċ", "d"] and self.tokenizer.normalizer is None
        self.small = self.alone and self.whole(["WORD Éß"]) == self.whole(["word éß"])
        # Tokens at which a word starts (byte level) or ends (word ends).
        edge = np.zeros(size, dtype=bool)
        for token, number in self.tokenizer.get_vocab().items():
            edge[number] = token.endswith("</w>") if self.alone else token.startswith("Ġ")
        self.edge = edge
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def whole(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in got]

    def batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian, in slices of bounded length."""
        out: list[bytes] = []
        begin, size = 0, 0
        for k, text in enumerate(texts):
            if size and size + len(text) > SLICE:
                out += self._slice(texts[begin:k])
                begin, size = k, 0
            size += len(text)
        return out + self._slice(texts[begin:])

    def _slice(self, texts: list[str]) -> list[bytes]:
        if not (self.alone or self.spaced):
            return self.whole(texts)
        out: list[bytes] = [b""] * len(texts)
        cut, plain, latin = [], [], True
        for k, text in enumerate(texts):
            if any(s in text for s in self.special):
                plain.append(k)
                continue
            narrow = _latin(text)
            latin &= narrow
            if self.alone:
                # The vocabulary has small letters only. Latin-1 has no composing
                # marks, so it makes no difference when they are made small.
                if narrow and self.small and "<|" not in text:
                    text = text.lower()
                cut.append((k, text.replace("\n", " ").split(" ")))
            else:
                text = text.replace("\n", " \n")
                if "  " in text or text[-1:] == " " or text[:1].isspace() and text[:2] != " \n":
                    plain.append(k)  # two spaces, or a space at an end or before a line end
                else:
                    words = text.split(" ")
                    # The text's first word has no space before it.
                    words[0] = "\n" + words[0] if words[0] else ""
                    cut.append((k, words))
        wanted = set(chain.from_iterable(w for _, w in cut))
        if self.spaced:
            # White space after a word takes part in what follows it.
            uneven = {w for w in wanted if w[-1:].isspace()}
            if uneven:
                plain += [k for k, w in cut if not uneven.isdisjoint(w)]
                cut = [(k, w) for k, w in cut if uneven.isdisjoint(w)]
                wanted = set(chain.from_iterable(w for _, w in cut))
        long = self._know(wanted, latin)
        known = self.young
        first = len(self.line_end) if self.spaced else 0
        for k, words in cut:
            ids = b"".join(map(known.__getitem__, words))
            # The line end that stood in for nothing goes again.
            out[k] = ids[first:] if words[0] else ids
        for k, ids in zip(plain, self.whole([texts[k] for k in plain]), strict=True):
            out[k] = ids
        for w in long:
            del known[w]
        if self.held > KEPT_BYTES:
            self.old, self.young, self.held = known, {}, 0
        return out

    @property
    def line_end(self) -> bytes:
        if not hasattr(self, "_line_end"):
            self._line_end = self.whole(["\n"])[0]
        return self._line_end

    def _know(self, wanted: set[str], latin: bool) -> list[str]:
        """Have every wanted word in ``young``; those not to be kept are returned.
        ``latin``: all of them are of Latin-1 letters."""
        young, old = self.young, self.old
        wanted = wanted.difference(young)
        again = {w for w in wanted if w in old}
        young.update((w, old[w]) for w in again)
        missing = wanted - again
        young[""] = b""
        missing.discard("")
        # A word of Latin letters is one pre-token; with a stop behind it, two.
        stems = {w for w in missing if w.isalpha() and (latin or _latin(w))}
        rest = missing - stems
        if self.spaced:
            # The space before it marks the first token of any word in a text.
            lines = {w for w in rest if w[0] == "\n"}
            self._joined(list(rest - lines))
            rest = lines
        ended = [w for w in rest if w[-1] in STOPS and w[:-1].isalpha() and (latin or _latin(w))]
        rest.difference_update(ended)
        stems.update(w[:-1] for w in ended)
        stems = stems.difference(young)
        self._joined(list(stems))
        self._each(list(rest))
        if ended:
            stop = dict(zip(STOPS, self.whole(list(STOPS)), strict=True))
            young.update((w, young[w[:-1]] + stop[w[-1]]) for w in ended)
        added = missing | stems
        self.held += ENTRY_BYTES * (len(added) + len(again)) + 2 * (sum(map(len, added)) + sum(map(len, again)))
        if max(map(len, added), default=0) <= KEPT_LENGTH:
            return []
        return [w for w in added if len(w) > KEPT_LENGTH]

    def _text(self, word: str) -> str:
        return word if self.alone or word[0] == "\n" else " " + word

    def _each(self, words: list[str]) -> None:
        self.young.update(zip(words, self.whole([self._text(w) for w in words]), strict=True))

    def _joined(self, words: list[str]) -> None:
        """Words of which a token tells that a word starts or ends there: many are
        encoded as one text, whose ids are cut at these tokens."""
        todo = iter(words)
        while some := list(islice(todo, JOINED)):
            joined = " ".join(some) if self.alone else " " + " ".join(some)
            ids = np.frombuffer(self.whole([joined])[0], dtype=self.kind)
            at = np.flatnonzero(self.edge[ids])
            if len(at) != len(some):
                self._each(some)
                continue
            begins = np.concatenate(([0], at[:-1] + 1)) if self.alone else at
            marks = [*(begins * self.width).tolist(), len(ids) * self.width]
            self.young.update(zip(some, map(ids.tobytes().__getitem__, map(slice, marks, marks[1:]))))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)
