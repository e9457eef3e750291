"""BPE against the tokenizers library; Elias-Fano and HTML on plain values."""

import array
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from logsift.llm import html_extract, word_ids
from logsift.llm.bpe import Codec, vocabulary_path
from logsift.llm.token_store import EliasFano
from logsift.llm.word_ids import WordIds

PIECES = [" ", "  ", "\n", "\t", "a", "the", "é", "ß", "'s", "!!!", "123", "<|endoftext|>", " ", "日本", "🙂", "\r\n", "\x1c", ""]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary_path())


def texts(n):
    rnd = random.Random(7)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


def test_encoding_and_decoding_equal_the_library(tokenizer):
    codec = Codec(vocabulary_path())
    for text in [*texts(4000), "x" * 5000, "ab " * 3000]:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        got = codec.encode(text)
        assert got == array.array("I", ids).tobytes()
        assert codec.decode(got) == tokenizer.decode(ids, skip_special_tokens=False)


#: Composing marks, letters whose lower case is longer, white space outside ASCII.
ODD = ["e\u0301", "\u0301", "Σ", "İ", "\xa0", "\x85", "ǅ", "ﬁ", "<|start", "A,b.", "\u3000", "Word,", "Word.", "x" * 70]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_batches_by_word_equal_whole_texts(name, monkeypatch):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    encoder = WordIds(public_tokenizers.path(name))
    assert encoder.alone != encoder.spaced
    rnd = random.Random(7)
    some = ["".join(rnd.choice(PIECES + ODD) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    some += ["", "\n", "\n\n", "a\n", "\na", "a \nb", "a\n b", " a", "a ", "x\ny"]
    monkeypatch.setattr(word_ids, "KEPT_BYTES", 20_000)  # generations change many times
    for begin in range(0, len(some), 200):
        part = some[begin : begin + 200]
        for text, ids in zip(part, encoder.batch(part), strict=True):
            assert list(np.frombuffer(ids, "<u2")) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("values", [[], [0], [5], [1, 1, 1], [3, 7, 7, 900, 10**6], list(range(0, 90000, 7))])
def test_elias_fano_selects_every_number(values):
    ef = EliasFano.build(values)
    assert list(ef.all()) == values
    assert [ef.select(i) for i in range(0, len(values), 101)] == values[::101]


def test_main_text_leaves_boilerplate_out():
    page = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body>
    <header><p>Site header</p></header><nav><ul><li><a href=x>Menu</a></li></ul></nav><div class="ad">Buy now</div>
    <article><header><h1>Title &amp; more</h1></header><p><b>First</b>  part<br>of it<aside>Side note</aside>
    <p>Second.</p><ul><li>One</li><li>Two</li></ul><form><p>Your mail</p></form><p class="notice">Careful</p>
    <p>Last&nbsp;one</p><section id="comments"><p>Me too!</p></section></article>
    <footer>&copy; x</footer></body></html>"""
    text = html_extract.extract(page, {})
    assert text == "Title & more\nFirst part of it\nSecond.\nOne\nTwo\nLast one"
    assert html_extract.extract(None, {}) == html_extract.extract("", {}) == html_extract.extract("<p>", {}) == ""
    assert html_extract.extract("<body><div class=post><p>Only</p><p>text", {}) == "Only\ntext"
