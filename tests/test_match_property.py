"""Property: the native plan equals a plain Python re-implementation of the
reference's per-line loop, on random text."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from logsift.operators import matching
from logsift.sources import patterns as P

ALPHABET = list("abcdefxyz0123456789 _=:.,[]()@\t\r\n\x0b\x0cé\xa0") + [
    "[ERROR]", "[INFO]", "user_id=", "session_id=", "from IP ", "Additional info: request_id=",
    ", process_time=", "ms", "Data saved", "NullPointerException",
]


def py_clean(line: str) -> str:
    s = line.strip(" ")
    s = re.sub(r"[ \t\n\x0b\x0c\r]+", " ", s)
    return re.sub(r"[^\x00-\x7f]", "", s)


def py_match(log_id, content, cat):
    out = set()
    content = re.sub(r"\r\n|\r", "\n", content)
    for i, raw in enumerate(content.split("\n")):
        if raw == "":
            continue
        c = py_clean(raw)
        if c == "":
            continue
        for rid, pat in cat:
            if re.search(pat, c):
                out.add((rid, log_id, i + 1, c))
    return out


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=40).map("".join), min_size=1, max_size=8))
def test_native_equals_python(spark, contents):
    cat = P.DEFAULT_PATTERNS
    df = spark.createDataFrame([(f"L{i}", c) for i, c in enumerate(contents)], "log_id string, content string")
    got = {tuple(r) for r in matching.match_lines(df).collect()}
    want = set()
    for i, c in enumerate(contents):
        want |= py_match(f"L{i}", c, cat)
    assert got == want
