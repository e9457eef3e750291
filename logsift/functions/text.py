"""Column expressions for log text: line-end normalisation, splitting and the
three-step line cleaning. All are built-in Spark expressions, so they run in
the JVM inside whole-stage code generation.

Cleaning order matters and is part of the contract:

1. ``trim`` removes spaces (0x20) only; a leading tab stays.
2. every run of Java whitespace (space, \\t, \\n, \\x0B, \\f, \\r) becomes one space.
3. every non-ASCII character is deleted. This runs last, so it can leave a
   leading space or a double space behind (``' é x'`` -> ``' x'``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: the line-end, whitespace and non-ASCII patterns (Java regex).
LINE_END_PATTERN = r"\r\n|\r"
WHITESPACE_RUN_PATTERN = r"\s+"
NON_ASCII_PATTERN = r"[^\x00-\x7F]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_line_endings(content) -> Column:
    """``\\r\\n`` and lone ``\\r`` become ``\\n``."""
    return F.regexp_replace(_col(content), LINE_END_PATTERN, "\n")


def split_lines(content) -> Column:
    """Array of raw lines after line-end normalisation. Trailing empty lines
    are kept (limit -1), so positions count every line."""
    return F.split(normalize_line_endings(content), "\n", -1)


def clean_line(line) -> Column:
    c = F.trim(_col(line))
    c = F.regexp_replace(c, WHITESPACE_RUN_PATTERN, " ")
    return F.regexp_replace(c, NON_ASCII_PATTERN, "")


def numbered_clean_lines(content) -> Column:
    """Array of ``struct(line_content, cleaned_line)`` for every raw line of
    ``content``, cleaning each element once inside the array so the cleaned
    value is not recomputed by later filters and projections."""
    return F.transform(
        split_lines(content),
        lambda x: F.struct(x.alias("line_content"), clean_line(x).alias("cleaned_line")),
    )
