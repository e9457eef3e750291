"""Lines against a pattern catalogue.

One projection tests every catalogue entry on each cleaned line (literal
patterns as ``contains``, the rest as ``rlike``), then a generator turns the
matching ids into rows. The whole chain from the scan to the match rows is
narrow and stays inside whole-stage code generation.

Distinct. The reference removes duplicate (pattern, log, line) rows with a
distinct after the match. Duplicates come from two places only: catalogue
entries sharing an id, and one log id appearing twice in the input. The
first is removed exactly at compile time (entries with one id are OR-ed into
one predicate). The second cannot happen for a store keyed by ``log_id``
(the store's primary key; ``upsert_logs`` keeps it) and is removed on the
small id side by the lookup. So a distinct is only planned when the caller asks
for it (``distinct_rows=True``) because its input may repeat a log. It is taken of
the cleaned lines, before they are matched: the ids that match a line follow from
its text, so equal lines are what makes equal match rows. There are as many
partitions as the text needs, so what a task holds does not grow with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import match as M
from ..sources.patterns import Pattern, catalogue, check_java
from .lines import clean_lines
from .partitioning import parts_for


def _patterns(df: DataFrame, patterns) -> list[Pattern]:
    pats = catalogue(patterns) if patterns is None or not all(isinstance(p, Pattern) for p in patterns) else list(patterns)
    check_java(df.sparkSession, pats)
    return pats


def match_array(lines: DataFrame, patterns=None, line_col: str = "cleaned_line") -> DataFrame:
    """Adds ``regex_matches`` (array of ``regexId, matched_text``) and keeps
    lines with at least one match."""
    pats = _patterns(lines, patterns)
    return lines.withColumn("regex_matches", M.match_array(line_col, pats)).filter(F.size("regex_matches") > 0)


def match_cleaned_lines(
    lines: DataFrame,
    patterns=None,
    id_col: str = "log_id",
    line_col: str = "cleaned_line",
    distinct_rows: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``regexId, <id>, line_number, matched_text`` (then any ``carry``
    columns): one row per matching (pattern id, line)."""
    pats = _patterns(lines, patterns)
    out = (
        lines.select(id_col, "line_number", line_col, *carry, F.explode(M.matched_ids(line_col, pats)).alias("regexId"))
        .filter(F.col("regexId").isNotNull())
        .select("regexId", id_col, "line_number", F.col(line_col).alias("matched_text"), *carry)
    )
    return out.distinct() if distinct_rows else out


def match_lines(
    contents: DataFrame,
    patterns=None,
    id_col: str = "log_id",
    content_col: str = "content",
    distinct_rows: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Contents to match rows: split, clean, match."""
    lines = clean_lines(contents, id_col, content_col, carry)
    if distinct_rows and not contents.isStreaming:
        lines = distinct_lines(lines, parts_for(contents, F.col(content_col)), id_col, carry)
        distinct_rows = False
    return match_cleaned_lines(lines, patterns, id_col=id_col, distinct_rows=distinct_rows, carry=carry)


def distinct_lines(lines: DataFrame, parts: int, id_col: str = "log_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """Each cleaned line of a log once, in ``parts`` partitions."""
    columns = [id_col, "line_number", "cleaned_line", *carry]
    return lines.select(*columns).repartition(parts, *columns).distinct()


def match_summary(lines_with_matches: DataFrame, id_col: str = "log_id") -> DataFrame:
    """Per matching line: how many ids matched and which, in catalogue order."""
    return lines_with_matches.select(
        id_col,
        "line_number",
        F.size("regex_matches").alias("n_matches"),
        F.array_join(F.transform("regex_matches", lambda m: m["regexId"]), ",").alias("regex_ids"),
    )


def extract_fields(
    contents: DataFrame, patterns=None, id_col: str = "log_id", content_col: str = "content", carry: tuple[str, ...] = ()
) -> DataFrame:
    """``<id>, line_number, regexId, occurrence, field, value``: one row for each
    capture group of each place where a pattern is found in a cleaned line (the
    reference's patterns define such groups and discard them). One generator over
    all patterns, in the same narrow chain as the match rows."""
    lines = clean_lines(contents, id_col, content_col, carry)
    pats = _patterns(lines, patterns)
    found = F.explode(M.fields("cleaned_line", pats)).alias("f")
    return lines.select(id_col, "line_number", *carry, found).select(id_col, "line_number", "f.*", *carry)
