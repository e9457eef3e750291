"""Contents to numbered lines.

All steps are narrow (no shuffle): each log row expands to its lines in the
task that read it. Line numbers are 1-based and count every raw line,
including empty ones that are dropped afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text


def valid_contents(contents: DataFrame, content_col: str = "content") -> DataFrame:
    """Rows whose content is not null (a not-found id and a stored null
    content are both dropped)."""
    return contents.filter(F.col(content_col).isNotNull())


def _expandable(contents: DataFrame, content_col: str) -> DataFrame:
    return valid_contents(contents, content_col)


def normalize_content(contents: DataFrame, id_col: str = "log_id", content_col: str = "content") -> DataFrame:
    return _expandable(contents, content_col).select(
        id_col, text.normalize_line_endings(content_col).alias("content_normalized")
    )


def split_lines(contents: DataFrame, id_col: str = "log_id", content_col: str = "content") -> DataFrame:
    """``id, line_number, line_content`` for every non-empty raw line."""
    return (
        _expandable(contents, content_col)
        .select(id_col, F.posexplode(text.split_lines(content_col)).alias("pos", "line_content"))
        .filter(F.col("line_content") != "")
        .select(id_col, (F.col("pos") + 1).alias("line_number"), "line_content")
    )


def clean_lines(
    contents: DataFrame, id_col: str = "log_id", content_col: str = "content", carry: tuple[str, ...] = ()
) -> DataFrame:
    """``id, line_number, line_content, cleaned_line`` for every line whose
    cleaned form is not empty. A raw empty line cleans to empty, so one
    filter on the cleaned line covers both of the reference's filters.
    ``carry`` columns are passed through (e.g. a store's bucket)."""
    return (
        _expandable(contents, content_col)
        .select(id_col, *carry, F.posexplode(text.numbered_clean_lines(content_col)).alias("pos", "l"))
        .filter(F.col("l.cleaned_line") != "")
        .select(
            id_col,
            *carry,
            (F.col("pos") + 1).alias("line_number"),
            F.col("l.line_content").alias("line_content"),
            F.col("l.cleaned_line").alias("cleaned_line"),
        )
    )
