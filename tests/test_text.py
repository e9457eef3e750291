"""Golden cases for line ends, splitting and cleaning."""

import pytest
from pyspark.sql import functions as F

from logsift.functions import text
from logsift.operators import lines

# (input, cleaned output) observed on Spark for the reference's cleaning chain.
CLEAN_CASES = [
    ("  a  b ", "a b"),
    ("\tAdditional", " Additional"),
    ("\t", " "),
    ("é", ""),
    (" é x", " x"),
    ("a é b", "a  b"),
    ("\xa0x", "x"),
    ("\x1cy\x1d", "\x1cy\x1d"),
    ("a\x0bb\x0cc", "a b c"),
    ("x\u2028y", "xy"),
]


def test_clean_line_golden(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(CLEAN_CASES)], "i int, s string")
    got = {r.i: r.c for r in df.select("i", text.clean_line("s").alias("c")).collect()}
    for i, (_, want) in enumerate(CLEAN_CASES):
        assert got[i] == want, (CLEAN_CASES[i], got[i])


def test_split_positions(spark):
    df = spark.createDataFrame([("L", "a\r\n\r\nb\rc\n")], "log_id string, content string")
    got = [(r.line_number, r.line_content) for r in lines.split_lines(df).orderBy("line_number").collect()]
    # positions 0-4 are a, '', b, c, '' -> kept 1, 3, 4
    assert got == [(1, "a"), (3, "b"), (4, "c")]


def test_empty_and_null_content(spark):
    df = spark.createDataFrame([("E", ""), ("N", None)], "log_id string, content string")
    assert lines.split_lines(df).count() == 0
    assert lines.clean_lines(df).count() == 0


def test_clean_lines_numbers_count_dropped_lines(spark):
    df = spark.createDataFrame([("L", "x\n   \n\t\né\ny")], "log_id string, content string")
    got = [(r.line_number, r.cleaned_line) for r in lines.clean_lines(df).orderBy("line_number").collect()]
    # '   ' trims to '', the tab survives as ' ', 'é' cleans to ''
    assert got == [(1, "x"), (3, " "), (5, "y")]


def test_normalize_line_endings(spark):
    df = spark.createDataFrame([("a\r\nb\rc\nd",)], "s string")
    assert df.select(text.normalize_line_endings("s")).first()[0] == "a\nb\nc\nd"


@pytest.mark.parametrize("content,n", [("a\nb", 2), ("a\r\n", 1), ("\n\n", 0)])
def test_split_counts(spark, content, n):
    df = spark.createDataFrame([("L", content)], "log_id string, content string")
    assert lines.split_lines(df).count() == n
