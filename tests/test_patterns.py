import pytest
from pyspark.sql import functions as F

from logsift.operators import matching
from logsift.sources import patterns as P


def test_default_catalogue():
    cat = P.catalogue()
    assert len(cat) == 23
    assert len({p.regex_id for p in cat}) == 23
    literal = [p for p in cat if p.literal() is not None]
    assert len(literal) == 19
    assert P.Pattern("X", r"\[ERROR\]").literal() == "[ERROR]"
    assert P.Pattern("X", r"user_id=(\w+)").literal() is None
    assert P.Pattern("X", r"a.b").literal() is None


def test_catalogue_validation(spark):
    with pytest.raises(P.CatalogueError):
        P.catalogue([("", "x")])
    with pytest.raises(P.CatalogueError):
        P.catalogue([("X" * 51, "x")])
    with pytest.raises(P.CatalogueError):
        P.catalogue([("A", "(?P<n>x)")])
    with pytest.raises(P.CatalogueError):
        P.check_java(spark, P.catalogue([("A", "a(")]))


def test_catalogue_table_roundtrip(spark):
    cat = P.catalogue()
    assert P.from_frame(P.to_frame(spark, cat)) == cat


def test_duplicate_ids_emit_one_row(spark):
    df = spark.createDataFrame([("L", "Data saved [ERROR]")], "log_id string, content string")
    cat = [("DATA_SAVED", "Data saved"), ("DATA_SAVED", r"Data sav(ed)"), ("LOG_TYPE_ERROR", r"\[ERROR\]")]
    rows = matching.match_lines(df, cat).collect()
    assert sorted(r.regexId for r in rows) == ["DATA_SAVED", "LOG_TYPE_ERROR"]


def test_match_array_order_and_text(spark):
    df = spark.createDataFrame(
        [("L", "2024-01-01 00:00:00 [ERROR] user_id=user_1 session_id=session_1 from IP 1.2.3.4: OutOfMemoryError")],
        "log_id string, content string",
    )
    from logsift.operators import lines

    arr = matching.match_array(lines.clean_lines(df)).first().regex_matches
    ids = [m.regexId for m in arr]
    assert ids == ["LOG_TYPE_ERROR", "ERROR_DETAIL_OOM", "USER_ID_EXTRACT", "SESSION_ID_EXTRACT", "IP_ADDRESS_EXTRACT"]
    assert all(m.matched_text.startswith("2024-01-01") for m in arr)


def test_additional_info_needs_leading_whitespace(spark):
    content = "h\n\tAdditional info: request_id=0123456789, process_time=5ms\n    Additional info: request_id=0123456789, process_time=5ms"
    df = spark.createDataFrame([("L", content)], "log_id string, content string")
    rows = matching.match_lines(df).filter(F.col("regexId") == "ADDITIONAL_INFO_LINE").collect()
    # the tab-led line keeps a leading space after cleaning; the space-led one is trimmed
    assert [r.line_number for r in rows] == [2]


def test_required_literals():
    req = {p.regex_id: p.required_literal() for p in P.catalogue()}
    assert req["USER_ID_EXTRACT"] == "user_id="
    assert req["ADDITIONAL_INFO_LINE"] == "Additional info: request_id="
    assert req["IP_ADDRESS_EXTRACT"] == "from IP "
    for pat in ["ab|cd", "(?i)abc", r"\x41bc", r"\Qa.b\E"]:
        assert P.Pattern("X", pat).required_literal() is None
    assert P.Pattern("X", "ab*c").required_literal() in ("a", "c")
    assert P.Pattern("X", r"[A-Za-z]+@[a-z]+\.com").required_literal() in ("@", ".com")


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from logsift.sources import fixtures  # noqa: E402

EXTRA = [r"ab*c", r"a(b|c)d", r"x{2}yz", r"ab?c+d", r"(ab)?c", r"a\.?b", r"[xy]+z=\d", r"q(r)+s"]
ALL = [p for _, p in P.DEFAULT_PATTERNS + fixtures.DOCUMENT_PATTERNS] + EXTRA
CHARS = list("abcdqrsxyz=.@+( )-019") + ["user_id=", "from IP ", "token = \"", "Additional info: request_id="]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(CHARS), max_size=30).map("".join))
def test_match_implies_required_literal(s):
    import re

    for pat in ALL:
        req = P.Pattern("X", pat).required_literal()
        if req is not None and re.search(pat, s):
            assert req in s, (pat, req, s)


def test_no_required_literal_behind_nested_classes_and_references():
    for pat in (r"[a-z&&[^aeiou]]+", r"[a-c[x-z]]y", r"(a)(b)\1\2", r"(x)\10"):
        assert P.Pattern("X", pat).required_literal() is None


def test_class_intersection_matches_as_rlike(spark):
    from logsift.functions.match import pattern_predicate

    lines = spark.createDataFrame([("xyz ok",), ("aeiou",), ("",), ("]",)], "line string")
    p = P.Pattern("CONSONANTS", r"[a-z&&[^aeiou]]+")
    got = lines.select("line", pattern_predicate("line", p).alias("a"), F.col("line").rlike(p.pattern).alias("b")).collect()
    assert all(r.a == r.b for r in got) and sum(r.a for r in got) == 1


def test_catalogue_table_keeps_its_order_whatever_its_length(spark):
    many = P.catalogue([(f"ID{i:04d}", f"text {i}") for i in range(2500)])
    frame = P.to_frame(spark, many).orderBy(F.desc("position"))
    assert P.from_frame(frame) == many
