"""Plan properties: what each registered query must (not) contain."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

FORBIDDEN = ["BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if n != "stream_match"))
def test_no_cross_join_or_python(spark, name):
    p = plan_text(E.queries()[name](spark, SF_SMALL))
    assert not [w for w in FORBIDDEN if w in p], name


def test_core_match_has_no_shuffle_beyond_spread(spark):
    p = plan_text(E.queries()["match_lines"](spark, SF_SMALL)).split("\n\n")[0]
    # the only exchange is the round-robin spread of a one-split scan
    exchanges = re.findall(r"Exchange \(\d+\)", p)
    assert len(exchanges) <= 1
    full = plan_text(E.queries()["match_lines"](spark, SF_SMALL))
    assert "RoundRobinPartitioning" in full or not exchanges
    assert "HashAggregate" not in full  # no distinct over match rows


def test_scans_read_only_needed_columns(spark):
    p = plan_text(E.queries()["match_custom"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p
    p = plan_text(E.queries()["decode_events"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p


def test_error_view_filters_before_join_and_skips_content(spark, tmp_path):
    from logsift.operators import views
    from logsift.sources import stores, tables

    res = spark.createDataFrame(
        [("a", "LOG_TYPE_ERROR", 1, "m", "m"), ("b", "DATA_SAVED", 1, "m", "m")],
        "log_id string, regex_id string, line_number int, match string, line_content string",
    )
    res.write.parquet(str(tmp_path / "res"))
    logs = spark.createDataFrame(
        [("a", "s", None, "big text", False)], tables.LOGS_SCHEMA
    )
    logs.write.parquet(str(tmp_path / "logs"))
    df = views.error_logs(
        tables.read_store(spark, str(tmp_path / "logs")),
        tables.read_store(spark, str(tmp_path / "res"), tables.RESULTS_SCHEMA),
    )
    p = plan_text(df)
    assert "PushedFilters: [IsNotNull(regex_id), EqualTo(regex_id,LOG_TYPE_ERROR)" in p
    assert "content" not in re.findall(r"ReadSchema: struct<log_id:string,source[^>]*>", p)[0]
    assert [r.log_id for r in df.collect()] == ["a"]
