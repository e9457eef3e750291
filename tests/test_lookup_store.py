"""Golden cases for event decoding, the bulk lookup and store maintenance."""

import datetime as dt

import duckdb
from pyspark.sql import functions as F

from logsift.operators import lookup, payload, stats, store, views
from logsift.plans import micro_batch, registry
from logsift.sources import fixtures

from .oracle_compare import compare


def test_decode_events(spark):
    values = [
        '{"log_id":"a"}',
        '{"log_id":12}',
        '{"LOG_ID":"a"}',
        "not json",
        '{"log_id":null}',
        '{"log_id":""}',
        '{"log_id":{"k":1}}',
        '[{"log_id":"z"}]',
        '{"log_id":" "}',
    ]
    df = spark.createDataFrame([(v,) for v in values], "value string").select(F.col("value").cast("binary").alias("value"))
    got = sorted(r.log_id for r in lookup.decode_events(df).collect())
    assert got == sorted(["a", "12", '{"k":1}', " "])


def _store(spark):
    return spark.createDataFrame(
        [("a", "text a"), ("b", None)], "log_id string, content string"
    )


def test_bulk_lookup_golden(spark):
    req = spark.createDataFrame([("a",), ("a",), ("b",), ("zz",), (None,)], "log_id string")
    for bound in (None, 10):
        rows = sorted(
            (tuple(r) for r in lookup.bulk_lookup(req, _store(spark), max_broadcast_keys=bound).collect()),
            key=repr,
        )
        assert rows == sorted(
            [
                ("a", "text a", None),
                ("a", "text a", None),
                ("b", None, None),
                ("zz", None, "not_found"),
                (None, None, "not_found"),
            ],
            key=repr,
        )


def test_every_log_is_requested(spark):
    events = spark.createDataFrame([(e,) for e in range(1, 61)], "event_id bigint")
    got = sorted(r.log_id for r in fixtures.lookup_requests(events).collect())
    known = [f"log_{e:010d}" for e in [*range(1, 61), 20, 40, 60]]
    assert got == sorted([*known, "log_missing_50"])


def _sixty_logs(spark, path):
    """A folder with 60 events, so 60 logs, each of which is asked for."""
    rows = [(e, dt.datetime(2024, 1, 1, 0, 0, e), e % 7, "error" if e % 2 else "click", 1.0, "{}") for e in range(60)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/events.parquet")
    return str(path)


def _events_duck(path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{path}/events.parquet/*.parquet')")
    return con


def test_bulk_lookup_asks_for_every_log(spark, tmp_path):
    path = _sixty_logs(spark, tmp_path)
    r = compare(spark, "bulk_lookup", path, _events_duck(path))
    # Every log, three of them twice, and two unknown ids.
    assert r["ok"] and r["rows"] == 60 + 3 + 2, r


def test_get_log_matches_of_every_log(spark, tmp_path):
    path = _sixty_logs(spark, tmp_path)
    r = compare(spark, "get_log_matches", path, _events_duck(path))
    assert r["ok"] and r["rows"] == registry.q_results_rows(spark, path).count() > 0, r


def test_log_by_id_of_every_log(spark, tmp_path):
    path = _sixty_logs(spark, tmp_path)
    r = compare(spark, "log_by_id", path, _events_duck(path))
    assert r["ok"] and r["rows"] == 60, r


def test_results_for_log_of_every_log(spark, tmp_path):
    path = _sixty_logs(spark, tmp_path)
    r = compare(spark, "results_for_log", path, _events_duck(path))
    assert r["ok"] and r["rows"] == registry.q_results_rows(spark, path).count() > 0, r


def test_process_ids_dedups_and_quarantines(spark):
    req = spark.createDataFrame([("a",), ("a",), ("b",), ("zz",)], "log_id string")
    st = spark.createDataFrame([("a", "x [ERROR] y\nz [ERROR]"), ("b", None)], "log_id string, content string")
    out = micro_batch.process_ids(req, st)
    m = sorted((r.regexId, r.log_id, r.line_number) for r in out.matches.collect())
    assert m == [("LOG_TYPE_ERROR", "a", 1), ("LOG_TYPE_ERROR", "a", 2)]
    assert [r.log_id for r in out.not_found.collect()] == ["zz"]


def test_kafka_payload_json(spark):
    df = spark.createDataFrame([("R", "l", 3, 'say "hi" \\ a/b')], "regexId string, log_id string, line_number int, matched_text string")
    v = payload.kafka_payload(df).first().value
    assert v == '{"regexId":"R","log_id":"l","line_number":3,"matched_text":"say \\"hi\\" \\\\ a/b"}'


T0 = dt.datetime(2024, 1, 1)


def test_upsert_golden(spark):
    st = spark.createDataFrame(
        [("a", "s-a", T0, "old", True), ("b", "s-b", T0, "bb", False)],
        "log_id string, source string, timestamp timestamp_ntz, content string, processed boolean",
    )
    writes = spark.createDataFrame(
        [
            ("a", "w1", T0, "c1", 1),
            ("a", "w2", T0, None, 2),
            ("z", "z1", T0, "c9", 1),
            ("z", None, T0, "c8", 2),
            (None, "x", T0, "c", 3),
        ],
        "log_id string, source string, timestamp timestamp_ntz, content string, seq long",
    )
    for bound in (None, 10):
        got = {r.log_id: r for r in store.upsert_logs(st, writes, max_broadcast_keys=bound).collect()}
        assert set(got) == {"a", "b", "z"}
        assert (got["a"].source, got["a"].content, got["a"].processed) == ("s-a", None, True)
        assert (got["b"].source, got["b"].content, got["b"].processed) == ("s-b", "bb", False)
        assert (got["z"].source, got["z"].content, got["z"].processed) == ("z1", "c8", False)


def test_upsert_new_log_without_source(spark):
    st = spark.createDataFrame([], "log_id string, source string, timestamp timestamp_ntz, content string, processed boolean")
    writes = spark.createDataFrame([("n", None, T0, "c", 1)], "log_id string, source string, timestamp timestamp_ntz, content string, seq long")
    r = store.upsert_logs(st, writes).first()
    assert (r.source, r.content, r.processed) == ("unknown", "c", False)


def _logs(spark):
    return spark.createDataFrame(
        [("a", "s", T0, "x", False), ("b", "s", T0 + dt.timedelta(1), "y", False), ("c", "s", T0, "z", None)],
        "log_id string, source string, timestamp timestamp_ntz, content string, processed boolean",
    )


def _results(spark):
    return spark.createDataFrame(
        [
            ("a", "LOG_TYPE_ERROR", 1, "m", "m"),
            ("a", "USER_ID_EXTRACT", 1, "m", "m"),
            ("q", "LOG_TYPE_ERROR", 1, "m", "m"),
            ("a", None, 1, "m", None),
            ("a", "X" * 51, 1, "m", None),
        ],
        "log_id string, regex_id string, line_number int, match string, line_content string",
    )


def test_mark_processed(spark):
    for bound in (None, 10):
        got = {r.log_id: r.processed for r in store.mark_processed(_logs(spark), _results(spark), bound).collect()}
        assert got == {"a": True, "b": False, "c": None}


def test_check_results(spark):
    got = sorted(
        (r.log_id, r.regex_id or "", r.reject_reason or "") for r in store.check_results(_results(spark), _logs(spark)).collect()
    )
    assert got == sorted(
        [
            ("a", "LOG_TYPE_ERROR", ""),
            ("a", "USER_ID_EXTRACT", ""),
            ("q", "LOG_TYPE_ERROR", store.REASON_UNKNOWN_LOG),
            ("a", "", store.REASON_NULL_REGEX_ID),
            ("a", "X" * 51, store.REASON_LONG_REGEX_ID),
        ]
    )


def test_cascade_delete(spark):
    deleted = spark.createDataFrame([("a",)], "log_id string")
    logs, res = store.cascade_delete(_logs(spark), _results(spark), deleted)
    assert sorted(r.log_id for r in logs.collect()) == ["b", "c"]
    assert sorted(r.log_id for r in res.collect()) == ["q"]


def test_views_and_stats(spark):
    logs, res = _logs(spark), _results(spark).filter(F.col("regex_id").isNotNull())
    assert [r.log_id for r in views.pending_logs(logs).collect()] == ["b", "a"]
    assert [r.regex_id for r in views.results_for_log(res, "a").collect()] == ["LOG_TYPE_ERROR", "USER_ID_EXTRACT", "X" * 51]
    assert [r.log_id for r in views.error_logs(logs, res).collect()] == ["a"]
    s = stats.stats(logs, res).first()
    assert (s.total_logs, s.processed_logs, s.total_matches) == (3, 0, 4)
    rec = stats.stats_record(logs, res).first()
    assert rec.matches_by_type == {"LOG_TYPE_ERROR": 2, "USER_ID_EXTRACT": 1, "X" * 51: 1}
    assert [tuple(r) for r in stats.matches_by_type(res).collect()][0] == ("LOG_TYPE_ERROR", 2)


def test_sql_table_function(spark):
    views.register_sql(spark, _logs(spark), _results(spark).filter(F.col("regex_id").isNotNull()), prefix="t_")
    rows = spark.sql("SELECT * FROM t_get_log_matches('a')").collect()
    assert [r.line_number for r in rows] == [1, 1, 1]
    assert spark.sql("SELECT count(*) FROM t_error_logs").first()[0] == 1
    assert [tuple(r) for r in views.log_content_sql(spark, "b", prefix="t_").collect()] == [("b", "y")]
    assert views.log_content_sql(spark, "x' OR '1'='1", prefix="t_").count() == 0
    assert [r.regex_id for r in views.results_for_log_sql(spark, "a", prefix="t_").collect()] == [
        "LOG_TYPE_ERROR", "USER_ID_EXTRACT", "X" * 51
    ]


def test_bucketed_store_lookup_prunes(spark, tmp_path):
    from logsift.sources import stores

    logs = spark.createDataFrame(
        [(f"log_{i}", "s", T0, f"line {i}", False) for i in range(200)],
        "log_id string, source string, timestamp timestamp_ntz, content string, processed boolean",
    )
    table = stores.write_bucketed(logs, str(tmp_path / "logs"), bucket_count=32)
    ids = spark.createDataFrame([("log_3",), ("log_77",), ("nope",)], "log_id string")
    found = lookup.found_logs(ids, table.read(spark), bucket_count=32)
    import contextlib
    import io
    import re

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        found.explain("formatted")
    filters = [ln for ln in buf.getvalue().splitlines() if ln.startswith("PartitionFilters")]
    assert filters and re.search(r"bucket#\d+ IN \(", filters[0]), filters
    assert sorted(r.log_id for r in found.collect()) == ["log_3", "log_77"]


def test_maintenance_versions(spark, tmp_path):
    from logsift.plans import maintenance as M

    logs = _logs(spark)
    empty = spark.createDataFrame([], "log_id string, regex_id string, line_number int, match string, line_content string")
    st = M.LogStores.create(str(tmp_path / "stores"), logs, empty, bucket_count=8)
    writes = spark.createDataFrame(
        [("a", "w", T0, "new a", 1), ("n", "w", T0, "new n", 2)],
        "log_id string, source string, timestamp timestamp_ntz, content string, seq long",
    )
    st = M.post_logs(spark, st, writes)
    got = {r.log_id: r.content for r in st.read_logs(spark).collect()}
    assert got == {"a": "new a", "b": "y", "c": "z", "n": "new n"}
    st, rejected = M.post_results(spark, st, _results(spark))
    assert sorted(r.reject_reason for r in rejected.collect()) == sorted(
        [store.REASON_UNKNOWN_LOG, store.REASON_NULL_REGEX_ID, store.REASON_LONG_REGEX_ID]
    )
    assert st.read_results(spark).count() == 2
    assert {r.log_id: r.processed for r in st.read_logs(spark).collect()}["a"] is True
    st = M.delete_logs(spark, st, spark.createDataFrame([("a",)], "log_id string"))
    assert st.read_results(spark).count() == 0
    assert sorted(r.log_id for r in st.read_logs(spark).collect()) == ["b", "c", "n"]


def test_lookup_lists_only_touched_buckets(spark, tmp_path):
    import re

    from logsift.sources import stores

    logs = spark.createDataFrame(
        [(f"log_{i}", "s", T0, f"line {i}", False) for i in range(300)],
        "log_id string, source string, timestamp timestamp_ntz, content string, processed boolean",
    )
    table = stores.write_bucketed(logs, str(tmp_path / "logs"), bucket_count=32)
    ids = spark.createDataFrame([("log_3",), ("log_77",), ("nope",)], "log_id string")
    found = lookup.found_logs(ids, table)
    assert sorted(r.log_id for r in found.collect()) == ["log_3", "log_77"]
    touched = {int(m) for f in found.inputFiles() for m in re.findall(r"bucket=(\d+)", f)}
    assert touched and touched <= set(stores.buckets_of(ids, 32))
    empty = lookup.found_logs(spark.createDataFrame([], "log_id string"), table)
    assert empty.count() == 0


def test_upsert_in_place_rewrites_only_touched_buckets(spark, tmp_path):
    import os

    from logsift.plans import maintenance as M
    from logsift.sources import stores

    logs = spark.createDataFrame(
        [(f"log_{i}", "s", T0, f"c{i}", False) for i in range(200)],
        "log_id string, source string, timestamp timestamp_ntz, content string, processed boolean",
    )
    empty = spark.createDataFrame([], "log_id string, regex_id string, line_number int, match string, line_content string")
    st = M.LogStores.create(str(tmp_path / "s"), logs, empty, bucket_count=16)

    def files():
        root = st.logs.path
        return {d: sorted(os.listdir(os.path.join(root, d))) for d in os.listdir(root) if d.startswith("bucket=")}

    before = files()
    writes = spark.createDataFrame(
        [("log_5", "w", T0, "new", 1), ("log_new", "w", T0, "n", 2)],
        "log_id string, source string, timestamp timestamp_ntz, content string, seq long",
    )
    M.post_logs(spark, st, writes)
    after = files()
    touched = {f"bucket={b}" for b in stores.buckets_of(writes, 16)}
    assert {d for d in after if after[d] != before.get(d)} <= touched
    got = {r.log_id: r.content for r in st.read_logs(spark).collect()}
    assert len(got) == 201 and got["log_5"] == "new" and got["log_new"] == "n" and got["log_6"] == "c6"


def test_batch_metrics_single_pass_equals_generic(spark):
    from logsift.operators import lines, matching

    st = spark.createDataFrame(
        [("a", "x [ERROR] y\n\nz user_id=u1"), ("b", None), ("c", "\t\né")],
        "log_id string, content string",
    )
    req = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("c",), ("zz",)], "log_id string")
    lk = lookup.bulk_lookup(req, st)
    found = lookup.found_logs(req, st)
    generic = payload.batch_metrics(lk, lines.clean_lines(lk), matching.match_lines(found)).first()
    single = payload.batch_metrics_single_pass(req, st).first()
    assert tuple(generic) == tuple(single)
    assert (single.fetched, single.valid, single.cleaned_lines, single.matches) == (6, 4, 7, 2)
