"""Stores behind one commit point, the stream that stores its results, and what it
rejects; capture-group fields and large catalogues."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logsift.functions import match as M
from logsift.operators import catalogue_index, lines, lookup, matching, stats, store, views
from logsift.plans.versioned import VersionedStores
from logsift.sources import patterns as P
from logsift.streaming import job

LOGS = "log_id string, source string, timestamp timestamp_ntz, content string, processed boolean"


def logs(spark, rows):
    full = [(i, "s", None, text, done) for i, text, done in rows]
    return spark.createDataFrame(full, LOGS)


def events(spark, ids):
    values = [v if isinstance(v, bytes) else json.dumps({"log_id": v, "timestamp": "t", "source": "x"}).encode() for v in ids]
    return spark.createDataFrame([(bytearray(v),) for v in values], "value binary")


@pytest.fixture
def stores(spark, tmp_path):
    rows = [("a", "[ERROR] one\n[INFO] two", False), ("b", "[INFO] Data saved", False), ("c", "nothing", False), ("d", None, True)]
    return VersionedStores.create(spark, str(tmp_path / "stores"), logs(spark, rows), bucket_count=4)


def state(stores):
    results = sorted((r.log_id, r.regex_id, r.line_number) for r in stores.read_results().collect())
    done = sorted(r.log_id for r in stores.read_logs().where("processed").collect())
    return results, done


A = [("a", "LOG_TYPE_ERROR", 1), ("a", "LOG_TYPE_INFO", 2)]
B = [("b", "DATA_SAVED", 1), ("b", "LOG_TYPE_INFO", 1)]


def test_batches_replays_and_folds_show_each_row_once(spark, stores, tmp_path):
    writer = job.store_events(spark, stores, [events(spark, ["a", "a", "x"]), events(spark, ["b", b"oops", ""])], str(tmp_path))
    assert state(stores) == (A + B, ["a", "b", "d"])
    # The last batch again, as Spark does after a failure between writing and commit.
    again = lookup.check_events(events(spark, ["b", b"oops", ""]))
    writer(again, 1)
    assert state(stores) == (A + B, ["a", "b", "d"])
    # A replay that finds something else replaces all of the batch, flags included.
    writer(lookup.check_events(events(spark, ["c"])), 1)
    assert state(stores) == (A, ["a", "d"])
    writer(again, 1)
    assert state(stores) == (A + B, ["a", "b", "d"])
    history = {r.batch_id: (r.events, r.rejected, r.found, r.not_found, r.cleaned_lines, r.matches) for r in stores.metrics_history().collect()}
    assert history == {0: (3, 0, 1, 1, 2, 2), 1: (3, 2, 1, 0, 1, 2)}
    assert sorted(r.reject_reason for r in stores.read_rejected().collect()) == [lookup.REASON_EMPTY_LOG_ID, lookup.REASON_NOT_JSON]
    assert [r.log_id for r in stores.read_not_found().collect()] == ["x"]
    assert stores.read_results().where("timestamp is null").count() == 0
    # Folding moves the first batch; the newest stays, as it may still be replayed.
    v = stores.fold()
    assert list(v.folded.values()) == [0] and len(v.results) == 1
    assert state(stores) == (A + B, ["a", "b", "d"])
    writer(again, 1)
    assert state(stores) == (A + B, ["a", "b", "d"])
    assert stores.fold().version == v.version
    stores.compact()
    assert state(stores) == (A + B, ["a", "b", "d"])
    record = stats.stats(stores.read_logs(), stores.read_results()).first()
    assert tuple(record) == (4, 3, 4)
    assert [r.log_id for r in views.error_logs(stores.read_logs(), stores.read_results()).collect()] == ["a"]
    assert [r.log_id for r in views.pending_logs(stores.read_logs()).collect()] == ["c"]


def test_an_attempt_without_its_commit_is_not_seen(spark, stores, tmp_path, monkeypatch):
    def lost(*_):
        raise RuntimeError("driver lost")

    writer = job.StoreBatchWriter(stores, str(tmp_path / "checkpoint"))
    monkeypatch.setattr(job, "stream_id_of", lambda *_: "s1")
    with monkeypatch.context() as m:
        m.setattr(VersionedStores, "_append_row", lost)
        with pytest.raises(RuntimeError):
            writer(lookup.check_events(events(spark, ["a"])), 0)
    assert state(stores) == ([], ["d"])
    writer(lookup.check_events(events(spark, ["a"])), 0)
    assert state(stores) == (A, ["a", "d"])


def test_delete_hides_both_stores_at_once(spark, stores, tmp_path, monkeypatch):
    job.store_events(spark, stores, [events(spark, ["a"]), events(spark, ["b"])], str(tmp_path))
    gone = spark.createDataFrame([("a",), ("zz",), (None,)], "log_id string")

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedStores, "_append_row", lost)
        with pytest.raises(RuntimeError):
            stores.delete(gone)
    assert state(stores) == (A + B, ["a", "b", "d"])
    before = stores.current()
    after = stores.delete(gone)
    # No store is rewritten for it.
    assert (after.logs, after.results) == (before.logs, before.results) and len(after.tombstones) == 1
    assert state(stores) == (B, ["b", "d"])
    assert sorted(r.log_id for r in stores.read_logs().collect()) == ["b", "c", "d"]
    # A deleted log is not found by the stream, and comes back as a new one.
    monkeypatch.setattr(job, "stream_id_of", lambda *_: "s2")
    writer = job.StoreBatchWriter(stores, "")
    writer(lookup.check_events(events(spark, ["a"])), 0)
    assert state(stores) == (B, ["b", "d"])
    write = spark.createDataFrame([("a", None, None, "[DEBUG] back", 1)], "log_id string, source string, timestamp timestamp_ntz, content string, seq long")
    stores.upsert(write)
    assert stores.current().tombstones == []
    row = stores.read_logs().where("log_id = 'a'").first()
    assert (row.source, row.content, row.processed) == ("unknown", "[DEBUG] back", False) and row.timestamp is not None
    assert state(stores) == (B, ["b", "d"])
    writer(lookup.check_events(events(spark, ["a"])), 1)
    assert state(stores) == ([("a", "LOG_TYPE_DEBUG", 1), *B], ["a", "b", "d"])


def test_rejected_writes_have_a_reason(spark, stores):
    rows = [(None, "s", "x"), ("i" * 256, "s", "x"), ("e", "s" * 256, "x"), ("f", "s" * 255, "x"), ("a", None, None)]
    writes = spark.createDataFrame([(i, s, None, c, k) for k, (i, s, c) in enumerate(rows)], "log_id string, source string, timestamp timestamp_ntz, content string, seq long")
    rejected = stores.upsert(writes).collect()
    assert [r.reject_reason for r in sorted(rejected, key=lambda r: r.seq)] == [store.REASON_NULL_LOG_ID, store.REASON_LONG_LOG_ID, store.REASON_LONG_SOURCE]
    got = {r.log_id: r.content for r in stores.read_logs().collect()}
    assert got == {"a": None, "b": "[INFO] Data saved", "c": "nothing", "d": None, "f": "x"}


def test_an_id_in_several_batches_is_matched_once_within_its_time(spark, stores, tmp_path):
    folder, checkpoint = str(tmp_path / "events"), str(tmp_path / "checkpoint")
    writer = job.StoreBatchWriter(stores, checkpoint)
    for part in (["a", "a", b"oops"], ["b", "a", b"oops"], ["b", "a", "c"]):  # stopped and started between them
        events(spark, part).write.mode("append").parquet(folder)
        q = job.start_store_stream(job.file_events(spark, folder, "value binary"), writer, available_now=True, once_within="1 hour")
        q.awaitTermination()
        assert q.exception() is None
    history = stores.metrics_history().agg(F.sum("events"), F.sum("rejected"), F.sum("found"), F.sum("matches")).first()
    assert tuple(history) == (5, 2, 3, 4)
    assert state(stores) == (A + B, ["a", "b", "d"])


def test_another_checkpoint_is_refused_an_old_folder(spark, tmp_path):
    events(spark, ["a"]).write.parquet(str(tmp_path / "events"))
    found = logs(spark, [("a", "[INFO] x", False)])
    for name, fine in (("c1", True), ("c1", True), ("c2", False)):
        writer = job.MatchBatchWriter(lambda: found, str(tmp_path / "r"), str(tmp_path / "n"))
        events(spark, ["a"]).write.mode("append").parquet(str(tmp_path / "events"))
        stream = job.file_events(spark, str(tmp_path / "events"), "value binary")
        q = job.start_match_stream(stream, writer, str(tmp_path / name), available_now=True)
        try:
            q.awaitTermination()
        except Exception:
            pass
        assert (q.exception() is None) == fine
    assert spark.read.parquet(str(tmp_path / "r")).count() == 2


def test_every_broken_message_has_its_reason(spark):
    values = [None, b"", b"not json", b'"text"', b"{}", b'{"log_id": null}', b'{"log_id": ""}', b'{"log_id": " "}', b'{"log_id": "a", "more": 1}']
    frame = spark.createDataFrame([(None if v is None else bytearray(v),) for v in values], "value binary")
    got = [(r.log_id, r.reject_reason) for r in lookup.check_events(frame).collect()]
    reasons = [lookup.REASON_NULL_VALUE, *[lookup.REASON_NOT_JSON] * 3, *[lookup.REASON_NO_LOG_ID] * 2, lookup.REASON_EMPTY_LOG_ID, None, None]
    assert [reason for _, reason in got] == reasons
    assert [i for i, reason in got if reason is None] == [r.log_id for r in lookup.decode_events(frame).collect()] == [" ", "a"]


def test_group_names():
    def names(p, *given):
        return P.Pattern("x", p, given).group_names()

    assert names(r"a(b)(?:c)(?=d)(?<=e)(?<!f)(?<year>\d)\(g[(]") == ["group_1", "year"]
    assert names(r"(a)(b)(c)", "one", "", "three") == ["one", "group_2", "three"]
    assert names(r"\Q(a)\E(b)[[(]x](c)") == ["group_1", "group_2"]
    assert [(p.regex_id, p.group_names()) for p in P.catalogue() if p.group_names()] == [(k, list(v)) for k, v in P.DEFAULT_FIELDS.items()]


def test_fields_of_every_place(spark):
    content = "user_id=ann user_id=bob from IP 10.0.0.1\n\tAdditional info: request_id=0123456789, process_time=12ms\nuser_id="
    rows = matching.extract_fields(spark.createDataFrame([("a", content), ("b", None), ("c", "")], "log_id string, content string"))
    assert sorted(map(tuple, rows.collect())) == [
        ("a", 1, "IP_ADDRESS_EXTRACT", 1, "ip_address", "10.0.0.1"),
        ("a", 1, "USER_ID_EXTRACT", 1, "user_id", "ann"),
        ("a", 1, "USER_ID_EXTRACT", 2, "user_id", "bob"),
        ("a", 2, "ADDITIONAL_INFO_LINE", 1, "process_time", "12"),
        ("a", 2, "ADDITIONAL_INFO_LINE", 1, "request_id", "0123456789"),
    ]
    custom = P.catalogue([("DATE", r"(?<year>\d{4})-(\d\d)?"), ("NONE", "plain")])
    got = matching.extract_fields(spark.createDataFrame([("a", "on 2024- and 2025-06")], "log_id string, content string"), custom)
    assert [tuple(r)[3:] for r in got.collect()] == [(1, "year", "2024"), (2, "year", "2025"), (1, "group_2", ""), (2, "group_2", "06")]
    plain = P.catalogue([("NONE", "plain")])
    assert matching.extract_fields(spark.createDataFrame([("a", "plain")], "log_id string, content string"), plain).count() == 0


def plan_size(df):
    return len(df._jdf.queryExecution().optimizedPlan().toString())


def test_indexed_catalogue_equals_the_unrolled_one(spark):
    words = [f"w{k}ord{k % 7}" for k in range(90)]
    entries = [(f"P{k}", w) for k, w in enumerate(words)]
    entries += [("P3", "w5ord5"), ("P3", r"w3o.d\d"), ("R1", r"\bw1\w+"), ("R2", r"[0-9]{3}"), ("R3", "(?i)W4ORD4"), ("R4", "ab"), ("R5", r"x\.y"), ("R6", "w7ord0|w8ord1")]
    catalogue = P.catalogue(entries)
    texts = [" ".join(words[k % 90] for k in range(n, n + n % 5)) for n in range(200)]
    texts += ["", None, "ab", "x.y", "xzy 123", "w3ord3 w5ord5 W4Ord4", "w", "line one ab\nw1ord1\n\n w2ord2 " + "é" * 30, "pad " * 3000 + "w89ord5"]
    frame = spark.createDataFrame(list(enumerate(texts)), "log_id int, content string")
    want = sorted(map(tuple, matching.match_lines(frame, catalogue).collect()))
    cleaned = lines.clean_lines(frame)
    index = catalogue_index.index_frame(spark, catalogue)
    for bound in (catalogue_index.MAX_BROADCAST_PATTERNS, 0):
        got = catalogue_index.match_indexed(cleaned, index, max_broadcast=bound)
        assert sorted(map(tuple, got.collect())) == want
    small = catalogue_index.match_indexed(cleaned, catalogue_index.index_frame(spark, catalogue[:10]))
    # The plan does not grow with the catalogue, but for the rows of the index itself.
    many = catalogue_index.match_indexed(cleaned, index)
    assert abs(plan_size(small) - plan_size(many)) < 200
    assert [r[0] for r in M.id_predicates("x", catalogue)] == list(dict.fromkeys(p.regex_id for p in catalogue))


def test_only_keys_of_the_index_leave_a_line(spark):
    keys = ["", "abc", "abcd", "bcdef", "abcdef", "éé1", "efg"]
    texts = ["xabcdefg", "", None, "ab", "cab", "abc" * 400_000, "ef", "gabc", "ééé1"] * 3
    find = catalogue_index.KeyFinder(keys)
    got = find(pa.array(["no", *texts]).slice(1)).to_pylist()
    assert got == [sorted(k for k in keys if t is not None and k in t) for t in texts]
    assert catalogue_index.KeyFinder([])(pa.array(["abc", None])).to_pylist() == [[], []]
    frame = spark.createDataFrame([(1, 1, "some words of a line")], "log_id int, line_number int, cleaned_line string")
    index = catalogue_index.index_frame(spark, P.catalogue([("A", "words"), ("B", "elsewhere")]))
    plan = catalogue_index.match_indexed(frame, index)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan


def test_batch_mode_stores_and_flags_pending_logs(spark, stores):
    stores.match_pending()
    assert state(stores) == (A + B, ["a", "b", "d"])
    stores.match_pending()  # c is still pending, and still has no match
    assert state(stores) == (A + B, ["a", "b", "d"])


def test_command_line_stores_streams_and_folds(spark, stores, tmp_path):
    from logsift.streaming.main import main

    folder = str(tmp_path / "in")
    for ids in (["a"], ["b", ""]):
        spark.createDataFrame([(json.dumps({"log_id": i}),) for i in ids], "value string").write.mode("append").text(folder)
        main(["stream", "--stores", stores.base, "--buckets", "4", "--events-dir", folder, "--checkpoint", str(tmp_path / "c"), "--available-now"], spark)
    assert main(["fold", "--stores", stores.base, "--buckets", "4"], spark).version == 2
    assert state(stores) == (A + B, ["a", "b", "d"])
    with pytest.raises(SystemExit):
        main(["stream", "--store", "x"], spark)


def test_statistics_from_partial_counts(spark, tmp_path, monkeypatch):
    from logsift.plans import maintenance as m

    rows = [(f"l{k}", f"[ERROR] {k}" if k % 3 else "[INFO] x", False) for k in range(40)]
    none = spark.createDataFrame([], "log_id string, regex_id string, line_number int, match string, line_content string")
    stores = m.LogStores.create(str(tmp_path / "s"), logs(spark, rows), none, bucket_count=8)
    results = store.results_rows(matching.match_lines(logs(spark, rows)))

    def same():
        want = stats.stats_json(stores.read_logs(spark), stores.read_results(spark)).first()
        assert m.stored_stats(spark, stores).first() == want
        return want

    assert same().total_logs == 40
    more = [(f"l{k}", "s", None, "new", k) for k in range(35, 50)]
    stores = m.post_logs(spark, stores, spark.createDataFrame(more, "log_id string, source string, timestamp timestamp_ntz, content string, seq long"))
    assert same().total_logs == 50
    stores, _ = m.post_results(spark, stores, results.where("log_id < 'l3'"))
    assert same().processed_logs == 23
    stores = m.delete_logs(spark, stores, spark.createDataFrame([(f"l{k}",) for k in range(0, 50, 2)], "log_id string"))
    assert same().total_logs == 25
    # A job that is lost after it changed the stores.
    with monkeypatch.context() as lost:
        lost.setattr(m, "count_buckets", lambda *_: None)
        stores, _ = m.post_results(spark, stores, results.where("log_id = 'l39'"))
    assert same().total_matches > 0
    plan = m.stored_stats(spark, stores)
    assert all("/stats/counts/" in f for f in plan.inputFiles())


def test_stores_are_rewritten_some_buckets_at_a_time(spark, tmp_path, monkeypatch):
    from logsift.plans import maintenance as m
    from logsift.sources import stores as st

    rows = [(f"l{k}", f"[ERROR] {k}" if k % 3 else "[INFO] x", False) for k in range(40)] + [("l1", "[INFO] again", False)]
    results = store.results_rows(matching.match_lines(logs(spark, rows[:30])))
    staging = []
    monkeypatch.setattr(m, "scratch_path", lambda _, *parts: staging.append(str(tmp_path / "staging" / str(len(staging)))) or staging[-1])
    monkeypatch.setattr(m, "MAX_BROADCAST_KEYS", 7)
    many = m.LogStores.create(str(tmp_path / "s"), logs(spark, rows), results.limit(0), bucket_count=8)
    hits = results.select("log_id").unionByName(spark.createDataFrame([(None,)], "log_id string"))
    groups = st.bucket_groups(hits, 8, 7)
    assert len(groups) > 2 and sorted(sum(groups, [])) == sorted(st.buckets_of(results, 8))
    more = [("l1", "s", None, "new", 1), ("l99", "s", None, "[ERROR] new", 2)]
    many = m.post_logs(spark, many, spark.createDataFrame(more, "log_id string, source string, timestamp timestamp_ntz, content string, seq long"))
    many, _ = m.post_results(spark, many, results)
    # What was staged has been moved to its place, not copied.
    assert staging and not [d for d in (tmp_path / "staging").glob("*/bucket=*")]
    flagged = {r.log_id for r in many.read_logs(spark).collect() if r.processed}
    assert flagged == {f"l{k}" for k in range(30)}
    many = m.delete_logs(spark, many, spark.createDataFrame([("l2",), ("l39",), (None,)], "log_id string"))
    kept = {f"l{k}" for k in [*range(40), 99]} - {"l2", "l39"}
    assert {r.log_id for r in many.read_logs(spark).collect()} == kept
    assert many.read_results(spark).count() == results.where("log_id <> 'l2'").count()
    assert m.stored_stats(spark, many).first() == stats.stats_json(many.read_logs(spark), many.read_results(spark)).first()


def test_few_ids_read_few_row_groups(spark, tmp_path, monkeypatch):
    from logsift.sources import stores as st

    monkeypatch.setattr(st, "ROW_GROUP_BYTES", 64 << 10)
    frame = spark.range(40_000).select(F.format_string("log_%08d", "id").alias("log_id"), F.lit("s").alias("source"), F.lit(None).cast("timestamp_ntz").alias("timestamp"), F.sha2(F.col("id").cast("string"), 512).alias("content"), F.lit(False).alias("processed"))
    table = st.write_bucketed(frame, str(tmp_path / "logs"), 2)
    ids = spark.createDataFrame([(f"log_{k * 3999:08d}",) for k in range(9)] + [("log_none",)], "log_id string")
    found = lookup.log_by_id(table, ids)
    assert sorted(r.log_id for r in found.collect()) == sorted(f"log_{k * 3999:08d}" for k in range(9))

    def rows_read(df):
        df.collect()
        node, todo, n = None, [df._jdf.queryExecution().executedPlan()], 0
        while todo:
            node = todo.pop()
            if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
                node = node.executedPlan()
            if node.getClass().getSimpleName() == "FileSourceScanExec" and "content" in node.schema().toString():
                n += node.metrics().apply("numOutputRows").value()
            if hasattr(node, "plan") and node.getClass().getSimpleName().endswith("QueryStageExec"):
                todo.append(node.plan())
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
        return n

    few = rows_read(found)
    monkeypatch.setattr(lookup, "POINT_IDS", 0)
    assert 9 <= few < 20_000 < rows_read(lookup.log_by_id(table, ids))
