"""The streaming job equals the batch plan, survives a restart, and a
replayed batch replaces its own output."""

import os
import tempfile

from pyspark.sql import functions as F

from logsift.operators import matching
from logsift.sources import fixtures, tables
from logsift.streaming import job

from .conftest import SF_SMALL


def _event_files(spark, base):
    """The events table split into 4 files (one micro-batch each)."""
    ev = tables.table(spark, SF_SMALL, "events")
    path = os.path.join(base, "events")
    ev.withColumn("part", (F.col("event_id") % 4).cast("int")).repartition(1, "part").write.partitionBy("part").parquet(path)
    return ev, path


def test_stream_equals_batch_with_restart(spark):
    base = tempfile.mkdtemp(prefix="logsift-stream-")
    ev, path = _event_files(spark, base)
    schema = ev.schema
    logs = fixtures.render_logs(ev)

    def envelope(max_files):
        s = job.file_events(spark, path, schema, max_files_per_trigger=max_files)
        return fixtures.event_values(s)

    out = os.path.join(base, "out")
    writer = job.MatchBatchWriter(lambda: logs, os.path.join(out, "results"), os.path.join(out, "not_found"))
    ckpt = os.path.join(out, "checkpoint")

    # First run: two batches, then stop (simulates a crash between batches).
    q = job.start_match_stream(envelope(1), writer, ckpt, trigger="1 second")
    import time

    deadline = time.time() + 120
    while len(writer.history) < 2 and time.time() < deadline:
        time.sleep(0.5)
    q.stop()
    first = len(writer.history)
    assert first >= 2

    # Restart from the checkpoint: the rest is processed once.
    q = job.start_match_stream(envelope(1), writer, ckpt, available_now=True)
    q.awaitTermination()
    assert q.exception() is None

    got = spark.read.parquet(os.path.join(out, "results"))
    # how many batches the restart needs depends on where the stop landed
    assert got.select("batch_id").distinct().count() >= 2
    streamed = {tuple(r) for r in got.select("regexId", "log_id", "line_number", "matched_text").collect()}

    from logsift.operators.lookup import decode_events

    ids = decode_events(fixtures.event_values(ev))
    want = {tuple(r) for r in matching.match_lines(logs.join(ids, "log_id", "left_semi")).collect()}
    assert streamed == want
    assert got.count() == len(want)  # no duplicates


def test_replayed_batch_overwrites_its_partition(spark):
    base = tempfile.mkdtemp(prefix="logsift-replay-")
    ev = tables.table(spark, SF_SMALL, "events")
    logs = fixtures.render_logs(ev)
    out = os.path.join(base, "results")
    writer = job.MatchBatchWriter(lambda: logs, out, os.path.join(base, "nf"))
    batch = ev.limit(50).select(fixtures.log_id_of(F.col("event_id")).alias("log_id"))
    writer(batch, 7)
    n1 = spark.read.parquet(out).count()
    writer(batch, 7)  # the same batch again, as after a failure
    assert spark.read.parquet(out).count() == n1
    writer(batch, 8)
    assert spark.read.parquet(out).count() == 2 * n1


def test_batch_match_over_bucketed_store_has_no_shuffle(spark, tmp_path):
    import contextlib
    import io

    from logsift.plans import micro_batch
    from logsift.sources import stores

    ev = tables.table(spark, SF_SMALL, "events")
    logs = fixtures.render_logs(ev)
    table = stores.write_bucketed(logs, str(tmp_path / "logs"), bucket_count=8)
    rows = micro_batch.store.results_rows(
        matching.match_lines(table.read(spark), carry=(stores.BUCKET_COL,))
    )
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        rows.explain("formatted")
    assert "Exchange" not in buf.getvalue()
    out = micro_batch.batch_match_table(spark, table, str(tmp_path / "results"))
    got = out.read(spark)
    want = micro_batch.batch_match(logs)
    cols = ["log_id", "regex_id", "line_number", "match", "line_content"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    # every result row sits in its log's bucket
    assert got.filter(stores.bucket_of("log_id", 8) != F.col("bucket")).count() == 0


def test_stream_batches_record_metrics(spark):
    base = tempfile.mkdtemp(prefix="logsift-metrics-")
    ev = tables.table(spark, SF_SMALL, "events")
    logs = fixtures.render_logs(ev)
    writer = job.MatchBatchWriter(lambda: logs, os.path.join(base, "r"), os.path.join(base, "nf"))
    batch = ev.select(fixtures.log_id_of(F.col("event_id")).alias("log_id"))
    writer(batch, 0)
    h = writer.history[0]
    assert h["found"] == ev.count()
    assert h["matches"] == spark.read.parquet(os.path.join(base, "r")).count()
    assert h["cleaned_lines"] >= h["found"] - ev.filter(F.col("event_id") % 17 == 0).count()


def test_command_line_stream_and_batch(spark, tmp_path):
    from logsift.sources import stores
    from logsift.streaming import main as cli

    ev = tables.table(spark, SF_SMALL, "events")
    logs = fixtures.render_logs(ev)
    store = stores.write_bucketed(logs, str(tmp_path / "store"), bucket_count=8)
    # event messages as text lines, like Kafka values
    fixtures.event_values(ev).select(F.col("value").cast("string").alias("value")).write.text(str(tmp_path / "events"))
    writer = cli.main(
        [
            "stream", "--events-dir", str(tmp_path / "events"), "--store", store.path, "--buckets", "8",
            "--out", str(tmp_path / "out"), "--available-now", "--checkpoint", str(tmp_path / "ckpt"),
        ],
        spark,
    )
    got = spark.read.parquet(str(tmp_path / "out" / "results")).drop("batch_id")
    from logsift.operators.lookup import decode_events

    ids = decode_events(fixtures.event_values(ev))
    want = matching.match_lines(logs.join(ids, "log_id", "left_semi"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sum(h["matches"] for h in writer.history) == got.count()
    nf = spark.read.schema("log_id string, batch_id long").parquet(str(tmp_path / "out" / "not_found"))
    assert nf.count() == 0
    res = cli.main(["batch", "--store", store.path, "--buckets", "8", "--out", str(tmp_path / "batch")], spark)
    assert res.read(spark).count() == matching.match_lines(logs).count()


def test_failed_lookup_fails_batch_and_restart_recovers(spark, tmp_path):
    ev = tables.table(spark, SF_SMALL, "events")
    logs = fixtures.render_logs(ev)
    path = str(tmp_path / "events")
    fixtures.event_values(ev).select(F.col("value").cast("string").alias("value")).write.text(path)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")

    def broken():
        raise RuntimeError("store unavailable")

    w1 = job.MatchBatchWriter(broken, out + "/r", out + "/nf")
    q = job.start_match_stream(job.file_events(spark, path, "value string", fmt="text"), w1, ckpt, available_now=True)
    try:
        q.awaitTermination()
    except Exception:
        pass
    assert q.exception() is not None and not w1.history  # nothing silently dropped

    w2 = job.MatchBatchWriter(lambda: logs, out + "/r", out + "/nf")
    q = job.start_match_stream(job.file_events(spark, path, "value string", fmt="text"), w2, ckpt, available_now=True)
    q.awaitTermination()
    assert q.exception() is None and len(w2.history) == 1
    from logsift.operators.lookup import decode_events

    want = matching.match_lines(logs.join(decode_events(fixtures.event_values(ev)), "log_id", "left_semi")).count()
    assert spark.read.parquet(out + "/r").count() == want


def test_empty_batch_does_no_work(spark, tmp_path):
    ev = tables.table(spark, SF_SMALL, "events")
    writer = job.MatchBatchWriter(lambda: fixtures.render_logs(ev), str(tmp_path / "r"), str(tmp_path / "nf"))
    writer(spark.createDataFrame([], "log_id string"), 3)
    assert list(writer.history) == [{"batch_id": 3, "found": 0, "cleaned_lines": 0, "matches": 0}]
    assert not os.path.exists(tmp_path / "r")


def test_replay_without_rows_clears_the_batch(spark, tmp_path):
    import os

    from logsift.streaming import job

    logs = spark.createDataFrame([("a", "[ERROR] broken")], "log_id string, content string")
    empty = logs.limit(0)
    store = [empty]
    writer = job.MatchBatchWriter(lambda: store[0], str(tmp_path / "r"), str(tmp_path / "n"))
    batch = spark.createDataFrame([("a",)], "log_id string")

    def rows(name):
        return [x.log_id for x in spark.read.parquet(os.path.join(str(tmp_path), name)).collect()]

    writer(batch, 5)
    assert (rows("r"), rows("n")) == ([], ["a"])
    store[0] = logs
    writer(batch, 5)
    assert set(rows("r")) == {"a"} and rows("n") == []
    store[0] = empty
    writer(batch, 5)
    assert (rows("r"), rows("n")) == ([], ["a"])


def test_stream_without_matches_returns_an_empty_frame(spark, tmp_path):
    from logsift.streaming import job

    path = str(tmp_path / "events")
    spark.createDataFrame([("not json",)], "value string").write.text(path)
    events = job.file_events(spark, path, "value string", fmt="text")
    out, writer, _ = job.run_to_completion(spark, events, lambda: None, base=str(tmp_path / "out"))
    assert out.count() == 0 and "regexId" in out.columns
