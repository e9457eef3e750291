"""Hot keys: one id holding a third of all rows must neither change results
nor land in one task."""

import contextlib
import io

from pyspark.sql import functions as F

from logsift.operators import lookup, stats, store


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


SHUFFLE_ONLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


def _hot_requests(spark, n=30000):
    # a third of all requests ask for one id
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))).alias("log_id")
    ).repartition(8)


def test_hot_id_lookup_is_split_and_correct(spark):
    st = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("log_id"), F.lit("c").alias("content"))
    st = st.unionByName(spark.createDataFrame([("hot", "hot text")], "log_id string, content string"))
    with conf(spark, **SHUFFLE_ONLY):
        out = lookup.bulk_lookup(_hot_requests(spark), st, max_broadcast_keys=None)
        rows = out.collect()
        counts = {}
        for r in rows:
            counts[r.log_id] = counts.get(r.log_id, 0) + 1
        assert counts["hot"] == 10000
        assert len(rows) == 30000
        assert all(r.status is None for r in rows)


def test_expand_counts_spreads_heavy_rows(spark):
    from logsift.operators import skew

    df = spark.createDataFrame([("hot", 2500), ("a", 3), ("b", 1), (None, 2)], "k string, n long")
    out = skew.expand_counts(df, "n", "k", chunk=100)
    got = {r.k: r.c for r in out.groupBy("k").agg(F.count(F.lit(1)).alias("c")).collect()}
    assert got == {"hot": 2500, "a": 3, "b": 1, None: 2}
    per_task = out.filter(F.col("k") == "hot").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) > 1  # the heavy key is expanded by several tasks


def test_salted_join_equals_plain_join(spark):
    from logsift.operators import skew

    res = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))).alias("log_id"),
        F.lit("R").alias("regex_id"),
        F.col("id").cast("int").alias("line_number"),
        F.lit("m").alias("match"),
        F.lit("m").alias("line_content"),
    )
    logs = spark.range(0, 5000, 2).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("log_id"))
    logs = logs.unionByName(spark.createDataFrame([("hot",)], "log_id string"))
    hot = skew.hot_keys(res, "log_id", hot_key_rows=1000)
    assert list(hot) == ["hot"] and hot["hot"] == 10
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = skew.salted_join(res, logs, "log_id", how, ["regex_id", "line_number"], hot)
        b = res.join(logs, "log_id", how)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())), how
    with conf(spark, **SHUFFLE_ONLY):
        j = skew.salted_join(res, logs, "log_id", "left_semi", ["regex_id", "line_number"], hot)
        j.collect()
        plan = j._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan
    checked = store.check_results(res, logs, hot_key_rows=1000)
    assert checked.filter(F.col("reject_reason").isNull()).count() == res.join(logs, "log_id", "left_semi").count()


def test_hot_id_aggregates_combine_map_side(spark):
    res = _hot_requests(spark).select(
        "log_id", F.lit("R").alias("regex_id"), F.lit(1).alias("line_number"), F.lit("m").alias("match"), F.lit("m").alias("line_content")
    )
    df = stats.matches_by_type(res.withColumn("regex_id", F.when(F.col("log_id") == "hot", "HOT").otherwise("COLD")))
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in p
    assert {r.regex_id: r.n for r in df.collect()} == {"HOT": 10000, "COLD": 20000}


def test_upsert_hot_id(spark):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    st = spark.createDataFrame([("hot", "s", t0, "old", True)], "log_id string, source string, timestamp timestamp_ntz, content string, processed boolean")
    writes = spark.range(30000).select(
        F.lit("hot").alias("log_id"),
        F.lit("w").alias("source"),
        F.lit(t0).alias("timestamp"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("content"),
        F.col("id").alias("seq"),
    ).repartition(8)
    with conf(spark, **SHUFFLE_ONLY):
        r = store.upsert_logs(st, writes, max_broadcast_keys=None).collect()
    assert len(r) == 1 and r[0].content == "c29999" and r[0].source == "s" and r[0].processed is True


def test_hot_bucket_append_is_split(spark, tmp_path):
    import os

    from logsift.sources import stores, tables

    res = spark.range(40000).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("log_id"),
        F.lit("R").alias("regex_id"),
        F.col("id").cast("int").alias("line_number"),
        F.lit("m" * 50).alias("match"),
        F.lit("m").alias("line_content"),
    )
    table = stores.StoreTable(str(tmp_path / "res"), 16, tables.RESULTS_SCHEMA)
    with conf(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "8"}):
        stores.append_bucketed(res, table)
    hot_bucket = spark.range(1).select(stores.bucket_of(F.lit("hot"), 16)).first()[0]
    files = [f for f in os.listdir(tmp_path / "res" / f"bucket={hot_bucket}") if f.endswith(".parquet")]
    assert len(files) > 1
    assert table.read(spark).count() == 40000


def test_no_heavy_key_is_left_out(spark):
    from logsift.operators import skew

    df = spark.range(4500).select((F.col("id") % 1500).alias("k"))
    assert len(skew.hot_keys(df, "k", hot_key_rows=2)) == 1500


def test_distinct_lines_have_as_many_partitions_as_their_text_needs(spark, monkeypatch):
    from logsift.operators import matching, partitioning

    rows = [("a", "x [ERROR] y\nx [ERROR] y"), ("a", "x [ERROR] y\nz [INFO]"), ("a", "x [ERROR] y"), (None, "[INFO]"), (None, "[INFO]"), ("b", None)]
    logs = spark.createDataFrame(rows, "log_id string, content string")
    want = sorted(map(repr, matching.match_cleaned_lines(matching.clean_lines(logs), distinct_rows=True).collect()))
    monkeypatch.setattr(partitioning.parts_for, "__defaults__", (2,))
    found = matching.match_lines(logs, distinct_rows=True)
    assert sorted(map(repr, found.collect())) == want and len(want) == len(set(want))
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    size = sum(len(text) for _, text in rows if text)
    assert partitioning.parts_for(logs, F.col("content")) == size / 2 > 8
