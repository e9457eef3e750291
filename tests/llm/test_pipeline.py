import corpus_pipeline


def test_stages_keep_columns_and_clean_rows(spark, tmp_path):
    clean = [(k, " ".join(f"w{k}x{i}" for i in range(80)), "en", f"s{k % 2}", 0) for k in range(30)]
    copies = [(100 + k, clean[0][1], "en", "s0", 0) for k in range(5)]
    junk = [(200, "spam " * 200, "en", "s0", 0), (201, None, None, None, None)]
    docs = spark.createDataFrame(clean + copies + junk, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        out.write.parquet(str(tmp_path / name))
        if name != "tokens":
            assert out.columns == docs.columns
        docs = spark.read.parquet(str(tmp_path / name))
    assert {r.doc_id for r in docs.collect()} == set(range(30))
