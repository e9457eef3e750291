"""Empty tables, columns with clashing names, very long texts and rows of nulls, for
every operator and every stage."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logsift.llm import bpe, centroids, chat, cleanup, divergence, html_extract, mixing, packing, pivot_index, quality, repeats, simhash, token_store, url_rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators give to columns of their own.
NAMES = (
    "key packed g f at n off spans q_row q_body pool level bound m_order m_range row slot epoch place block ids shard start base "
    "k_key k_root fingerprint h rep label2 unit term df v p rank value piece length part nth cluster distance total u node root"
).split()

ON_DOCS = {
    "op3": simhash.near_duplicates,
    "op4": mixing.positions,
    "op5": lambda d: token_store.offsets(d.sparkSession, d),
    "op7": quality.verdicts,
    "op8": repeats.digests,
    "op9": bpe.digests,
    "op11": divergence.audit,
    "op12": lambda d: packing.digests(d).drop("sequence_id", "offset"),
}
STAGES = dict(corpus_pipeline.STAGES)


def rows():
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    out = [(k, text(rnd.randint(60, 90)), "en", f"s{k % 3}", 0) for k in range(30)]
    long = text(250_000)  # over a megabyte
    return out + [(100, long, "en", "s0", 0), (101, "x" * 1_500_000, "en", "s1", 0), (None, None, None, None, None), (102, "", "", "", 0)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3).cache()


def crowded(frame):
    return frame.withColumns({c: F.lit(7) for c in NAMES if c not in frame.columns})


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(repr, map(tuple, a.collect()))) == sorted(map(repr, map(tuple, b.collect())))


@pytest.mark.parametrize("name", ON_DOCS)
def test_documents_of_any_shape(docs, name):
    op = ON_DOCS[name]
    assert op(docs.limit(0)).collect() == []
    same(op(docs), op(crowded(docs)))


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_stages_of_any_shape(spark, docs, name):
    stage = STAGES[name]
    assert stage(spark, docs.limit(0), "").collect() == []
    wide = crowded(docs)
    out = stage(spark, wide, "")
    assert out.columns == wide.columns
    same(out.select(*docs.columns), stage(spark, docs, ""))
    assert all(r[c] == 7 for r in out.select(*[c for c in NAMES if c not in docs.columns]).distinct().collect() for c in r.__fields__)


def test_pages_of_any_shape(spark):
    long = "<body><article>" + "<p>some words of text here</p>" * 40_000 + "</article></body>"
    pages = [(1, None, None), (None, "http://a.b/c", "<p>a"), (2, "", ""), (3, "http://x.org/" + "a/" * 500, long), (3, "http://x.org/" + "a/" * 500, long)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    labels = spark.createDataFrame([(1, 0, 0), (None, None, None)], "doc_id long, quality int, toxic int")
    for op in (html_extract.main_text, lambda p: url_rules.judge(p, crowded(labels))):
        assert op(frame.limit(0)).collect() == []
        same(op(frame), op(crowded(frame)))
    got = {r.page_id: r for r in html_extract.main_text(frame).collect()}
    assert got[3].n_chars == 40_000 * len("some words of text here") + 39_999
    assert url_rules.judge(frame, labels.limit(0)).count() == 5


def test_vectors_and_conversations_of_any_shape(spark):
    vectors = spark.createDataFrame([(k, [float(k % 5), 1.0], k % 2) for k in range(20)] + [(None, None, None)], "vec_id long, embedding array<double>, label int")
    for op in (pivot_index.near_duplicates, lambda v: centroids.clusters(v, k=3, dims=2)):
        assert op(vectors.limit(0)).collect() == []
        same(op(vectors), op(crowded(vectors)))
    turns = spark.createDataFrame([(1, 0, "user", "a" * 300_000), (1, 1, "assistant", "b c " * 50_000), (None, None, None, None)], "conv_id long, turn long, role string, text string")
    assert chat.digests(spark, turns.limit(0)).collect() == []
    same(chat.digests(spark, turns), chat.digests(spark, crowded(turns)))


def test_intermediate_tables_can_be_removed(spark, docs):
    assert quality.verdicts(docs.limit(3)).count() == 3
    assert cleanup.clean(spark) and not cleanup.clean(spark)
