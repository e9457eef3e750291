"""Operators against brute force on small tables with nulls, empty texts, ties
and repeated rows."""

import collections
import hashlib
import heapq
import itertools
import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from logsift.llm import bpe, chat, html_extract, mixing, pivot_index, quality, repeats, simhash, token_store, url_rules

DOCS = "doc_id long, text string, lang string, source string"


def documents():
    rnd = random.Random(3)
    passage = "".join(rnd.choice("abcd efgh") for _ in range(700))
    rows = []
    for k in range(40):
        a, b = sorted(rnd.sample(range(700), 2))
        text = "".join(rnd.choice("abcdé ") for _ in range(rnd.randint(0, 600))) + passage[a:b]
        rows.append((k, text, "en", f"s{k % 3}"))
    return rows + [
        (100, "a" * 1500, "de", None),
        (101, None, None, None),
        (None, "", "en", "s0"),
        (104, "ab" * 900, "en", "s1"),
        (105, rows[3][1], "en", "s1"),
        (105, rows[3][1], "en", "s1"),
    ]


def key(rows):
    return sorted(map(repr, rows))


def roots(n, links):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(a) for a in range(n)]


@pytest.mark.parametrize("length", [400, 256, 64])
def test_repeats(spark, monkeypatch, length):
    docs = documents()
    seen = collections.Counter()
    data = [(i, (t or "").encode()) for i, t, *_ in docs]
    for _, b in data:
        seen.update(b[s : s + length] for s in range(len(b) - length + 1))
    expected = []
    for i, b in data:
        mask = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                mask[s : s + length] = b"\1" * length
        kept = bytes(c for c, m in zip(b, mask, strict=True) if not m)
        runs = sum(1 for on, _ in itertools.groupby(mask) if on)
        expected.append((i, len(b), sum(mask), runs, hashlib.sha256(kept).hexdigest()))
    frame = spark.createDataFrame(docs, DOCS)
    for part in (512, 4):  # 4: large parts are dealt again, down to single windows
        monkeypatch.setattr(repeats, "PART", part)
        assert key(map(tuple, repeats.digests(frame, length).collect())) == key(expected)
    assert repeats.digests(frame.limit(0), length).collect() == []


def test_parts_are_sorted_from_rows(spark, monkeypatch):
    """Members reach a task as rows, not as one list a part; a part is never split
    over what is sorted together."""
    size = repeats.Sizes(64)
    rng = random.Random(5)
    members, expected = [], set()
    for g in range(30):
        shared = rng.randbytes(70)
        part = [rng.randbytes(3) + shared + rng.randbytes(k % 4) for k in range(rng.randint(2, 12))]
        seen = collections.Counter(d[s : s + 64] for d in part for s in range(len(d) - 63))
        for f, d in enumerate(part):
            members.append((g, f, d, 12, len(d) - 63))
            expected |= {(g, f, s) for s in range(len(d) - 63) if seen[d[s : s + 64]] > 1}
    rng.shuffle(members)
    frame = spark.createDataFrame(members, repeats.MEMBER)
    for part in (512, 1):  # 1: few members are sorted together
        monkeypatch.setattr(repeats, "PART", part)
        out = repeats._sort_parts(frame, size)
        got = [(r.g, r.f, s) for r in out.collect() for s in range(r.lo, r.hi + 1)]
        assert len(got) == len(set(got)) and set(got) == expected
    assert "collect_list" not in out._jdf.queryExecution().toString()


def test_batches_become_objects_in_pieces():
    texts = ["x" * k for k in (3 << 20, 10, 0, 2 << 20, 5)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(5))], names=["text", "k"])
    pieces = list(repeats._pieces([batch, batch.slice(0, 0)]))
    assert len(pieces) > 1 and pa.Table.from_batches(pieces).to_pylist() == batch.to_pylist()
    small = batch.slice(1, 2)
    assert [p.num_rows for p in repeats._pieces([small])] == [2]


def test_simhash(spark):
    docs = documents()

    def fingerprint(text):
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, min(1, len(words))))]
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    fps = [fingerprint(t) for _, t, *_ in docs]
    links = [(a, b) for a, b in itertools.combinations(range(len(docs)), 2) if (fps[a] ^ fps[b]).bit_count() <= 2]
    found = roots(len(docs), links)
    least = {r: min((docs[k][0] for k in range(len(docs)) if found[k] == r and docs[k][0] is not None), default=None) for r in found}
    expected = [(docs[k][0], f"{fps[k]:016x}", least[found[k]]) for k in range(len(docs))]
    frame = spark.createDataFrame(docs, DOCS)
    assert key(map(tuple, simhash.near_duplicates(frame).collect())) == key(expected)
    assert simhash.near_duplicates(frame.limit(0)).collect() == []


def test_keep_one_of_each_component(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(80))
    docs = [(None, text(k), "en", "s0") for k in range(20)] + [(None, text(0), "en", "s0")] * 3
    docs += [(5, text(30), "en", "s0"), (5, text(31), "en", "s0")]  # two components named 5
    docs += [(7, text(40), "en", "s0"), (7, text(41), "en", "s0"), (6, text(41), "en", "s1")]  # one of 7's belongs to 6
    docs += [(None, text(50), "en", "s0"), (9, text(50), "en", "s0"), (8, None, "en", "s0"), (None, "", "en", "s0")]
    expected = docs[:20] + docs[23:26] + [docs[27], docs[29], docs[30]]
    frame = spark.createDataFrame(docs, DOCS)
    assert key(map(tuple, simhash.keep_one(frame).collect())) == key(expected)
    assert simhash.keep_one(frame.limit(0)).collect() == []


def test_token_store_equals_the_library(spark):
    docs = documents() + [(2**63 - 1, "last word", "en", "s0"), (9007199254740993, "a  b", None, None), (-5, "x" * 3000, "en", "s0")]
    docs += [(9007199254740995, "Word. " * 70000 + "end", "en", "s0"), (7_000, "one\n\ntwo <|endoftext|> three", "en", "s0")]
    tokenizer = Tokenizer.from_file(bpe.vocabulary_path())
    expected, start = [], 0
    rows = token_store.offsets(spark, spark.createDataFrame(docs, DOCS)).collect()
    for r, (i, t, *_) in zip(
        sorted(rows, key=lambda r: r.start), sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or "")), strict=True
    ):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        assert (r.doc_id, r.start) == (i, start)
        start += r.n_tokens
        expected.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert key((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == key(expected)
    assert token_store.offsets(spark, spark.createDataFrame([], DOCS)).collect() == []


def test_token_store_round_trip(spark):
    docs = documents()
    rows = token_store.offsets(spark, spark.createDataFrame(docs, DOCS)).collect()
    assert len(rows) == len(docs) and min(r.start for r in rows) == 0
    ends = sorted((r.start, r.start + r.n_tokens) for r in rows)
    assert all(a[1] == b[0] for a, b in itertools.pairwise(ends))
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)] == sorted((d[0] for d in docs), key=lambda i: (i is not None, i))
    digests = bpe.digests(spark.createDataFrame(docs, DOCS)).collect()
    assert sorted(r.n_tokens for r in digests) == sorted(r.n_tokens - 1 for r in rows)


def test_quality_counts_and_edges(spark):
    rows = [
        (1, None, None, None),
        (None, "a b", "en", "x"),
        (2, "word " * 60, "en", None),
        (2, "word " * 60, "en", None),
        (3, "\n".join(f"line {i} | of # words" for i in range(30)) + "\nline 3 | of # words", "en", "x"),
    ]
    got = {r.doc_id: r for r in quality.verdicts(spark.createDataFrame(rows, DOCS)).collect()}
    assert tuple(got[1])[1:] == (0, 0, 0, 0, 0, True, False)
    assert got[2].n_repeat_words == 60 and got[2].base_failed
    r = got[3]  # not in a repeat: the numbers but the two 3s, and the first word
    assert (r.n_words, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (186, 62, 1, 186 - 30)
    assert quality.verdicts(spark.createDataFrame([], DOCS)).collect() == []


def test_quality_of_a_group_with_a_third_of_junk(spark):
    rnd = random.Random(11)

    def words(n):
        return ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 8))) for _ in range(n)]

    rows = [(k, " ".join(words(rnd.randint(60, 90))), "en", "x") for k in range(400)]
    rows += [(k, " ".join(w + " #*" * (i % 2) for i, w in enumerate(words(70))), "en", "x") for k in range(400, 600)]
    got = {r.doc_id: r for r in quality.verdicts(spark.createDataFrame(rows, DOCS)).collect()}
    assert not any(r.base_failed for r in got.values())
    assert [k for k in range(600) if got[k].kept != (k < 400)] == []


def test_mixing_deviates_less_than_a_block(spark):
    docs = [(k, None, None, "hot" if k % 3 else f"s{k % 4}") for k in range(600)] + [(None, None, None, None)] * 3
    rows = mixing.positions(spark.createDataFrame(docs, DOCS)).collect()
    assert {r.doc_id for r in rows} == {d[0] for d in docs}
    assert sum(r.doc_id is None and r.epoch == 0 for r in rows) == 3
    slots = {r.slot: r.source for r in rows}
    assert all(r.release <= r.slot < r.deadline for r in rows)
    weight = collections.defaultdict(lambda: [0.0, 1.0])  # bounds of the weight from the blocks' windows
    counts = collections.Counter()
    for s in range(max(slots) + 1):
        counts[slots[s]] += 1
    for r in rows:
        weight[r.source][1] = min(weight[r.source][1], (r.block + 1) / (r.deadline - 1) if r.deadline > 1 else 1.0)
        weight[r.source][0] = max(weight[r.source][0], r.block / (r.release + 1))
    assert all(lo < hi for lo, hi in weight.values())


def test_mixing_follows_given_targets(spark):
    docs = [(k, None, None, f"s{k % 60}") for k in range(60 * 40)]
    for given in ({"s0": 0.5} | {f"s{k}": 0.5 / 59 for k in range(1, 60)}, {"s0": 0.9} | {f"s{k}": 0.1 / 59 for k in range(1, 60)}):
        targets = spark.createDataFrame(list(given.items()), "source string, weight double")
        rows = mixing.positions(spark.createDataFrame(docs, DOCS), targets).collect()
        assert {r.doc_id for r in rows} == set(range(60 * 40)) and all(r.release <= r.slot < r.deadline for r in rows)
        slots = {r.slot: r.source for r in rows}
        counts = collections.Counter()
        for s in range(max(slots) + 1):
            counts[slots[s]] += 1
            assert max(abs(counts[k] - w * (s + 1)) for k, w in given.items()) < 1.01


def plain_turns(ws, t):
    """Earliest deadline first, one slot after the other: (slot, source, block)."""
    used, ready, out = [0] * len(ws), [], []
    waiting = [(0, i) for i in range(len(ws))]
    for now in range(t):
        while waiting and waiting[0][0] <= now:
            i = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(used[i] + 1) * t // ws[i]), i))
        i = heapq.heappop(ready)[1]
        out.append((now, i, used[i]))
        used[i] += 1
        heapq.heappush(waiting, (used[i] * t // ws[i], i))
    return out


@pytest.mark.parametrize("ws", [[500], [583, 285, 132], [330, 330, 335, 5], [100] * 9 + [99, 1], list(range(90, 150))])
def test_mixing_in_parts_equals_one_slot_after_the_other(spark, monkeypatch, ws):
    monkeypatch.setattr(mixing, "PART", 1)
    rows = [(f"s{i}", 16 * 10**6, 10**6, w, sum(ws), i) for i, w in enumerate(ws)]
    weights = spark.createDataFrame(rows, "source string, n long, b long, w long, t long, idx int")
    assert len(ws) == 1 or mixing._parts(weights).count() > 1 or 1 in ws
    assert sorted((r.turn, r.idx, r.number) for r in mixing.turns(weights).collect()) == plain_turns(ws, sum(ws))


def test_mixing_ends_with_the_most_epochs(spark):
    docs = spark.createDataFrame([(k, None, None, "s" if k < 32 else "big") for k in range(800)], DOCS)
    targets = spark.createDataFrame([("s", 0.5), ("big", 0.5)], "source string, weight double")
    whole, short = (mixing.positions(docs, targets, e).collect() for e in (None, 3))
    assert max(r.epoch for r in whole) > 10 and {r.doc_id for r in whole} == set(range(800))
    end = max(r.slot for r in short)
    assert max(r.epoch for r in short) == 2 and sorted(short) == sorted(r for r in whole if r.slot <= end)
    assert mixing.positions(docs.limit(0), targets, 3).collect() == []


def test_chat_reads_back_what_was_said(spark):
    rows = [(1, 0, "system", "be <|end|> kind"), (1, 1, "user", "x" * 900), (1, 2, "assistant", r"<\|turn|> [INST]" * 40)]
    rows += [(1, k, "user" if k % 2 else "assistant", f"turn {k} " * 30) for k in range(3, 20)]
    rows += [(2, 0, None, None), (2, None, "assistant", "a"), (2, None, "assistant", "a"), (None, 5, "user\n", "<s></s>")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    got = {r.conv_id: r for r in chat.digests(spark, frame).collect()}
    for conv in (1, 2, None):
        own = sorted((r for r in rows if r[0] == conv), key=order)
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        expected = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert tuple(got[conv])[1:5] == expected
    out = chat.windows(frame, budget=300, history=60).where("conv_id = 1").collect()
    assert len(out) > 3 and all(w.formatted.startswith(chat.TURN if w.window == 0 else chat.AGAIN + "system") for w in out)


@pytest.mark.parametrize("lead", [0, 100, 500, 900])
def test_chat_windows_keep_the_budget_in_any_script(spark, lead):
    rnd = random.Random(lead)
    words = ["机器学习", "hello", "<|end|>", "[INST]", "привет", "🙂", "x"]
    rows = [(c, 0, "system", "s" * lead) for c in range(6) if lead]
    for c in range(6):
        rows += [(c, k, "user" if k % 2 else "assistant", " ".join(rnd.choices(words, k=rnd.randint(0, 20)))) for k in range(1, 40)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    budget, repeated = 700, 0
    for w in chat.windows(frame, budget=budget, history=200).collect():
        parts = w.formatted.split(chat.END)[:-1]
        system = [p for p in parts if p.split(chat.TEXT)[0].endswith("system")]
        own = [p for p in parts if p.startswith(chat.TURN) and p not in system]
        assert len(system) == (lead > 0)
        if len(w.formatted.encode()) > budget:
            assert len(own) <= 1 and len(parts) == len(own) + len(system)  # at most one turn beside the system turn
        repeated += len(parts) - len(own) - len(system)
    assert (repeated > 0) == (lead < 600)


def test_embeddings(spark):
    rnd = np.random.default_rng(5)
    base = rnd.normal(size=(40, 16))
    rows = [(i, [float(x) for x in base[i % 40] + rnd.normal(size=16) * 0.1 * (i >= 40)], i % 40 % 3) for i in range(300)]
    rows += [(900, rows[0][1], 0), (901, None, 1), (902, [0.0] * 16, 1), (903, [float("nan")] * 16, 1), (904, rows[1][1], None)]
    rows += [(905, [1.0, 2.0], 1), (905, [1.0, 2.0], 1), (906, [None] * 16, 1)]
    good = [k for k, (_, v, lab) in enumerate(rows) if lab is not None and v and None not in v and any(v) and np.isfinite(v).all()]
    links = []
    for a, b in itertools.combinations(good, 2):
        u, v = np.array(rows[a][1]), np.array(rows[b][1])
        if rows[a][2] == rows[b][2] and len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.93:
            links.append((a, b))
    count = collections.Counter(itertools.chain.from_iterable(links))
    found = roots(len(rows), links)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = pivot_index.near_duplicates(frame).collect()
    expected = [(rows[k][0], count[k], rows[found[k]][0], rows[k][0] == rows[found[k]][0]) for k in range(len(rows))]
    assert sum(r.n_links for r in got) >= 0.9 * sum(count.values())
    assert len(set(map(tuple, got)) & set(expected)) >= 0.9 * len(set(expected))
    assert pivot_index.near_duplicates(frame.limit(0)).collect() == []


@pytest.mark.parametrize("n", [3000, 24000])
def test_embeddings_of_a_large_noisy_group(spark, n):
    rnd = np.random.default_rng(7)
    group, dims = n // 3, 64
    centre = rnd.normal(size=dims)
    noise = rnd.normal(size=(group, dims)) * np.linalg.norm(centre) / 8 * (1 / 0.95 - 1) ** 0.5  # cosines about 0.95
    vectors = np.concatenate((centre + noise, rnd.normal(size=(n - group, dims)))).astype("f4")
    vectors[group + 1 :: 10] = vectors[group::10][: len(vectors[group + 1 :: 10])] * 0.9 + vectors[group + 1 :: 10] * 0.25
    unit = vectors.astype("f8") / np.linalg.norm(vectors.astype("f8"), axis=1, keepdims=True)
    count = np.concatenate([(unit[k : k + 1000] @ unit.T >= 0.93).sum(1) - 1 for k in range(0, n, 1000)])
    frame = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": list(vectors), "label": np.zeros(n, "i4")}))
    got = {r.vec_id: r.n_links for r in pivot_index.near_duplicates(frame).select("vec_id", "n_links").collect()}
    links = np.array([got[k] for k in range(n)])
    assert (links <= count).all() and (links[:group] == count[:group]).all()
    assert links[group:].sum() >= 0.99 * count[group:].sum() > 0


def test_urls_and_pages(spark):
    urls = ["HTTP://A.Example.NET/en/x", "http://x.net/en/", "https://example.com/de/1#x", "ftp://q.org/fr/?a=b", "x", None]
    urls += [f"http://shop-{k % 7}.example.com/en/pills/{k}" for k in range(60)] + [f"http://good.example.com/en/{k}" for k in range(60)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(k, int(not 6 <= k < 60), 0) for k in range(126)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in url_rules.judge(pages, labels).collect()}
    assert [(got[k].host, got[k].path, got[k].rule, got[k].verdict) for k in range(6)] == [
        ("a.example.net", "/en/x", "example.net/en/", "allow"),
        ("x.net", "/en/", "net/", "block"),
        ("example.com", "/de/1", "example.com/de/", "block"),
        ("q.org", "/fr/", "org/fr/", "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
    ]
    assert got[10].verdict == got[64].verdict == "block" and got[70].verdict == "allow"
    html = spark.createDataFrame([(1, None, None), (None, "u", "<body><p>a b</p></body>")], "page_id long, url string, html string")
    assert key(map(tuple, html_extract.main_text(html).collect())) == key([(1, None, "", 0), (None, "u", "a b", 3)])


def test_mined_rules_equal_counted_item_sets(spark):
    rnd = random.Random(12)
    hosts = ["big-shop.example.com", "pills.example.com", "news.site.de", "a.b.fr", "www.cheap-pills.biz"]
    urls = []
    for k in range(700):
        host, path = rnd.choice(hosts), rnd.choice(["buy", "read", "pills", "about"])
        urls.append((k, f"http://{host}/{path}/{k}?{rnd.choice(['ref', 'id'])}=1"))
    bad = {k: "pills" in u or ("shop" in u and "buy" in u) or rnd.random() < 0.1 for k, u in urls if k % 5}
    labels = spark.createDataFrame([(k, int(not b), 0) for k, b in bad.items()], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame(urls, "page_id long, url string")
    host, path = url_rules.parts(url_rules.F.col("url"))
    tokens = {r.page_id: frozenset(r.t) for r in pages.select("page_id", url_rules.url_tokens(host, path, url_rules.F.col("url")).alias("t")).collect()}
    held, wrong = collections.Counter(), collections.Counter()
    for k, b in bad.items():
        for n in range(1, len(tokens[k]) + 1):
            for some in itertools.combinations(sorted(tokens[k]), n):
                held[frozenset(some)] += 1
                wrong[frozenset(some)] += b
    good = {s for s, n in wrong.items() if n >= url_rules.MIN_COUNT and n / held[s] >= url_rules.MIN_CONFIDENCE}
    rules = {s for s in good if not any(part < s for part in good)}
    frame = spark.createDataFrame([(sorted(tokens[k]), b) for k, b in bad.items()], "tokens array<string>, bad boolean")
    got = {frozenset(r.tokens): (r.support, r.confidence) for r in url_rules.mine_rules(frame).collect()}
    assert got == {s: (wrong[s], wrong[s] / held[s]) for s in rules} and len(rules) > 2
    blocked = {r.page_id for r in url_rules.judge(pages, labels).where("rule is null and verdict = 'block'").collect()}
    assert blocked == {k for k, _ in urls if any(s <= tokens[k] for s in rules)} and 0 < len(blocked) < len(urls)
    # Without labels, and without pages, nothing is mined.
    assert url_rules.judge(pages, labels.limit(0)).where("verdict = 'block'").count() == 0
    assert url_rules.judge(pages.limit(0), labels).collect() == []
