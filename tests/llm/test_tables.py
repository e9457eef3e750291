"""Source divergence, packing and clustering against brute force on small tables
with nulls, empty texts, ties, repeated rows and columns with clashing names."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logsift.llm import centroids, config_lp, divergence, packing

DOCS = "doc_id long, text string, lang string, source string"


def audit(docs):
    """The contract, term by term, with Python's integers."""
    per_doc = [
        (lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        for _, text, lang, source, *_ in docs
    ]
    out = []
    for lang in {d[0] for d in per_doc}:
        mine = [d for d in per_doc if d[0] == lang]
        in_docs = collections.Counter(t for _, _, terms in mine for t in set(terms))
        kept = [t for t, n in in_docs.items() if n >= 3]
        counts = {s: collections.Counter() for _, s, _ in mine}
        for _, s, terms in mine:
            counts[s].update(t for t in terms if in_docs[t] >= 3)
        every = sum(counts.values(), collections.Counter())

        def share(c, t, v=len(kept)):
            return 1 + 10**9 * (c[t] + 1) // (c.total() + v)

        for s, c in counts.items():
            pairs = [(-sum((share(c, t) - share(o, t)) ** 2 // share(o, t) for t in kept), r) for r, o in counts.items() if r != s]
            terms = [(-((share(c, t) - share(every, t)) ** 2 // share(every, t)), t) for t in c if share(c, t) > share(every, t)]
            for part, found, most in (("pair", pairs, None), ("term", terms, 200)):
                ranked = sorted(found, key=lambda x: (x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, -v, k + 1) for k, (v, item) in enumerate(ranked)]
    return sorted(out)


def test_audit_equals_brute_force(spark, monkeypatch):
    rnd = random.Random(5)
    words = ["Alpha", "alpha", "BETA", "été", "Été", "x1y", "日本", "gamma-ray", "Ünder", "a\x7fb", "a\x00b"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    docs = [
        (k, " ".join(rnd.choice(words[: 20 + 40 * (k % 7)]) for _ in range(rnd.randint(0, 40))), rnd.choice(["en", "en", "de", None, ""]), f"s{rnd.randint(0, 5)}")
        for k in range(300)
    ]
    docs += [(None, None, None, None), (7, "", "fr", "alone"), (7, "", "fr", "alone"), (8, "alpha", "es", "a"), (9, "alpha", "es", "b")]
    docs += [(10, "Alpha alpha\nalpha", "es", "a"), (11, "?!", "es", None), (12, "same " * 50_000, "en", "s0"), (13, "same", "en", "s1"), (14, "same", "en", "s1")]
    expected = audit(docs)
    frame = spark.createDataFrame(docs, DOCS)
    crowded = frame.withColumns({c: F.lit(1) for c in ("term", "n", "value", "rank", "place", "base", "p", "deal", "tile")})
    monkeypatch.setattr(divergence, "HELD_TERMS", 500)  # counts are handed on many times
    for few in (divergence.FEW_GROUPS, 0):
        monkeypatch.setattr(divergence, "FEW_GROUPS", few)
        got = divergence.audit(crowded)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, got.collect())) == expected
    assert divergence.audit(frame.limit(0)).collect() == []


def test_audit_of_more_sources_than_a_tile_holds(spark):
    rnd = random.Random(6)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    docs = [(k, " ".join(rnd.choice(words) for _ in range(4)), "en", f"s{k % 150}") for k in range(450)]
    got = divergence.audit(spark.createDataFrame(docs, DOCS)).collect()
    assert sorted(map(tuple, got)) == audit(docs)


def test_bins_hold_every_piece_and_fit():
    rnd = random.Random(9)
    for capacity, most in ((4096, 4096), (4096, 300), (100, 100), (512, 512), (1000, 700)):
        for n in (0, 1, 40, 3000):
            histogram = np.zeros(capacity + 1, dtype=np.int64)
            for _ in range(n):
                histogram[min(most, 1 + int(rnd.expovariate(4 / most)))] += rnd.choice([1, 1, 5])
            runs, said = config_lp.bins(histogram, capacity)
            used = np.zeros_like(histogram)
            for count, content in runs:
                assert count > 0 and sum(length * a for length, a in content) <= capacity
                for length, a in content:
                    used[length] += count * a
            assert (used == histogram).all()
            total = int((histogram * np.arange(capacity + 1)).sum())
            first_fit = plain_best_fit(histogram, capacity)
            assert -(-total // capacity) <= said["bins"] <= first_fit
            assert said["bound"] <= said["program"] + 1e-6 and said["bound"] <= first_fit + 1e-6


def plain_best_fit(histogram, capacity):
    rooms = [0] * (capacity + 1)
    for length in range(capacity, 0, -1):
        for _ in range(int(histogram[length])):
            room = next((r for r in range(length, capacity) if rooms[r]), None)
            if room is None:
                room = capacity
            else:
                rooms[room] -= 1
            rooms[room - length] += 1
    return sum(rooms)


def test_the_program_covers_all_classes_within_its_bound():
    histogram = np.zeros(101, dtype=np.int64)
    histogram[[51, 27, 26, 23]] = 6, 6, 12, 12
    configuration, worth = config_lp.best_configuration(np.arange(101.0), histogram, 100)
    assert worth == 100 and sum(j * a for j, a in configuration.items()) == 100
    x, bound = config_lp.solve(histogram, 100)
    cover = collections.Counter()
    for c, share in x.items():
        assert sum(j * a for j, a in c) <= 100 and share >= 0
        for j, a in c:
            cover[j] += share * a
    assert all(cover[j] >= histogram[j] - 1e-6 for j in (51, 27, 26, 23))
    assert 10.5 <= bound <= sum(x.values()) + 1e-9


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_equals_the_library(spark, capacity, monkeypatch):
    rnd = random.Random(8)
    docs = [(k, " ".join(rnd.choice(["Word", "été", "naïve,", "x9", "日本語"]) for _ in range(rnd.randint(0, 90))), "en", "s") for k in range(120)]
    docs += [(None, None, None, None), (None, "", None, None), (200, "same text", "en", "s"), (200, "same text", "en", "s")]
    docs += [(2**63 - 1, "long " * 9000, "en", "s"), (-4, "<|endoftext|> a", "en", "s")]
    docs += [(k, "hot length", "en", "s") for k in range(300, 400)]
    library = Tokenizer.from_file(packing.vocabulary_path())
    expected = []
    for i, text, *_ in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), capacity)):
            cut = np.array(ids[at : at + capacity], "<u4")
            expected.append((i, n, at, len(cut), zlib.crc32(cut.tobytes())))
    frame = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit(1) for c in ("piece", "length", "part", "ids", "nth", "n", "begin")})
    for few in (packing.FEW_ROWS, 0):
        monkeypatch.setattr(packing, "FEW_ROWS", few)
        rows = packing.digests(frame.repartition(5), capacity=capacity).collect()
        assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(expected, key=repr)
        places = collections.defaultdict(list)
        for r in rows:
            places[r.sequence_id].append((r.offset, r.length))
        for parts in places.values():
            ends = list(itertools.accumulate(n for _, n in sorted(parts)))
            assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= capacity
    total = sum(e[3] for e in expected)
    assert math.ceil(total / capacity) <= len(places) <= plain_best_fit(np.bincount([e[3] for e in expected], minlength=capacity + 1), capacity)
    made = packing.sequences(frame, capacity=capacity).collect()
    assert all(len(r.ids) == 2 * r.n_tokens <= 2 * capacity for r in made) and sum(r.n_tokens for r in made) == total
    cuts = collections.Counter()
    for r in made:
        ids = np.frombuffer(r.ids, "<u2").astype("<u4")
        for a, b in itertools.pairwise([*r.begins, r.n_tokens]):
            cuts[zlib.crc32(ids[a:b].tobytes())] += 1
    assert cuts == collections.Counter(e[4] for e in expected)
    assert packing.digests(frame.limit(0)).collect() == []


def test_tournament_is_the_nearest_centroid():
    rnd = np.random.default_rng(4)
    for scale in (2, 300, (1 << 26) - 1):  # many ties; doubles; 64-bit integers
        points = rnd.integers(-scale, scale + 1, (12, 6))
        field = centroids.Tournament([*points.tolist(), points[0].tolist(), points[3].tolist()])
        x = np.concatenate((rnd.integers(-scale, scale + 1, (400, 6)), points))
        best = field.champions(x)
        apart = [[sum((a - b) ** 2 for a, b in zip(row, c, strict=True)) for c in field.centroids.tolist()] for row in x.tolist()]
        assert best.tolist() == [d.index(min(d)) for d in apart]
        assert field.distances(x, best).tolist() == [min(d) for d in apart]


def lloyd(rows, k, rounds, dims):
    good = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x) < 2**18 for x in v)
    ]
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    order = sorted(good, key=lambda r: (digest(f"2:{'' if r[0] is None else r[0]}"), np.array(r[1], "<i4").tobytes()))
    at = [v for _, v in order[:k]]
    for step in range(rounds + 1):
        found = []
        for _, v in good:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in at]
            found.append((d.index(min(d)), min(d)))
        if step < rounds:
            for c in range(len(at)):
                own = [v for (_, v), (j, _) in zip(good, found, strict=True) if j == c]
                if own:
                    at[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    inertia = collections.Counter()
    for c, d in found if good else []:
        inertia[c] += d
    return [
        (i, c, d, inertia[c], inertia.total(), digest(",".join(map(str, at[c]))))
        for (i, _), (c, d) in zip(good, found if good else [], strict=True)
    ]


def test_clusters_equal_brute_force(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rnd.normal(size=8) * (1 + i % 5)]) for i in range(300)]
    rows += [(400, None), (401, [1.0] * 7), (402, [1.0] * 7 + [None]), (403, [math.nan] * 8), (404, [math.inf] + [0.0] * 7), (405, [])]
    rows += [(406, [2.0**18] * 8), (407, [-(2.0**18) + 1] * 8), (408, [0.0] * 8), (408, [0.0] * 8), (409, rows[0][1]), (None, rows[1][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("v", "cluster", "distance", "dim", "total")})
    for k, rounds, part in ((40, 5, frame), (7, 2, frame.repartition(6)), (1, 1, frame), (40, 5, frame.where("vec_id < 10"))):
        left = {r.vec_id for r in part.select("vec_id").collect()}
        mine = [r for r in rows if r[0] in left]
        got = centroids.clusters(part, k=k, rounds=rounds, dims=8).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(lloyd(mine, k, rounds, 8), key=repr)
    assert centroids.clusters(frame.where("vec_id = 400"), dims=8).collect() == []
    assert centroids.clusters(frame.limit(0)).collect() == []
