"""Source divergence audit from term frequencies (operator 11).

Terms are runs of ASCII letters and of everything beyond ASCII, with only A-Z
lower-cased. In UTF-8 that is one ``bytes.translate`` of a whole text (capitals to
small letters, every other ASCII byte to a blank), one ``bytes.split``, and one
``Counter`` a document for its term frequencies and, by its keys, the document
counts. A task adds its Counters up by (lang, source), so what is shuffled are
sparse counts.

A language keeps the terms that are in ``LEAST_DOCS`` of its documents. With V of
them, a group's N occurrences and a term's count there,

    p = 1 + floor(SCALE * (count + 1) / (N + V))
    f = floor((p - q) * (p - q) / q)

compare a group's p with a q: of another source (summed over all kept terms), or
of the language (by term).

Most terms are absent from most sources, so a sum over all V terms is not taken
term by term. With z and y the values of a term that is absent from g, from h:

    sum f(p, q) =   sum over the terms of g       f(p, y)        (only p, y count)
                  + sum over the terms of h       f(z, q)        (only q, z count)
                  + sum over the terms of both    f(p, q) - f(p, y) - f(z, q) + f(z, y)
                  + (V - |terms of g| - |terms of h|) * f(z, y)

The first two sums come from the histogram of a group's counts and the few
different y of a language. The third one is taken in blocks of ``TILE`` by ``TILE``
sources over the terms that they share; a task adds it up in a matrix a tile.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsift.llm.common import materialise, small_batches
from logsift.operators.joins import at_most

LEAST_DOCS, SCALE, RANKS = 3, 1_000_000_000, 200
#: Bytes that belong to a term, capitals as small letters; all others are blanks.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Different (group, term) counts that a task holds before it hands them on.
HELD_TERMS = 200_000
#: Sources of a tile, pairs that are compared at once, tiles that a task holds.
TILE, PAIRS, HELD_TILES = 128, 1 << 18, 64
#: Ways in which a language is dealt in joins on the language alone.
DEAL = 16
#: Groups that may be broadcast (about 100 bytes each).
FEW_GROUPS = 200_000


def term_counts(text: bytes) -> Counter:
    """Frequencies of the terms of one UTF-8 text."""
    return Counter(text.translate(TERM_BYTES).split())


def counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df): occurrences of a term in a group and documents
    of the group that have it. Every group has a row with a null term, whose n
    and df are 0."""
    small_batches(docs.sparkSession)
    plain = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = docs.select(plain("lang").alias("lang"), plain("source").alias("source"), F.encode(plain("text"), "UTF-8").alias("text"))

    def handed(held: dict) -> pa.RecordBatch:
        lang, source, term, n, df = [], [], [], [], []
        for (a, b), (freq, seen) in held.items():
            size = len(freq) + 1
            lang += [a] * size
            source += [b] * size
            term += [None, *freq]
            n += [0, *freq.values()]
            df += [0, *(seen[t] for t in freq)]
        columns = [pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary())]
        columns += [pa.array(n, pa.int64()), pa.array(df, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "df"])

    def run(batches):
        held: dict = defaultdict(lambda: (Counter(), Counter()))
        size = 0
        for b in batches:
            groups = zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), b.column("text").to_pylist(), strict=True)
            for lang, source, text in groups:
                found = term_counts(text)
                freq, seen = held[lang, source]
                before = len(freq)
                freq.update(found)
                seen.update(found.keys())
                size += len(freq) - before
                if size >= HELD_TERMS:
                    yield handed(held)
                    held.clear()
                    size = 0
        yield handed(held)

    parts = rows.mapInArrow(run, "lang string, source string, term binary, n long, df long")
    # By term only, so that the sums over a term need no further shuffle.
    return parts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _share(count: Column, of: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / of), exact for any counts."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count.cast("decimal(19,0)") + F.lit(1))
    return (F.lit(1) + F.call_function("div", top, of.cast("decimal(19,0)"))).cast("long")


def _gap(p: Column, q: Column) -> Column:
    # At most SCALE squared, which 64 bits hold.
    return F.call_function("div", (p - q) * (p - q), q)


class Audit:
    """The kept counts and totals of ``docs``, written once."""

    def __init__(self, docs: DataFrame):
        of_term = Window.partitionBy("lang", "term")
        # Dropped before they are written: most terms are in one document.
        rows = (
            counts(docs)
            .withColumn("docs", F.sum("df").over(of_term))
            .withColumn("lang_n", F.sum("n").over(of_term))
            .where((F.col("docs") >= LEAST_DOCS) | F.col("term").isNull())
            .select("lang", "source", F.col("term").cast("string").alias("term"), "n", "lang_n")
        )
        rows = materialise(rows, "counts")
        kept = rows.where("term is not null")
        by_lang = (
            kept.groupBy("lang", "term")
            .agg(F.first("lang_n").alias("n"))
            .groupBy("lang")
            .agg(F.count("*").alias("v"), F.sum("n").alias("lang_total"))
        )
        sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
        zero = F.lit(0).cast("long")
        groups = (
            rows.where("term is null")
            .select("lang", "source")
            .join(by_lang, "lang", "left")
            .join(sums, ["lang", "source"], "left")
            .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("v", "lang_total", "total", "terms")])
            .withColumn("base", F.when(F.col("v") > 0, _share(zero, F.col("total") + F.col("v"))))
            # One row a source: as many as the result has for each of them.
            .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
        )
        self.groups = materialise(groups, "groups")
        few = at_most(self.groups, FEW_GROUPS)
        totals = self.groups.select("lang", "source", "v", "lang_total", "total", "base", "place")
        # Two written tables: past the bound Spark splits a hot group of the join.
        self.kept = (
            kept.join(F.broadcast(totals) if few else totals, ["lang", "source"])
            .withColumn("p", _share(F.col("n"), F.col("total") + F.col("v")))
            .withColumn("q", _share(F.col("lang_n"), F.col("lang_total") + F.col("v")))
        )

    def terms(self, ranks: int = RANKS) -> DataFrame:
        """Part ``term``: the terms that a group has more of than its language."""
        value = _gap(F.col("p"), F.col("q")).alias("value")
        more = self.kept.where("p > q").select("lang", "source", F.col("term").alias("item"), value)
        return _ranked(more, "term").where(F.col("rank") <= ranks)

    def pairs(self) -> DataFrame:
        """Part ``pair``: each source against the others of its language."""
        out = self._others()
        spread = self._absent()
        # The sums over a group's own terms, with it first and with it second.
        own = spread.select("lang", F.col("place").alias("g"), F.col("other").alias("y"), F.col("first").alias("of_g"))
        theirs = spread.select("lang", F.col("place").alias("h"), F.col("other").alias("z"), F.col("second").alias("of_h"))
        none = F.lit(0).cast("decimal(38,0)")
        rest = F.col("v") - F.col("g_terms") - F.col("h_terms")
        value = (
            F.coalesce("of_g", none)
            + F.coalesce("of_h", none)
            + F.coalesce("both", none)
            + rest.cast("decimal(38,0)") * _gap(F.col("z"), F.col("y"))
        )
        joined = out.join(own, ["lang", "g", "y"], "left").join(theirs, ["lang", "h", "z"], "left")
        joined = joined.join(self._shared(), ["lang", "g", "h"], "left")
        value = F.when(F.col("v") > 0, value).otherwise(none).cast("long")
        return _ranked(joined.select("lang", "source", "item", value.alias("value")), "pair")

    def _others(self) -> DataFrame:
        """(lang, g, source, h, item, ...) of every two sources of a language: the
        rows of the result. The language is dealt, so no task makes them all."""
        one = self.groups.select(
            "lang", F.col("place").alias("g"), "source", "v", F.col("terms").alias("g_terms"), F.col("base").alias("z"),
            F.pmod("place", F.lit(DEAL)).alias("deal"),
        )
        other = self.groups.select(
            "lang", F.col("place").alias("h"), F.col("source").alias("item"), F.col("terms").alias("h_terms"), F.col("base").alias("y"),
            F.explode(F.sequence(F.lit(0), F.lit(DEAL - 1))).alias("deal"),
        )
        return one.join(other, ["lang", "deal"]).where("g != h")

    def _absent(self) -> DataFrame:
        """(lang, place, other, first, second): for a group and a value of absent
        terms, the sums of f over the group's terms with it first, and second."""
        histogram = self.kept.groupBy("lang", "place", "p").agg(F.count("*").alias("m"))
        bases = self.groups.where("v > 0").select("lang", F.col("base").alias("other")).distinct()
        bases = bases.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(DEAL - 1))))
        m = F.col("m").cast("decimal(20,0)")
        gap = lambda a, b: F.sum(m * _gap(F.col(a), F.col(b))).cast("decimal(38,0)")
        return (
            histogram.withColumn("deal", F.pmod(F.xxhash64("place", "p"), F.lit(DEAL)).cast("int"))
            .join(bases, ["lang", "deal"])
            .groupBy("lang", "place", "other")
            .agg(gap("p", "other").alias("first"), gap("other", "p").alias("second"))
        )

    def _shared(self) -> DataFrame:
        """(lang, g, h, both): the sums over the terms that g and h share."""
        tile = F.floor(F.col("place") / TILE).cast("int")
        members = F.collect_list(F.struct("place", "p", "base"))
        blocks = self.kept.groupBy("lang", "term", tile.alias("tile")).agg(members.alias("members"))
        last = self.groups.agg(F.max("place")).first()[0]
        if last is not None and last >= TILE:
            blocks = materialise(blocks, "blocks")
            right = blocks.select("lang", "term", F.col("tile").alias("tile2"), F.col("members").alias("members2"))
            rows = blocks.join(right, ["lang", "term"]).select("lang", "tile", "tile2", "members", "members2")
        else:
            rows = blocks.where(F.size("members") > 1)
            rows = rows.select("lang", "tile", F.col("tile").alias("tile2"), "members", F.col("members").alias("members2"))
        sums = rows.mapInArrow(_tiles, "lang string, g int, h int, both long")
        return sums.groupBy("lang", "g", "h").agg(F.sum(F.col("both").cast("decimal(38,0)")).alias("both"))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _tiles(batches):
    """Adds up, for rows (lang, tile, tile2, members, members2) that stand for one
    term each, f(p, q) - f(p, y) - f(z, q) + f(z, y) of their pairs of sources."""
    held: dict = {}

    def f(p, q):
        gap = p - q
        return gap * gap // q

    def flushed():
        for (lang, t, u), m in held.items():
            g, h = np.nonzero(m)
            columns = [pa.array([lang] * len(g), pa.string()), pa.array(g + t * TILE, pa.int32())]
            columns += [pa.array(h + u * TILE, pa.int32()), pa.array(m[g, h], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "g", "h", "both"])
        held.clear()

    for b in batches:
        sides = []
        for name in ("members", "members2"):
            column = b.column(name)
            flat = column.flatten()
            parts = [flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("place", "p", "base")]
            sides.append((np.diff(column.offsets.to_numpy()), parts))
        (left_n, left), (right_n, right) = sides
        left_begin, right_begin = (np.cumsum(n) - n for n in (left_n, right_n))
        tiles = list(zip(b.column("lang").to_pylist(), b.column("tile").to_pylist(), b.column("tile2").to_pylist(), strict=True))
        names = sorted(set(tiles), key=str)
        number = {t: i for i, t in enumerate(names)}
        of_row = np.array([number[t] for t in tiles], dtype=np.int64)
        todo = np.cumsum(left_n.astype(np.int64) * right_n)
        begin = 0
        while begin < b.num_rows:
            done = todo[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(todo, done + PAIRS, side="right")))
            # Every member of the left side beside every one of the right.
            rows = np.arange(begin, end)
            i = np.repeat(np.arange(left_begin[begin], left_begin[end - 1] + left_n[end - 1]), np.repeat(right_n[rows], left_n[rows]))
            runs = np.repeat(right_n[rows], left_n[rows])
            starts = np.repeat(right_begin[rows], left_n[rows])
            j = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(starts, runs)
            (g, p, z), (h, q, y) = ([a[i] for a in left], [a[j] for a in right])
            value = f(p, q) - f(p, y) - f(z, q) + f(z, y)
            cell = np.repeat(np.repeat(of_row[rows], left_n[rows]), runs) * TILE * TILE + g % TILE * TILE + h % TILE
            cells, at = np.unique(cell, return_inverse=True)
            sums = np.zeros(len(cells), dtype=np.int64)
            np.add.at(sums, at, value)
            for k in np.unique(cells // (TILE * TILE)).tolist():
                mine = cells // (TILE * TILE) == k
                m = held.setdefault(names[k], np.zeros((TILE, TILE), dtype=np.int64))
                m.reshape(-1)[cells[mine] % (TILE * TILE)] += sums[mine]
            begin = end
        if len(held) > HELD_TILES:
            yield from flushed()
    yield from flushed()


def audit(docs: DataFrame, ranks: int = RANKS) -> DataFrame:
    """(lang, source, part, item, value, rank) of both parts, see above.

    Null text, lang or source counts as ''. A document without terms still makes
    its group; a language that keeps no term has pairs of value 0 and no terms. A
    group alone in its language has no pairs. Repeated rows count again. An empty
    table gives an empty result; other columns are not read.
    """
    of = Audit(docs.select("text", "lang", "source"))
    return of.pairs().unionAll(of.terms(ranks))


ORACLE_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents),
words AS (SELECT d, lang, source, unnest(terms) AS term FROM docs),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= {LEAST_DOCS}),
freq AS MATERIALIZED (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
groups AS MATERIALIZED (
  SELECT g.lang, g.source, coalesce(l.v, 0) AS v, coalesce(l.total, 0) AS lang_total,
    coalesce((SELECT sum(n) FROM freq f WHERE f.lang = g.lang AND f.source = g.source), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN langs l ON g.lang = l.lang),
shares AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n,
    CAST(1 + {SCALE}::HUGEINT * (coalesce(f.n, 0) + 1) // (g.total + g.v) AS HUGEINT) AS p,
    CAST(1 + {SCALE}::HUGEINT * (k.n + 1) // (g.lang_total + g.v) AS HUGEINT) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN freq f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
  ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
  FROM parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {RANKS}
"""
