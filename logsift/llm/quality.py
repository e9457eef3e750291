"""Quality rules as robust multivariate outliers (operator 7).

For each language and source, a minimum-covariance-determinant estimate of the
transformed statistics of its documents gives a centre and a scatter that junk
does not move. A document far from the centre by its Mahalanobis distance is
rejected. Built-in DataFrame functions only.

The estimate starts from the coordinates' medians and median deviations (one
deterministic start) and takes ``STEPS`` concentration steps: distances to the
present estimate, then mean and covariance of the nearest ``SHARE`` of the
group. A last step uses all within the 97.5 % ellipsoid. Statistics are whole
numbers (thousandths), so their sums are exact and a run gives the same result
however Spark orders the rows. ``FLOORS`` are least standard deviations: clean
text has no symbols at all, say, and one should not be an outlier.

Aggregation is partial on every task before rows are shuffled by group, so a
source with a third of all documents sends a few numbers from each task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import WORD_SPACE, materialise, text_of
from logsift.operators.joins import at_most

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Half of a group, so that junk must reach half of it to move its estimate.
SHARE = 0.5
STEPS = 5
#: Groups with fewer documents that pass the base rules are estimated together,
#: by language, and languages with fewer all together.
MIN_GROUP = 100
#: Groups whose estimates may be broadcast (about 300 bytes each); with more the
#: joins shuffle.
FEW_GROUPS = 100_000
#: A clean document is rejected with this probability if its statistics are normal.
REJECT = 1e-6
#: Transformed statistics and the least standard deviation of each.
FLOORS = {"length": 0.06, "symbols": 0.05, "repeats": 0.15, "lines": 0.15, "upper": 0.06}
UNIT = 1000
STATS = list(FLOORS)
D = len(STATS)
PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]


def chi2_cdf(x: float, d: int) -> float:
    """Chi-squared distribution function, by the series of the incomplete gamma."""
    a, x = d / 2, x / 2
    term = total = 1 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= x / k
        total += term
    return total * math.exp(a * math.log(x) - x - math.lgamma(a))


def chi2_quantile(p: float, d: int) -> float:
    lo, hi = 1e-9, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, d) < p else (lo, mid)
    return lo


def consistency(share: float) -> float:
    """Factor that makes the covariance of the nearest share that of a normal."""
    return share / chi2_cdf(chi2_quantile(share, D), D + 2)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def base_statistics(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines and n_upper of the whole text in columns named ``q_...``."""
    out = rows.withColumn("q_text", text)
    out = out.withColumn("q_words", F.filter(F.split("q_text", "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    out = out.withColumn("q_lines", F.filter(F.split("q_text", "\n"), lambda x: _without(x, WORD_SPACE) != ""))
    # Windows are compared by a 64-bit hash within one text.
    hashes = F.transform("q_words", lambda w, i: F.xxhash64(w, F.get("q_words", i + 1), F.get("q_words", i + 2)))
    out = out.withColumn("q_windows", F.slice(hashes, F.lit(1), F.greatest(F.size("q_words") - 2, F.lit(0))))
    # Only texts with a repeated window sort theirs; the places of equal neighbours are repeats.
    placed = F.sort_array(F.transform("q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = F.size(F.array_distinct("q_windows")) < F.size("q_windows")
    out = out.withColumn("q_placed", F.when(repeated, placed))
    h = lambda i: F.get("q_placed", i)["h"]
    twice = F.filter("q_placed", lambda s, i: s["h"].eqNullSafe(h(i + 1)) | ((i > 0) & s["h"].eqNullSafe(h(i - 1))))
    out = out.withColumn("q_places", F.sort_array(F.transform(twice, lambda s: s["i"])))
    covered = F.transform("q_places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("q_places", k + 1) - p, F.lit(3))))
    count = lambda c: c.cast("long")
    return out.withColumns(
        {
            "q_n_words": count(F.size("q_words")),
            "q_word_chars": count(F.length(_without(F.col("q_text"), WORD_SPACE))),
            "q_n_symbols": count(F.length("q_text") - F.length(_without(F.col("q_text"), SYMBOLS))),
            "q_n_dup_lines": count(F.size("q_lines") - F.size(F.array_distinct("q_lines"))),
            "q_n_repeat_words": count(F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0))),
            "q_n_lines": count(F.size("q_lines")),
            "q_n_upper": count(F.length("q_text") - F.length(F.regexp_replace("q_text", "\\p{Lu}", ""))),
        }
    ).drop("q_text", "q_words", "q_lines", "q_windows", "q_placed", "q_places")


def _transformed(rows: DataFrame) -> DataFrame:
    """The statistic vector in thousandths, and the base rules' verdict."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    value = {
        "length": F.log(F.greatest(share("q_word_chars", "q_n_words"), F.lit(0.1))),
        "symbols": F.log1p(share("q_n_symbols", "q_n_words")),
        "repeats": F.sqrt(share("q_n_repeat_words", "q_n_words")),
        "lines": F.sqrt(share("q_n_dup_lines", "q_n_lines")),
        "upper": share("q_n_upper", "q_word_chars"),
    }
    failed = (F.col("q_n_words") < MIN_WORDS) | (100 * F.col("q_n_repeat_words") > MAX_REPEAT_PERCENT * F.col("q_n_words"))
    return rows.withColumns({f"z_{s}": F.round(value[s] * UNIT).cast("long") for s in STATS} | {"q_failed": failed})


def _factored(estimate: DataFrame) -> DataFrame:
    """Inverse of the Cholesky factor as columns w_i_j, so that a distance is a
    few products; computed once a group. Each column may name those before it.
    The arithmetic of this module is SQL text, as thousands of small Column
    objects would take longer to build than a small table takes to judge."""
    steps = []
    for i in range(D):
        for j in range(i + 1):
            rest = f"c_{i}_{j}" + "".join(f" - l_{i}_{k} * l_{j}_{k}" for k in range(j))
            steps.append((f"sqrt({rest})" if i == j else f"({rest}) / l_{j}_{j}") + f" AS l_{i}_{j}")
    for j in range(D):
        for i in range(j, D):
            rest = ("1D" if i == j else "0D") + "".join(f" - l_{i}_{k} * w_{k}_{j}" for k in range(j, i))
            steps.append(f"({rest}) / l_{i}_{i} AS w_{i}_{j}")
    out = estimate.selectExpr("*", *steps)
    return out.select("pool", *[f"m_{i}" for i in range(D)], *[f"w_{i}_{j}" for i, j in PAIRS])


def _distance() -> Column:
    x = [f"(z_{s} - m_{i})" for i, s in enumerate(STATS)]
    away = [" + ".join(f"w_{i}_{j} * {x[j]}" for j in range(i + 1)) for i in range(D)]
    return F.expr(" + ".join(f"({a}) * ({a})" for a in away))


def _level(distance: Column) -> Column:
    """Distances on a fine logarithmic scale of whole numbers: their order
    statistics need a bounded table of counts."""
    return F.floor(F.log1p(distance) * 500)


def _estimate(rows: DataFrame, factor: float) -> DataFrame:
    """Centre and covariance of each pool from exact sums."""
    sums = [f"sum(z_{s}) AS s_{i}" for i, s in enumerate(STATS)]
    sums += [f"cast(sum(cast(z_{STATS[i]} * z_{STATS[j]} AS decimal(28,0))) AS double) AS s_{i}_{j}" for i, j in PAIRS]
    out = rows.groupBy("pool").agg(*map(F.expr, ["count(*) AS n", *sums]))
    cov = {(i, j): f"(s_{i}_{j} / n - m_{i} * m_{j}) * {factor!r}D" for i, j in PAIRS}
    # The variance of a constant can come out a little under 0 in floating point.
    cov |= {(i, i): f"greatest({cov[i, i]}, 0D) + {(FLOORS[s] * UNIT) ** 2!r}D" for i, s in enumerate(STATS)}
    means = [f"s_{i} / n AS m_{i}" for i in range(D)]
    return _factored(out.selectExpr("*", *means, *[f"{c} AS c_{i}_{j}" for (i, j), c in cov.items()]))


def _sent(table: DataFrame, few: bool) -> DataFrame:
    """A table of a row a group for a join: with few groups (counted) the rows stay
    where they are, so a hot group is as spread as the table that it is in."""
    return F.broadcast(table) if few else table


def _start(rows: DataFrame, few: bool) -> DataFrame:
    """Medians, and median deviations as a diagonal covariance."""
    centre = rows.groupBy("pool").agg(*[F.expr(f"percentile(z_{s}, 0.5D) AS m_{i}") for i, s in enumerate(STATS)])
    away = [f"percentile(abs(z_{s} - m_{i}), 0.5D) AS a_{i}" for i, s in enumerate(STATS)]
    away += [f"first(m_{i}) AS m_{i}" for i in range(D)]
    spread = rows.join(_sent(centre, few), "pool").groupBy("pool").agg(*map(F.expr, away))
    cov = {(i, j): "0D" for i, j in PAIRS}
    cov |= {(i, i): f"pow(a_{i} * 1.4826D, 2D) + {(FLOORS[s] * UNIT) ** 2!r}D" for i, s in enumerate(STATS)}
    return _factored(spread.selectExpr("*", *[f"{c} AS c_{i}_{j}" for (i, j), c in cov.items()]))


def estimates(stats: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
    """(pools, estimates, few): the pool of each (lang, source), each pool's
    centre and scatter, and whether there are few groups. ``stats`` needs lang,
    source, q_failed and z_*."""
    passed = stats.where("not q_failed")
    sizes = stats.groupBy("lang", "source").agg(F.count_if(~F.col("q_failed")).alias("n"))
    name = lambda *c: F.to_json(F.struct(*c), {"ignoreNullFields": "false"})
    small = F.col("n") < MIN_GROUP
    by_lang = sizes.where(small).groupBy(F.col("lang").alias("of")).agg((F.sum("n") < MIN_GROUP).alias("few"))
    pool = F.when(~small, name("lang", "source")).when(F.col("few"), F.lit("all")).otherwise(name("lang"))
    pools = materialise(
        sizes.join(by_lang, F.col("lang").eqNullSafe(F.col("of")), "left").select("lang", "source", pool.alias("pool")), "pools"
    )
    few = at_most(pools, FEW_GROUPS)
    rows = materialise(_pooled(passed, pools, few).select("pool", *[f"z_{s}" for s in STATS]), "vectors")
    estimate = materialise(_start(rows, few), "estimate")
    for _ in range(STEPS):
        at = rows.join(_sent(estimate, few), "pool").select("pool", *[f"z_{s}" for s in STATS], _level(_distance()).alias("level"))
        bound = at.groupBy("pool").agg(F.percentile("level", F.lit(SHARE)).alias("bound"))
        near = at.join(_sent(bound, few), "pool").where("level <= bound")
        estimate = materialise(_estimate(near, consistency(SHARE)), "estimate")
    near = rows.join(_sent(estimate, few), "pool").where(_distance() <= chi2_quantile(0.975, D))
    return pools, materialise(_estimate(near, consistency(0.975)), "estimate"), few


def _pooled(rows: DataFrame, pools: DataFrame, few: bool) -> DataFrame:
    names = pools.select(F.col("lang").alias("p_lang"), F.col("source").alias("p_source"), "pool")
    on = F.col("lang").eqNullSafe(F.col("p_lang")) & F.col("source").eqNullSafe(F.col("p_source"))
    return rows.join(_sent(names, few), on).drop("p_lang", "p_source")


def _judged(rows: DataFrame, pools: DataFrame, estimate: DataFrame, few: bool) -> DataFrame:
    """``rows`` with q_kept. A pool without an estimate rejects nothing more."""
    far = F.coalesce(_distance() > chi2_quantile(1 - REJECT, D), F.lit(False))
    judged = _pooled(rows, pools, few).join(_sent(estimate, few), "pool", "left")
    # One condition over both sides of the join: as two, Spark would move the
    # first below and compute the statistics a second time there.
    return judged.withColumn("q_kept", F.when(F.col("q_failed"), F.lit(False)).otherwise(~far))


def _prepared(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*docs.columns).alias("q_row"), "lang", "source", text_of().alias("q_body"))


def verdicts(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept) of every row of ``docs``.

    A null text counts as empty; texts under ``MIN_WORDS`` words fail the base
    rules and take no part in estimates. A null lang or source is a group like
    any other. Repeated rows are judged alike. An empty table gives an empty
    result.
    """
    base = base_statistics(_prepared(docs), F.col("q_body"))
    doc_id = F.col("q_row")["doc_id"].alias("doc_id")
    stats = materialise(_transformed(base).withColumn("doc_id", doc_id).drop("q_row", "q_body"), "statistics")
    kept = _judged(stats, *estimates(stats))
    counts = [F.col(f"q_{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return kept.select("doc_id", *counts, F.col("q_failed").alias("base_failed"), F.col("q_kept").alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep. Texts are not shuffled: their
    statistics are computed once for the estimates and once where they are
    judged."""
    rows = _transformed(base_statistics(_prepared(docs), F.col("q_body")))
    stats = materialise(rows.drop("q_row", "q_body"), "statistics")
    kept = _judged(rows, *estimates(stats)).where("q_kept")
    return kept.select(*[F.col("q_row")[c].alias(c) for c in docs.columns])
