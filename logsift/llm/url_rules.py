"""URL filters by association rules (operator 2).

Fixed rules (host, path) decide first. For the other URLs, FP-growth mines
token combinations of the bad ones among the labelled URLs. The sets that ``MIN_COUNT``
bad URLs hold are counted again on all labelled rows, and a set gives the rule
"these tokens -> bad" if its confidence is high enough and no shorter kept rule is
part of it. Rules are matched by an inverted index, for the recount and for the
URLs alike: each set stands under its rarest token, and the distinct token sets of
the URLs look their tokens up in it.

The least count is a number of URLs and no share of them, so what makes a rule does
not depend on the size of the table.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import materialise
from logsift.operators.skew import expand_counts

#: (host, path, verdict): a rule fits its host and all subdomains if the path
#: starts with its own; the longest decides.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
#: Least number of bad labelled URLs behind a rule, and least share of bad ones
#: among the labelled URLs that hold its tokens.
MIN_COUNT = 20
MIN_CONFIDENCE = 0.8


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty for null or without ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lowered, F.lit("")), F.coalesce(path, F.lit(""))


def rule_verdict(host: Column, path: Column) -> Column:
    """Struct (rule, verdict) of the longest fixed rule that fits, else null."""
    found = None
    for name, start, verdict in sorted(RULES, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        value = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found


def url_tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens, sorted: labels of the host, the words of those that have
    several, path segments in their order (numbers as #), and names in the query."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    several = F.filter(F.split(host, r"\."), lambda x: x.contains("-"))
    words = F.transform(F.flatten(F.transform(several, lambda x: F.split(x, "-"))), lambda x: F.concat(F.lit("w:"), x))
    masked = F.transform(F.split(path, "/"), lambda x: F.regexp_replace(x, r"[0-9]+", "#"))
    segments = F.transform(masked, lambda x, i: F.concat(F.lit("p"), i.cast("string"), F.lit(":"), x))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.regexp_extract(x, r"(?s)^([^=]*)", 1)))
    every = F.concat(labels, words, segments, names)
    return F.sort_array(F.array_distinct(F.filter(every, lambda x: ~x.endswith(":"))))


RULE_SCHEMA = "rule_id long, tokens array<string>, confidence double, support long"


def frequent_sets(labelled: DataFrame) -> DataFrame:
    """(tokens, support): the token sets that at least ``MIN_COUNT`` bad rows of
    ``labelled`` (tokens, bad, n) hold, by FP-growth over the bad rows. Tokens that
    are too rare are left out before."""
    wrong = labelled.where("bad")
    often = wrong.select("n", F.explode("tokens").alias("token")).groupBy("token").agg(F.sum("n").alias("f"))
    often = often.where(F.col("f") >= MIN_COUNT).select("token")
    # Equal token sets are one row of ``labelled``, so they name their baskets.
    items = wrong.select("tokens", "n", F.explode("tokens").alias("token")).join(often, "token")
    items = items.groupBy("tokens", "n").agg(F.collect_list("token").alias("items"))
    # A basket is there as often as its row stands for, spread over the tasks.
    baskets = materialise(expand_counts(items.select("items", "n"), "n", "items"), "baskets")
    count = baskets.count()
    if count < MIN_COUNT:
        return baskets.sparkSession.createDataFrame([], "tokens array<string>, support long")
    # A little under the least share, as shares are rounded.
    model = FPGrowth(itemsCol="items", minSupport=(MIN_COUNT - 0.5) / count, minConfidence=1.0).fit(baskets)
    sets = model.freqItemsets.where(F.col("freq") >= MIN_COUNT)
    return sets.select(F.sort_array("items").alias("tokens"), F.col("freq").alias("support"))


def mine_rules(labelled: DataFrame) -> DataFrame:
    """(rule_id, tokens, confidence, support) from labelled rows (tokens, bad)."""
    spark = labelled.sparkSession
    counted = materialise(labelled.groupBy("tokens", "bad").agg(F.count("*").alias("n")), "labelled")
    sets = materialise(frequent_sets(counted).withColumn("rule_id", F.xxhash64("tokens")), "sets")
    if sets.isEmpty():
        return spark.createDataFrame([], RULE_SCHEMA)
    # All labelled rows that hold a set, good ones included.
    held = _held(counted.select("tokens", "n"), sets.select("rule_id", F.col("tokens").alias("needed")), ["n"])
    totals = held.groupBy("rule_id").agg(F.sum("n").alias("total"))
    rules = sets.join(totals, "rule_id").withColumn("confidence", F.col("support") / F.col("total"))
    rules = rules.where(F.col("confidence") >= MIN_CONFIDENCE).select("rule_id", "tokens", "confidence", "support")
    rules = materialise(rules, "rules")
    # A rule with a kept rule's tokens among its own decides nothing more.
    parts = rules.select("rule_id", F.col("tokens").alias("needed"))
    within = _held(rules.select("tokens", F.col("rule_id").alias("whole")), parts, ["whole"])
    implied = within.where("rule_id <> whole").select(F.col("whole").alias("rule_id")).distinct()
    return rules.join(implied, "rule_id", "left_anti")


def _held(sets: DataFrame, needed: DataFrame, carry: list[str]) -> DataFrame:
    """(rule_id, needed, tokens, *carry): which sets (``tokens``) hold which of the
    sets ``needed`` (rule_id, needed), by an index of the rarest token of each."""
    often = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("often"))
    listed = needed.select("rule_id", F.explode("needed").alias("token"))
    rarest = listed.join(often, "token").groupBy("rule_id").agg(F.min(F.struct("often", "token")).alias("rarest"))
    index = materialise(needed.join(rarest, "rule_id").select(F.col("rarest.token").alias("token"), "rule_id", "needed"), "index")
    looked = sets.select("tokens", *carry, F.explode("tokens").alias("token")).join(index, "token")
    return looked.where(F.size(F.array_except("needed", "tokens")) == 0).select("rule_id", "needed", "tokens", *carry)


def blocked_sets(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """The ``tokens`` of ``sets`` that a rule fits, each with its best rule."""
    fits = _held(sets, rules.select("rule_id", F.col("tokens").alias("needed")), [])
    best = fits.join(rules.select("rule_id", "confidence"), "rule_id")
    return best.groupBy("tokens").agg(F.max(F.struct("confidence", "needed")).alias("best"))


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined) of every row of ``pages``.

    ``labels`` has doc_id, quality and toxic; a labelled URL is bad if quality
    is 0 or toxic is 1 (a page is labelled under its id). ``mined`` has the
    tokens of the mined rule that blocks a URL, else null. A URL that nothing
    blocks is allowed; a null url has empty host and path. Repeated rows come
    out repeated; of several labels for a page, a bad one counts. Empty tables
    give an empty result, or no mined rules.
    """
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("tokens", url_tokens(F.col("host"), F.col("path"), F.coalesce("url", F.lit(""))))
    rows = rows.withColumn("given", rule_verdict(F.col("host"), F.col("path"))).drop("url")
    rows = materialise(rows, "urls")
    wrong = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    named = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(F.max(wrong).alias("bad"))
    rules = mine_rules(rows.join(named, "page_id").select("tokens", "bad"))
    open_sets = rows.where("given is null").select("tokens").distinct()
    blocked = materialise(blocked_sets(materialise(open_sets, "sets"), rules), "blocked")
    found = rows.join(blocked.withColumnRenamed("tokens", "set"), F.col("tokens") == F.col("set"), "left")
    verdict = F.coalesce(F.col("given.verdict"), F.when(F.col("best").isNotNull(), "block").otherwise("allow"))
    mined = F.when(F.col("given").isNull(), F.col("best.needed")).alias("mined")
    return found.select("page_id", "host", "path", F.col("given.rule").alias("rule"), verdict.alias("verdict"), mined)
