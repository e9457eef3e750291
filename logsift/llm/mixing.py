"""Mixing sources to target weights by Pfair scheduling (operator 4).

A source's documents form blocks of ``BLOCK_DOCS``. With the weight w = W / T
its j-th block (from 0) is released at slot floor(j / w) and due by slot
ceil((j + 1) / w). One block is laid out a slot: of the released blocks the one
that is due first (of equals, that of the first source by name). As the weights
sum to 1, every block lies inside its window, so after any number of slots
every source has its weight's share of them to within less than one block.

All sources are back in step after T slots, so T slots are worked out and every
further block follows by arithmetic. DataFrame functions only. The default
weights are rounded to 1 / T. Given targets are not: T is so large that the
weights follow them to within ``1 / FINE`` of a block over the whole mix, and
the slots of the mix are worked out. They are in parts of ``PART`` slots, which
do not wait for each other: what earliest deadline first has laid out before a
part follows from the windows that hold its first slot (``_begun``). A part
holds one number for each source beside its own blocks.

The mix goes on until every source has been laid out whole. A source that is
short of its weight starts anew with its first block (``epoch`` counts), so no
document is left out and the weights hold to the end.

Documents get their places in a source from counts of hash ranges, summed up
over ranges, and a sort within each range: a source with a third of all
documents is spread over ``RANGES`` groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsift.llm.common import materialise

BLOCK_DOCS = 16
#: Slots after which the schedule repeats; weights are multiples of 1 / T.
#: With more than 1/20 as many sources, T is 20 times their number.
SLOTS = 1000
#: Slots of T for each slot of the mix, where targets are given.
FINE = 1000
#: Slots of a part. More if the longest window of a block has more slots, or 20
#: times the number of sources is more.
PART = 10_000
#: Events of a part, gone through backwards.
OPEN, SURE, SLOT = 1, 2, 3
#: Events of the schedule whose picks are added to the others at once.
CHUNK = 1000
#: Default target: a source's share of the documents to this power, normalised,
#: which lifts small sources and lowers large ones.
TEMPER = 0.7
#: Hash ranges of a source: 16 to the power of this.
RANGE_DIGITS = 3


def _weights(sizes: DataFrame, targets: DataFrame | None) -> DataFrame:
    """(source, n, b, w, t, idx): blocks b and whole weight w of t, at least 1.
    The default shares out what is left when every source has 1."""
    if targets is None:
        raw = sizes.withColumn("raw", F.pow(F.col("n").cast("double"), F.lit(TEMPER)))
    else:
        named = targets.groupBy(F.col("source").alias("of")).agg(F.max("weight").cast("double").alias("weight"))
        raw = sizes.join(named, F.col("source").eqNullSafe(F.col("of")), "left")
        # A source without a target gets the least weight, 1 / T of the defaults.
        raw = raw.withColumn("raw", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    # One row a source from here on.
    every = Window.partitionBy()
    out = raw.withColumns({"s": F.count("*").over(every), "sum": F.sum("raw").over(Window.partitionBy().orderBy(F.col("source").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    out = out.withColumn("t", F.greatest(F.lit(SLOTS), F.col("s") * 20).cast("int"))
    out = out.withColumn("b", F.ceil(F.col("n") / BLOCK_DOCS)).withColumn("t", F.col("t").cast("long"))
    share = F.when(F.col("sum") > 0, F.col("raw") / F.col("sum")).otherwise(1 / F.col("s"))
    if targets is None:
        out = out.withColumn("least", F.lit(1)).withColumn("ideal", share * (F.col("t") - F.col("s")))
    else:
        none = F.sum((share <= 0).cast("int")).over(every)
        out = out.withColumn("least", F.lit(0))
        out = out.withColumn("share", F.when(share > 0, share * (1 - none / F.col("t"))).otherwise(1 / F.col("t")))
        rounded = F.max(F.abs(F.col("share") * F.col("t") - F.round(F.col("share") * F.col("t")))).over(every) > 1e-9
        fine = F.ceil(F.max(F.col("b") / F.col("share")).over(every) * FINE)
        out = out.withColumn("t", F.when(rounded, F.greatest(F.col("t"), fine)).otherwise(F.col("t")))
        out = out.withColumn("ideal", F.col("share") * F.col("t"))
    # A whole number may come out a little under itself.
    out = out.withColumn("base", F.floor("ideal") if targets is None else F.floor(F.round("ideal", 6)))
    by_rest = Window.partitionBy().orderBy((F.col("base") - F.round("ideal", 9)), F.col("source").asc_nulls_first())
    out = out.withColumns({"rest": F.row_number().over(by_rest), "given": F.sum(F.col("base") + F.col("least")).over(every)})
    extra = (F.col("rest") <= F.col("t") - F.col("given")).cast("int")
    out = out.withColumn("w", (F.col("least") + F.col("base") + extra).cast("long"))
    idx = F.row_number().over(Window.partitionBy().orderBy(F.col("source").asc_nulls_first())) - 1
    return out.select("source", "n", "b", "w", "t", idx.alias("idx"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _product(a: Column, b: Column) -> Column:
    # Blocks times slots pass 64 bits in mixes of some billion documents.
    return a.cast("decimal(19,0)") * b.cast("decimal(19,0)")


def release(j: Column, w: Column, t: Column) -> Column:
    return _div(_product(j, t), w.cast("decimal(19,0)"))


def deadline(j: Column, w: Column, t: Column) -> Column:
    return _div(_product(j + 1, t) + (w - 1).cast("decimal(19,0)"), w.cast("decimal(19,0)"))


def released_before(u: Column, w: Column, t: Column) -> Column:
    """Blocks that are released in a slot before ``u``."""
    return _div(_product(u, w) + (t - 1).cast("decimal(19,0)"), t.cast("decimal(19,0)"))


def _parts(weights: DataFrame) -> DataFrame:
    """The slots to work out, one row a part: first and last slot, t, and the
    array of all sources (idx, w)."""
    one = weights.agg(
        F.sort_array(F.collect_list(F.struct("idx", "w"))).alias("sources"),
        F.max("t").alias("t"),
        F.least(F.max("t"), F.max(deadline(F.col("b") - 1, F.col("w"), F.col("t")))).alias("slots"),
        F.max(deadline(F.lit(0), F.col("w"), F.col("t"))).alias("window"),
    ).where("slots > 0")
    one = one.withColumn("step", F.greatest(F.lit(PART), 20 * F.size("sources"), "window").cast("long"))
    parts = one.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.col("step"))))
    parts = parts.withColumn("last", F.least(F.col("first") + F.col("step"), F.col("slots")) - 1)
    return parts.select("first", "last", "t", "sources").repartition("first")


def _key(due: Column, idx: Column) -> Column:
    """Order of blocks: earliest deadline, then first source, as one number."""
    return due * F.size("sources") + idx


def _begun(parts: DataFrame) -> DataFrame:
    """``parts`` with ``begun``: the keys of the blocks whose windows hold the
    part's first slot and that are laid out before it.

    A source has laid out floor(first * w / t) blocks, and maybe one more, its
    open block. What earliest deadline first lays out in the slots before
    ``first`` is the best set, by its order, that fits there: of the blocks
    released at u or later no more than slots from u on. So time is gone
    through backwards: a slot makes room for one open block, a sure block takes
    it, and when there is more open than room, the last in order goes.
    """
    t, first = F.col("t"), F.col("first")
    none = F.expr("cast(array() as array<bigint>)")

    def sure(s):
        done = _div(_product(first, s["w"]), t.cast("decimal(19,0)"))
        return F.struct(s["idx"].alias("idx"), s["w"].alias("w"), done.alias("done"))

    def event(slot, kind, key):
        # Sorted descending, so within a slot by falling kind.
        return F.struct(slot.alias("slot"), F.lit(kind).alias("kind"), key.cast("long").alias("key"))

    def open_block(s):
        return event(release(s["done"], s["w"], t), OPEN, _key(deadline(s["done"], s["w"], t), s["idx"]))

    rows = parts.withColumn("sure", F.transform("sources", sure))
    rows = rows.withColumn("open", F.filter(F.transform("sure", open_block), lambda o: o["slot"] < first))
    # From the first of their releases on.
    low = F.coalesce(F.array_min(F.transform("open", lambda o: o["slot"])), first)
    # Written, so that nothing of it is worked out again for each event.
    rows = materialise(rows.withColumn("low", low), "low")

    def sure_blocks(s):
        begin = released_before(F.col("low"), s["w"], t)
        some = F.when(begin < s["done"], F.sequence(begin, s["done"] - 1)).otherwise(none)
        return F.transform(some, lambda j: event(release(j, s["w"], t), SURE, F.lit(0)))

    slots = F.when(F.col("low") < first, F.sequence("low", first - 1)).otherwise(none)
    events = F.concat("open", F.flatten(F.transform("sure", sure_blocks)), F.transform(slots, lambda n: event(n, SLOT, F.lit(0))))
    rows = materialise(rows.withColumn("events", F.sort_array(events, asc=False)), "past")

    def step(state, e):
        room = state["room"] + F.when(e["kind"] == SLOT, 1).when(e["kind"] == SURE, -1).otherwise(0)
        more = F.when(e["kind"] == OPEN, F.concat(state["kept"], F.array(e["key"]))).otherwise(state["kept"])
        kept = F.when(F.size(more) > room, F.array_remove(more, F.array_max(more))).otherwise(more)
        return F.struct(kept.alias("kept"), room.alias("room"))

    start = F.struct(none.alias("kept"), F.lit(0).alias("room"))
    # Before the first release of an open block there is room for just the rest.
    rest = first - F.aggregate("sure", F.lit(0).cast("long"), lambda n, s: n + s["done"])
    kept = F.sort_array(F.aggregate("events", start, step)["kept"])
    return rows.withColumn("begun", F.slice(kept, F.lit(1), rest.cast("int"))).drop("events", "open", "low")


def turns(weights: DataFrame) -> DataFrame:
    """(idx, number, turn): the slot ``turn`` of each source's block ``number``
    in the first t slots, or in as many as the mix can have, earliest deadline
    first. Parts of the slots are worked out independently of each other."""
    t, first, last = F.col("t"), F.col("first"), F.col("last")

    def blocks(s):
        # From the block that is open at the first slot to the last one released.
        end = released_before(last + 1, s["w"], t)
        some = F.when(s["done"] < end, F.sequence(s["done"], end - 1)).otherwise(F.expr("cast(array() as array<bigint>)"))
        return F.transform(
            some,
            lambda j: F.struct(
                F.greatest(release(j, s["w"], t), first).alias("slot"),
                F.lit(1).alias("pick"),
                _key(deadline(j, s["w"], t), s["idx"]).alias("key"),
            ),
        )

    rows = materialise(_begun(_parts(weights)).select("first", "last", "t", "sources", "sure", "begun"), "parts")
    # What happens, by slot: blocks are released (1), then one is picked (2).
    released = F.filter(F.flatten(F.transform("sure", blocks)), lambda e: ~F.array_contains("begun", e["key"]))
    picks = F.transform(
        F.sequence(first, last), lambda n: F.struct(n.alias("slot"), F.lit(2).alias("pick"), F.lit(0).cast("long").alias("key"))
    )
    rows = rows.withColumn("events", F.sort_array(F.concat(released, picks)))
    empty = F.expr("cast(array() as array<bigint>)")
    start = F.struct(empty.alias("ready"), empty.alias("picks"), F.expr("cast(array() as array<array<bigint>>)").alias("before"))

    def event(state, e):
        best = F.array_min(state["ready"])
        return F.struct(
            F.when(e["pick"] == 2, F.array_remove(state["ready"], best)).otherwise(F.concat(state["ready"], F.array(e["key"]))).alias("ready"),
            F.when(e["pick"] == 2, F.concat(state["picks"], F.array(best))).otherwise(state["picks"]).alias("picks"),
            state["before"].alias("before"),
        )

    def chunk(state, k):
        def close(s):
            return F.struct(s["ready"].alias("ready"), empty.alias("picks"), F.concat(s["before"], F.array(s["picks"])).alias("before"))

        return F.aggregate(F.slice("events", k, F.lit(CHUNK)), state, event, close)

    chosen = F.flatten(F.aggregate(F.sequence(F.lit(1), F.size("events"), F.lit(CHUNK)), start, chunk)["before"])
    laid = rows.select("first", "t", "sources", F.posexplode(chosen).alias("n", "key"))
    size = F.size("sources").cast("long")
    laid = laid.withColumn("idx", F.pmod("key", size)).withColumn("due", _div(F.col("key"), size))
    of = F.get("sources", F.col("idx").cast("int"))["w"]
    number = _div(_product(F.col("due"), of), t.cast("decimal(19,0)")) - 1
    return laid.select(F.col("idx").cast("int").alias("idx"), number.alias("number"), (first + F.col("n")).alias("turn"))


def schedule(sizes: DataFrame, targets: DataFrame | None = None, epochs: int | None = None) -> tuple[DataFrame, DataFrame]:
    """From (source, n): the plan, each source's blocks b, weight w of t and
    the number j of its blocks that the whole mix lays out; and the ``turns``
    of a period (or of the mix, if that is shorter)."""
    weights = materialise(_weights(sizes, targets), "weights")
    laid = materialise(turns(weights).withColumnRenamed("idx", "t_idx"), "turns")
    at = laid.withColumnRenamed("number", "t_number")
    of_last = (F.col("idx") == F.col("t_idx")) & (F.pmod(F.col("b") - 1, F.col("w")) == F.col("t_number"))
    every = Window.partitionBy()
    ends = F.max(_div(F.col("b") - 1, F.col("w")) * F.col("t") + F.col("turn") + 1).over(every)
    if epochs is not None:
        ends = F.least(ends, F.min(release(F.col("b") * epochs, F.col("w"), F.col("t"))).over(every))
    plan = weights.join(at, of_last).withColumn("slots", ends).drop("t_idx", "t_number", "turn")
    # Blocks in what the end leaves of a period.
    left = plan.select(F.col("idx").alias("l_idx"), F.pmod("slots", "t").alias("rest"))
    left = laid.join(left, F.col("t_idx") == F.col("l_idx")).where("turn < rest").groupBy("l_idx").agg(F.count("*").alias("partly"))
    plan = plan.join(left, F.col("idx") == F.col("l_idx"), "left")
    j = _div(F.col("slots"), F.col("t")) * F.col("w") + F.coalesce("partly", F.lit(0))
    return plan.withColumn("j", j).select("source", "n", "b", "w", "t", "idx", "slots", "j"), at


def _placed(docs: DataFrame, others: list[str]) -> DataFrame:
    """``docs`` with its place (from 0) in its source, by the hash of doc_id."""
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.withColumn("m_order", order).withColumn("m_range", F.substring("m_order", 1, RANGE_DIGITS))
    counts = rows.groupBy("source", "m_range").agg(F.count("*").alias("m_count"))
    earlier = Window.partitionBy("source").orderBy("m_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        F.col("source").alias("m_source"),
        F.col("m_range").alias("m_of"),
        F.coalesce(F.sum("m_count").over(earlier), F.lit(0)).alias("m_before"),
    )
    before = materialise(before, "ranges")
    own = Window.partitionBy("source", "m_range").orderBy("m_order", F.col("doc_id"), *others)
    rows = rows.withColumn("m_number", F.row_number().over(own) - 1)
    on = F.col("source").eqNullSafe(F.col("m_source")) & (F.col("m_range") == F.col("m_of"))
    placed = rows.join(before, on).withColumn("m_place", F.col("m_before") + F.col("m_number"))
    return placed.drop("m_order", "m_range", "m_source", "m_of", "m_before", "m_number")


def mix(docs: DataFrame, targets: DataFrame | None = None, epochs: int | None = None) -> DataFrame:
    """Every row of ``docs`` with its slots in the mix: columns slot, epoch,
    block (of the source), release, deadline and place (within the block), one
    row for each time that it is laid out.

    ``targets`` has (source, weight); default: the sources' sizes tempered.
    A source of b blocks and weight w is laid out up to w * m / b times, where
    m, the slots of the mix, is the largest b / w of all sources: rows grow by
    the factor m * 16 / rows. ``epochs`` bounds that: the mix then ends before
    the first slot in which a source could start its epoch number ``epochs``
    (from 0), and what has had no slot by then is not in the mix.
    Null is a source like any other. Rows with equal or null doc_ids each have
    their own place. An empty table gives an empty mix. Columns of ``docs``
    come through in a struct ``row`` beside the six, so names cannot clash.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source")
    tie = [F.xxhash64(F.col("row")["text"])] if "text" in docs.columns else []
    plan, slots = schedule(docs.groupBy("source").agg(F.count("*").alias("n")), targets, epochs)
    plan = materialise(plan.withColumnRenamed("source", "p_source"), "schedule")
    placed = _placed(rows, tie).join(plan, F.col("source").eqNullSafe(F.col("p_source")))
    own = F.floor(F.col("m_place") / BLOCK_DOCS)
    placed = placed.where(own < F.col("j"))
    laid = placed.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil((F.col("j") - own) / F.col("b")) - 1)))
    number = F.col("epoch") * F.col("b") + own
    laid = laid.join(slots, (F.col("idx") == F.col("t_idx")) & (F.pmod(number, F.col("w")) == F.col("t_number")))
    return laid.select(
        "row",
        (_div(number, F.col("w")) * F.col("t") + F.col("turn")).alias("slot"),
        F.col("epoch").cast("long").alias("epoch"),
        number.cast("long").alias("block"),
        release(number, F.col("w"), F.col("t")).alias("release"),
        deadline(number, F.col("w"), F.col("t")).alias("deadline"),
        F.pmod(F.col("m_place"), F.lit(BLOCK_DOCS)).cast("int").alias("place"),
    )


def mixed(docs: DataFrame, targets: DataFrame | None = None, epochs: int | None = None) -> DataFrame:
    """The mix itself: rows of ``docs`` in the order of their slots, with the
    documents of short sources repeated."""
    laid = mix(docs, targets, epochs).repartitionByRange("slot", "place").sortWithinPartitions("slot", "place")
    return laid.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def positions(docs: DataFrame, targets: DataFrame | None = None, epochs: int | None = None) -> DataFrame:
    """(doc_id, source, slot, epoch, block, release, deadline, place)."""
    laid = mix(docs.select("doc_id", "source"), targets, epochs)
    return laid.select("row.doc_id", "row.source", "slot", "epoch", "block", "release", "deadline", "place")


#: The same in DuckDB SQL over the table documents.
ORACLE_SQL = f"""
WITH RECURSIVE sizes AS (
  SELECT source, count(*) AS n, pow(count(*)::DOUBLE, {TEMPER}) AS raw FROM documents GROUP BY source
), ideal AS (
  SELECT *, count(*) OVER () AS s, greatest({SLOTS}, 20 * count(*) OVER ()) AS t,
         raw / sum(raw) OVER (ORDER BY source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
           * (greatest({SLOTS}, 20 * count(*) OVER ()) - count(*) OVER ()) AS ideal
  FROM sizes
), weights AS MATERIALIZED (
  SELECT source, n, ceil(n / {BLOCK_DOCS})::BIGINT AS b, t::BIGINT AS t,
         (1 + floor(ideal) + (row_number() OVER (ORDER BY floor(ideal) - round(ideal, 9), source NULLS FIRST)
           <= t - s - sum(floor(ideal)) OVER ())::INT)::BIGINT AS w,
         row_number() OVER (ORDER BY source NULLS FIRST) AS idx
  FROM ideal
), lists AS MATERIALIZED (
  SELECT list(w ORDER BY idx) AS ws, max(t) AS t, count(*) AS s FROM weights
), slots AS (
  SELECT 0::BIGINT AS tick, list_transform(ws, lambda x: 0::BIGINT) AS used, NULL::BIGINT AS pick FROM lists
  UNION ALL
  SELECT tick + 1, list_transform(used, lambda u, i: u + (i = p)::BIGINT), p FROM (
    SELECT tick, used, list_min(list_transform(range(1, s + 1), lambda i:
      CASE WHEN used[i] * t // ws[i] <= tick
           THEN ((used[i] + 1) * t + ws[i] - 1) // ws[i] * 1000000 + i END)) % 1000000 AS p, t
    FROM slots, lists WHERE tick < t)
), offsets AS MATERIALIZED (
  SELECT pick AS idx, list(tick - 1 ORDER BY tick) AS offsets FROM slots WHERE pick IS NOT NULL GROUP BY pick
), ends AS (
  SELECT *, max((b - 1) // w * t + offsets[(b - 1) % w + 1] + 1) OVER () AS total
  FROM weights JOIN offsets USING (idx)
), plan AS MATERIALIZED (
  SELECT *, total // t * w + len(list_filter(offsets, lambda o: o < total % t)) AS j FROM ends
), placed AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source
           ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id) - 1 AS place
  FROM documents
), laid AS (
  SELECT doc_id, placed.source AS source, place, w, t, offsets,
         unnest(range(0, (j - place // {BLOCK_DOCS} + b - 1) // b)) AS epoch, b
  FROM placed JOIN plan ON placed.source IS NOT DISTINCT FROM plan.source
), numbered AS (
  SELECT *, epoch * b + place // {BLOCK_DOCS} AS block FROM laid
)
SELECT doc_id, source, (block // w * t + offsets[block % w + 1])::BIGINT AS slot, epoch::BIGINT AS epoch,
       block::BIGINT AS block, (block * t // w)::BIGINT AS release,
       (((block + 1) * t + w - 1) // w)::BIGINT AS deadline, (place % {BLOCK_DOCS})::INTEGER AS place
FROM numbered
"""
