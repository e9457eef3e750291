"""Chat formatting in budgeted windows (operator 10).

A conversation is cut at turns into windows of ``BUDGET`` tokens at most. A
turn counts as many tokens as its formatted text has UTF-8 bytes, which no
byte-level vocabulary exceeds, in any script. The cuts come from prefix sums of
the turns' tokens: with a step of the budget less the system turn and the
history, a turn whose tokens lie within one step belongs to that step's window,
and a turn that crosses into another step is a window of its own. Each further
window repeats the system turn and the turns before it that lie within
``HISTORY`` tokens; what is repeated is masked, so every assistant text is a
target once.

History gives way to the system turn (it takes half of what that leaves at
most) and to a long turn. So a window is within the budget unless the system
turn and one other turn exceed it by themselves; turns are never cut.

Output rows: conv_id, window, formatted, and loss as (start, length) pairs of
code points. DataFrame functions only.

Prefix sums go in two levels, over stretches of ``STRETCH`` turn numbers and
within one, so a conversation with very many turns is spread over tasks; only
what belongs to one window is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logsift.llm.common import materialise, text_of

BUDGET = 4096
HISTORY = 1024
STRETCH = 64

TURN, AGAIN, TEXT, END = "<|turn|>", "<|again|>", "<|text|>", "<|end|>"
#: What starts a control string of this or another template, after the first
#: character and any number of backslashes.
TAIL = r"\||/?s>|</?SYS>>|/?INST\]"


def escape(text: Column) -> Column:
    """One backslash more after the first character of each control string."""
    return F.regexp_replace(text, rf"([<\[])(\\*)({TAIL})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({TAIL})", r"$1$2$3")


def _turns(conversations: DataFrame) -> DataFrame:
    """Turns with their number, tokens and the tokens before them."""
    marks = max(len(TURN), len(AGAIN)) + len(TEXT) + len(END)
    size = F.octet_length(escape(text_of())) + F.octet_length(escape(F.coalesce("role", F.lit(""))))
    t = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        text_of().alias("text"),
        (size + marks).cast("long").alias("cost"),
        F.floor(F.col("turn") / STRETCH).alias("stretch"),
    )
    sums = t.groupBy("conv_id", "stretch").agg(F.sum("cost").alias("cost"), F.count("*").alias("count"))
    earlier = Window.partitionBy("conv_id").orderBy(F.col("stretch").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    before = sums.select(
        F.col("conv_id").alias("b_conv"),
        F.col("stretch").alias("b_stretch"),
        zero(F.sum("cost").over(earlier)).alias("b_cost"),
        zero(F.sum("count").over(earlier)).alias("b_count"),
    )
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    own = Window.partitionBy("conv_id", "stretch").orderBy(*order)
    t = t.withColumns(
        {"nr": F.row_number().over(own) - 1, "start": zero(F.sum("cost").over(own.rowsBetween(Window.unboundedPreceding, -1)))}
    )
    on = F.col("conv_id").eqNullSafe(F.col("b_conv")) & F.col("stretch").eqNullSafe(F.col("b_stretch"))
    return t.join(before, on).select(
        "conv_id", (F.col("nr") + F.col("b_count")).alias("nr"), "role", "text", "cost", (F.col("start") + F.col("b_cost")).alias("start")
    )


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, formatted, loss) of all conversations.

    Turns are taken by turn number (null first), those with one number by role
    and text; null roles and texts count as empty; repeated rows are turns of
    their own. A null conv_id is a conversation like any other. The system
    turn is a conversation's first turn if its role is ``system``. An empty
    table gives no window; other columns are ignored.
    """
    turns = materialise(_turns(conversations), "turns")
    system = turns.where("nr = 0 and role = 'system'").select(
        F.col("conv_id").alias("s_conv"), F.col("text").alias("s_text"), F.col("cost").alias("s_cost")
    )
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    t = turns.join(system, same("conv_id", "s_conv"), "left").drop("s_conv")
    lead = F.coalesce("s_cost", F.lit(0))
    t = t.withColumn("start", F.greatest(F.col("start") - lead, F.lit(0)))
    t = t.withColumn("is_system", F.col("s_cost").isNotNull() & (F.col("nr") == 0))
    room = F.greatest(budget - lead, F.lit(0).cast("long"))
    repeat = F.least(F.lit(history).cast("long"), F.floor(room / 2))
    step = F.greatest(room - repeat, F.lit(1).cast("long"))
    t = t.withColumn("room", room).withColumn("repeat", repeat)
    t = t.withColumn("cell", F.when(F.col("is_system"), 0).otherwise(F.floor(F.col("start") / step)))
    crosses = ~F.col("is_system") & (F.floor((F.col("start") + F.col("cost") - 1) / step) > F.col("cell"))
    t = materialise(t.withColumn("window", F.col("cell") * 2 + crosses.cast("int")), "placed")

    member = lambda again, nr: F.struct(F.col(nr).alias("nr"), F.lit(again).alias("again"), "role", "text").alias("m")
    own = t.select("conv_id", "window", member(False, "nr"))
    said = F.sum(F.when(F.col("is_system"), 0).otherwise(F.col("cost")))
    left = F.greatest(F.max("room") - said, F.lit(0).cast("long"))
    heads = t.groupBy("conv_id", "window").agg(
        F.min("start").alias("head"),
        F.max("is_system").alias("has_system"),
        F.max("s_text").alias("s_text"),
        F.least(F.max("repeat"), left).alias("repeat"),
    )
    heads = materialise(heads, "heads")
    led = heads.where("s_text is not null and not has_system").select(
        "conv_id",
        "window",
        F.struct(
            F.lit(-1).cast("long").alias("nr"), F.lit(True).alias("again"), F.lit("system").alias("role"), F.col("s_text").alias("text")
        ).alias("m"),
    )
    # History: a window looks at the two stretches of ``history`` tokens that
    # its last ``history`` tokens before its head lie in.
    at = F.floor(F.col("head") / history)
    looks = heads.where("head > 0").select(
        F.col("conv_id").alias("h_conv"), F.col("window").alias("h_window"), "head", F.col("repeat").alias("h_repeat"), F.explode(F.array(at - 1, at)).alias("h_part")
    )
    past = t.where("not is_system").withColumn("part", F.floor(F.col("start") / history))
    past = past.join(looks, same("conv_id", "h_conv") & (F.col("part") == F.col("h_part")))
    past = past.where((F.col("start") >= F.col("head") - F.col("h_repeat")) & (F.col("start") + F.col("cost") <= F.col("head")))
    past = past.select("conv_id", F.col("h_window").alias("window"), member(True, "nr"))
    grouped = own.unionByName(led).unionByName(past).groupBy("conv_id", "window").agg(F.sort_array(F.collect_list("m")).alias("turns"))

    def lay(state, m):
        role, text = escape(m["role"]), escape(m["text"])
        head = F.concat(F.when(m["again"], AGAIN).otherwise(TURN), role, F.lit(TEXT))
        begin = state["size"] + F.length(head)
        target = ~m["again"] & (m["role"] == "assistant")
        span = F.struct(begin.cast("int").alias("start"), F.length(text).cast("int").alias("length"))
        return F.struct(
            F.concat(state["parts"], F.array(F.concat(head, text, F.lit(END)))).alias("parts"),
            (begin + F.length(text) + len(END)).cast("int").alias("size"),
            F.when(target, F.concat(state["loss"], F.array(span))).otherwise(state["loss"]).alias("loss"),
        )

    start = F.expr(
        "named_struct('parts', cast(array() as array<string>), 'size', 0, 'loss', cast(array() as array<struct<start:int,length:int>>))"
    )
    laid = grouped.withColumn("laid", F.aggregate("turns", start, lay))
    return laid.select("conv_id", "window", F.concat_ws("", "laid.parts").alias("formatted"), F.col("laid.loss").alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, window, turns, targets, size) parsed from formatted windows:
    the turns (role, text) without the repeated ones, the texts under the loss
    mask, and the window's code points."""
    parts = F.filter(F.split("formatted", r"<\|end\|>"), lambda p: p.startswith(TURN))

    def parse(p):
        halves = F.split(F.substr(p, F.lit(len(TURN) + 1)), r"<\|text\|>")
        return F.struct(unescape(halves[0]).alias("role"), unescape(halves[1]).alias("text"))

    target = lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"]))
    return formatted.select(
        "conv_id",
        "window",
        F.transform(parts, parse).alias("turns"),
        F.transform("loss", target).alias("targets"),
        F.length("formatted").alias("size"),
    )


def digests(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars) of each conversation, read back from written windows. A
    digest is over a whole conversation, so its windows meet in one row here."""
    written = materialise(windows(conversations), "windows")
    one = F.struct("window", "turns", "targets", "size").alias("w")
    whole = read_back(written).groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("w"))
    turns, targets = F.flatten(F.col("w.turns")), F.concat_ws("", F.flatten(F.col("w.targets")))
    said = F.concat_ws("", F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return whole.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        sha(said).alias("turns_sha256"),
        F.length(targets).cast("long").alias("loss_chars"),
        sha(targets).alias("loss_sha256"),
        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x["size"]).alias("formatted_chars"),
    )
