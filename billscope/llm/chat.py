"""Chat formatting in budgeted windows, with DataFrame functions only.

A conversation becomes one or more windows of at most ``budget`` tokens, cut between turns. Running sums of the
turns' tokens choose the windows: with ``span`` tokens left beside the system turn and the history, the turns
that lie whole in the same multiple of ``span`` make a window, and a turn that crosses into the next multiple is
one of its own. Every later window repeats the system turn and the turns that fit into the last ``history``
tokens before it. Only assistant turns that aren't repeated are under the loss mask, so each is once.

Only a turn of more than ``span`` tokens makes a window exceed the budget, as turns stay whole, or a system turn
of more than three quarters of the budget less the history; such windows are marked. A turn's tokens are given as a
column, marks included, or taken as the bytes of the written turn: a byte-level vocabulary never needs more, whatever
the script, so no unmarked window is longer than the budget.

Template: ``<s>`` role ``[INST]`` text ``</s>``; ``[/INST]`` in place of ``[INST]`` before a target, ``[CTX]``
after ``<s>`` of a repeated turn. Inside roles and texts a backslash is doubled, and one is put into each control
string, after its first character.

Running sums don't gather a conversation in one task: rows are dealt by range of conversation and turn, summed
within each range, and ranges are summed per conversation.

Order is by turn (null first), then role, then text; equal rows are separate turns. A null role or text is
empty; rows with a null conversation id make one conversation of their own. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billscope.work import materialise

BUDGET, HISTORY = 4096, 512
NO_ID = -(1 << 63)
# The template's control strings.
BEGIN, END, PROMPT, TARGET, REPEATED = "<s>", "</s>", "[INST]", "[/INST]", "[CTX]"
CONTROL = (BEGIN, END, PROMPT, TARGET, REPEATED)
#: Most bytes that the template adds to a turn.
MARKS = len(BEGIN + REPEATED + TARGET + END)


def escape(text: Column) -> Column:
    """Text without control strings, from which ``unescape`` restores it."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        text = F.replace(text, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _turns(chats: DataFrame, tokens: Column | None) -> DataFrame:
    """Turns with their place in the conversation and the tokens before them, system turn at the head aside."""
    written = F.octet_length(escape(F.col("role"))) + F.octet_length(escape(F.col("text"))) + MARKS
    rows = chats.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        (F.lit(None) if tokens is None else tokens).cast("long").alias("given"),
    ).withColumn("tokens", F.greatest(F.coalesce("given", written), F.lit(1)).cast("long"))
    rows = rows.drop("given").withColumn("text_key", F.xxhash64("text"))
    # The row's number keeps many equal rows from being one range.
    dealt = rows.withColumn("row", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange("conv", "turn", "role", "text_key", "row")
    dealt = materialise(dealt.withColumn("part", F.spark_partition_id()), "turns")
    inside = Window.partitionBy("part", "conv").orderBy("turn", "role", "text_key", "text", "row")
    local = inside.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0)
    summed = dealt.select(
        "*",
        F.coalesce(F.sum("tokens").over(local), none).alias("tokens_before"),
        F.coalesce(F.count("*").over(local), none).alias("turns_before"),
    )
    first = F.min(F.struct("turn", "role", "text_key", "text", "row", "tokens"))
    parts = dealt.groupBy("part", "conv").agg(F.sum("tokens").alias("sum"), F.count("*").alias("count"), first.alias("first"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    head = F.first("first").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.select(
        "part",
        "conv",
        F.coalesce(F.sum("sum").over(earlier), none).alias("sum"),
        F.coalesce(F.sum("count").over(earlier), none).alias("count"),
        F.when(head["role"] == "system", head["tokens"]).otherwise(none).alias("system_tokens"),
    )
    place = (F.col("turns_before") + F.col("count")).alias("place")
    whole = summed.join(parts, ["part", "conv"]).select("conv", place, "role", "text", "tokens", "system_tokens", "sum", "tokens_before")
    is_head = (F.col("place") == 0) & (F.col("system_tokens") > 0)
    start = F.when(is_head, none).otherwise(F.col("sum") + F.col("tokens_before") - F.col("system_tokens"))
    size = F.when(is_head, none).otherwise(F.col("tokens"))
    return whole.withColumns({"head": is_head, "start": start, "size": size}).drop("sum", "tokens_before", "tokens")


def _written(repeated: Column) -> Column:
    """A turn by the template, and where its text lies if it is a target."""
    target = ~repeated & (F.col("role") == "assistant")
    role, text = escape(F.col("role")), escape(F.col("text"))
    lead = F.concat(F.lit(BEGIN), F.when(repeated, REPEATED).otherwise(""), role, F.when(target, TARGET).otherwise(PROMPT))
    return F.struct(
        F.col("place"),
        F.concat(lead, text, F.lit(END)).alias("text"),
        F.when(target, F.length(lead)).cast("long").alias("from"),
        F.length(text).cast("long").alias("chars"),
    )


def windows(chats: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: Column | None = None) -> DataFrame:
    """One row per window: conv_id, window (in order), text, loss (ranges of code points), tokens, over_budget."""
    if not 0 <= history <= budget // 4:
        raise ValueError("the history is at most a quarter of the budget")
    turns = _turns(chats, tokens)
    span = F.greatest(F.lit(budget - history) - F.col("system_tokens"), F.lit(budget // 4))
    band = F.floor(F.col("start") / span)
    crosses = (F.col("size") > 0) & (F.floor((F.col("start") + F.col("size") - 1) / span) > band)
    turns = turns.withColumns({"band": band, "window": 2 * band + crosses.cast("long")})
    turns = materialise(turns, "placed")
    own = turns.groupBy("conv", "band", "window").agg(F.min("start").alias("opens"), F.min("place").alias("first_place"))
    # A turn within the history before a window lies in the window's band or in the one before.
    near = turns.where(~F.col("head") & (F.col("size") <= history))
    near = near.withColumn("band", F.explode(F.array("band", F.col("band") + 1)))
    near = near.drop("window").join(own, ["conv", "band"]).where(
        (F.col("place") < F.col("first_place")) & (F.col("opens") - F.col("start") <= history)
    )
    systems = turns.where("head").drop("band", "window").join(own.where("first_place > 0"), "conv")
    no, yes = F.lit(False), F.lit(True)
    size = F.when(F.col("head"), F.col("system_tokens")).otherwise(F.col("size")).alias("size")
    told = turns.select("conv", "window", size, _written(no).alias("turn"))
    told = told.unionByName(near.select("conv", "window", "size", _written(yes).alias("turn")))
    told = told.unionByName(systems.select("conv", "window", F.col("system_tokens").alias("size"), _written(yes).alias("turn")))
    grouped = told.groupBy("conv", "window").agg(
        F.array_sort(F.collect_list("turn")).alias("turns"), F.sum("size").alias("tokens")
    )
    loss = F.aggregate(
        "turns",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("spans")),
        lambda done, turn: F.struct(
            (done["at"] + F.length(turn["text"])).alias("at"),
            F.when(turn["from"].isNull(), done["spans"])
            .otherwise(
                F.concat(
                    done["spans"],
                    F.array(
                        F.struct(
                            (done["at"] + turn["from"]).alias("start"),
                            (done["at"] + turn["from"] + turn["chars"]).alias("end"),
                        )
                    ),
                )
            )
            .alias("spans"),
        ),
    )
    return grouped.select(
        F.nullif("conv", F.lit(NO_ID)).alias("conv_id"),
        "window",
        F.array_join(F.transform("turns", lambda turn: turn["text"]), "").alias("text"),
        loss["spans"].alias("loss"),
        "tokens",
        (F.col("tokens") > budget).alias("over_budget"),
    )


def read_turns(text: Column) -> Column:
    """Turns of a window's text: whether repeated, role, text."""
    pattern = r"(?s)^<s>(\[CTX\])?(.*?)\[/?INST\](.*)$"
    parts = F.split(text, END)

    def turn(part: Column) -> Column:
        def group(number: int) -> Column:
            return F.regexp_extract(part, pattern, number)

        return F.struct(
            (group(1) != "").alias("repeated"), unescape(group(2)).alias("role"), unescape(group(3)).alias("text")
        )

    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def masked_text(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    cut = F.transform(loss, lambda s: unescape(F.substring(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return F.array_join(cut, "")
