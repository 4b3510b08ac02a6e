"""Chat formatting with perspective rotation.

Every participant of a conversation gets a rendering of it with that speaker as
the assistant, the others as named users and system turns as context, plus the masks: the
code point spans that belong to the assistant's words (and the mark that ends them), which a
trainer computes its loss on.

A conversation of more than ``piece_turns`` turns is rendered in pieces of consecutive turns, each for
all participants of the conversation, also those who are silent in it. A piece opens with the system turn in force: the
last one before it. So no row and no task grows with a conversation; positions of such
turns come from range partitions, not from one task for each conversation.

Defined results: turns go by number (null last), then role, then text; a repeated row is one
turn; a null role speaks as ``unknown``; a null text is an empty turn; rows without a conversation id form
one conversation; a conversation of system turns only has no participant and gives no row.
Marks that occur inside texts or names are broken by a space, so no text can open a turn.
Extra columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.frames import keep_lineage, latest_before, let, running_sum, sums_before

PIECE_TURNS = 256
SYSTEM = "system"
END = "<|end|>"
#: Most long conversations whose ids are broadcast (some 20 bytes each); beyond that the join shuffles.
BROADCAST_IDS = 200_000


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _turns(rows: DataFrame, *keys: str) -> DataFrame:
    # a set, so rows that repeat are one before the shuffle
    return rows.groupBy("conv", *keys).agg(
        F.sort_array(F.collect_set(F.struct(F.col("turn").isNull().alias("no_turn"), "turn", "role", "text"))).alias("turns"))


def _views(rows: DataFrame, piece_turns: int) -> DataFrame:
    """(conv, piece, participant, turns, before): the sorted turns of each piece for each participant, and the system turn in
    force before it (null: none)."""
    counted = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > piece_turns)
    long_ids = keep_lineage(counted.select(F.col("conv").alias("long_conv")))
    known = F.broadcast(long_ids) if long_ids.count() <= BROADCAST_IDS else long_ids
    same = F.col("conv").eqNullSafe(F.col("long_conv"))
    short = _turns(rows.join(known, same, "left_anti"))
    speakers = F.array_distinct(F.transform("turns", lambda t: t["role"]))
    short = short.select("conv", F.lit(0).cast("long").alias("piece"), F.explode(F.filter(speakers, lambda r: r != SYSTEM)).alias("participant"),
                         "turns", F.lit(None).cast("string").alias("before"))
    order = [F.col("conv").asc_nulls_last(), F.col("turn").asc_nulls_last(), F.col("role"), F.col("text")]
    placed = running_sum(rows.join(known, same, "left_semi").distinct().withColumn("one", F.lit(1)), order, "one", "at")
    first = placed.groupBy("conv").agg(F.min("at").alias("first")).withColumnRenamed("conv", "c")
    placed = placed.join(first, F.col("conv").eqNullSafe(F.col("c"))).withColumn(
        "piece", F.floor((F.col("at") - F.col("first")) / piece_turns))
    placed = keep_lineage(placed.select("conv", "turn", "role", "text", "piece", "at", "first"))
    is_system = F.col("role") == SYSTEM
    # of each piece the place and text of its last system turn, then for each the last place before it
    last = placed.groupBy("conv", "piece", "first").agg(F.min("at").alias("from"), F.max(F.when(is_system, F.col("at"))).alias("sat"),
                                                        F.max_by("text", F.when(is_system, F.col("at"))).alias("said"))
    force = latest_before(last, "from", "sat", "held")
    texts = last.where("sat is not null").select(F.col("sat").alias("held"), F.col("said").alias("before"))
    force = force.withColumn("held", F.when(F.col("held") >= F.col("first"), F.col("held"))).join(texts, "held", "left")
    force = force.select(F.col("conv").alias("c"), F.col("piece").alias("p"), "before")
    who = placed.where(~is_system).select(F.col("conv").alias("c"), F.col("role").alias("participant")).distinct()
    long = _turns(placed, "piece").join(force, F.col("conv").eqNullSafe(F.col("c")) & (F.col("piece") == F.col("p"))).drop("c", "p")
    long = long.join(who, F.col("conv").eqNullSafe(F.col("c"))).select("conv", "piece", "participant", "turns", "before")
    return short.unionByName(long)


def rotate(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           piece_turns: int = PIECE_TURNS) -> DataFrame:
    """One row per conversation piece and participant: conv_id, piece, participant, n_turns (of the piece), n_own, rendered and
    masks (array of start and end)."""
    rows = turns.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("unknown")).alias("role"),
                        F.coalesce(text, F.lit("")).alias("text"))
    views = _views(rows, piece_turns)
    carried = F.transform("turns", lambda t: F.struct(t["no_turn"].alias("no_turn"), t["turn"].alias("turn"), F.lit(SYSTEM).alias("role"), F.col("before").alias("text")))
    views = views.withColumn("shown", F.when(F.col("before").isNull(), F.col("turns")).otherwise(F.concat(F.slice(carried, 1, 1), F.col("turns"))))

    def head(t: Column) -> Column:
        return F.when(t["role"] == F.col("participant"), F.lit("<|assistant|>\n")).when(
            t["role"] == SYSTEM, F.lit("<|system|>\n")).otherwise(F.concat(F.lit("<|user name="), _plain(t["role"]), F.lit("|>\n")))

    parts = F.transform("shown", lambda t: F.struct(
        (t["role"] == F.col("participant")).alias("own"), head(t).alias("head"), F.concat(_plain(t["text"]), F.lit(END)).alias("body")))

    def spans(ps: Column) -> Column:
        sizes = F.transform(ps, lambda p: (F.length(p["head"]) + F.length(p["body"]) + 1).cast("long"))
        return let(sums_before(sizes), lambda ahead: F.transform(F.filter(
            F.transform(ps, lambda p, i: F.struct(p["own"].alias("own"), (ahead[i] + F.length(p["head"])).alias("start"),
                                                  (ahead[i] + F.length(p["head"]) + F.length(p["body"])).alias("end"))),
            lambda s: s["own"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    done = let(parts, lambda ps: F.struct(
        F.array_join(F.transform(ps, lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("rendered"), spans(ps).alias("masks")))
    return views.withColumn("done", done).select(
        F.col("conv").alias(conv_id), "piece", "participant", F.size("turns").cast("long").alias("n_turns"),
        F.size("done.masks").cast("long").alias("n_own"), "done.rendered", "done.masks")
