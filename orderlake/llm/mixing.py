"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled (by a seeded hash of their id, so reruns
agree), repeated while its target asks for it, and given a virtual finish time:
cumulative words of the source divided by its target. All copies are then
range-sorted by finish time and the mix is cut where the total budget is spent,
so every source stands near its target wherever the cut falls.

Running totals come from range partitions plus one offset per partition
(``frames.running_sum``): a source with most of the rows is spread over many
tasks and no task sees a whole source.

Targets: sources in code point order (null last) weigh ``weights`` in turn and share
``budget_share`` times all sizes; a target stops at ``max_epochs`` times its source's
size and what is over is shared again by weight until none is above.

Defined results: null or blank texts have size 0 and are never needed for a target
(they count as taken with 0 words); documents without a source form a source of
their own; rows that repeat are separate documents; rows that agree in id, source and
text may swap places, which changes no total. An empty table gives an empty mix.
Extra columns pass through; a column named like a result column is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.frames import fresh, keep_lineage, cleared, running_sum

WEIGHTS = (5, 2, 1)
BUDGET_SHARE = 1.5
MAX_EPOCHS = 2
SEED = 17
#: Most source rows to broadcast (some 100 bytes each); beyond that the join shuffles.
BROADCAST_SOURCES = 50_000


def targets(sized: DataFrame, *, source: str, size: str, weights: tuple = WEIGHTS, budget_share: float = BUDGET_SHARE,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, no_source, source_rank (from 0), weight, source_size, target (double)."""
    totals = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    totals = totals.withColumns({"no_source": F.col("source").isNull(), "one": F.lit(1)})
    ranked = running_sum(totals, [F.col("no_source"), F.col("source")], "one", "rank")
    turn = F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1
    ranked = keep_lineage(ranked.select(
        "source", "no_source", (F.col("rank") - 1).alias("source_rank"), "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int")).alias("weight"),
        (F.col("source_size") * F.lit(float(max_epochs))).alias("most")))
    # Water level: words per unit of weight. A source whose cap lies below it is full; each round
    # shares what the full ones leave, so the level only rises and ends after a few rounds.
    budget = ranked.agg(F.sum("source_size").alias("s")).first()["s"]
    level, full = 0.0, -1
    while budget:
        is_full = F.col("most") <= F.lit(level) * F.col("weight")
        state = ranked.agg(F.sum(F.when(is_full, F.col("most")).otherwise(0.0)).alias("used"),
                           F.sum(F.when(is_full, 0.0).otherwise(F.col("weight"))).alias("open"),
                           F.sum(is_full.cast("long")).alias("full")).first()
        if state["full"] == full or not state["open"]:
            break
        full, level = state["full"], (budget_share * budget - state["used"]) / state["open"]
    return ranked.withColumn("target", F.least(F.col("most"), F.lit(level) * F.col("weight"))).drop("most")


def mix(docs: DataFrame, *, size: str, doc_id: str = "doc_id", source: str = "source", weights: tuple = WEIGHTS,
        budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED, text: str | None = None) -> DataFrame:
    """``docs`` plus source_size, target, copies (long) and taken (copies times size).

    ``size`` names a long column. ``text``, if given, separates documents of equal id, source and size.
    """
    docs = cleared(docs, "source_size", "target", "copies", "taken")
    rid, g = fresh(docs, "_rid", "_g")
    rows = keep_lineage(docs.withColumn(rid, F.monotonically_increasing_id()))
    tie = F.xxhash64(text) if text else F.lit(0).cast("long")
    sized = rows.select(F.col(rid).alias("rid"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                        F.coalesce(F.col(size), F.lit(0)).cast("long").alias("size"), tie.alias("tie"))
    goals = targets(sized, source="source", size="size", weights=weights, budget_share=budget_share, max_epochs=max_epochs)
    copies = schedule(sized, goals, max_epochs=max_epochs, seed=seed)
    count = copies.groupBy("rid").agg(F.count(F.lit(1)).alias("copies")).select(F.col("rid").alias(rid), "copies")
    goal = _small(goals.select(F.col("source").alias(g), "source_size", "target"))
    out = rows.join(count, rid, "left").drop(rid)
    out = out.join(goal, out[source].eqNullSafe(goal[g]), "left").drop(g)
    copies_or_0 = F.coalesce("copies", F.lit(0)).cast("long")
    return out.withColumns({"copies": copies_or_0, "taken": copies_or_0 * F.coalesce(F.col(size), F.lit(0)).cast("long")})


def _small(goals: DataFrame) -> DataFrame:
    """One row per source: broadcast when there are few enough, left to the planner otherwise."""
    return F.broadcast(goals) if goals.count() <= BROADCAST_SOURCES else goals


def schedule(sized: DataFrame, goals: DataFrame, *, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mix in order: rid, epoch, finish (virtual time) and spent (words up to and with this copy)."""
    goal = _small(goals.select(F.col("source").alias("g"), "source_rank", "source_size", "target"))
    joined = sized.join(goal, sized["source"].eqNullSafe(goal["g"]))
    epochs = F.when(F.col("target") > F.col("source_size"), F.sequence(F.lit(0), F.lit(max_epochs - 1))).otherwise(F.array(F.lit(0)))
    queue = joined.withColumn("epoch", F.explode(epochs)).withColumn(
        "draw", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    queue = queue.select("rid", "source_rank", "epoch", "draw", "doc_id", "size", "tie", "target")
    # the row's number comes last, so that rows equal in all else (null ids, say) are not one key of a range
    shuffled = ["source_rank", "epoch", "draw", "doc_id", "size", "tie", "rid"]
    summed = running_sum(queue, [F.col(c) for c in shuffled], "size", "sum_all")
    # words of all sources before this one in rank order: a source's own running total starts there
    ahead = running_sum(
        goals.withColumn("queued", F.when(F.col("target") > F.col("source_size"), F.lit(max_epochs)).otherwise(1) * F.col("source_size")),
        [F.col("source_rank")], "queued", "upto").select(F.col("source_rank").alias("sr"), (F.col("upto") - F.col("queued")).alias("ahead"))
    ahead = _small(ahead)
    timed = summed.join(ahead, summed["source_rank"] == ahead["sr"]).withColumn(
        "finish", F.when(F.col("target") > 0, (F.col("sum_all") - F.col("ahead")).cast("double") / F.col("target")).otherwise(0.0))
    timed = timed.select("finish", *shuffled)
    spent = running_sum(timed, [F.col("finish"), *[F.col(c) for c in shuffled]], "size", "spent")
    budget = goals.agg(F.sum("target").alias("budget"))
    # one number; whole words, rounded so that float error in the targets costs no document
    limit = F.lit(round(float(budget.first()["budget"] or 0.0), 3))
    return spent.where(F.col("spent") <= limit).select("rid", "epoch", "finish", "spent")
