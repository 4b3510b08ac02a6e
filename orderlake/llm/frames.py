"""Frame helpers shared by the training-data operators: scratch names, row keys, running sums."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.session import ensure_checkpoint_dir

#: Word and blank characters of the contracts: words are runs of anything but space and \\t \\n \\v \\f \\r.
BLANK_CLASS = r"[\x20\x09-\x0D]+"


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in ``text`` (null: 0), without leaving the JVM."""
    def count(pieces: Column) -> Column:
        blank_ends = F.when(F.element_at(pieces, 1) == "", 1).otherwise(0) + F.when(
            (F.size(pieces) > 1) & (F.element_at(pieces, -1) == ""), 1).otherwise(0)
        return F.size(pieces) - blank_ends

    return F.when(text.isNull(), F.lit(0)).otherwise(let(F.split(text, BLANK_CLASS), count)).cast("long")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names for internal use that clash with none of ``df`` (compared as Spark does, ignoring case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        new = name
        while new.lower() in taken:
            new = "_" + new
        taken.add(new.lower())
        out.append(new)
    return out


def cleared(df: DataFrame, *added: str) -> DataFrame:
    """``df`` without the columns that the result is about to have: those are replaced."""
    return df.drop(*added)


def shield(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all but the columns ``used`` under names that clash with nothing, and how to undo it.

    The undoing returns exactly the columns of ``docs``, in their order.
    """
    names = [c if c in used else f"__kept_{k}" for k, c in enumerate(docs.columns)]

    def restore(df: DataFrame) -> DataFrame:
        return df.select(*names).toDF(*docs.columns)

    return docs.toDF(*names), restore


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, also where ``use`` names it inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def sums_before(lengths: Column) -> Column:
    """For each element of an array the sum of those before it, in about n * sqrt(n) steps."""
    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)

    def in_blocks(ls: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(ls))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(ls) - 1) / width).cast("int")),
                             lambda b: total(F.slice(ls, b * width + 1, width)))
        return let(blocks, lambda bs: let(
            F.transform(bs, lambda _, b: total(F.slice(bs, F.lit(1), b))),
            lambda ahead: F.transform(ls, lambda _, i: F.get(ahead, F.floor(i / width).cast("int")) + total(
                F.slice(ls, (F.floor(i / width) * width).cast("int") + 1, i % width)))))

    # sequence(0, -1) would count down, so no element, no blocks
    return let(lengths, lambda ls: F.when(F.size(ls) > 0, in_blocks(ls)).otherwise(F.array().cast("array<bigint>")))


def row_key(id_col: Column, text: Column) -> tuple[Column, Column]:
    """Two non-null longs that rows share only if they agree in id and text (128 bits together)."""
    return F.xxhash64(text, F.lit(11)), F.xxhash64(F.lit(29), id_col, text)


_SHARED: list[Broadcast] = []


def share(df: DataFrame, value) -> Broadcast:
    """``value`` broadcast, to be dropped from the executors by ``release``."""
    _SHARED.append(df.sparkSession.sparkContext.broadcast(value))
    return _SHARED[-1]


def release() -> None:
    """Drop what ``share`` broadcast so far from the executors. A frame that is still to run fetches its own again."""
    while _SHARED:
        _SHARED.pop().unpersist()


def keep_lineage(df: DataFrame) -> DataFrame:
    """``checkpoint()`` into the shared folder, so that a lost executor never repeats the work above."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def running_sum(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows up to this one in ``order`` (itself included).

    No window over the whole frame: rows are range-partitioned, each partition sums
    its own, and one total per partition gives the offset. Rows equal in all of
    ``order`` get some order among themselves. The partitioned frame is checkpointed,
    so partition numbers stay what they were if an executor is lost.
    """
    part, total, before = fresh(df, "_part", "_total", "_before")
    ranged = keep_lineage(df.repartitionByRange(_partitions(df), *order).withColumn(part, F.spark_partition_id()))
    totals = ranged.groupBy(part).agg(F.sum(value).alias(total))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(part, F.coalesce(F.sum(total).over(earlier), F.lit(0)).alias(before))
    upto = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # One row per partition of the frame: as many rows as tasks, whatever the input.
    return (ranged.join(F.broadcast(offsets), part)
            .withColumn(name, F.col(before) + F.sum(value).over(upto)).drop(part, before))


def latest_before(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """Add ``name``: the largest ``value`` of all rows ahead of this one in ``order``, which no two rows share (null: none)."""
    part, most, before = fresh(df, "_part", "_most", "_before")
    ranged = keep_lineage(df.repartitionByRange(_partitions(df), order).withColumn(part, F.spark_partition_id()))
    totals = ranged.groupBy(part).agg(F.max(value).alias(most))
    ahead = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(part, F.max(most).over(ahead).alias(before))
    own = Window.partitionBy(part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the frame
    return ranged.join(F.broadcast(offsets), part).withColumn(name, F.greatest(before, F.max(value).over(own))).drop(part, before)


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
