"""Bronze order documents on storage.

The scan is a parallel read with a declared schema: no inference job, no
driver-side listing loop, no per-file reads in Python. A file may hold one
object or a list of values; unreadable files and values that are not objects
give no row and are never fatal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from orderlake.functions.codec import JSON_OPTIONS, json_objects
from orderlake.schemas import RAW_ORDER

def bronze_scan(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Every order document under ``path`` (recursive), leaves as text.

    ``multi_line=True`` reads one JSON value per file (an object or a list, as
    the listener stores them); ``False`` reads JSON lines. Every object of a list is kept,
    also beside values that are none; a field of another type than the order
    model's is null and the rest of its document stays. Malformed text is skipped.
    """
    text = spark.read.option("wholetext", multi_line).option("recursiveFileLookup", True).text(path)
    objects = text.select(F.explode(json_objects("value")).alias("m"))
    order = [F.col("m").getItem(f.name) if f.dataType == StringType() else F.from_json(F.col("m").getItem(f.name), f.dataType, JSON_OPTIONS)
             for f in RAW_ORDER.fields]
    return objects.select(*[c.alias(f.name) for c, f in zip(order, RAW_ORDER.fields)])


def write_bronze(latest_docs: DataFrame, path: str, fmt: str = "json") -> None:
    """Store the latest document per order (one dataset, overwritten as a whole).

    The ledger listener keeps one object per order; at scale the same state
    is one dataset written in parallel instead of one small file per order.
    ``latest_docs`` must already be one row per ``orderId``.
    """
    latest_docs.write.mode("overwrite").format(fmt).save(path)
