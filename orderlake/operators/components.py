"""Connected components by iterated min-label propagation with pointer jumping.

Each round sends labels over the edges, keeps the smallest one of every vertex,
and replaces it by that label's own label of the round before (pointer
jumping), so rounds grow with the log of the component diameter in practice.
Rounds go on until no label changes. The label table is written as Parquet below the
session's checkpoint folder (reliable storage named by ``spark.checkpoint.dir``) and read back,
so lineage stays short, a lost executor only recomputes one round, and each round is planned
on the size of its files; a round's files are deleted once the next one stands. Both joins
read stored or freshly shuffled sides, so a label or vertex with most of
the rows can be split by the adaptive skew join.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.session import discard, stored


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """vertices: column ``v``; edges: ``src``, ``dst`` (same type as ``v``).

    Returns (v, label) with label = the smallest vertex of its component.
    """
    log = logging.getLogger(__name__)
    e = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    e = e.filter(F.col("src") != F.col("dst")).distinct()
    e = stored(e, "component-edges")
    labels = before = stored(vertices.select("v").distinct().withColumn("label", F.col("v")), "component-labels")
    none = F.lit(None).cast(vertices.schema["v"].dataType)
    rnd = 0
    while True:
        rnd += 1
        sent = e.join(labels.select(F.col("v").alias("src"), "label"), "src").select(F.col("dst").alias("v"), "label", none.alias("old"))
        least = (labels.withColumn("old", F.col("label")).unionByName(sent)
                 .groupBy("v").agg(F.min("label").alias("label"), F.max("old").alias("old")))
        hop = labels.select(F.col("v").alias("label"), F.col("label").alias("hop"))
        new = stored(least.join(hop, "label", "left")
                     .select("v", F.least("label", F.coalesce("hop", "label")).alias("label"), "old"), "component-labels")
        discard(before)
        before, labels = new, new.select("v", "label")
        if new.filter(F.col("label") != F.col("old")).isEmpty():
            log.info("connected components settled after %d rounds", rnd)
            discard(e)
            return labels
