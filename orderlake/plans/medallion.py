"""End-to-end jobs: ledger -> bronze -> silver -> gold -> clustering.

Each job takes a session and paths or namespaces, runs the library operators
and writes tables. Nothing is collected to the driver but row counts and
fitted model summaries.
"""

from __future__ import annotations

import logging

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlake.operators import density, features, gold, hdbscan, ledger, silver
from orderlake.schemas import CLUSTERING_RESULTS
from orderlake.sources import bronze as B
from orderlake.sources import sinks
from orderlake.sources.blocks import read_blocks

log = logging.getLogger(__name__)


def ledger_to_bronze(spark: SparkSession, blocks_path: str, bronze_path: str, chaincode: str = "mycc",
                     multi_line: bool = True) -> dict:
    """Listener: all blocks -> qualifying order writes -> latest per order -> bronze dataset."""
    counted = Observation("order_writes")  # counted while writing: the ledger is read once
    writes = ledger.order_writes(read_blocks(spark, blocks_path, multi_line), chaincode).observe(counted, F.count(F.lit(1)).alias("n"))
    latest = ledger.latest_order_values(writes)
    B.write_bronze(latest.select("value"), bronze_path, fmt="text")
    return {"order_writes": counted.get["n"]}


def bronze_to_silver(spark: SparkSession, bronze_path: str, namespace: str = "silver",
                     multi_line: bool = True, buckets: int | None = None) -> dict:
    """Bronze documents -> silver header and items.

    Both tables are bucketed on ``orderId`` with the same bucket count
    (default: the session's shuffle partitions), so the gold job joins them
    without shuffling either side.
    """
    sinks.ensure_namespace(spark, namespace)
    bronze = B.bronze_scan(spark, bronze_path, multi_line)
    if sinks.is_empty(bronze):
        log.info("no bronze data: stop")
        return {}
    header, items = silver.bronze_to_silver(bronze)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return {
        "orders_header": sinks.replace_table(header, f"{namespace}.orders_header", bucket_by=("orderId", n)),
        "orders_items": sinks.replace_table(items, f"{namespace}.orders_items", bucket_by=("orderId", n)),
    }


def silver_to_gold(spark: SparkSession, silver_ns: str = "silver", gold_ns: str = "gold", as_of=None) -> dict:
    sinks.ensure_namespace(spark, gold_ns)
    header = spark.table(f"{silver_ns}.orders_header")
    items = spark.table(f"{silver_ns}.orders_items")
    out = {}
    if not sinks.is_empty(items):
        # A1 and A2 share one join; keep it while both are written.
        j = gold.items_with_header(items, header).persist(StorageLevel.MEMORY_AND_DISK)
        # The global sort of the query is kept out of the table write (a table has no order).
        pm = gold.product_monthly_joined(j, sort=False).sortWithinPartitions("productId", "year", "month")
        out["product_monthly"] = sinks.replace_table(pm, f"{gold_ns}.product_monthly")
        out["customer_rfm"] = sinks.replace_table(gold.customer_rfm_joined(j, as_of), f"{gold_ns}.customer_rfm")
        j.unpersist()
        out["product_anomaly"] = sinks.replace_table(gold.product_anomaly(items), f"{gold_ns}.product_anomaly")
    else:
        log.info("orders_items empty: skip item-level gold tables")
    out["orders"] = sinks.replace_table(gold.gold_orders(header), f"{gold_ns}.orders")
    return out


def clustering_table(feats: DataFrame, scores: DataFrame, labels: DataFrame) -> DataFrame:
    """The 13 columns of the clustering table, integers without NaN and infinities."""
    j = feats.join(scores, "orderid").join(labels, "orderid")
    cols = []
    for f in CLUSTERING_RESULTS.fields:
        c = F.col({"orderId": "orderid", "approvedByOrg1": "approvedbyorg1"}.get(f.name, f.name))
        if f.dataType.typeName() == "integer":
            c = F.coalesce(features.finite_or_null_col(c), F.lit(0.0)).cast("int")
        cols.append(c.cast(f.dataType).alias(f.name))
    return j.select(*cols)


def wide_table(orders: DataFrame, feats: DataFrame, scores: DataFrame, labels: DataFrame) -> DataFrame:
    """Everything that is known of an order: its dates, the features, the components and the labels."""
    dates = gold.lowercase_columns(orders, ()).select("orderid", "orderdate", "requireddate", "shippeddate")
    return dates.join(feats, "orderid").join(scores, "orderid").join(labels, "orderid")


def hdbscan_clustering(spark: SparkSession, gold_ns: str = "gold", csv_path: str | None = None,
                       min_cluster_size: int = 15, min_samples: int = 8) -> dict:
    """Features -> standardise -> PCA(3) -> HDBSCAN -> gold.hdbscan_results (+ CSV): every column of the gold orders, the
    features, the components, cluster, cluster_probability and outlier_score."""
    g = spark.table(f"{gold_ns}.orders")
    feats, scores, fit = features.order_pca(g, 3)
    labels = hdbscan.hdbscan(scores, "orderid", ["pca1", "pca2", "pca3"], min_cluster_size, min_samples)
    result = wide_table(g, feats, scores, labels.withColumnRenamed("probability", "cluster_probability"))
    n = sinks.replace_table(result, f"{gold_ns}.hdbscan_results")
    if csv_path:
        sinks.export_csv(spark.table(f"{gold_ns}.hdbscan_results"), csv_path)
    return {"hdbscan_results": n, "explained_variance": [float(x) for x in fit.ratios]}


def clustering(spark: SparkSession, gold_ns: str = "gold", csv_path: str | None = None,
               eps: float = 0.9, min_samples: int = 10) -> dict:
    """Features -> standardise -> PCA(3) -> DBSCAN -> gold.clustering_results (13 columns), and a CSV of all columns."""
    g = spark.table(f"{gold_ns}.orders")
    feats, scores, fit = features.order_pca(g, 3)
    labels = density.dbscan(scores, "orderid", ["pca1", "pca2", "pca3"], eps, min_samples)
    result = clustering_table(feats, scores, labels)
    n = sinks.replace_table(result, f"{gold_ns}.clustering_results")
    if csv_path:
        sinks.export_csv(wide_table(g, feats, scores, labels.select("orderid", "cluster")), csv_path)
    return {"clustering_results": n, "explained_variance": [float(x) for x in fit.ratios]}
