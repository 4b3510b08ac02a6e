"""End-to-end jobs and the ledger round trip."""

import os

from pyspark.sql import functions as F

from orderlake.operators import nest, silver
from orderlake.plans import medallion
from orderlake.sources import sinks
from orderlake.sources.blocks import blocks_from_tables
from orderlake.sources.bronze import bronze_scan
from orderlake.sources.csv import read_order_details_csv, read_orders_csv
from orderlake.sources.tables import bronze_documents, bulk_load_frames
from tests.conftest import SF0001


def test_ledger_round_trip_equals_direct_silver(spark, scratch):
    """orders -> blocks (JSON files) -> listener job -> bronze -> silver == silver built directly."""
    blocks_dir = os.path.join(scratch, "blocks")
    blocks_from_tables(spark, SF0001).write.mode("overwrite").json(blocks_dir)
    bronze_dir = os.path.join(scratch, "bronze")
    stats = medallion.ledger_to_bronze(spark, blocks_dir, bronze_dir, multi_line=False)
    assert stats["order_writes"] > 0
    via_ledger = silver.orders_header(bronze_scan(spark, bronze_dir, multi_line=False))
    direct = silver.orders_header(bronze_documents(spark, SF0001))
    assert via_ledger.exceptAll(direct).count() == 0
    assert direct.exceptAll(via_ledger).count() == 0


def test_jobs_write_tables(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS t_silver LOCATION '{scratch}/wh_silver'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS t_gold LOCATION '{scratch}/wh_gold'")
    bronze_dir = os.path.join(scratch, "bronze_docs")
    bronze_documents(spark, SF0001).write.mode("overwrite").json(bronze_dir)
    c1 = medallion.bronze_to_silver(spark, bronze_dir, "t_silver", multi_line=False)
    assert c1["orders_header"] == spark.table("t_silver.orders_header").count() > 0
    assert c1["orders_items"] == spark.table("t_silver.orders_items").count() > 0
    # silver tables are bucketed alike on orderId: the gold join shuffles neither side
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from orderlake.operators import gold as G
        j = G.items_with_header(spark.table("t_silver.orders_items"), spark.table("t_silver.orders_header"))
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    c2 = medallion.silver_to_gold(spark, "t_silver", "t_gold", as_of="2002-01-01")
    assert set(c2) == {"product_monthly", "customer_rfm", "product_anomaly", "orders"}
    names = {r.tableName for r in sinks.list_tables(spark, "t_gold").collect()}
    assert {"product_monthly", "customer_rfm", "product_anomaly", "orders"} <= names
    c3 = medallion.clustering(spark, "t_gold", os.path.join(scratch, "csv"))
    assert c3["clustering_results"] == c2["orders"]
    res = spark.table("t_gold.clustering_results")
    assert res.columns[0] == "orderId" and len(res.columns) == 13
    back = spark.read.option("header", True).csv(os.path.join(scratch, "csv"))
    assert back.count() == c2["orders"] and {"orderdate", "freight", "pca3", "cluster"} <= set(back.columns)
    c4 = medallion.hdbscan_clustering(spark, "t_gold", os.path.join(scratch, "csv_h"))
    assert c4["hdbscan_results"] == c2["orders"]
    back = spark.read.option("header", True).csv(os.path.join(scratch, "csv_h"))
    assert back.count() == c2["orders"] and {"orderdate", "pca1", "cluster", "cluster_probability", "outlier_score"} <= set(back.columns)


def test_csv_nesting(spark, scratch):
    o, d = bulk_load_frames(spark, SF0001)
    o.withColumn("orderID", F.concat(F.lit("  "), "orderID")).write.option("header", True).csv(f"{scratch}/o")
    orphan = spark.createDataFrame([("no-such-order", "p1", 1.0, 2, 0.0)], d.schema)
    d.unionByName(orphan).write.option("header", True).csv(f"{scratch}/d")
    oc, dc = read_orders_csv(spark, f"{scratch}/o"), read_order_details_csv(spark, f"{scratch}/d")
    n = nest.nest_orders(oc, dc)
    assert n.count() == o.count()  # padded ids are trimmed on the orders side
    lines = n.select(F.sum(F.size("orderDetails.items"))).first()[0]
    assert lines == d.count()  # the orphan line is dropped
    empty = n.filter(F.size("orderDetails.items") == 0).select("orderDetails.total").distinct().collect()
    assert all(r.total == 0.0 for r in empty)


def test_cli_runs_jobs(spark, scratch):
    from orderlake.plans import cli
    bronze_dir = os.path.join(scratch, "bronze_cli")
    bronze_documents(spark, SF0001).write.mode("overwrite").json(bronze_dir)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS c_silver LOCATION '{scratch}/c_silver'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS c_gold LOCATION '{scratch}/c_gold'")
    cli.main(["bronze-to-silver", "--bronze", bronze_dir, "--namespace", "c_silver", "--json-lines"])
    cli.main(["silver-to-gold", "--silver", "c_silver", "--gold", "c_gold", "--as-of", "2002-01-01"])
    assert spark.table("c_gold.customer_rfm").count() > 0
