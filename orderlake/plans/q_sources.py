"""Registered queries for sources and sinks.

Each writes data Spark derives from the tables into a fresh folder under the
shared checkpoint folder, then reads it back through the real scanner, so
the result can be checked against the same oracle as the direct query.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlake.functions import try_int
from orderlake.operators import gold, ledger, nest, silver
from orderlake.plans.q_ledger import _TX
from orderlake.plans.q_medallion import _NEST_SQL, bronze
from orderlake.plans.registry import register
from orderlake.plans.sql_fragments import ITEMS, RAW_ITEMS, SILVER_HEADER, with_views
from orderlake.session import scratch_path
from orderlake.sources import sinks
from orderlake.sources.blocks import blocks_from_tables, ledger_blocks, ledger_blocks_path, read_blocks, write_blocks
from orderlake.sources.bronze import bronze_scan
from orderlake.sources.csv import read_order_details_csv, read_orders_csv
from orderlake.sources.tables import bulk_load_frames


@register("bronze_scan", with_views(
    """SELECT h.*, coalesce(n.n_items, 0) AS n_items, coalesce(n.units, 0) AS units FROM h
       LEFT JOIN (SELECT orderId, cast(count(*) AS integer) AS n_items, cast(sum(quantity) AS bigint) AS units FROM r GROUP BY orderId) n
       USING (orderId)""", h=SILVER_HEADER, r=RAW_ITEMS))
def q_bronze_scan(spark, sf):
    """Documents stored as JSON, scanned back with the bronze schema, header and items parsed."""
    path = scratch_path(spark, "bronze")
    bronze(spark, sf).write.mode("overwrite").json(path)
    docs = bronze_scan(spark, path, multi_line=False)
    units = F.aggregate("OrderDetail.items", F.lit(0).cast("bigint"), lambda a, x: a + try_int(x["quantity"]))
    typed = docs.select("*", F.size("OrderDetail.items").alias("n_items"), units.alias("units"))
    return silver.orders_header(typed, "n_items", "units")


@register("block_scan", with_views(
    """SELECT cast(block AS bigint) AS block_number, cast(count(*) AS integer) AS tx_count,
              cast(sum(CASE kind WHEN 'config' THEN 0 WHEN 'create' THEN 2
                       ELSE 1 + CASE WHEN k % 13 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 17 = 0 THEN 1 ELSE 0 END END) AS bigint) AS n_writes,
              cast(count(orderId) AS bigint) AS n_commands
       FROM tx GROUP BY block""", tx=_TX))
def q_block_scan(spark, sf):
    """S3: generated blocks stored as JSON and scanned back with the block schema."""
    path = scratch_path(spark, "blocks")
    write_blocks(blocks_from_tables(spark, sf), path)
    blocks = read_blocks(spark, path, multi_line=False)
    counts = ledger.block_summary(blocks).select("block_number", "tx_count")
    writes = ledger.tx_rwset(blocks).groupBy("block_number").agg(F.count(F.lit(1)).alias("n_writes"))
    commands = ledger.block_transactions(blocks).where("function != ''").groupBy("block_number").agg(F.count(F.lit(1)).alias("n_commands"))
    return counts.join(writes, "block_number", "left").join(commands, "block_number", "left").na.fill(0, ["n_writes", "n_commands"])


@register("csv_orders_scan", _NEST_SQL)
def q_csv_orders_scan(spark, sf):
    """S4 + S8: bulk-load CSVs exported with a header, scanned back (ids as text), nested."""
    o, d = bulk_load_frames(spark, sf)
    po, pd_ = scratch_path(spark, "orders_csv"), scratch_path(spark, "details_csv")
    sinks.export_csv(o, po)
    sinks.export_csv(d, pd_)
    n = nest.nest_orders(read_orders_csv(spark, po), read_order_details_csv(spark, pd_))
    return n.select("orderId", "customerId",
                    F.size("orderDetails.items").cast("bigint").alias("n_items"),
                    F.aggregate("orderDetails.items", F.lit(0).cast("bigint"),
                                lambda acc, x: acc + x["quantity"]).alias("units"))


@register("table_replace", with_views(
    """SELECT orderId, orderDate, requiredDate, shippedDate, freight, approvedByOrg1,
              freight AS total_amount, freight AS avg_price, 1 AS num_items FROM h""", h=SILVER_HEADER))
def q_table_replace(spark, sf):
    """S6 + S9 + S10: gold orders written as a managed table (replaced on rerun) and read back."""
    # a namespace of its own for each call: a lazy result keeps its table
    location = scratch_path(spark, "warehouse")
    ns = "orderlake_q_gold_" + location.rsplit("-", 1)[-1]
    spark.sql(f"CREATE NAMESPACE {ns} LOCATION '{location}'")
    h = silver.orders_header(bronze(spark, sf))
    sinks.replace_table(gold.gold_orders(h), f"{ns}.orders")
    if sinks.list_tables(spark, ns).filter(F.col("tableName") == "orders").isEmpty():
        raise RuntimeError(f"table {ns}.orders missing after replace")
    return spark.table(f"{ns}.orders")


# ---------------------------------------------------------------- streaming
#: Triggers in which the files of a stream arrive.
STREAM_TRIGGERS = 4


def block_files_per_trigger(spark, sf) -> int:
    from orderlake.streaming import ingest

    return ingest.files_per_trigger(len(ledger_blocks(spark, sf).inputFiles()), STREAM_TRIGGERS)


@register("stream_latest_orders", with_views(
    """SELECT orderId, cast(block AS bigint) AS block_number, tx_index
       FROM tx WHERE kind <> 'config'
       QUALIFY row_number() OVER (PARTITION BY orderId ORDER BY block DESC, pos DESC) = 1""", tx=_TX))
def q_stream_latest_orders(spark, sf):
    """T1 + T2: block files streamed (several triggers), stateful latest write per order.

    The result names ledger positions, so state and log hold these: no document is read out of them, and the planner cannot see that through the state.
    """
    from orderlake.streaming import ingest

    blocks = ledger_blocks_path(spark, sf)
    writes = ledger.order_writes(ingest.block_stream(spark, blocks, multi_line=False, max_files_per_trigger=block_files_per_trigger(spark, sf)))
    writes = writes.select("orderId", *ledger.ORDER_KEY_COLS)
    updates = scratch_path(spark, "latest_orders")
    q = ingest.run_latest(ingest.latest_order_stream(writes), updates, scratch_path(spark, "stream_ckpt"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return ingest.current_latest(spark, updates, "orderId").select("orderId", "block_number", "tx_index")


@register("stream_silver_header", with_views(
    """SELECT orderId, customerIdHash, employee, orderDate, requiredDate, shippedDate, shipperID, freight,
              status, approvedByOrg1 FROM h""", h=SILVER_HEADER))
def q_stream_silver_header(spark, sf):
    """Blocks -> foreachBatch update log -> compacted state -> silver header."""
    from orderlake.streaming import ingest

    blocks = ledger_blocks_path(spark, sf)
    updates = scratch_path(spark, "stream_updates")
    q = ingest.run_ingest(spark, blocks, updates, scratch_path(spark, "stream_ckpt"),
                          multi_line=False, max_files_per_trigger=block_files_per_trigger(spark, sf))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    header, _ = ingest.current_silver(spark, updates)
    return header


@register("stream_silver_items", with_views(
    """SELECT i.orderId, productId, quantity, unitPrice, discount, price, totalPrice FROM i
       JOIN (SELECT cast(o_orderkey AS varchar) AS orderId FROM orders WHERE o_orderstatus <> 'O') p USING (orderId)""", i=ITEMS))
def q_stream_silver_items(spark, sf):
    """The items of the streamed state; orders that were only created have none."""
    from orderlake.streaming import ingest

    updates = scratch_path(spark, "stream_updates")
    q = ingest.run_ingest(spark, ledger_blocks_path(spark, sf), updates, scratch_path(spark, "stream_ckpt"),
                          multi_line=False, max_files_per_trigger=block_files_per_trigger(spark, sf))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return ingest.current_silver(spark, updates)[1]


@register("stream_latest_event_per_user", """
SELECT user_id, event_id, ts, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_stream_latest_event_per_user(spark, sf):
    """T2 on the events stream: event files arrive over several triggers; running latest per user."""
    from orderlake.sources.tables import read_table
    from orderlake.streaming import ingest

    ev = read_table(spark, sf, "events")
    src = scratch_path(spark, "events_stream")
    ev.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).write.mode("overwrite").parquet(src)
    files = len(spark.read.parquet(src).inputFiles())
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", ingest.files_per_trigger(files, STREAM_TRIGGERS)).parquet(src)
    latest = ledger.latest_per_key(stream, "user_id", ["ts", "event_id"])
    updates = scratch_path(spark, "latest_events")
    q = ingest.run_latest(latest, updates, scratch_path(spark, "events_ckpt"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return ingest.current_latest(spark, updates, "user_id").select("user_id", "event_id", "ts", "event_type", "value", "props")
