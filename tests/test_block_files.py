"""Block files: packed, and made from typed fields that are spelled out as envelopes inside the block only."""

import datetime as dt
import os

from orderlake.operators import ledger
from orderlake.sources import tables
from orderlake.sources.blocks import blocks_from_tables, ledger_blocks, ledger_blocks_path


def _tables(spark, d):
    day = dt.datetime(1997, 3, 1)
    spark.createDataFrame([(k, k % 7, "O" if k % 3 == 0 else "F", 1000.0 + k, day) for k in range(300)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz") \
         .write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(k, n, 60 + k * 3 + n, float(n + 1), 10.0 * (k + 1) / 3, 0.05) for k in range(300) for n in range(k % 5)],
                          "l_orderkey long, l_linenumber long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double") \
         .write.parquet(f"{d}/lineitem.parquet")


def test_block_files_take_a_part_of_their_text(spark, scratch):
    _tables(spark, scratch)
    path = ledger_blocks_path(spark, scratch).removeprefix("file:")
    stored = sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.startswith("part-"))
    text = sum(len(r[0]) for r in blocks_from_tables(spark, scratch).toJSON().map(lambda j: (j,)).collect())
    assert stored < text / 3
    writes = ledger.order_writes(ledger_blocks(spark, scratch))
    assert writes.count() == 300 + 200
    assert {r["value"].count('"productId"') for r in writes.where("orderId = '4'").collect()} == {0, 4}


def test_envelopes_do_not_travel_between_tasks(spark, scratch):
    _tables(spark, scratch)
    plan = blocks_from_tables(spark, scratch)._jdf.queryExecution().executedPlan().toString()
    to_blocks = plan[plan.index("Exchange hashpartitioning(block"):]
    assert "payload" not in to_blocks and "sha2(" not in to_blocks and "base64(" not in to_blocks


def test_orders_and_lines_go_to_their_blocks_in_one_shuffle(spark, scratch):
    """Lines used to meet their orders first; then the documents went to the blocks. Repeated and missing keys keep their blocks."""
    _tables(spark, scratch)
    blocks = blocks_from_tables(spark, scratch)
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "Join" not in plan
    orders, lines = (spark.read.parquet(f"{scratch}/{t}.parquet") for t in ("orders", "lineitem"))
    twice = orders.where("o_orderkey = 4").selectExpr("o_orderkey", "o_custkey + 1 as o_custkey", *orders.columns[2:])
    null = orders.where("o_orderkey = 7").selectExpr("cast(null as long) as o_orderkey", *orders.columns[1:])
    d = f"{scratch}/odd"
    orders.unionByName(twice).unionByName(null).write.parquet(f"{d}/orders.parquet")
    lines.unionByName(lines.limit(3).selectExpr("cast(null as long) as l_orderkey", *lines.columns[1:])).write.parquet(f"{d}/lineitem.parquet")
    state = ledger.order_writes(blocks_from_tables(spark, d)).where("orderId = '4' and value like '%OrderDetail%'").collect()
    assert [(r["block_number"], r["value"].count('"productId"')) for r in state] == [(4, 4), (4, 4)]
    counts = {r["block_number"]: r["tx_count"] for r in ledger.block_summary(blocks_from_tables(spark, d)).collect()}
    assert counts[None] == 2 and counts[1] == 5 + 1 and counts[0] == 1 and len(counts) == len(blocks.collect()) + 1


def test_parts_follow_the_rows(spark, monkeypatch):
    """However few parts the session shuffles to, a task groups a bounded number of rows."""
    monkeypatch.setattr(tables, "ROWS_A_TASK", 10)
    few = spark.range(30)
    assert tables.dealt(few, 300, "id").rdd.getNumPartitions() == 30
    assert "REPARTITION_BY_COL" in tables.dealt(few, 30, "id")._jdf.queryExecution().executedPlan().toString()
