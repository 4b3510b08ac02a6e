"""Streaming ingest equals the batch result, whatever the file arrival order."""

import os

from pyspark.sql import functions as F

from orderlake.operators import ledger, silver
from orderlake.sources.blocks import blocks_from_tables, read_blocks
from orderlake.streaming import ingest
from tests.conftest import SF0001


def _write_blocks(spark, d):
    # several JSON-lines files; a high block number lands in an early file and vice versa
    b = blocks_from_tables(spark, SF0001)
    b.orderBy((F.col("header.number").cast("long") * 7919) % 101).repartition(5).write.mode("overwrite").json(d)


def test_stream_equals_batch(spark, scratch):
    blocks = os.path.join(scratch, "blocks")
    _write_blocks(spark, blocks)
    q = ingest.run_ingest(spark, blocks, os.path.join(scratch, "updates"), os.path.join(scratch, "ckpt"),
                          multi_line=False, max_files_per_trigger=1)
    q.awaitTermination(600)
    assert q.exception() is None
    batches = spark.read.parquet(os.path.join(scratch, "updates")).select("batch_id").distinct().count()
    assert batches >= 2
    h_stream, i_stream = ingest.current_silver(spark, os.path.join(scratch, "updates"))
    bl = read_blocks(spark, blocks, multi_line=False)
    state = ledger.latest_order_state(ledger.order_writes(bl)).drop("block_number", "tx_index")
    h_batch, i_batch = silver.bronze_to_silver(state)
    assert h_stream.exceptAll(h_batch).count() == 0 and h_batch.exceptAll(h_stream).count() == 0
    assert i_stream.exceptAll(i_batch).count() == 0 and i_batch.exceptAll(i_stream).count() == 0

    # restart on the same checkpoint: nothing new, nothing duplicated
    q2 = ingest.run_ingest(spark, blocks, os.path.join(scratch, "updates"), os.path.join(scratch, "ckpt"),
                           multi_line=False)
    q2.awaitTermination(600)
    h2, _ = ingest.current_silver(spark, os.path.join(scratch, "updates"))
    assert h2.count() == h_batch.count()


def test_stateful_latest_stream(spark, scratch):
    blocks = os.path.join(scratch, "blocks2")
    _write_blocks(spark, blocks)
    writes = ledger.order_writes(ingest.block_stream(spark, blocks, multi_line=False, max_files_per_trigger=2))
    latest = ingest.latest_order_stream(writes)
    updates = os.path.join(scratch, "latest")
    q = ingest.run_latest(latest, updates, os.path.join(scratch, "ck2"))
    q.awaitTermination(600)
    got = ingest.current_latest(spark, updates, "orderId").select("orderId", "block_number", "tx_index")
    want = ledger.latest_order_values(ledger.order_writes(read_blocks(spark, blocks, multi_line=False))) \
        .select("orderId", "block_number", "tx_index")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
