"""Streams of the latest write keep positions in a store on disk."""

import datetime as dt

from orderlake.operators import ledger
from orderlake.plans import registry
from orderlake.streaming import ingest

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _tables(spark, folder):
    day = dt.datetime(1997, 3, 1)
    spark.createDataFrame([(k, 4, "F" if k % 2 else "O", 10.0, day) for k in range(1, 30)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz") \
         .write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(k, 1, 100 + k, 2.0, 8.0, 0.0) for k in range(1, 30)],
                          "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, l_discount double") \
         .write.parquet(f"{folder}/lineitem.parquet")


def test_state_and_log_hold_positions(spark, scratch, monkeypatch):
    _tables(spark, scratch)
    seen, run, fold = [], ingest.run_latest, ingest.run_compacted
    monkeypatch.setattr(ingest, "run_latest", lambda latest, *a, **b: seen.append((latest, run(latest, *a, **b))) or seen[-1][1])
    monkeypatch.setattr(ingest, "run_compacted", lambda latest, *a, **b: seen.append((latest, fold(latest, *a, **b))) or seen[-1][1])
    # k is written in block k // 5 + 1 at k % 5 * 2, if not open again in block k // 5 + 4 at the place after; position 17 leaves out deletes
    for name in ("stream_latest_orders", "stream_compacted_orders"):
        got = {int(r["orderId"]): r["block_number"] for r in registry.queries()[name](spark, scratch).collect()}
        assert got == {k: k // 5 + (4 if k % 2 else 1) for k in range(1, 30)}
        latest, query = seen[-1]
        assert sorted(latest.columns) == sorted(["orderId", *ledger.ORDER_KEY_COLS])
        assert any("rocksdb" in k for k in query.lastProgress["stateOperators"][0]["customMetrics"])
    assert spark.conf.get(PROVIDER, None) is None


def test_a_store_named_by_the_session_wins(spark):
    own = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    with ingest.state_on_disk(spark):
        assert spark.conf.get(PROVIDER, None).endswith("RocksDBStateStoreProvider")
    spark.conf.set(PROVIDER, own)
    try:
        with ingest.state_on_disk(spark):
            assert spark.conf.get(PROVIDER) == own
        assert spark.conf.get(PROVIDER) == own
    finally:
        spark.conf.unset(PROVIDER)
