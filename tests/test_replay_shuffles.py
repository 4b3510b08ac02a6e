"""The replay deals the commands out once; lines are sorted by order in small tasks only."""

import datetime as dt

from pyspark.sql import functions as F

from orderlake.operators import lifecycle as L
from orderlake.plans import registry
from orderlake.sources.tables import by_order, order_lines, typed_documents

EVENTS = ("orderId string, block long, tx int, function string, org string, customerId string, order struct<employee:int,orderDate:string,requiredDate:string,shippedDate:string,shipperID:int,freight:double>, "
          "orderDetails struct<total:double,items:array<struct<productId:string>>>")


def _events(spark):
    full = ((1, "1997-03-01", "1997-03-08", "", 2, 0.5), (2.0, [("p",)]))
    rows = [("a", 1, 0, L.CREATE, L.ORG2, "7", *full), ("a", 5, 1, L.VERIFY, L.ORG1, "7", None, None),
            ("a", 6, 0, L.VERIFY, L.ORG1, "8", None, None), ("a", 30, 2, L.CREATE, L.ORG2, "7", *full),
            ("b", 2, 0, L.CREATE, L.ORG2, None, *full), ("b", 3, 0, L.VERIFY, L.ORG1, "7", None, None),
            (None, 1, 1, L.CREATE, L.ORG2, "9", *full), (None, 2, 1, L.CREATE, L.ORG2, "9", *full)]
    return spark.createDataFrame(rows, EVENTS)


def test_commands_are_dealt_out_once_and_carry_ids(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = L.rejected_events(_events(spark), chunk_blocks=4)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "orderlake-scratch" not in plan and "sha2(" not in plan
    # by order and chunk: the commands (the same exchange wherever they are read) and the carry-ins, never the scanned rows
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(orderId" in x and "_chunk" in x]
    assert {("REPARTITION_BY_NUM" in x) for x in dealt} == {True, False}
    assert sum("REPARTITION_BY_NUM" not in x for x in dealt) == 3  # carry-ins of the first scan (read twice) and of the second


def test_verdicts_across_chunks(spark):
    found = {(r["orderId"], r["block"]): r["reason"] for r in L.rejected_events(_events(spark), chunk_blocks=4).collect()}
    assert found == {("a", 6): L.MSG["verify_mismatch"], ("a", 30): "order a already exists", ("b", 2): L.MSG["missing_transient"],
                     ("b", 3): L.MSG["verify_not_found"], (None, 2): found.get((None, 2))}
    assert (None, 2) in found  # the second create of the null id, too
    state = L.order_lifecycle(_events(spark), chunk_blocks=4).where("orderId = 'a'").first()
    assert state["customerIdHash"] == spark.range(1).select(F.sha2(F.lit("7"), 256)).first()[0] and state["status"] == "APPROVED"


def test_only_hot_orders_are_cut_into_chunks(spark):
    """Orders of few commands have one whole history, with no carry-in; hot ones are cut; the verdicts are the same."""
    events = _events(spark)
    dealt = {hot: {(r["orderId"], r["_chunk"]) for r in L.by_chunk(events, "orderId", "_chunk", F.floor(F.col("block") / 4), hot).collect()}
             for hot in (1, 2, 100)}
    assert dealt[100] == {("a", None), ("b", None), (None, None)}
    assert dealt[2] == {("a", 0), ("a", 1), ("a", 7), ("b", None), (None, None)}
    assert dealt[1] == dealt[2] - {("b", None)} | {("b", 0)}
    verdicts = [sorted(map(str, L.rejected_events(events, chunk_blocks=2, hot=hot).collect())) for hot in (0, 2, 100)]
    assert verdicts[0] == verdicts[1] == verdicts[2]
    states = [sorted(map(str, L.order_lifecycle(events, chunk_blocks=2, hot=hot).where("orderId = 'a'").collect())) for hot in (0, 100)]
    assert states[0] == states[1] and len(states[0]) == 1


def test_lines_meet_before_they_are_nested(spark, scratch):
    orders = spark.createDataFrame([(1, 4, "F", 10.0, dt.datetime(1997, 3, 1)), (2, 4, "O", 10.0, dt.datetime(1997, 3, 1))],
                                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz")
    lines = spark.createDataFrame([(1, n, 100 + n, 2.0, 8.0, 0.0) for n in (2, 1)],
                                  "l_orderkey long, l_linenumber long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double")
    docs = typed_documents(orders, lines)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    nesting = plan[:plan.index("REPARTITION_BY_COL")]
    assert nesting.count("ObjectHashAggregate") == 2  # both steps after the exchange
    assert {r["orderId"]: [i["productId"] for i in r["OrderDetail"]["items"]] for r in docs.collect()} == {"1": ["101", "102"], "2": []}
    assert order_lines(by_order(lines, "orderId")).columns[:2] == ["orderId", "orderKey"]
    assert order_lines(lines).columns[0] == "orderKey"
    assert "share_details" in registry.queries()
