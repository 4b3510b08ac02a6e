"""The first valid create of an order is found in a hash table, whatever the events carry besides."""

from orderlake.operators import lifecycle as L

EVENTS = ("orderId string, block long, tx int, function string, org string, customerId string, order struct<employee:int,orderDate:string>, "
          "orderDetails struct<total:double,items:array<struct<productId:string>>>")
FULL = ((1, "1997-03-01"), (2.0, [("p",)]))


def _events(spark):
    rows = [("a", 7, 3, L.CREATE, L.ORG2, "3", *FULL), ("a", 7, 1, L.CREATE, L.ORG2, "1", *FULL), ("a", 8, 0, L.CREATE, L.ORG2, "8", *FULL),
            ("a", 2, 0, L.CREATE, L.ORG1, "0", *FULL), ("a", 1, 0, L.CREATE, L.ORG2, None, *FULL), ("a", 1, 1, L.CREATE, L.ORG2, "2", FULL[0], None),
            ("b", 2 ** 62, 2 ** 31 - 1, L.CREATE, L.ORG2, "4", *FULL), ("b", 2 ** 62 + 1, -2 ** 31, L.CREATE, L.ORG2, "5", *FULL),
            (None, None, None, L.CREATE, L.ORG2, "6", *FULL), (None, 1, None, L.CREATE, L.ORG2, "7", *FULL), ("c", 5, 5, L.VERIFY, L.ORG1, "9", None, None)]
    return spark.createDataFrame(rows, EVENTS)


def test_first_by_position(spark):
    found = {r["orderId"]: (r["block"], r["tx"], r["customerId"], r["order"]["orderDate"], r["org"], r["function"])
             for r in L.first_create_wins(_events(spark)).collect()}
    rest = ("1997-03-01", L.ORG2, L.CREATE)
    assert found == {"a": (7, 1, "1", *rest), "b": (2 ** 62, 2 ** 31 - 1, "4", *rest), None: (None, None, "6", *rest)}
    assert L.first_create_wins(_events(spark)).columns == _events(spark).columns
    narrow = L.first_create_wins(_events(spark), ["block", "tx", "org"])
    assert sorted((r["orderId"] or "", r["block"], r["tx"], r["org"]) for r in narrow.collect() if r["block"]) == [
        ("a", 7, 1, L.ORG2), ("b", 2 ** 62, 2 ** 31 - 1, L.ORG2)]


def test_no_row_is_sorted(spark):
    plan = L.first_create_wins(_events(spark), ["block", "tx", "org"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
