"""Bronze scan and silver rules on hand-written documents (FIXTURES F1)."""

import datetime as dt
import json
import os

from orderlake.operators import silver
from orderlake.sources.bronze import bronze_scan


def hdr(oid, **kw):
    d = {"orderId": oid, "customerIdHash": "h", "employee": 1, "orderDate": "1996-07-04",
         "requiredDate": "1996-08-01", "shippedDate": "1996-07-10", "shipperID": 2, "freight": 3.5,
         "status": "APPROVED", "approvedByOrg1": True}
    d.update(kw)
    return d


def item(q=1, p=1.0, d=0.0, pid="p"):
    return {"productId": pid, "quantity": q, "unitPrice": p, "discount": d, "price": 1.0}


def write(dirpath, name, text):
    with open(os.path.join(dirpath, name), "w") as f:
        f.write(text)


def test_bronze_and_silver_rules(spark, scratch):
    d = os.path.join(scratch, "bronze", "orders")
    os.makedirs(os.path.join(d, "nested"))
    write(d, "list.json", json.dumps([hdr("L1"), hdr("L2")]))
    write(d, "bad.json", "{bad")
    write(d, "scalar.json", "5")
    write(d, "empty.json", "[]")
    write(d, "nodetail.json", json.dumps(hdr("N1")))
    write(d, "nulldetail.json", json.dumps(hdr("N2", OrderDetail=None)))
    write(d, "nullitems.json", json.dumps(hdr("N3", OrderDetail={"orderId": "N3", "items": None, "total": 0})))
    write(d, "emptyitems.json", json.dumps(hdr("N4", OrderDetail={"orderId": "N4", "items": [], "total": 0})))
    write(os.path.join(d, "nested"), "dates.json", json.dumps([
        hdr("D1", shippedDate=""), hdr("D2", shippedDate="nan"),
        hdr("D3", shippedDate="1996-07-04 00:00:00.000")]))
    qty = [item(q=0), item(q=-1), item(q=None), item(q="2"), item(q=2.5)]
    price = [item(p=-0.01), item(p=0), item(p=None)]
    disc = [item(d=-0.1, pid="a"), item(d=0, pid="b"), item(d=0.5, pid="c"), item(d=1, pid="d"),
            item(d=1.1, pid="e"), item(d=None, pid="f")]
    write(d, "items.json", json.dumps([
        hdr("Q", OrderDetail={"orderId": "Q", "items": qty, "total": 1}),
        hdr("P", OrderDetail={"orderId": "P", "items": price, "total": 1}),
        hdr("X", OrderDetail={"orderId": "X", "items": disc, "total": 1}),
    ]))

    bronze = bronze_scan(spark, os.path.join(scratch, "bronze"))
    h, i = silver.bronze_to_silver(bronze)
    ids = sorted(r.orderId for r in h.collect())
    assert ids == sorted(["L1", "L2", "N1", "N2", "N3", "N4", "D1", "D2", "D3", "Q", "P", "X"])
    shipped = {r.orderId: r.shippedDate for r in h.filter("orderId like 'D%'").collect()}
    assert shipped == {"D1": None, "D2": None, "D3": dt.datetime(1996, 7, 4)}
    assert h.filter("orderId = 'L1'").first().orderDate == dt.datetime(1996, 7, 4)

    rows = i.collect()
    assert not [r for r in rows if r.orderId.startswith("N") or r.orderId.startswith("L")]
    assert sorted(r.quantity for r in rows if r.orderId == "Q") == [2, 2]
    assert [r.unitPrice for r in rows if r.orderId == "P"] == [0.0]
    xd = {r.productId: (r.discount, r.totalPrice) for r in rows if r.orderId == "X"}
    assert xd == {"a": (0.0, 1.0), "b": (0.0, 1.0), "c": (0.5, 0.5), "d": (1.0, 0.0), "e": (0.0, 1.0),
                  "f": (None, None)}


def test_no_detail_anywhere_gives_empty_items(spark, scratch):
    d = os.path.join(scratch, "b2")
    os.makedirs(d)
    write(d, "a.json", json.dumps(hdr("A")))
    h, i = silver.bronze_to_silver(bronze_scan(spark, d))
    assert h.count() == 1
    assert i.count() == 0


def test_mixed_lists_and_mismatches_keep_their_records(spark, scratch):
    d = os.path.join(scratch, "b3")
    os.makedirs(d)
    write(d, "mixed.json", json.dumps([hdr("M1"), 5, "x", hdr("M2", OrderDetail={"orderId": "M2",
                                                                                "items": [item(q="3")]})]))
    write(d, "single.json", json.dumps(hdr("S1")))
    write(d, "bad.json", "{bad")
    write(d, "scalar.json", "5")
    write(d, "mismatch.json", '{"orderId":"d","OrderDetail":"oops"}')
    write(d, "tail.json", json.dumps(hdr("T1")) + " x")
    write(d, "nan.json", '{"orderId":"nan","freight":NaN}')
    write(d, "quotes.json", "{'orderId':'q'}")
    h, i = silver.bronze_to_silver(bronze_scan(spark, d))
    assert sorted(r.orderId for r in h.collect()) == ["M1", "M2", "S1", "d", "nan"]
    assert [(r.orderId, r.quantity) for r in i.collect()] == [("M2", 3)]
