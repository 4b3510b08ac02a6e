"""Ledger flattening on hand-written blocks (FIXTURES F2)."""

import base64
import json
import os

from orderlake.operators import ledger
from orderlake.sources.blocks import read_blocks


def b64(x):
    return base64.b64encode(x if isinstance(x, bytes) else x.encode()).decode()


def tx(writes_by_ns, args=("CreateOrder", "o1"), creator_text="x CN=User1@org2.example.com,OU=client",
       msp="Org2MSP", n_actions=1, raw_args=()):
    ns = [{"namespace": n, "rwset": ({"writes": w} if w is not None else None)} for n, w in writes_by_ns]
    action = {"payload": {
        "chaincode_proposal_payload": {"input": {"chaincode_spec": {
            "chaincode_id": {"name": "mycc"},
            "input": {"args": [b64(a) for a in args] + list(raw_args)}}}},
        "action": {"proposal_response_payload": {"extension": {"results": {"ns_rwset": ns}}}}}}
    return {"payload": {"header": {"channel_header": {"channel_id": "mychannel", "tx_id": "t", "timestamp": "ts"},
                                   "signature_header": {"creator": {"Mspid": msp, "IdBytes": b64(creator_text)}}},
                        "data": {"actions": [action] * n_actions}}}


def block(n, txs):
    return {"header": {"number": str(n), "previous_hash": "p", "data_hash": "d"}, "data": {"data": txs}}


def order(oid, status):
    return b64(json.dumps({"orderId": oid, "status": status, "freight": 1.5}))


def test_order_writes_and_latest(spark, scratch):
    config = {"payload": {"header": {"channel_header": {"channel_id": "mychannel", "tx_id": "", "timestamp": ""},
                                     "signature_header": {"creator": {"Mspid": "OrdererMSP", "IdBytes": b64("no cn")}}},
                          "data": {}}}
    blocks = [
        block(0, [config]),
        block(1, [tx([("mycc", [{"key": "o1", "value": order("o1", "CREATED")}]),
                      ("othercc", [{"key": "o1", "value": order("o1", "OTHER")}]),
                      ("mycc", None)])]),
        block(2, [tx([("mycc", [{"key": "o1", "value": order("o1", "APPROVED")},
                                {"key": "o2", "value": None},
                                {"key": "o3", "value": "@@not-base64@@"},
                                {"key": "o4", "value": b64(b"\xff\xfe")},
                                {"key": "o5", "value": b64("not json")},
                                {"key": "o6", "value": b64("[1,2]")},
                                {"key": "o7", "value": b64('{"noOrder": 1}')}])], n_actions=2)]),
        block(3, [tx([("mycc", [{"key": "o1", "value": order("o1", "PUBLISHED")}])]),
                  tx([("mycc", [{"key": "o1", "value": b64('{"other": true}')}])], raw_args=("%%raw",))]),
    ]
    d = os.path.join(scratch, "blocks")
    os.makedirs(d)
    for i in (2, 0, 3, 1):  # arrival order does not matter
        with open(os.path.join(d, f"block_{i}.json"), "w") as f:
            json.dump(blocks[i], f, indent=2)
    bl = read_blocks(spark, d)
    w = ledger.order_writes(bl).orderBy(*ledger.ORDER_KEY_COLS).collect()
    # block 2 has the same action twice: both copies qualify
    assert [(r.block_number, r.action_index, json.loads(r.value)["status"]) for r in w] == [
        (1, 0, "CREATED"), (2, 0, "APPROVED"), (2, 1, "APPROVED"), (3, 0, "PUBLISHED")]
    latest = ledger.latest_order_state(ledger.order_writes(bl)).collect()
    assert [(r.orderId, r.status, r.block_number) for r in latest] == [("o1", "PUBLISHED", 3)]
    assert ledger.ledger_height(bl).first().height == 4
    s = [(r.block_number, r.tx_count, r.channel_id) for r in ledger.block_summary(bl, ordered=True).collect()]
    assert s == [(0, 1, "mychannel"), (1, 1, "mychannel"), (2, 1, "mychannel"), (3, 2, "mychannel")]
    t = ledger.block_transactions(bl).orderBy("block_number", "tx_index").collect()
    assert t[0].chaincode == "" and t[0].creator == "OrdererMSP"
    assert t[1].function == "CreateOrder" and t[1].args == "o1"
    assert t[1].creator == "User1@org2.example.com (Org2MSP)"
    assert t[-1].args == "o1, %%raw"
    # a block without a number takes the one in its file name
    nameless = dict(blocks[2])
    nameless["header"] = {"previous_hash": "p", "data_hash": "d"}
    d2 = os.path.join(scratch, "blocks2")
    os.makedirs(d2)
    with open(os.path.join(d2, "block_7.json"), "w") as f:
        json.dump(nameless, f)
    s2 = ledger.block_summary(read_blocks(spark, d2, with_source=True)).first()
    assert (s2.block_number, s2.tx_count) == (7, 1)
    rw = ledger.tx_rwset(bl).filter("block_number = 1").orderBy("ns_index", "write_index").collect()
    assert [(r.namespace, r.key) for r in rw] == [("mycc", "o1"), ("othercc", "o1")]
