"""Replay of the order life cycle as a stream (C1, C2): one small state per order, kept between triggers.

The state holds ledger positions and flags, never documents: who the customer is (hash), status, approval, and the
commands that supplied the current metadata, details and shared details. Each command gives a row with its verdict and the
state after it; metadata and details are looked up in the log by position (``operators.lifecycle``).

The states of a few thousand orders lie packed in one bucket of the state store, as an Arrow table: a call and a frame for each order
cost several times the replay itself. A trigger reads and writes the buckets that its commands touch, so the number of
buckets (``buckets``, fixed by the first run on a checkpoint) is chosen for the number of orders.

Commands of one trigger are taken in ledger order, whatever order they arrive in; a later trigger must hold later blocks, as
it does when a log is appended block by block. The rules and wordings are those of ``operators.lifecycle``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from orderlake.functions import sha256_hex
from orderlake.operators import lifecycle as L

#: hash and position of the accepted create, status, approval, position of the published details, of the private ones'
#: block, and of the shared ones with the block that shared them. -1: none.
_STATE = ("hash string, made_block long, made_tx long, status string, approved boolean, detail_block long, detail_tx long, "
          "shared_made_block long, shared_made_tx long, shared_block long")
_EMPTY = (None, -1, -1, None, False, -1, -1, -1, -1, -1)
OUTPUT = ("orderId string, block long, tx long, function string, org string, accepted boolean, reason string, customerIdHash string, "
          "made_block long, made_tx long, status string, approved boolean, detail_block long, detail_tx long")

_COLUMNS = pd.Index([c.split()[0] for c in OUTPUT.split(", ")])

#: Buckets of orders in the state store.
BUCKETS = 1024
_DTYPES = {"string": object, "long": np.int64, "boolean": bool}
_OUT = [(c, _DTYPES[t]) for c, t in (x.split() for x in OUTPUT.split(", "))]
_COMMAND = ("block", "tx", "function", "org", "claim", "full")
_ARROW = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
_PACKED = pa.schema([("orderId", pa.string()), *((c, _ARROW[t]) for c, t in (x.split() for x in _STATE.split(", ")))])

_ALLOWED = {L.CREATE: (L.ORG2,), L.SHARE: (L.ORG2,), L.CREATE_APPROVE: (L.ORG2,), L.VERIFY: (L.ORG1,), L.PUBLISH: (L.ORG1, L.ORG2)}
_WORDS = {L.CREATE: "create_org", L.SHARE: "share_org", L.CREATE_APPROVE: "caa_org", L.VERIFY: "verify_org", L.PUBLISH: "publish_org"}


def step(state: tuple, order_id: str, block: int, tx: int, function: str, org: str, claim: str | None, full: bool) -> tuple[tuple, str | None]:
    """The state after one command, and why it was rejected (None: accepted)."""
    made, made_block, made_tx, status, approved, detail_block, detail_tx, from_block, from_tx, shared = state
    there = made is not None

    def held(since: int, collection: str) -> bool:
        return since >= 0 and block - since <= L.COLLECTION_TTL[collection]

    if function not in _ALLOWED:
        return state, L.MSG["unknown"]
    if org not in _ALLOWED[function]:
        return state, L.MSG[_WORDS[function]]
    if function == L.CREATE:
        if there:
            return state, L.MSG["create_exists"].replace("<orderId>", order_id)
        if not full:
            return state, L.MSG["missing_transient"]
        return (claim, block, tx, "CREATED", False, -1, -1, from_block, from_tx, shared), None
    if function == L.CREATE_APPROVE:
        if not full:
            return state, L.MSG["missing_transient"]
        return (claim, block, tx, "APPROVED", True, block, tx, block, tx, block), None
    if function == L.SHARE:
        if not (there and held(made_block, L.ORG2_DETAILS)):
            return state, L.MSG["share_not_found"]
        return (made, made_block, made_tx, status, approved, detail_block, detail_tx, made_block, made_tx, block), None
    if function == L.VERIFY:
        if not there:
            return state, L.MSG["verify_not_found"]
        if claim is None:
            return state, L.MSG["verify_missing"]
        if claim != made:
            return state, L.MSG["verify_mismatch"]
        return (made, made_block, made_tx, "APPROVED", True, -1, -1, from_block, from_tx, shared), None
    if not there:
        return state, L.MSG["publish_not_found"]
    if not approved:
        return state, L.MSG["publish_not_approved"]
    if not held(shared, L.SHARED_DETAILS):
        return state, L.MSG["publish_not_shared"]
    return (made, made_block, made_tx, status, approved, from_block, from_tx, from_block, from_tx, shared), None


def _verdict(state: tuple, order_id: str, block: int, tx: int, function: str, org: str, claim: str | None, full: bool) -> tuple[tuple, tuple]:
    """The state after a command, and its row of the output."""
    state, reason = step(state, order_id, int(block), int(tx), function, org, claim, bool(full))
    made, made_block, made_tx, status, approved, detail_block, detail_tx, *_ = state
    return state, (order_id, block, tx, function, org, reason is None, reason, made, made_block, made_tx, status, approved, detail_block, detail_tx)


def _fold(key: tuple, batches: Iterable[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
    """The commands of one order."""
    state = held.get if held.exists else _EMPTY
    rows = [r for b in batches for r in zip(*(b[c].tolist() for c in _COMMAND))]
    rows.sort(key=lambda r: r[:2])
    out = []
    for r in rows:
        state, row = _verdict(state, key[0], *r)
        out.append(row)
    held.update(state)
    yield pd.DataFrame(np.array(out, dtype=object), columns=_COLUMNS)


def _pack(states: dict[str | None, tuple]) -> bytes:
    columns = zip(*((k, *v) for k, v in states.items()))
    table = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PACKED)], schema=_PACKED)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _PACKED, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(table)
    return sink.getvalue().to_pybytes()


def _unpack(packed: bytes) -> dict[str | None, tuple]:
    names, *columns = (c.to_pylist() for c in pa.ipc.open_stream(packed).read_all().columns)
    return dict(zip(names, zip(*columns)))


def _fold_bucket(key: tuple, batches: Iterable[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
    """The commands of the orders of one bucket."""
    states = _unpack(bytes(held.get[0])) if held.exists else {}
    rows = [r for b in batches for r in zip(*(b[c].tolist() for c in ("orderId", *_COMMAND)))]
    rows.sort(key=lambda r: r[1:3])
    out = []
    for order_id, *command in rows:
        states[order_id], row = _verdict(states.get(order_id, _EMPTY), order_id, *command)
        out.append(row)
    held.update((_pack(states),))
    yield pd.DataFrame({c: np.array(values, dtype) for (c, dtype), values in zip(_OUT, zip(*out))})


def replay_stream(events: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """A row for each command of the stream ``events`` with its verdict and the state after it."""
    commands = events.select(
        "orderId", F.col("block").cast("long").alias("block"), F.col("tx").cast("long").alias("tx"), "function", "org", sha256_hex("customerId").alias("claim"),
        (F.col("customerId").isNotNull() & F.col("order").isNotNull() & F.col("orderDetails").isNotNull()).alias("full"))
    dealt = commands.withColumn("bucket", F.pmod(F.xxhash64("orderId"), F.lit(buckets)).cast("int"))
    return dealt.groupBy("bucket").applyInPandasWithState(_fold_bucket, OUTPUT, "packed binary", "append", GroupStateTimeout.NoTimeout)


def run_replay(events: DataFrame, log_path: str, checkpoint_path: str):
    """Append the replay of ``events`` to a log of verdicts. Returns the started query."""
    return (replay_stream(events).writeStream.format("parquet").option("path", log_path).option("checkpointLocation", checkpoint_path)
            .outputMode("append").trigger(availableNow=True).start())


def current_orders(log: DataFrame, events: DataFrame) -> DataFrame:
    """The state after the last command of each order that exists, with metadata and details out of ``events``."""
    state = log.groupBy("orderId").agg(F.max_by(F.struct("customerIdHash", "made_block", "made_tx", "status", "approved", "detail_block", "detail_tx"),
                                                F.struct("block", "tx")).alias("s"), F.max("block").alias("last_block"))
    state = state.where("s.customerIdHash is not null").select(
        "orderId", "s.customerIdHash", "s.status", F.col("s.approved").alias("approvedByOrg1"), "last_block",
        F.struct(F.col("s.made_block").alias("block"), F.col("s.made_tx").alias("tx")).alias("made_at"),
        F.struct(F.col("s.detail_block").alias("block"), F.col("s.detail_tx").alias("tx")).alias("detail_at"))
    return L.supplied(L.supplied(state, events, "made_at", "meta"), events, "detail_at", "detail").select(
        "orderId", "customerIdHash", "meta", "status", "approvedByOrg1", F.col("detail").alias("OrderDetail"), "last_block")
