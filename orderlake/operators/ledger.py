"""Ledger block flattening (L1-L6), latest state (W1) and ledger counts.

All flattening is narrow: chained ``posexplode`` over nested arrays, with the
positions kept as the ledger-order key. The only shuffle is the keep-latest
aggregation, a ``max_by`` that combines map-side, so a key written in many
blocks (a hot order) is reduced before the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions import b64_decode, json_objects, utf8_lenient, utf8_strict
from orderlake.schemas import RAW_ORDER

DEFAULT_CHAINCODE = "mycc"
DEFAULT_CHANNEL = "mychannel"

ORDER_KEY_COLS = ["block_number", "tx_index", "action_index", "ns_index", "write_index"]


def _block_number(blocks: DataFrame):
    return F.col("header.number").cast("long")


def order_writes(blocks: DataFrame, chaincode: str = DEFAULT_CHAINCODE) -> DataFrame:
    """L1 (+P9-P11): every qualifying order write, in ledger order.

    Drops configuration transactions (no actions), other namespaces, empty
    read/write sets, writes without a value and values that are not
    base64 -> UTF-8 -> a JSON object holding ``orderId``.
    Output: block_number, tx_index, action_index, ns_index, write_index, key,
    orderId, value (the JSON text).
    """
    tx = blocks.select(_block_number(blocks).alias("block_number"),
                       F.posexplode("data.data").alias("tx_index", "env"))
    act = (tx.filter(F.col("env.payload.data.actions").isNotNull())
             .select("block_number", "tx_index", F.posexplode("env.payload.data.actions").alias("action_index", "a")))
    ns = act.select("block_number", "tx_index", "action_index",
                    F.posexplode("a.payload.action.proposal_response_payload.extension.results.ns_rwset")
                    .alias("ns_index", "ns"))
    ns = ns.filter((F.col("ns.namespace") == chaincode) & F.col("ns.rwset").isNotNull())
    w = ns.select("block_number", "tx_index", "action_index", "ns_index",
                  F.posexplode(F.coalesce("ns.rwset.writes", F.array())).alias("write_index", "w"))
    w = w.filter(F.col("w.value").isNotNull() & (F.col("w.value") != ""))
    text = utf8_strict(b64_decode("w.value"))
    values = w.select(*ORDER_KEY_COLS, F.col("w.key").alias("key"), text.alias("value")).filter(F.ltrim("value").startswith("{"))
    # one parse: a value that qualifies gives its object as one row, any other none
    return values.withColumn("doc", F.explode(json_objects("value", "orderId"))) \
                 .withColumn("orderId", F.col("doc").getItem("orderId")).drop("doc")


def latest_per_key(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """Keep the row with the greatest ``order_cols`` per ``key`` (max_by, map-side combined)."""
    others = [c for c in df.columns if c != key]
    ordk = F.struct(*[F.col(c) for c in order_cols])
    agg = df.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in others]), ordk).alias("_r"))
    return agg.select(key, "_r.*")


def latest_order_values(writes: DataFrame) -> DataFrame:
    """The latest qualifying write per ``orderId`` (last write wins)."""
    return latest_per_key(writes, "orderId", ORDER_KEY_COLS)


def latest_order_state(writes: DataFrame) -> DataFrame:
    """W1 + parse: current bronze document per order (leaves as text) with its ledger position."""
    latest = latest_order_values(writes)
    doc = F.from_json("value", RAW_ORDER)
    return latest.select("orderId", "block_number", "tx_index", doc.alias("doc")).select(
        "block_number", "tx_index", *[F.col(f"doc.{f.name}").alias(f.name) for f in RAW_ORDER.fields
                                      if f.name != "orderId"], "orderId")


def block_summary(blocks: DataFrame, default_channel: str = DEFAULT_CHANNEL, ordered: bool = False) -> DataFrame:
    """L2 + A7 (+ O3 when ``ordered``): number, transaction count, channel of the first
    transaction, hashes.

    A block without ``header.number`` takes the number in its file name when
    the frame carries ``source_file`` (``read_blocks(..., with_source=True)``).
    """
    txs = F.coalesce(F.col("data.data"), F.array())
    number = _block_number(blocks)
    if "source_file" in blocks.columns:
        from_name = F.regexp_extract(F.col("source_file"), r"(\d+)[^/\d]*$", 1)
        number = F.coalesce(number, F.when(from_name != "", from_name.cast("long")))
    out = blocks.select(
        number.alias("block_number"),
        F.size(txs).alias("tx_count"),
        F.coalesce(F.get(txs, 0)["payload"]["header"]["channel_header"]["channel_id"],
                   F.lit(default_channel)).alias("channel_id"),
        F.coalesce("header.previous_hash", F.lit("")).alias("previous_hash"),
        F.coalesce("header.data_hash", F.lit("")).alias("data_hash"),
    )
    return out.orderBy("block_number") if ordered else out


def _decode_or_raw(c):
    return F.coalesce(utf8_strict(b64_decode(c)), c)


def creator_label(msp, id_bytes):
    """``"CN (MSP)"`` when the certificate text has a ``CN=``, else the MSP id."""
    cert = utf8_lenient(b64_decode(id_bytes))
    cn = F.regexp_extract(F.coalesce(cert, F.lit("")), r"CN=([^,]+)", 1)
    m = F.coalesce(msp, F.lit(""))
    return F.when(cn != "", F.concat(cn, F.lit(" ("), m, F.lit(")"))).otherwise(m)


def block_transactions(blocks: DataFrame) -> DataFrame:
    """L3 + L4 + L5: one row per transaction (configuration ones included).

    Contract, function and arguments come from the first action only; the
    first argument is the function name, the rest are joined with ", ";
    an argument that does not decode is shown as given.
    """
    tx = blocks.select(_block_number(blocks).alias("block_number"),
                       F.posexplode("data.data").alias("tx_index", "env"))
    p = F.col("env.payload")
    spec = F.get(p["data"]["actions"], 0)["payload"]["chaincode_proposal_payload"]["input"]["chaincode_spec"]
    args = spec["input"]["args"]
    rest = F.slice(args, 2, F.greatest(F.size(args) - 1, F.lit(0)))
    return tx.select(
        "block_number", "tx_index",
        F.coalesce(p["header"]["channel_header"]["tx_id"], F.lit("")).alias("tx_id"),
        F.coalesce(p["header"]["channel_header"]["timestamp"], F.lit("")).alias("timestamp"),
        F.coalesce(spec["chaincode_id"]["name"], F.lit("")).alias("chaincode"),
        F.coalesce(_decode_or_raw(F.get(args, 0)), F.lit("")).alias("function"),
        F.coalesce(F.array_join(F.transform(rest, _decode_or_raw), ", "), F.lit("")).alias("args"),
        creator_label(p["header"]["signature_header"]["creator"]["Mspid"],
                      p["header"]["signature_header"]["creator"]["IdBytes"]).alias("creator"),
    )


def tx_rwset(blocks: DataFrame) -> DataFrame:
    """read/write-set rows of the first action, every namespace, leniently decoded values."""
    tx = blocks.select(_block_number(blocks).alias("block_number"),
                       F.posexplode("data.data").alias("tx_index", "env"))
    a0 = F.get(F.col("env.payload.data.actions"), 0)
    ns = tx.select("block_number", "tx_index",
                   F.posexplode(a0["payload"]["action"]["proposal_response_payload"]["extension"]["results"]["ns_rwset"])
                   .alias("ns_index", "ns"))
    w = ns.select("block_number", "tx_index", "ns_index",
                  F.coalesce(F.col("ns.namespace"), F.lit("")).alias("namespace"),
                  F.posexplode(F.coalesce("ns.rwset.writes", F.array())).alias("write_index", "w"))
    raw = F.col("w.value")
    return w.select(
        "block_number", "tx_index", "ns_index", "write_index", "namespace",
        F.coalesce(F.col("w.key"), F.lit("")).alias("key"),
        F.coalesce(utf8_lenient(b64_decode(raw)), raw).alias("value"),
    )


def ledger_height(blocks: DataFrame) -> DataFrame:
    """Newest block number + 1."""
    return blocks.agg((F.max(_block_number(blocks)) + 1).alias("height"))


def order_write_count(writes: DataFrame) -> DataFrame:
    """Qualifying order writes before the overwrite."""
    return writes.agg(F.count(F.lit(1)).alias("order_writes"))
