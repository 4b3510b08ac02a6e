"""Ledger blocks: reader (S3) and a block generator over the supplied tables.

A block is the JSON a block decoder prints (schema ``schemas.BLOCK``); the
block number is text. The reader declares the schema, so no inference pass
runs, and reads a whole directory (recursively) in parallel.

The generator turns the ``orders``/``lineitem`` tables into blocks with the
write pattern of the order contract, keyed only on ``o_orderkey`` (no global
ordering, no driver work). Fixed layout (shared with the oracle SQL):

* block 0 holds one configuration transaction (no actions);
* order k is created in block k // 5 + 1 at position (k % 5) * 2 with
  function ``CreateOrder``: one write of the header document (status
  CREATED) to the contract namespace, plus one write to the ``_lifecycle``
  namespace whose value also carries an ``orderId`` field;
* an order whose status is not 'O' is re-written in block k // 5 + 4 at
  position (k % 5) * 2 + 1 by ``CreateOrderAndApprove`` with the published
  document (header + ``OrderDetail``); when k % 13 = 0 that transaction also
  writes an audit value without ``orderId``; when k % 17 = 0 it ends with a
  delete of the order key (a write without value);
* when k % 19 = 0 the create transaction's second argument is raw text
  instead of base64.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions import b64_encode
from orderlake.schemas import BLOCK
from orderlake.sources.tables import DOCUMENT, ITEM_COLS, date_texts, dealt, header_fields, line_fields, read_table

CHANNEL = "mychannel"
CHAINCODE = "mycc"

# Fixed certificate texts of the two submitting identities.
ORG2_CERT = "-----BEGIN CERTIFICATE-----\nsubject=C=US,ST=North Carolina,O=org2.example.com,CN=User1@org2.example.com,OU=client\n-----END CERTIFICATE-----\n"
ORDERER_CERT = "-----BEGIN CERTIFICATE-----\nsubject=C=US,O=example.com\n-----END CERTIFICATE-----\n"


def read_blocks(spark: SparkSession, path: str, multi_line: bool = True, with_source: bool = False) -> DataFrame:
    """S3: every decoded block under ``path``.

    ``multi_line=True``: one (pretty-printed) JSON document per file, as a
    block decoder writes them; ``False``: JSON lines, one block per line.
    ``with_source`` adds ``source_file`` (the file path), which the block
    summary uses as the fallback block number (``block_<n>.json``).
    """
    df = (spark.read.schema(BLOCK)
          .option("multiLine", multi_line)
          .option("recursiveFileLookup", True)
          .json(path))
    return df.withColumn("source_file", F.col("_metadata.file_path")) if with_source else df


def _b64(text):
    return b64_encode(F.encode(text, "UTF-8"))


def _envelope(tx_id, ts, msp, cert, actions):
    """One transaction envelope; a configuration transaction has no actions."""
    return F.struct(F.struct(
        F.struct(
            F.struct(F.lit(CHANNEL).alias("channel_id"), tx_id.alias("tx_id"), ts.alias("timestamp"))
            .alias("channel_header"),
            F.struct(F.struct(msp.alias("Mspid"), _b64(cert).alias("IdBytes")).alias("creator"))
            .alias("signature_header"),
        ).alias("header"),
        F.struct(actions.alias("actions")).alias("data"),
    ).alias("payload"))


def _action(args, ns_rwset):
    return F.struct(F.struct(
        F.struct(F.struct(F.struct(
            F.struct(F.lit(CHAINCODE).alias("name")).alias("chaincode_id"),
            F.struct(args.alias("args")).alias("input"),
        ).alias("chaincode_spec")).alias("input")).alias("chaincode_proposal_payload"),
        F.struct(F.struct(F.struct(F.struct(ns_rwset.alias("ns_rwset")).alias("results"))
                          .alias("extension")).alias("proposal_response_payload")).alias("action"),
    ).alias("payload"))


def _ns(namespace, writes):
    return F.struct(F.lit(namespace).alias("namespace"), F.struct(writes.alias("writes")).alias("rwset"))


def _write(key, value):
    return F.struct(key.cast("string").alias("key"), value.cast("string").alias("value"))


#: What a transaction is made of; the rest of its order's header follows from these.
_ORDER = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"]


def _transaction(t, lines):
    """The envelope of one transaction: ``t`` holds its ``kind`` and the row of its order, ``lines`` the order lines of its block."""
    fields = date_texts(header_fields(lambda c: t[c]))
    k, oid, config, create = fields["orderKey"], fields["orderId"], t["kind"] == "config", t["kind"] == "create"
    own = F.sort_array(F.filter(lines, lambda line: line["orderKey"] == k))
    detail = F.struct(
        oid.alias("orderId"), F.transform(own, lambda line: line["item"]).alias("items"),
        F.aggregate(own, F.lit(0.0), lambda total, line: total + F.coalesce(line["item"]["price"], F.lit(0.0))).alias("total"))
    header_doc = F.to_json(F.struct(
        *[fields[c].alias(c) for c in DOCUMENT[:-2]], F.lit("CREATED").alias("status"), F.lit(False).alias("approvedByOrg1")))
    public_doc = F.to_json(F.struct(*[fields[c].alias(c) for c in DOCUMENT], detail.alias("OrderDetail")))
    create_action = _action(
        F.array(_b64(F.lit("CreateOrder")),
                F.when(k % 19 == 0, F.concat(F.lit("raw:"), oid)).otherwise(_b64(oid))),
        F.array(
            _ns(CHAINCODE, F.array(_write(oid, _b64(header_doc)))),
            _ns("_lifecycle", F.array(_write(F.concat(F.lit("seq/"), oid),
                                             _b64(F.to_json(F.struct(oid.alias("orderId"))))))),
        ))
    approve_action = _action(
        F.array(_b64(F.lit("CreateOrderAndApprove")), _b64(oid)),
        F.array(_ns(CHAINCODE, F.filter(F.array(
            _write(oid, _b64(public_doc)),
            F.when(k % 13 == 0, _write(F.concat(F.lit("audit~"), oid), _b64(F.lit('{"audit":true}')))),
            F.when(k % 17 == 0, _write(oid, F.lit(None))),
        ), lambda w: w.isNotNull()))))
    return _envelope(
        F.when(config, F.lit("")).otherwise(F.sha2(F.concat(F.lit("tx:"), t["kind"], F.lit(":"), oid), 256)),
        F.when(config, F.lit("1970-01-01T00:00:00Z")).otherwise(
            F.concat(F.regexp_replace(fields["orderDate"], " ", "T"), F.lit("Z"))),
        F.when(config, F.lit("OrdererMSP")).otherwise(F.lit("Org2MSP")),
        F.when(config, F.lit(ORDERER_CERT)).otherwise(F.lit(ORG2_CERT)),
        F.when(create, F.array(create_action)).when(~config, F.array(approve_action)))


def blocks_from_rows(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Build blocks from the rows of ``orders`` and ``lineitem``.

    One shuffle: the transactions, as the rows of their orders, and the lines, as read, go to their blocks together; the documents and
    envelopes, with their texts and base64 values several times as long, are spelled out inside the block.
    """
    k = F.col("o_orderkey")

    def block(key, offset: int):
        return (F.floor(key / 5) + offset).cast("long").alias("block")

    def tx(kind: str, offset: int, slot: int):
        return F.struct(block(k, offset), F.struct(((k % 5) * 2 + slot).cast("long").alias("pos"), F.lit(kind).alias("kind"), *_ORDER).alias("tx"))

    txs = orders.select(F.explode(F.filter(F.array(
        tx("create", 1, 0),
        F.when(header_fields()["approvedByOrg1"], tx("approve", 4, 1)),
    ), lambda t: t.isNotNull())).alias("t")).select("t.*")
    genesis = orders.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("block"),
        F.struct(F.lit(0).cast("long").alias("pos"), F.lit("config").alias("kind"),
                 *[F.lit(None).cast(orders.schema[c].dataType).alias(c) for c in _ORDER]).alias("tx"))
    lines = lineitem.where(F.col("l_orderkey").isNotNull()).select(block(F.col("l_orderkey"), 4), F.struct(*_LINE).alias("line"))
    met = dealt(txs.unionByName(genesis).unionByName(lines, allowMissingColumns=True), orders.count() + lineitem.count(), "block")
    line = line_fields(lambda c: F.col("line")[c])
    item = F.struct(F.col("line")["l_orderkey"].alias("orderKey"), line["lineNumber"].alias("lineNumber"),
                    F.struct(*[line[c].alias(c) for c in ITEM_COLS]).alias("item"))
    met = met.groupBy("block").agg(F.collect_list("tx").alias("txs"), F.collect_list(F.when(F.col("line").isNotNull(), item)).alias("lines"))
    envelopes = F.transform("txs", lambda t: F.struct(t["pos"].alias("pos"), _transaction(t, F.col("lines")).alias("env")))
    blocks = met.where(F.size("txs") > 0).select("block", F.sort_array(envelopes).alias("txs"))
    n = F.col("block")
    return blocks.select(
        F.struct(
            n.cast("string").alias("number"),
            F.when(n > 0, F.sha2(F.concat(F.lit("block:"), (n - 1).cast("string")), 256))
             .otherwise(F.lit("")).alias("previous_hash"),
            F.sha2(F.concat(F.lit("data:"), n.cast("string")), 256).alias("data_hash"),
        ).alias("header"),
        F.struct(F.transform("txs", lambda t: t["env"]).alias("data")).alias("data"),
    )


def write_blocks(blocks: DataFrame, path: str) -> None:
    """Block files under ``path``: JSON lines, one block per line, packed (base64 values and repeated keys shrink to a part)."""
    blocks.write.mode("overwrite").option("compression", "gzip").json(path)


_MATERIALIZED: dict[tuple, str] = {}


def _source_key(spark: SparkSession, sf_dir: str) -> tuple:
    """The application and the files read, so that tables written anew are derived anew."""
    files = [f for t in ("orders", "lineitem") for f in sorted(read_table(spark, sf_dir, t).inputFiles())]
    return (spark.sparkContext.applicationId, sf_dir, *files)


def ledger_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger derived from the tables, as block files, scanned with ``read_blocks``.

    In the order system the blocks already sit on storage and every ledger job
    reads them; here they are generated from the tables once per application
    and scale-factor folder, written as packed JSON lines under the shared checkpoint
    folder, and every caller reads those files through the block scanner.
    """
    from orderlake.session import scratch_path

    key = _source_key(spark, sf_dir)
    path = _MATERIALIZED.get(key)
    if path is not None:
        try:
            return read_blocks(spark, path, multi_line=False)
        except Exception:  # noqa: BLE001 - folder removed: derive it again
            _MATERIALIZED.pop(key, None)
    path = scratch_path(spark, "ledger_blocks")
    write_blocks(blocks_from_tables(spark, sf_dir), path)
    _MATERIALIZED[key] = path
    return read_blocks(spark, path, multi_line=False)


def ledger_blocks_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the materialised block files (see ``ledger_blocks``)."""
    ledger_blocks(spark, sf_dir)
    return _MATERIALIZED[_source_key(spark, sf_dir)]


def blocks_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks_from_rows(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem"))
