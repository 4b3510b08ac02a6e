"""Order life cycle: set-based commands (J3-J6, W2, C3, C4) and event replay.

Event rows: orderId, block, tx, function, org, customerId, order (meta
struct), orderDetails (struct<total, items>). Ledger order is (block, tx).

Replay is expressed as running aggregates in ledger order (``block, tx``):
every rule of the contract depends only on "was there an accepted X before
this event" or "the first / last accepted Y before this event". Those scans
are associative, so they run in two levels (``scan_before``): inside
(order, block-range chunk) partitions, plus a carry-in from a scan over
one-row chunk summaries. A hot order spreads over many chunks and tasks, any other has its
whole history in one; the final state is a plain aggregation per order. The scans carry ledger positions only: an
order's metadata and details are joined once, at the end, by the position of the command that supplied them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions import sha256_hex

# Fixed values of the contract: function names, organisations, collections.
CREATE = "CreateOrder"
VERIFY = "VerifyCustomer"
SHARE = "ShareOrderDetailsToOrg1"
PUBLISH = "PublishOrderDetails"
CREATE_APPROVE = "CreateOrderAndApprove"
ORG1 = "Org1MSP"
ORG2 = "Org2MSP"

#: Commands of an order that one task scans at once; a longer history is cut into chunks.
HOT_COMMANDS = 100_000

# Rejection messages, as the contract words them.
MSG = {
    "create_org": "only Org2 can create order",
    "create_exists": "order <orderId> already exists",
    "missing_transient": "missing transient fields",
    "verify_org": "only Org1 can verify customer",
    "verify_not_found": "order not found in world state",
    "verify_missing": "missing customerId",
    "verify_mismatch": "customer mismatch between Org1 and Org2",
    "share_org": "only Org2 can share order details",
    "share_not_found": "order details not found in Org2 private collection",
    "publish_org": "only Org1 or Org2 can publish order",
    "publish_not_found": "order not found",
    "publish_not_approved": "order not approved by Org1",
    "publish_not_shared": "shared order details not found",
    "caa_org": "only Org2 can create and approve order",
    "unknown": "unknown function",
}

# Private data collections and their retention in blocks (blockToLive).
COLLECTION_TTL = {
    "Org1MSPCustomerCollection": 1000,
    "Org1Org2OrdersCollection": 1000,
    "Org1Org2OrderDetailsShared": 10,
    "Org2MSPOrderDetailsCollection": 1000,
}
ORG2_DETAILS = "Org2MSPOrderDetailsCollection"
SHARED_DETAILS = "Org1Org2OrderDetailsShared"


def scan_before(df: DataFrame, key: str, chunk, order: list[str], specs) -> DataFrame:
    """Running aggregates over the strictly earlier rows of the same ``key``, in ``order``.

    ``specs``: (name, kind, value, cond) with kind ``any`` (was ``cond`` true
    before), ``first`` / ``last`` (``value`` of the first / last earlier row
    where ``cond`` holds). Adds one column per spec.

    Two levels, so a key with a huge history is not one task: rows are
    scanned inside (key, chunk) partitions, each chunk is reduced to a
    one-row summary, and a scan over the summaries of a key gives every chunk
    its carry-in; a key's first chunk has none. Only the summaries (one small
    row per key and chunk) are shuffled again.

    ``chunk``: an expression, or the name of a column that stays: rows dealt out by ``key`` and that column
    (``by_chunk``) are scanned where they are, in this scan and in later ones. Null in such a column says that the
    partition holds the key's whole history, so it has no summary.
    """
    named = isinstance(chunk, str)
    part = chunk if named else "_chunk"
    df = df if named else df.withColumn(part, chunk)
    w = Window.partitionBy(key, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ordk = F.struct(*[F.col(c) for c in order])
    local, summ = df, []
    for name, kind, value, cond in specs:
        if kind == "any":
            local = local.withColumn(f"_l_{name}", F.max(cond.cast("int")).over(w) == 1)
            summ.append(F.max(cond.cast("int")).alias(f"_s_{name}"))
        else:
            tagged = F.when(cond, F.struct(ordk.alias("o"), value.alias("v")))
            agg = F.max if kind == "last" else F.min
            win = F.last if kind == "last" else F.first
            local = local.withColumn(f"_l_{name}", win(tagged, ignorenulls=True).over(w)["v"])
            summ.append(agg(tagged).alias(f"_s_{name}"))
    summary = (df.where(F.col(part).isNotNull()) if named else df).groupBy(key, part).agg(*summ)
    wc = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    carry_cols = []
    for name, kind, _, _ in specs:
        if kind == "any":
            carry_cols.append((F.max(f"_s_{name}").over(wc) == 1).alias(f"_c_{name}"))
        else:
            win = F.last if kind == "last" else F.first
            carry_cols.append(win(f"_s_{name}", ignorenulls=True).over(wc)["v"].alias(f"_c_{name}"))
    # most keys have a single chunk: their summaries go no further
    carry = summary.select(key, part, *carry_cols, F.row_number().over(Window.partitionBy(key).orderBy(part)).alias("_nth")) \
                   .where(F.col("_nth") > 1).drop("_nth")
    out = local.join(carry, [key, part], "left")
    for name, kind, _, _ in specs:
        lc, cc = F.col(f"_l_{name}"), F.col(f"_c_{name}")
        if kind == "any":
            v = F.coalesce(lc, F.lit(False)) | F.coalesce(cc, F.lit(False))
        elif kind == "last":
            v = F.when(lc.isNotNull(), lc).otherwise(cc)
        else:
            v = F.when(cc.isNotNull(), cc).otherwise(lc)
        out = out.withColumn(name, v).drop(f"_l_{name}", f"_c_{name}")
    return out if named else out.drop(part)


def by_chunk(df: DataFrame, key: str, chunk: str, value: Column, hot: int) -> DataFrame:
    """``df`` dealt out by ``key`` and, for keys of more than ``hot`` rows, by ``value``, the new column ``chunk`` (null for other keys).

    Into as many parts as the session shuffles to (not fewer: rows grow in the scans). There are at most rows / ``hot`` hot keys,
    so they are broadcast.
    """
    spread = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot).select(key, F.lit(True).alias("_hot"))
    df = df.join(F.broadcast(spread), key, "left").withColumn(chunk, F.when(F.col("_hot"), F.coalesce(value, F.lit(-1)))).drop("_hot")
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key, chunk)


def _here() -> Column:
    """The position of this command, by which its order and details are found again."""
    return F.struct("block", "tx")


def replay(events: DataFrame, chunk_blocks: int = 1024, with_state: bool = False, hot: int = HOT_COMMANDS) -> DataFrame:
    """C1 + C2 per event (orderId, block, tx, function, org): ``accepted`` and the rejection ``reason`` (null when accepted).

    With ``with_state`` the state after each event is added: ``exists``,
    ``customerIdHash``, ``meta``, ``status``, ``approved``, ``detail``.

    Histories of more than ``hot`` commands are cut into chunks of ``chunk_blocks`` blocks; a ledger block
    holds a bounded number of transactions, so a chunk is bounded too.
    """
    key, order = "orderId", ["block", "tx"]
    chunk = "_chunk"
    fn, org = F.col("function"), F.col("org")
    is_create, is_caa = fn == CREATE, fn == CREATE_APPROVE
    org_ok = (F.when(fn.isin(CREATE, SHARE, CREATE_APPROVE), org == ORG2)
               .when(fn == VERIFY, org == ORG1)
               .when(fn == PUBLISH, org.isin(ORG1, ORG2))
               .otherwise(F.lit(False)))
    created = F.struct(F.col("_customer").alias("customer"), _here().alias("at"), F.col("block").alias("block"))
    nowhere = F.lit(None).cast(events.select(_here().alias("at")).schema["at"].dataType)

    def held(written: str, collection: str):
        """Whether a private row written in that block is still kept at this event."""
        return F.coalesce(F.col("block") - F.col(written) <= COLLECTION_TTL[collection], F.lit(False))

    # customers travel as their ids, which are equal when their hashes are and take a tenth of them
    e = by_chunk(events.select("orderId", "block", "tx", "function", "org", F.col("customerId").cast("string").alias("_customer"),
                               _complete().alias("_full")), key, chunk, F.floor(F.col("block") / F.lit(chunk_blocks)), hot)
    e = (e.withColumn("_org_ok", F.coalesce(org_ok, F.lit(False)))
          .withColumn("_valid_cl", F.coalesce((is_create | is_caa) & org_ok & F.col("_full"), F.lit(False))))

    # Pass 1: a create is accepted only when no valid create-like event came before;
    # create-and-approve always overwrites. The last accepted create-like before an
    # event is the last valid create-and-approve, else the first valid create-like.
    e = scan_before(e, key, chunk, order, [
        ("_exists_before", "any", None, F.col("_valid_cl")),
        ("_last_caa", "last", created, F.col("_valid_cl") & is_caa),
        ("_first_cl", "first", created, F.col("_valid_cl")),
    ])
    e = (e.withColumn("_acc_cl", F.col("_valid_cl") & (is_caa | ~F.col("_exists_before")))
          .withColumn("_cur", F.coalesce("_last_caa", "_first_cl"))
          .drop("_last_caa", "_first_cl"))

    # Pass 2: verify and share (row-local given pass 1).
    claim_ok = F.coalesce(F.col("_customer") == F.col("_cur.customer"), F.lit(False))
    e = (e.withColumn("_acc_verify", (fn == VERIFY) & F.col("_org_ok") & F.col("_exists_before") &
                      F.col("_customer").isNotNull() & claim_ok)
          .withColumn("_acc_share", (fn == SHARE) & F.col("_org_ok") & held("_cur.block", ORG2_DETAILS)))

    # Pass 3: approval and shared details before each event; publish.
    approval_event = F.when(F.col("_acc_cl") & is_create, F.lit(False)) \
                      .when((F.col("_acc_cl") & is_caa) | F.col("_acc_verify"), F.lit(True))
    shared_event = F.when(F.col("_acc_cl") & is_caa, F.struct(_here().alias("at"), F.col("block"))) \
                    .when(F.col("_acc_share"), F.struct(F.col("_cur.at").alias("at"), F.col("block")))
    e = scan_before(e, key, chunk, order, [
        ("_approval_before", "last", approval_event, approval_event.isNotNull()),
        ("_shared_before", "last", shared_event, shared_event.isNotNull()),
    ])
    e = e.withColumn("_approved_before", F.coalesce("_approval_before", F.lit(False)))
    e = e.withColumn("_acc_publish", (fn == PUBLISH) & F.col("_org_ok") & F.col("_exists_before") &
                     F.col("_approved_before") & held("_shared_before.block", SHARED_DETAILS))

    accepted = F.col("_acc_cl") | F.col("_acc_verify") | F.col("_acc_share") | F.col("_acc_publish")
    reason = (
        F.when(accepted, F.lit(None).cast("string"))
        .when(is_create & ~F.col("_org_ok"), MSG["create_org"])
        .when(is_create & F.col("_exists_before"),
              F.concat(F.lit("order "), F.col("orderId"), F.lit(" already exists")))
        .when(is_create, MSG["missing_transient"])
        .when((fn == VERIFY) & ~F.col("_org_ok"), MSG["verify_org"])
        .when((fn == VERIFY) & ~F.col("_exists_before"), MSG["verify_not_found"])
        .when((fn == VERIFY) & F.col("_customer").isNull(), MSG["verify_missing"])
        .when(fn == VERIFY, MSG["verify_mismatch"])
        .when((fn == SHARE) & ~F.col("_org_ok"), MSG["share_org"])
        .when(fn == SHARE, MSG["share_not_found"])
        .when((fn == PUBLISH) & ~F.col("_org_ok"), MSG["publish_org"])
        .when((fn == PUBLISH) & ~F.col("_exists_before"), MSG["publish_not_found"])
        .when((fn == PUBLISH) & ~F.col("_approved_before"), MSG["publish_not_approved"])
        .when(fn == PUBLISH, MSG["publish_not_shared"])
        .when(is_caa & ~F.col("_org_ok"), MSG["caa_org"])
        .when(is_caa, MSG["missing_transient"])
        .otherwise(MSG["unknown"])
    )
    e = (e.withColumn("accepted", accepted).withColumn("reason", reason)
          .withColumn("_created", F.when(F.col("_acc_cl"), created))
          .withColumn("_status_event", F.when(F.col("_acc_cl") & is_create, F.lit("CREATED"))
                      .when((F.col("_acc_cl") & is_caa) | F.col("_acc_verify"), F.lit("APPROVED")))
          .withColumn("_approval_event", approval_event)
          .withColumn("_detail_event",
                      F.when(F.col("_acc_cl") & is_create, F.struct(F.lit(0).alias("k"), nowhere.alias("at")))
                       .when(F.col("_acc_cl") & is_caa, F.struct(F.lit(1).alias("k"), _here().alias("at")))
                       .when(F.col("_acc_verify"), F.struct(F.lit(0).alias("k"), nowhere.alias("at")))
                       .when(F.col("_acc_publish"), F.struct(F.lit(1).alias("k"), F.col("_shared_before.at").alias("at")))))
    if with_state:
        e = scan_before(e, key, chunk, order, [
            ("_created_before", "last", F.col("_created"), F.col("_created").isNotNull()),
            ("_status_before", "last", F.col("_status_event"), F.col("_status_event").isNotNull()),
            ("_detail_before", "last", F.col("_detail_event"), F.col("_detail_event").isNotNull()),
        ])
        cur = F.coalesce("_created", "_created_before")
        e = (e.withColumn("exists", F.col("_exists_before") | F.col("_acc_cl"))
              .withColumn("customerIdHash", sha256_hex(cur["customer"]))
              .withColumn("_made_at", cur["at"])
              .withColumn("status", F.coalesce("_status_event", "_status_before"))
              .withColumn("approved", F.coalesce("_approval_event", "_approved_before"))
              .withColumn("_detail_at", F.coalesce("_detail_event", "_detail_before")["at"]))
        e = supplied(supplied(e, events, "_made_at", "meta"), events, "_detail_at", "detail")
    return e.drop(*[c for c in e.columns if c.startswith("_") and c not in _STATE_INPUTS])


def _complete() -> Column:
    return F.col("customerId").isNotNull() & F.col("order").isNotNull() & F.col("orderDetails").isNotNull()


def supplied(rows: DataFrame, events: DataFrame, at: str, name: str) -> DataFrame:
    """``rows`` plus ``name``: the metadata or the details that the command at position ``at`` of the same order supplied."""
    what = F.col("order") if name == "meta" else F.struct(
        F.col("orderId").alias("orderId"), F.col("orderDetails.items").alias("items"), F.col("orderDetails.total").alias("total"))
    supply = events.where(F.col("function").isin(CREATE, CREATE_APPROVE) & _complete()).select(
        F.col("orderId").alias("_order"), F.col("block").alias("_block"), F.col("tx").alias("_tx"), what.alias(name))
    same = (F.col("orderId") == F.col("_order")) & (F.col(f"{at}.block") == F.col("_block")) & (F.col(f"{at}.tx") == F.col("_tx"))
    return rows.join(supply, same, "left").drop("_order", "_block", "_tx")


# Per-event columns that ``final_state`` folds (kept by ``replay``).
_STATE_INPUTS = ("_acc_cl", "_created", "_status_event", "_approval_event", "_detail_event")


def final_state(replayed: DataFrame, events: DataFrame) -> DataFrame:
    """State of every order after its last event (public order model).

    A plain aggregation per order (the latest contribution of each kind,
    by ledger position), combined map-side, so a hot order is reduced before
    the shuffle; then ``events`` supply metadata and details of the positions that won.
    """
    o = F.struct("block", "tx")

    def latest(col):
        return F.max(F.when(F.col(col).isNotNull(), F.struct(o.alias("o"), F.col(col).alias("v"))))["v"]

    last = replayed.groupBy("orderId").agg(
        F.max(F.col("_acc_cl").cast("int")).alias("_exists"),
        latest("_created").alias("_c"),
        latest("_status_event").alias("status"),
        latest("_approval_event").alias("_approved"),
        latest("_detail_event").alias("_d"),
        F.max("block").alias("last_block"),
    )
    m = F.col("meta")
    state = last.filter(F.col("_exists") == 1).withColumns({"_made_at": F.col("_c.at"), "_detail_at": F.col("_d.at")})
    return supplied(supplied(state, events, "_made_at", "meta"), events, "_detail_at", "detail").select(
        "orderId",
        sha256_hex(F.col("_c.customer")).alias("customerIdHash"),
        m["employee"].alias("employee"), m["orderDate"].alias("orderDate"),
        m["requiredDate"].alias("requiredDate"), m["shippedDate"].alias("shippedDate"),
        m["shipperID"].alias("shipperID"), m["freight"].alias("freight"),
        "status", F.coalesce("_approved", F.lit(False)).alias("approvedByOrg1"),
        F.col("detail").alias("OrderDetail"),
        "last_block",
    )


def order_lifecycle(events: DataFrame, chunk_blocks: int = 1024, hot: int = HOT_COMMANDS) -> DataFrame:
    return final_state(replay(events, chunk_blocks, hot=hot), events)


def rejected_events(events: DataFrame, chunk_blocks: int = 1024, hot: int = HOT_COMMANDS) -> DataFrame:
    """Every rejected event with the contract's reason."""
    return replay(events, chunk_blocks, hot=hot).filter(~F.col("accepted")).select(
        "orderId", "block", "tx", "function", "org", "reason")


# ---------------------------------------------------------------- set-based commands
def first_create_wins(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The first valid ``CreateOrder`` per order (later ones would be rejected), with the columns ``keep`` (default: all).

    Valid = submitted by Org2 with customer id, metadata and details present.
    """
    creates = events.filter((F.col("function") == CREATE) & (F.col("org") == ORG2) & F.col("customerId").isNotNull() &
                            F.col("order").isNotNull() & F.col("orderDetails").isNotNull())
    # The position (long block, int tx; nulls first) as one number: numbers are kept in a hash table, whereas an aggregate that
    # holds texts or structs sorts every row before and after the shuffle. Function and organisation follow from the filter.
    at = (F.coalesce("block", F.lit(-2 ** 63)).cast("decimal(20,0)") * F.lit(2 ** 32).cast("decimal(11,0)")
          + F.coalesce("tx", F.lit(-2 ** 31)).cast("decimal(11,0)"))
    known = {"function": F.lit(CREATE), "org": F.lit(ORG2)}
    keep = [c for c in (keep or creates.columns) if c != "orderId"]
    rest = [c for c in keep if c not in ("block", "tx", *known)]
    first = creates.groupBy("orderId").agg(F.min_by("block", at).alias("block"), F.min_by("tx", at).alias("tx"),
                                           *([F.min_by(F.struct(*rest), at).alias("_rest")] if rest else []))
    return first.select("orderId", *[F.col(f"_rest.{c}").alias(c) if c in rest else known.get(c, F.col(c)).alias(c) for c in keep])


def create_orders(state: DataFrame, requests: DataFrame) -> DataFrame:
    """Accepted creates = first valid request per id whose id is not in ``state``.

    Output rows follow the header model with status CREATED, not approved.
    """
    first = first_create_wins(requests, ["block", "tx", "customerId", "order"])
    new = first.join(state.select("orderId"), "orderId", "left_anti")
    m = F.col("order")
    return new.select(
        "orderId", sha256_hex("customerId").alias("customerIdHash"),
        m["employee"].alias("employee"), m["orderDate"].alias("orderDate"),
        m["requiredDate"].alias("requiredDate"), m["shippedDate"].alias("shippedDate"),
        m["shipperID"].alias("shipperID"), m["freight"].alias("freight"),
        F.lit("CREATED").alias("status"), F.lit(False).alias("approvedByOrg1"),
        "block", "tx",
    )


def verify_customers(state: DataFrame, claims: DataFrame) -> DataFrame:
    """Check each claim (orderId, org, customerId) against the stored hash.

    Left join keeps claims on missing orders (reason "not found").
    """
    s = state.select("orderId", "customerIdHash")
    j = claims.join(s, "orderId", "left")
    ok_org = F.col("org") == ORG1
    found = F.col("customerIdHash").isNotNull()
    match = sha256_hex("customerId") == F.col("customerIdHash")
    reason = (F.when(~ok_org, MSG["verify_org"])
               .when(~found, MSG["verify_not_found"])
               .when(F.col("customerId").isNull(), MSG["verify_missing"])
               .when(~match, MSG["verify_mismatch"]))
    verified = reason.isNull()
    return j.select("orderId", "block", "tx", verified.alias("verified"),
                    F.when(verified, "APPROVED").alias("status"), reason.alias("reason"))


def share_details(org2_details: DataFrame, requests: DataFrame) -> DataFrame:
    """Detail rows of the requested orders, copied to the shared collection."""
    # Requests are reduced to distinct ids first (map-side), so an order requested
    # many times cannot make one join partition huge.
    req = requests.filter(F.col("org") == ORG2).select("orderId").distinct()
    return org2_details.join(req, "orderId", "left_semi")


def publish_orders(state: DataFrame, shared: DataFrame) -> DataFrame:
    """Approved orders joined with their shared details -> published documents."""
    return (state.filter(F.col("approvedByOrg1") == F.lit(True)).drop("OrderDetail")
                 .join(shared.select("orderId", F.col("detail").alias("OrderDetail")), "orderId", "inner"))


def private_writes(replayed: DataFrame) -> DataFrame:
    """(collection, orderId, block) of the last accepted write of each private detail row; a create with approval
    writes both collections."""
    fn = F.col("function")
    written = F.when(fn == CREATE, F.array(F.lit(ORG2_DETAILS))).when(fn == SHARE, F.array(F.lit(SHARED_DETAILS))).when(
        fn == CREATE_APPROVE, F.array(F.lit(ORG2_DETAILS), F.lit(SHARED_DETAILS)))
    return (replayed.filter("accepted").select(F.explode(written).alias("collection"), "orderId", "block")
                    .groupBy("collection", "orderId").agg(F.max("block").alias("block")))


def live_private_details(rows: DataFrame, current_block, ttl: dict | None = None) -> DataFrame:
    """Private rows still held at ``current_block`` (age <= blockToLive of their collection).

    The policy table has one row per configured collection, so it is
    broadcast (its size is fixed by the configuration, not by the data).
    """
    ttl = ttl or COLLECTION_TTL
    spark = rows.sparkSession
    policy = spark.createDataFrame(sorted(ttl.items()), "collection string, blockToLive int")
    cb = current_block if not isinstance(current_block, (int, float)) else F.lit(int(current_block))
    return (rows.join(F.broadcast(policy), "collection", "inner")
                .filter(cb - F.col("block") <= F.col("blockToLive")))
