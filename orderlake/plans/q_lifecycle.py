"""Registered queries: lifecycle commands and replay over the event log derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlake.operators import ledger
from orderlake.operators import lifecycle as L
from orderlake.operators import lookups
from orderlake.operators.nest import nest_items
from orderlake.plans.registry import register
from orderlake.plans.sql_fragments import HEADER, with_views
from orderlake.session import scratch_path
from orderlake.sources import tables as T
from orderlake.sources.blocks import ledger_blocks
from orderlake.sources.events import events_sql, lifecycle_event_table

_EV = events_sql()
#: Parts in which the log arrives at the streamed replay.
STREAM_PARTS = 3
_CLEAN_LINES_N = """SELECT cast(l_orderkey AS varchar) AS orderId, count(*) AS n_items,
       cast(sum(cast(l_quantity AS integer)) AS bigint) AS units FROM lineitem GROUP BY l_orderkey"""


def _events(spark, sf):
    return lifecycle_event_table(spark, sf)


def _commands(spark, sf):
    """The event log without item lists (for commands that never read them)."""
    return lifecycle_event_table(spark, sf, with_details=False)


def _headers(spark, sf):
    return T.order_headers(T.read_table(spark, sf, "orders"))


def _org2_details(spark, sf):
    """Org2's private detail rows: one per order (lines nested, empty list when none)."""
    h = _headers(spark, sf).select("orderKey", "orderId")
    lines = T.order_lines(T.by_order(T.read_table(spark, sf, "lineitem"), "orderKey"), dirty=False)
    n = nest_items(lines, "orderKey", T.ITEM_COLS, sort_cols=["lineNumber"])
    j = h.join(n, "orderKey", "left")
    empty = F.array().cast("array<struct<productId:string,quantity:int,unitPrice:double,"
                           "discount:double,price:double>>")
    return j.select("orderId", F.struct(F.col("orderId").alias("orderId"), F.coalesce("items", empty).alias("items"),
                                        F.coalesce("total", F.lit(0.0)).alias("total")).alias("detail"))


def _units(items):
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda a, x: a + x["quantity"])


@register("first_create_wins", with_views(
    """SELECT orderId, block, tx, org FROM ev
       WHERE function = 'CreateOrder' AND org = 'Org2MSP' AND customerId IS NOT NULL AND has_meta AND has_details
       QUALIFY row_number() OVER (PARTITION BY orderId ORDER BY block, tx) = 1""", ev=_EV))
def q_first_create_wins(spark, sf):
    return L.first_create_wins(_commands(spark, sf), ["block", "tx", "org"]).select("orderId", "block", "tx", "org")


@register("create_orders", with_views(
    """SELECT orderId, sha256(customerId) AS customerIdHash, 'CREATED' AS status, FALSE AS approvedByOrg1,
              block, tx
       FROM ev
       WHERE function = 'CreateOrder' AND org = 'Org2MSP' AND customerId IS NOT NULL AND has_meta AND has_details
         AND orderId NOT IN (SELECT cast(o_orderkey AS varchar) FROM orders
                             WHERE o_orderkey // 5 + 1 <= (SELECT max(CASE o_orderstatus WHEN 'O' THEN 1 ELSE 4 END + o_orderkey // 5) FROM orders) // 2)
       QUALIFY row_number() OVER (PARTITION BY orderId ORDER BY block, tx) = 1""", ev=_EV))
def q_create_orders(spark, sf):
    """J5 against the state of the ledger at half its height; the commands come after that."""
    blocks = ledger_blocks(spark, sf)
    half = (ledger.ledger_height(blocks).first()["height"] - 1) // 2
    state = ledger.latest_order_state(ledger.order_writes(blocks).where(F.col("block_number") <= half))
    out = L.create_orders(state, _commands(spark, sf))
    return out.select("orderId", "customerIdHash", "status", "approvedByOrg1", "block", "tx")


@register("verify_customers", with_views(
    """SELECT ev.orderId, ev.block, ev.tx, r.reason IS NULL AS verified,
              CASE WHEN r.reason IS NULL THEN 'APPROVED' END AS status, r.reason
       FROM ev
       LEFT JOIN h ON h.orderId = ev.orderId
       CROSS JOIN LATERAL (SELECT CASE
            WHEN ev.org <> 'Org1MSP' THEN 'only Org1 can verify customer'
            WHEN h.customerIdHash IS NULL THEN 'order not found in world state'
            WHEN ev.customerId IS NULL THEN 'missing customerId'
            WHEN sha256(ev.customerId) <> h.customerIdHash THEN 'customer mismatch between Org1 and Org2'
            END AS reason) r
       WHERE ev.function = 'VerifyCustomer'""", ev=_EV, h=HEADER))
def q_verify_customers(spark, sf):
    claims = _commands(spark, sf).filter(F.col("function") == L.VERIFY)
    return L.verify_customers(_headers(spark, sf), claims)


_SHARE_SQL = with_views(
    """SELECT DISTINCT o.orderId, coalesce(n.n_items, 0) AS n_items, coalesce(n.units, 0) AS units
       FROM (SELECT cast(o_orderkey AS varchar) AS orderId FROM orders) o
       JOIN ev ON ev.orderId = o.orderId AND ev.function = 'ShareOrderDetailsToOrg1' AND ev.org = 'Org2MSP'
       LEFT JOIN n ON n.orderId = o.orderId""", ev=_EV, n=_CLEAN_LINES_N)


@register("share_details", _SHARE_SQL)
def q_share_details(spark, sf):
    reqs = _commands(spark, sf).filter(F.col("function") == L.SHARE)
    s = L.share_details(_org2_details(spark, sf), reqs)
    return s.select("orderId", F.size("detail.items").cast("bigint").alias("n_items"),
                    _units("detail.items").alias("units"))


@register("publish_orders", with_views(
    """SELECT h.orderId, h.status, s.n_items FROM h JOIN s USING (orderId) WHERE h.approvedByOrg1""",
    h=HEADER, s=_SHARE_SQL))
def q_publish_orders(spark, sf):
    reqs = _commands(spark, sf).filter(F.col("function") == L.SHARE)
    shared = L.share_details(_org2_details(spark, sf), reqs)
    p = L.publish_orders(_headers(spark, sf), shared)
    return p.select("orderId", "status", F.size("OrderDetail.items").cast("bigint").alias("n_items"))


# The replay rules in SQL: running windows over each order's events in ledger order.
_W = "(PARTITION BY orderId ORDER BY block, tx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_U = "(PARTITION BY orderId ORDER BY block, tx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_REPLAY_SQL = f"""
e0 AS (
  SELECT *,
    CASE WHEN function IN ('CreateOrder', 'ShareOrderDetailsToOrg1', 'CreateOrderAndApprove') THEN org = 'Org2MSP'
         WHEN function = 'VerifyCustomer' THEN org = 'Org1MSP'
         WHEN function = 'PublishOrderDetails' THEN org IN ('Org1MSP', 'Org2MSP')
         ELSE FALSE END AS org_ok,
    function IN ('CreateOrder', 'CreateOrderAndApprove') AND customerId IS NOT NULL AND has_meta AND has_details
        AS full_cl
  FROM ev),
e1 AS (SELECT *, org_ok AND full_cl AS valid_cl,
              coalesce(bool_or(org_ok AND full_cl) OVER {_W}, FALSE) AS exists_before FROM e0),
e2 AS (SELECT *, valid_cl AND (function = 'CreateOrderAndApprove' OR NOT exists_before) AS acc_cl FROM e1),
e3 AS (SELECT *, last_value(CASE WHEN acc_cl THEN sha256(customerId) END IGNORE NULLS) OVER {_W} AS hash_before,
              last_value(CASE WHEN acc_cl THEN block END IGNORE NULLS) OVER {_W} AS details_block
       FROM e2),
e4 AS (SELECT *,
         function = 'VerifyCustomer' AND org_ok AND exists_before AND customerId IS NOT NULL
           AND coalesce(sha256(customerId) = hash_before, FALSE) AS acc_verify,
         function = 'ShareOrderDetailsToOrg1' AND org_ok AND coalesce(block - details_block <= 1000, FALSE) AS acc_share
       FROM e3),
e5 AS (SELECT *,
         coalesce(last_value(CASE WHEN acc_cl AND function = 'CreateOrder' THEN FALSE
                                  WHEN (acc_cl AND function = 'CreateOrderAndApprove') OR acc_verify THEN TRUE END
                             IGNORE NULLS) OVER {_W}, FALSE) AS approved_before,
         coalesce(block - last_value(CASE WHEN acc_share OR (acc_cl AND function = 'CreateOrderAndApprove') THEN block END
                                     IGNORE NULLS) OVER {_W} <= 10, FALSE) AS shared_before
       FROM e4),
e6 AS (SELECT *, function = 'PublishOrderDetails' AND org_ok AND exists_before AND approved_before
                 AND shared_before AS acc_publish FROM e5),
e7 AS (SELECT *, acc_cl OR acc_verify OR acc_share OR acc_publish AS accepted,
         CASE WHEN acc_cl OR acc_verify OR acc_share OR acc_publish THEN NULL
              WHEN function = 'CreateOrder' AND NOT org_ok THEN 'only Org2 can create order'
              WHEN function = 'CreateOrder' AND exists_before THEN 'order ' || orderId || ' already exists'
              WHEN function = 'CreateOrder' THEN 'missing transient fields'
              WHEN function = 'VerifyCustomer' AND NOT org_ok THEN 'only Org1 can verify customer'
              WHEN function = 'VerifyCustomer' AND NOT exists_before THEN 'order not found in world state'
              WHEN function = 'VerifyCustomer' AND customerId IS NULL THEN 'missing customerId'
              WHEN function = 'VerifyCustomer' THEN 'customer mismatch between Org1 and Org2'
              WHEN function = 'ShareOrderDetailsToOrg1' AND NOT org_ok THEN 'only Org2 can share order details'
              WHEN function = 'ShareOrderDetailsToOrg1' THEN 'order details not found in Org2 private collection'
              WHEN function = 'PublishOrderDetails' AND NOT org_ok THEN 'only Org1 or Org2 can publish order'
              WHEN function = 'PublishOrderDetails' AND NOT exists_before THEN 'order not found'
              WHEN function = 'PublishOrderDetails' AND NOT approved_before THEN 'order not approved by Org1'
              WHEN function = 'PublishOrderDetails' THEN 'shared order details not found'
              WHEN function = 'CreateOrderAndApprove' AND NOT org_ok THEN 'only Org2 can create and approve order'
              WHEN function = 'CreateOrderAndApprove' THEN 'missing transient fields'
              ELSE 'unknown function' END AS reason
       FROM e6),
e8 AS (SELECT *,
         bool_or(acc_cl) OVER {_U} AS exists_after,
         last_value(CASE WHEN acc_cl AND function = 'CreateOrder' THEN 'CREATED'
                         WHEN (acc_cl AND function = 'CreateOrderAndApprove') OR acc_verify THEN 'APPROVED' END
                    IGNORE NULLS) OVER {_U} AS status_after,
         coalesce(last_value(CASE WHEN acc_cl AND function = 'CreateOrder' THEN FALSE
                                  WHEN (acc_cl AND function = 'CreateOrderAndApprove') OR acc_verify THEN TRUE END
                             IGNORE NULLS) OVER {_U}, FALSE) AS approved_after,
         last_value(CASE WHEN acc_cl THEN sha256(customerId) END IGNORE NULLS) OVER {_U} AS hash_after,
         last_value(CASE WHEN acc_cl AND function = 'CreateOrder' THEN 0
                         WHEN acc_cl AND function = 'CreateOrderAndApprove' THEN 1
                         WHEN acc_verify THEN 0 WHEN acc_publish THEN 1 END IGNORE NULLS) OVER {_U} AS detail_after
       FROM e7)"""


_LIFECYCLE_SQL = f"""WITH ev AS ({_EV}),
n AS ({_CLEAN_LINES_N}), h AS ({HEADER}),{_REPLAY_SQL}
SELECT orderId, customerIdHash, employee, freight, status, approvedByOrg1, has_detail, n_items, units, last_block FROM (
  SELECT e.orderId, e.hash_after AS customerIdHash, h.employee, h.freight, e.status_after AS status, e.approved_after AS approvedByOrg1,
         coalesce(e.detail_after = 1, FALSE) AS has_detail,
         CASE WHEN e.detail_after = 1 THEN cast(coalesce(n.n_items, 0) AS integer) END AS n_items,
         CASE WHEN e.detail_after = 1 THEN cast(coalesce(n.units, 0) AS bigint) END AS units,
         e.block AS last_block, e.exists_after
  FROM e8 e LEFT JOIN n ON n.orderId = e.orderId LEFT JOIN h ON h.orderId = e.orderId
  QUALIFY row_number() OVER (PARTITION BY e.orderId ORDER BY e.block DESC, e.tx DESC) = 1) f
WHERE exists_after"""

_REJECTED_SQL = f"""WITH ev AS ({_EV}),{_REPLAY_SQL}
SELECT orderId, block, tx, function, org, reason FROM e8 WHERE NOT accepted"""


@register("order_lifecycle", _LIFECYCLE_SQL)
def q_order_lifecycle(spark, sf):
    s = L.order_lifecycle(_events(spark, sf))
    return s.select("orderId", "customerIdHash", "employee", "freight", "status", "approvedByOrg1",
                    F.col("OrderDetail").isNotNull().alias("has_detail"),
                    F.size("OrderDetail.items").alias("n_items"), _units("OrderDetail.items").alias("units"), "last_block")


def _streamed(spark, sf):
    """The verdicts of the streamed replay; the log grows by a part of its blocks before each of several runs, which go on from
    the state of the run before."""
    from orderlake.streaming import lifecycle as stream

    events, source, log, checkpoint = _events(spark, sf), *(scratch_path(spark, n) for n in ("event_stream", "verdicts", "replay_ckpt"))
    last = events.agg(F.max("block")).first()[0] or 0
    for part in range(STREAM_PARTS):
        rows = events.where((F.col("block") * STREAM_PARTS >= part * (last + 1)) & (F.col("block") * STREAM_PARTS < (part + 1) * (last + 1)))
        rows.write.mode("append").parquet(source)
        q = stream.run_replay(spark.readStream.schema(events.schema).parquet(source), log, checkpoint)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return spark.read.parquet(log), events


@register("stream_lifecycle", _LIFECYCLE_SQL)
def q_stream_lifecycle(spark, sf):
    """C1 as a stream with one small state per order."""
    from orderlake.streaming import lifecycle as stream

    s = stream.current_orders(*_streamed(spark, sf))
    return s.select("orderId", "customerIdHash", F.col("meta.employee").alias("employee"), F.col("meta.freight").alias("freight"), "status",
                    "approvedByOrg1", F.col("OrderDetail").isNotNull().alias("has_detail"), F.size("OrderDetail.items").alias("n_items"),
                    _units("OrderDetail.items").alias("units"), "last_block")


@register("approved_details_state", f"""SELECT orderId, CASE WHEN has_detail THEN orderId END AS detailOrderId, n_items, units
FROM ({_LIFECYCLE_SQL}) s WHERE approvedByOrg1""")
def q_approved_details_state(spark, sf):
    """P14 on the replayed state, where approved orders may have no details: those of a late verification."""
    d = lookups.approved_order_details(L.order_lifecycle(_events(spark, sf)))
    return d.select("orderId", "detailOrderId", F.size("items").alias("n_items"), _units("items").alias("units"))


@register("published_state", f"SELECT orderId, status, approvedByOrg1, n_items, units FROM ({_LIFECYCLE_SQL}) s WHERE has_detail")
def q_published_state(spark, sf):
    """P15 on the replayed state: orders without details are left out."""
    p = lookups.published_orders(L.order_lifecycle(_events(spark, sf)))
    return p.select("orderId", "status", "approvedByOrg1", F.size("OrderDetail.items").alias("n_items"), _units("OrderDetail.items").alias("units"))


@register("rejected_events", _REJECTED_SQL)
def q_rejected_events(spark, sf):
    return L.rejected_events(_commands(spark, sf))


@register("live_private_details", f"""WITH ev AS ({_EV}),{_REPLAY_SQL}
SELECT collection, orderId, max(block) AS block FROM (
  SELECT 'Org2MSPOrderDetailsCollection' AS collection, 1000 AS ttl, orderId, block FROM e8
  WHERE accepted AND function IN ('CreateOrder', 'CreateOrderAndApprove')
  UNION ALL
  SELECT 'Org1Org2OrderDetailsShared', 10, orderId, block FROM e8
  WHERE accepted AND function IN ('ShareOrderDetailsToOrg1', 'CreateOrderAndApprove'))
GROUP BY collection, orderId, ttl HAVING (SELECT max(block) FROM ev) - max(block) <= ttl""")
def q_live_private_details(spark, sf):
    """Private rows of accepted commands that are still kept at the ledger's height."""
    ev = _commands(spark, sf)
    # the ledger height is one scalar aggregate; it enters the plan as a literal
    current = ev.agg(F.max("block").alias("b")).first()["b"]
    live = L.live_private_details(L.private_writes(L.replay(ev)), current)
    return live.select("collection", "orderId", "block")
