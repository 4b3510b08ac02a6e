"""Registered queries: bronze -> silver -> gold, lookups, nesting."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlake.operators import gold, lookups, nest, silver
from orderlake.plans.registry import register
from orderlake.plans.sql_fragments import HEADER, ITEMS, LINES, RAW_ITEMS, SILVER_HEADER, with_views
from orderlake.sources import tables as T

# Fixed query parameters (shared with the oracle SQL below).
AS_OF = "2002-01-01"          # recency reference date for customer_rfm
LOOKUP_ORDER_ID = "1"         # read_order
LOOKUP_CUSTOMER_ID = "7"      # orders_by_customer


def bronze(spark, sf):
    return T.bronze_documents(spark, sf, dirty=True)


def silver_tables(spark, sf):
    return silver.bronze_to_silver(bronze(spark, sf))


def order_state(spark, sf):
    """Current public order documents (typed), derived from the tables."""
    return T.typed_documents(T.read_table(spark, sf, "orders"), T.read_table(spark, sf, "lineitem"))


# ---------------------------------------------------------------- silver
@register("silver_orders_header", SILVER_HEADER)
def q_silver_orders_header(spark, sf):
    return silver.orders_header(bronze(spark, sf))


@register("silver_orders_items", ITEMS)
def q_silver_orders_items(spark, sf):
    return silver.orders_items(bronze(spark, sf))


@register("discount_repair", with_views(
    """SELECT orderId, productId, discount AS rawDiscount,
              CASE WHEN discount < 0 OR discount > 1 THEN cast(0 AS double) ELSE discount END AS discount
       FROM r WHERE discount IS NULL OR discount < 0 OR discount > 1""", r=RAW_ITEMS))
def q_discount_repair(spark, sf):
    r = silver.raw_items(bronze(spark, sf))
    d = F.col("discount")
    return (r.filter(d.isNull() | (d < 0) | (d > 1))
             .select("orderId", "productId", d.alias("rawDiscount"), silver.repair_discount(d).alias("discount")))


@register("price_lines", with_views(
    """SELECT cast(orderKey AS varchar) AS orderId, productId, quantity, unitPrice,
              coalesce(discount, cast(0 AS double)) AS discount,
              unitPrice * quantity * (1 - coalesce(discount, cast(0 AS double))) AS price
       FROM l""", l=LINES))
def q_price_lines(spark, sf):
    lines = T.order_lines(T.read_table(spark, sf, "lineitem"), dirty=True)
    return nest.price_lines(lines).select(
        F.col("orderKey").cast("string").alias("orderId"), "productId", "quantity", "unitPrice",
        "discount", "price")


@register("table_counts", with_views(
    "SELECT (SELECT count(*) FROM h) AS header_rows, (SELECT count(*) FROM i) AS items_rows",
    h=SILVER_HEADER, i=ITEMS))
def q_table_counts(spark, sf):
    h, i = silver_tables(spark, sf)
    tagged = h.select(F.lit(1).alias("h"), F.lit(0).alias("i")).unionByName(
        i.select(F.lit(0).alias("h"), F.lit(1).alias("i")))
    return tagged.agg(F.sum("h").cast("bigint").alias("header_rows"), F.sum("i").cast("bigint").alias("items_rows"))


# ---------------------------------------------------------------- gold
@register("items_with_header", with_views(
    """SELECT i.*, h.customerIdHash, h.orderDate FROM i JOIN h USING (orderId)""",
    h=SILVER_HEADER, i=ITEMS))
def q_items_with_header(spark, sf):
    h, i = silver_tables(spark, sf)
    return gold.items_with_header(i, h)


@register("product_monthly", with_views(
    """SELECT i.productId, cast(year(h.orderDate) AS integer) AS year,
              cast(month(h.orderDate) AS integer) AS month,
              cast(sum(i.quantity) AS bigint) AS totalSold, sum(i.price) AS totalRevenue,
              avg(i.unitPrice) AS avgPrice
       FROM i JOIN h USING (orderId) GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""",
    h=SILVER_HEADER, i=ITEMS))
def q_product_monthly(spark, sf):
    h, i = silver_tables(spark, sf)
    return gold.product_monthly(i, h)


@register("customer_rfm", with_views(
    f"""SELECT customerIdHash, max(h.orderDate) AS lastOrder, count(i.orderId) AS frequency,
               sum(i.price) AS monetary,
               cast(date_diff('day', cast(max(h.orderDate) AS date), DATE '{AS_OF}') AS integer) AS recency
        FROM i JOIN h USING (orderId) GROUP BY customerIdHash""",
    h=SILVER_HEADER, i=ITEMS))
def q_customer_rfm(spark, sf):
    h, i = silver_tables(spark, sf)
    return gold.customer_rfm(i, h, as_of=AS_OF)


_STATS_SQL = """SELECT productId, avg(unitPrice) AS avgPrice, min(unitPrice) AS minPrice,
       max(unitPrice) AS maxPrice, avg(quantity) AS avgQuantity, cast(sum(quantity) AS bigint) AS qtySold
FROM i GROUP BY productId"""


@register("product_stats", with_views(_STATS_SQL, i=ITEMS))
def q_product_stats(spark, sf):
    _, i = silver_tables(spark, sf)
    return gold.product_stats(i)


@register("product_anomaly", with_views(
    """SELECT *, minPrice < avgPrice * 0.4 AS lowPriceAnomaly, maxPrice > avgPrice * 2.0 AS highPriceAnomaly,
              qtySold > avgQuantity * 3.0 AS highQuantityAnomaly FROM s""",
    i=ITEMS, s=_STATS_SQL))
def q_product_anomaly(spark, sf):
    _, i = silver_tables(spark, sf)
    return gold.product_anomaly(i)


_GOLD_ORDERS_SQL = """SELECT orderId, orderDate, requiredDate, shippedDate, freight, approvedByOrg1,
       freight AS total_amount, freight AS avg_price, 1 AS num_items FROM h"""


@register("gold_orders", with_views(_GOLD_ORDERS_SQL, h=SILVER_HEADER))
def q_gold_orders(spark, sf):
    h, _ = silver_tables(spark, sf)
    return gold.gold_orders(h)


@register("lowercase_columns", with_views(
    """SELECT orderId AS orderid, orderDate AS orderdate, requiredDate AS requireddate,
              shippedDate AS shippeddate, freight, approvedByOrg1 AS approvedbyorg1,
              total_amount, avg_price, num_items FROM g""",
    h=SILVER_HEADER, g=_GOLD_ORDERS_SQL))
def q_lowercase_columns(spark, sf):
    h, _ = silver_tables(spark, sf)
    return gold.lowercase_columns(gold.gold_orders(h), restore=())


@register("sql_adhoc", with_views(
    """SELECT status, count(*) AS orders, cast(sum(i_rows) AS bigint) AS item_rows,
              cast(sum(qty) AS bigint) AS units
       FROM (SELECT h.orderId, h.status, count(i.orderId) AS i_rows, coalesce(sum(i.quantity), 0) AS qty
             FROM h LEFT JOIN i ON h.orderId = i.orderId GROUP BY h.orderId, h.status) t
       GROUP BY status""",
    h=SILVER_HEADER, i=ITEMS))
def q_sql_adhoc(spark, sf):
    """SQL over the silver tables registered as temporary views."""
    h, i = silver_tables(spark, sf)
    h.createOrReplaceTempView("orders_header")
    i.createOrReplaceTempView("orders_items")
    # Items are aggregated per order before the outer join (map-side combine), so the
    # join sees one row per order on both sides whatever the skew of the items.
    return spark.sql("""
        SELECT status, count(*) AS orders, sum(coalesce(i_rows, 0)) AS item_rows,
               sum(coalesce(qty, 0)) AS units
        FROM orders_header h
        LEFT JOIN (SELECT orderId, count(*) AS i_rows, sum(quantity) AS qty
                   FROM orders_items GROUP BY orderId) i ON h.orderId = i.orderId
        GROUP BY status""")


# ---------------------------------------------------------------- lookups
_STATE_HEADER_SQL = f"""SELECT orderId, customerIdHash, employee,
       strftime(orderDate, '%Y-%m-%d %H:%M:%S') AS orderDate,
       strftime(requiredDate, '%Y-%m-%d %H:%M:%S') AS requiredDate,
       coalesce(strftime(shippedDate, '%Y-%m-%d %H:%M:%S'), '') AS shippedDate,
       shipperID, freight, status, approvedByOrg1, customerId, orderKey
FROM ({HEADER}) h"""
_HDR_COLS = ("orderId, customerIdHash, employee, orderDate, requiredDate, shippedDate, shipperID, "
             "freight, status, approvedByOrg1")


@register("read_order", with_views(
    f"SELECT {_HDR_COLS} FROM s WHERE orderId = '{LOOKUP_ORDER_ID}'", s=_STATE_HEADER_SQL))
def q_read_order(spark, sf):
    return lookups.read_order(order_state(spark, sf), LOOKUP_ORDER_ID)


@register("orders_by_customer", with_views(
    f"SELECT {_HDR_COLS} FROM s WHERE customerIdHash = sha256('{LOOKUP_CUSTOMER_ID}')",
    s=_STATE_HEADER_SQL))
def q_orders_by_customer(spark, sf):
    return lookups.orders_by_customer(order_state(spark, sf), LOOKUP_CUSTOMER_ID)


@register("read_all_orders", with_views(f"SELECT {_HDR_COLS} FROM s ORDER BY orderId", s=_STATE_HEADER_SQL))
def q_read_all_orders(spark, sf):
    return lookups.read_all_orders(order_state(spark, sf))


# Per-order item summary of the documents (all lines of existing orders, dirty values).
_DOC_ITEMS_SQL = f"""SELECT cast(orderKey AS varchar) AS orderId, count(*) AS n_items,
       cast(sum(quantity) AS bigint) AS units
FROM ({LINES}) l GROUP BY orderKey"""


@register("approved_order_details", with_views(
    """SELECT s.orderId, s.orderId AS detailOrderId, coalesce(d.n_items, 0) AS n_items,
              coalesce(d.units, 0) AS units
       FROM s LEFT JOIN d USING (orderId) WHERE s.approvedByOrg1""",
    s=_STATE_HEADER_SQL, d=_DOC_ITEMS_SQL))
def q_approved_order_details(spark, sf):
    d = lookups.approved_order_details(order_state(spark, sf))
    return d.select("orderId", "detailOrderId", F.size("items").cast("bigint").alias("n_items"),
                    F.aggregate("items", F.lit(0).cast("bigint"),
                                lambda acc, x: acc + x["quantity"]).alias("units"))


@register("published_orders", with_views(
    f"""SELECT {_HDR_COLS}, coalesce(d.n_items, 0) AS n_items
        FROM s LEFT JOIN d USING (orderId)""",
    s=_STATE_HEADER_SQL, d=_DOC_ITEMS_SQL))
def q_published_orders(spark, sf):
    p = lookups.published_orders(order_state(spark, sf))
    return p.select(*lookups.HEADER_FIELDS, F.size("OrderDetail.items").cast("bigint").alias("n_items"))


# ---------------------------------------------------------------- nesting
_NEST_SQL = f"""
SELECT o.orderId, o.customerId, coalesce(n.n_items, 0) AS n_items, coalesce(n.units, 0) AS units
FROM (SELECT orderId, customerId FROM ({HEADER}) h) o
LEFT JOIN (SELECT cast(orderKey AS varchar) AS orderId, count(*) AS n_items,
                  cast(sum(quantity) AS bigint) AS units FROM ({LINES}) l GROUP BY orderKey) n
USING (orderId)"""

# The bulk load prices lines itself, with a blank discount as none.
_NEST_TOTALS = f"""SELECT cast(orderKey AS varchar) AS orderId, sum(p) AS total, cast(sum(floor(p * 100)) AS bigint) AS cents FROM (
  SELECT orderKey, unitPrice * quantity * (1 - coalesce(discount, cast(0 AS double))) AS p FROM ({LINES}) l) x GROUP BY orderKey"""


@register("nest_orders", f"""SELECT b.*, coalesce(t.total, cast(0 AS double)) AS total, coalesce(t.cents, 0) AS cents
FROM ({_NEST_SQL}) b LEFT JOIN ({_NEST_TOTALS}) t USING (orderId)""")
def q_nest_orders(spark, sf):
    o, d = T.bulk_load_frames(spark, sf)
    n = nest.nest_orders(o, d)
    return n.select("orderId", "customerId",
                    F.size("orderDetails.items").cast("bigint").alias("n_items"),
                    F.aggregate("orderDetails.items", F.lit(0).cast("bigint"),
                                lambda acc, x: acc + x["quantity"]).alias("units"),
                    F.col("orderDetails.total").alias("total"), _cents("orderDetails.items").alias("cents"))


def _cents(items):
    """Whole hundredths of the items' prices, an exact sum whatever the order."""
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda acc, x: acc + F.floor(x["price"] * 100))


@register("create_and_approve", f"""
SELECT h.orderId, sha256(h.customerId) AS customerIdHash, employee, shipperID, freight,
       'APPROVED' AS status, true AS approvedByOrg1, h.orderId AS detailOrderId, b.n_items, b.units,
       coalesce(t.total, cast(0 AS double)) AS total, coalesce(t.cents, 0) AS cents
FROM ({HEADER}) h JOIN ({_NEST_SQL}) b USING (orderId) LEFT JOIN ({_NEST_TOTALS}) t USING (orderId)""")
def q_create_and_approve(spark, sf):
    o, d = T.bulk_load_frames(spark, sf)
    c = nest.create_and_approve(nest.nest_orders(o, d))
    return c.select("orderId", "customerIdHash", "employee", "shipperID", "freight", "status",
                    "approvedByOrg1", F.col("OrderDetail.orderId").alias("detailOrderId"),
                    F.size("OrderDetail.items").cast("bigint").alias("n_items"),
                    F.aggregate("OrderDetail.items", F.lit(0).cast("bigint"), lambda acc, x: acc + x["quantity"]).alias("units"),
                    F.col("OrderDetail.total").alias("total"), _cents("OrderDetail.items").alias("cents"))
