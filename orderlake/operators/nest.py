"""Order lines -> nested order documents.

The nesting is one shuffle on the order key: lines are grouped with
``collect_list`` (map-side partial lists, merged per key) and joined to the
orders, which Spark shuffles on the same key, so the joined side needs no
second exchange. A document is one ledger value, whose size the ledger caps
(block size limit), so the per-order list is bounded by the data model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions import sha256_hex


def price_lines(lines: DataFrame, unit_price="unitPrice", quantity="quantity",
                discount="discount") -> DataFrame:
    """Line price at entry, ``unitPrice * quantity * (1 - discount)``; blank discount -> 0."""
    d = F.coalesce(F.col(discount), F.lit(0.0))
    return lines.withColumn("discount", d).withColumn(
        "price", F.col(unit_price) * F.col(quantity) * (1 - F.col("discount")))


def nest_items(lines: DataFrame, key: str, item_cols: list[str], sort_cols: list[str] | None = None,
               total_col: str | None = "price") -> DataFrame:
    """A5: one row per ``key`` with ``items`` (array of struct) and ``total``.

    ``sort_cols`` fixes the item order (the list is otherwise in arrival
    order); the full item row is appended as a tie breaker.
    """
    sort_cols = sort_cols or []
    entry = F.struct(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(sort_cols)],
                     F.struct(*[F.col(c) for c in item_cols]).alias("item"))
    aggs = [F.collect_list(entry).alias("_items")]
    if total_col:
        aggs.append(F.sum(total_col).alias("total"))
    grouped = lines.groupBy(key).agg(*aggs)
    return grouped.select(
        key,
        F.transform(F.sort_array("_items"), lambda e: e["item"]).alias("items"),
        *(["total"] if total_col else []),
    )


def nest_orders(orders: DataFrame, details: DataFrame) -> DataFrame:
    """J2 + A5 on the bulk-load shape.

    ``orders``: orderID, customerID, employeeID, orderDate, requiredDate,
    shippedDate, shipperID, freight. ``details``: orderID, productID,
    unitPrice, quantity, discount.

    Orders keep ids trimmed, lines are matched on their id as given; an order
    without lines gets ``items = []`` and ``total = 0``; lines without an order
    are dropped. Output: orderId, customerId, order (meta struct),
    orderDetails struct<orderId, items, total>.
    """
    lines = price_lines(details).select(
        F.col("orderID").alias("_oid"),
        F.col("productID").alias("productId"),
        F.col("quantity").cast("int").alias("quantity"),
        F.col("unitPrice").cast("double").alias("unitPrice"),
        F.col("discount").cast("double").alias("discount"),
        F.col("price").cast("double").alias("price"),
    )
    nested = nest_items(lines, "_oid", ["productId", "quantity", "unitPrice", "discount", "price"],
                        sort_cols=["productId", "quantity", "unitPrice", "discount", "price"])
    o = orders.select(
        F.trim("orderID").alias("orderId"),
        F.trim(F.col("customerID").cast("string")).alias("customerId"),
        F.struct(
            F.trim("orderID").alias("orderId"),
            F.col("employeeID").cast("int").alias("employee"),
            F.col("orderDate").cast("string").alias("orderDate"),
            F.col("requiredDate").cast("string").alias("requiredDate"),
            F.col("shippedDate").cast("string").alias("shippedDate"),
            F.col("shipperID").cast("int").alias("shipperID"),
            F.col("freight").cast("double").alias("freight"),
        ).alias("order"),
    )
    j = o.join(nested, o["orderId"] == nested["_oid"], "left")
    empty = F.array().cast("array<struct<productId:string,quantity:int,unitPrice:double,discount:double,price:double>>")
    return j.select(
        "orderId", "customerId", "order",
        F.struct(
            F.col("orderId").alias("orderId"),
            F.coalesce(F.col("items"), empty).alias("items"),
            F.coalesce(F.col("total"), F.lit(0.0)).alias("total"),
        ).alias("orderDetails"),
    )


def create_and_approve(nested: DataFrame) -> DataFrame:
    """C4: nested orders -> published, approved order documents (typed).

    Output columns follow the public order model: the ten header fields plus
    ``OrderDetail``. The customer id is stored only as its SHA-256 digest.
    """
    m = F.col("order")
    return nested.select(
        F.col("orderId"),
        sha256_hex("customerId").alias("customerIdHash"),
        m["employee"].alias("employee"),
        m["orderDate"].alias("orderDate"),
        m["requiredDate"].alias("requiredDate"),
        m["shippedDate"].alias("shippedDate"),
        m["shipperID"].alias("shipperID"),
        m["freight"].alias("freight"),
        F.lit("APPROVED").alias("status"),
        F.lit(True).alias("approvedByOrg1"),
        F.col("orderDetails").withField("orderId", F.col("orderId")).alias("OrderDetail"),
    )


def to_raw_document(typed: DataFrame) -> DataFrame:
    """Typed order documents -> bronze shape (every leaf a string).

    This is what a JSON reader with the bronze schema returns for the stored
    values; silver parsing starts from it.
    """
    def s(c):
        return F.col(c).cast("string")

    d = F.col("OrderDetail")
    items = F.transform(d["items"], lambda i: F.struct(
        i["productId"].cast("string").alias("productId"),
        i["quantity"].cast("string").alias("quantity"),
        i["unitPrice"].cast("string").alias("unitPrice"),
        i["discount"].cast("string").alias("discount"),
        i["price"].cast("string").alias("price"),
    ))
    detail = F.when(d.isNotNull(), F.struct(
        d["orderId"].cast("string").alias("orderId"),
        d["total"].cast("string").alias("total"),
        items.alias("items"),
    ))
    return typed.select(
        s("orderId").alias("orderId"), s("customerIdHash").alias("customerIdHash"),
        s("employee").alias("employee"), s("orderDate").alias("orderDate"),
        s("requiredDate").alias("requiredDate"), s("shippedDate").alias("shippedDate"),
        s("shipperID").alias("shipperID"), s("freight").alias("freight"),
        s("status").alias("status"), s("approvedByOrg1").alias("approvedByOrg1"),
        detail.alias("OrderDetail"),
    )
