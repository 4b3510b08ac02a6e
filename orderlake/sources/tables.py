"""Adapter from the supplied star-schema tables to the order model.

The supplied parquet tables (``orders``, ``lineitem`` ...) are read as they
are, and every order-model frame used by the registered queries is derived
from them by Spark, so the work grows with the tables. Mapping (fixed values
shared with the DuckDB oracle):

* orderId = o_orderkey as text; customerId = o_custkey as text, stored as its
  SHA-256 hex digest;
* employee = o_orderkey % 9 + 1; shipperID = o_orderkey % 3 + 1;
* requiredDate = orderDate + (7 + o_orderkey % 36) days;
* shippedDate = null for open orders (status 'O'), else orderDate +
  (o_custkey % 30) days;
* freight = o_totalprice / 1000;
* status/approved = 'CREATED'/false for open orders, else 'APPROVED'/true;
* item: productId = l_partkey as text, quantity = l_quantity as int,
  unitPrice = l_extendedprice / l_quantity, discount = l_discount,
  price = unitPrice * quantity * (1 - discount);
* dirty variant (exercises the cleaning rules): quantity 0 when
  l_partkey % 50 = 0, discount 1.5 when % 50 = 1, discount null when
  % 50 = 2, unitPrice -1 when % 50 = 3.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.operators.nest import nest_items, to_raw_document

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

DATE_TEXT = "yyyy-MM-dd HH:mm:ss"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table scan. Column pruning and filters reach the parquet scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days(n):
    return F.make_dt_interval(days=n.cast("int"))


def header_fields(col=F.col) -> dict:
    """The typed order header (10 fields), its ``orderKey`` and ``customerId`` (clear text, for claims), of the columns ``col`` of ``orders``."""
    k = col("o_orderkey")
    is_open = col("o_orderstatus") == "O"
    # Day arithmetic on the wall-clock value (timestamp without zone), converted at the
    # end: the result does not depend on the session zone's daylight-saving rules.
    od = col("o_orderdate").cast("timestamp_ntz")
    return {
        "orderKey": k,
        "orderId": k.cast("string"),
        "customerId": col("o_custkey").cast("string"),
        "customerIdHash": F.sha2(col("o_custkey").cast("string"), 256),
        "employee": (k % 9 + 1).cast("int"),
        "orderDate": od.cast("timestamp"),
        "requiredDate": (od + _days(7 + k % 36)).cast("timestamp"),
        "shippedDate": F.when(is_open, F.lit(None).cast("timestamp"))
                        .otherwise((od + _days(col("o_custkey") % 30)).cast("timestamp")),
        "shipperID": (k % 3 + 1).cast("int"),
        "freight": col("o_totalprice") / 1000,
        "status": F.when(is_open, "CREATED").otherwise("APPROVED"),
        "approvedByOrg1": ~is_open,
    }


def order_headers(orders: DataFrame, *keep: str) -> DataFrame:
    """Typed order header (10 fields) + customerId (clear text, for claims), and the columns ``keep`` of ``orders``."""
    fields = header_fields()
    if "orderId" in orders.columns:
        fields["orderId"] = F.col("orderId")
    return orders.select(*[c.alias(name) for name, c in fields.items()], *keep)


def date_texts(fields: dict) -> dict:
    """The dates of a header as a stored document has them: text, ``""`` for a missing shipping date."""
    text = {d: F.date_format(fields[d], DATE_TEXT) for d in ("orderDate", "requiredDate", "shippedDate")}
    return fields | text | {"shippedDate": F.coalesce(text["shippedDate"], F.lit(""))}


#: Rows of ``orders`` and ``lineitem`` that one task groups.
ROWS_A_TASK = 500_000


def dealt(df: DataFrame, rows: int, key: str) -> DataFrame:
    """``df`` brought together by ``key``, in as many parts as ``rows`` rows need for a task's memory, however few the session shuffles to."""
    n = -(-rows // ROWS_A_TASK)
    return df.repartition(n, key) if n > df.sparkSession.sparkContext.defaultParallelism else df.repartition(key)


def by_order(lineitem: DataFrame, key: str, rows: int = 0) -> DataFrame:
    """The rows of ``lineitem`` brought together by order, with the order as ``key``: ``orderKey`` (long) or ``orderId`` (text).

    Nesting then groups the few lines of a task. Grouped where they were read, all lines of a large split are
    sorted at once, beyond the memory of the task. ``rows``, their number if known, sets the number of parts (``dealt``).
    """
    order = F.col("l_orderkey")
    return dealt(lineitem.withColumn(key, order if key == "orderKey" else order.cast("string")), rows, key)


def line_fields(col=F.col, dirty: bool = True) -> dict:
    """An order line in the item model (see module doc for the dirty variant), of the columns ``col`` of ``lineitem``."""
    pk = col("l_partkey")
    unit = col("l_extendedprice") / col("l_quantity")
    qty = col("l_quantity").cast("int")
    disc = col("l_discount")
    price = unit * qty * (1 - disc)
    if dirty:
        m = pk % 50
        qty = F.when(m == 0, F.lit(0)).otherwise(qty)
        disc = (F.when(m == 1, F.lit(1.5)).when(m == 2, F.lit(None).cast("double")).otherwise(disc))
        unit = F.when(m == 3, F.lit(-1.0)).otherwise(unit)
    return {"lineNumber": col("l_linenumber"), "productId": pk.cast("string"), "quantity": qty, "unitPrice": unit,
            "discount": disc, "price": price}


def order_lines(lineitem: DataFrame, dirty: bool = True) -> DataFrame:
    """Order lines in the item model (see module doc for the dirty variant), with the keys of ``by_order``."""
    return lineitem.select(
        *[c for c in ("orderKey", "orderId") if c in lineitem.columns],
        *([] if "orderKey" in lineitem.columns else [F.col("l_orderkey").alias("orderKey")]),
        *[c.alias(name) for name, c in line_fields(dirty=dirty).items()],
    )


#: The header of an order's document.
DOCUMENT = ["orderId", "customerIdHash", "employee", "orderDate", "requiredDate", "shippedDate", "shipperID", "freight", "status", "approvedByOrg1"]
ITEM_COLS = ["productId", "quantity", "unitPrice", "discount", "price"]


def typed_documents(orders: DataFrame, lineitem: DataFrame, dirty: bool = True,
                    with_detail: bool = True) -> DataFrame:
    """Public order documents (header + ``OrderDetail``) as stored on the ledger.

    Dates are text (``yyyy-MM-dd HH:mm:ss``; a missing date is ``""``, the
    zero value of the order model). One shuffle on ``orderId`` nests the
    lines; the orders side joins on the same key.
    """

    def document(h: DataFrame, *keep: str) -> DataFrame:
        fields = date_texts({c: F.col(c) for c in DOCUMENT})
        return h.select(*[fields[c].alias(c) for c in DOCUMENT], *keep)

    if not with_detail:
        return document(order_headers(orders)).withColumn("OrderDetail", F.lit(None).cast(
            "struct<orderId:string,items:array<struct<productId:string,quantity:int,unitPrice:double,"
            "discount:double,price:double>>,total:double>"))
    # by orderId, so a later join of the items with their header finds them where they are; the order's
    # texts (hash, dates) are made of its few numbers after the join, not carried through it
    lines = order_lines(by_order(lineitem, "orderId"), dirty)
    nested = nest_items(lines, "orderId", ITEM_COLS, sort_cols=["lineNumber"])
    joined = orders.withColumn("orderId", F.col("o_orderkey").cast("string")).join(nested, "orderId", "left")
    j = document(order_headers(joined, "items", "total"), "items", "total")
    empty = F.array().cast("array<struct<productId:string,quantity:int,unitPrice:double,"
                           "discount:double,price:double>>")
    return j.select(
        *DOCUMENT,
        F.struct(F.col("orderId").alias("orderId"),
                 F.coalesce("items", empty).alias("items"),
                 F.coalesce("total", F.lit(0.0)).alias("total")).alias("OrderDetail"),
    )


def bronze_documents(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    """Bronze order documents (all leaves text) derived from the tables."""
    return to_raw_document(typed_documents(read_table(spark, sf_dir, "orders"),
                                           read_table(spark, sf_dir, "lineitem"), dirty))


def bulk_load_frames(spark: SparkSession, sf_dir: str):
    """The two bulk-load CSV shapes (orders.csv, order_details.csv) from the tables."""
    h = order_headers(read_table(spark, sf_dir, "orders"))
    orders_csv = h.select(
        F.col("orderId").alias("orderID"), F.col("customerId").alias("customerID"),
        F.col("employee").alias("employeeID"),
        F.date_format("orderDate", DATE_TEXT).alias("orderDate"),
        F.date_format("requiredDate", DATE_TEXT).alias("requiredDate"),
        F.coalesce(F.date_format("shippedDate", DATE_TEXT), F.lit("nan")).alias("shippedDate"),
        "shipperID", "freight",
    )
    lines = order_lines(read_table(spark, sf_dir, "lineitem"), dirty=True)
    details_csv = lines.select(
        F.col("orderKey").cast("string").alias("orderID"), F.col("productId").alias("productID"),
        "unitPrice", "quantity", "discount",
    )
    return orders_csv, details_csv
