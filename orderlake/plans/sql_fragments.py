"""DuckDB SQL that mirrors the table adapter (``sources.tables``).

Fixed values shared with the adapter: employee = o_orderkey % 9 + 1,
shipperID = o_orderkey % 3 + 1, requiredDate = orderDate + (7 + o_orderkey % 36)
days, shippedDate = orderDate + (o_custkey % 30) days unless status 'O',
freight = o_totalprice / 1000, dirty lines keyed on l_partkey % 50 in
{0: quantity 0, 1: discount 1.5, 2: discount null, 3: unitPrice -1}.
"""

HEADER = """
SELECT o_orderkey AS orderKey,
       cast(o_orderkey AS varchar) AS orderId,
       cast(o_custkey AS varchar) AS customerId,
       sha256(cast(o_custkey AS varchar)) AS customerIdHash,
       cast(o_orderkey % 9 + 1 AS integer) AS employee,
       o_orderdate AS orderDate,
       o_orderdate + to_days(cast(7 + o_orderkey % 36 AS integer)) AS requiredDate,
       CASE WHEN o_orderstatus = 'O' THEN NULL
            ELSE o_orderdate + to_days(cast(o_custkey % 30 AS integer)) END AS shippedDate,
       cast(o_orderkey % 3 + 1 AS integer) AS shipperID,
       o_totalprice / 1000 AS freight,
       CASE WHEN o_orderstatus = 'O' THEN 'CREATED' ELSE 'APPROVED' END AS status,
       o_orderstatus <> 'O' AS approvedByOrg1
FROM orders
"""

LINES = """
SELECT l_orderkey AS orderKey,
       l_linenumber AS lineNumber,
       cast(l_partkey AS varchar) AS productId,
       CASE WHEN l_partkey % 50 = 0 THEN 0 ELSE cast(l_quantity AS integer) END AS quantity,
       CASE WHEN l_partkey % 50 = 3 THEN cast(-1 AS double) ELSE l_extendedprice / l_quantity END AS unitPrice,
       CASE WHEN l_partkey % 50 = 1 THEN cast(1.5 AS double)
            WHEN l_partkey % 50 = 2 THEN cast(NULL AS double) ELSE l_discount END AS discount,
       (l_extendedprice / l_quantity) * cast(l_quantity AS integer) * (1 - l_discount) AS price
FROM lineitem
"""

# Raw items of documents: lines whose order exists (left join from orders).
RAW_ITEMS = f"""
SELECT cast(l.orderKey AS varchar) AS orderId, l.productId, l.quantity, l.unitPrice, l.discount, l.price
FROM ({LINES}) l WHERE l.orderKey IN (SELECT o_orderkey FROM orders)
"""

ITEMS = f"""
SELECT orderId, productId, quantity, unitPrice, d AS discount, price,
       quantity * unitPrice * (1 - d) AS totalPrice
FROM (SELECT *, CASE WHEN discount < 0 OR discount > 1 THEN cast(0 AS double) ELSE discount END AS d
      FROM ({RAW_ITEMS}) r WHERE quantity > 0 AND unitPrice >= 0) c
"""

SILVER_HEADER = f"""
SELECT orderId, customerIdHash, employee, orderDate, requiredDate, shippedDate, shipperID, freight,
       status, approvedByOrg1
FROM ({HEADER}) h
"""


def with_views(body: str, **views: str) -> str:
    ctes = ",\n".join(f"{k} AS ({v})" for k, v in views.items())
    return f"WITH {ctes}\n{body}"
