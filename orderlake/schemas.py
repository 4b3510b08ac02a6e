"""Fixed schemas for every layer.

Raw (bronze) documents declare every leaf as ``string`` and cast afterwards:
a JSON reader with a typed leaf turns ``"2"`` or ``2.5`` into null, while the
order model accepts both. Declaring the schema also avoids an inference pass
over the whole input and keeps the plan stable when no document carries
``OrderDetail``.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

RAW_ITEM = T.StructType([
    T.StructField("productId", S),
    T.StructField("quantity", S),
    T.StructField("unitPrice", S),
    T.StructField("discount", S),
    T.StructField("price", S),
])

RAW_DETAIL = T.StructType([
    T.StructField("orderId", S),
    T.StructField("total", S),
    T.StructField("items", T.ArrayType(RAW_ITEM)),
])

HEADER_FIELDS = ["orderId", "customerIdHash", "employee", "orderDate", "requiredDate",
                 "shippedDate", "shipperID", "freight", "status", "approvedByOrg1"]

RAW_ORDER = T.StructType(
    [T.StructField(f, S) for f in HEADER_FIELDS]
    + [T.StructField("OrderDetail", RAW_DETAIL)]
)


# Typed order model (what the contract stores).
ITEM = T.StructType([
    T.StructField("productId", S),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unitPrice", T.DoubleType()),
    T.StructField("discount", T.DoubleType()),
    T.StructField("price", T.DoubleType()),
])

ORDER_DETAIL = T.StructType([
    T.StructField("orderId", S),
    T.StructField("items", T.ArrayType(ITEM)),
    T.StructField("total", T.DoubleType()),
])

ORDER_META = T.StructType([
    T.StructField("employee", T.IntegerType()),
    T.StructField("orderDate", S),
    T.StructField("requiredDate", S),
    T.StructField("shippedDate", S),
    T.StructField("shipperID", T.IntegerType()),
    T.StructField("freight", T.DoubleType()),
])

# Silver
ORDERS_HEADER = T.StructType([
    T.StructField("orderId", S),
    T.StructField("customerIdHash", S),
    T.StructField("employee", T.IntegerType()),
    T.StructField("orderDate", T.TimestampType()),
    T.StructField("requiredDate", T.TimestampType()),
    T.StructField("shippedDate", T.TimestampType()),
    T.StructField("shipperID", T.IntegerType()),
    T.StructField("freight", T.DoubleType()),
    T.StructField("status", S),
    T.StructField("approvedByOrg1", T.BooleanType()),
])

ORDERS_ITEMS = T.StructType([
    T.StructField("orderId", S),
    T.StructField("productId", S),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unitPrice", T.DoubleType()),
    T.StructField("discount", T.DoubleType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("totalPrice", T.DoubleType()),
])

# Clustering output table (13 columns, fixed order).
CLUSTERING_RESULTS = T.StructType([
    T.StructField("orderId", S),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("avg_price", T.DoubleType()),
    T.StructField("num_items", T.IntegerType()),
    T.StructField("freight", T.DoubleType()),
    T.StructField("order_to_required_days", T.IntegerType()),
    T.StructField("order_to_shipped_days", T.IntegerType()),
    T.StructField("is_not_shipped", T.IntegerType()),
    T.StructField("approvedByOrg1", T.IntegerType()),
    T.StructField("pca1", T.DoubleType()),
    T.StructField("pca2", T.DoubleType()),
    T.StructField("pca3", T.DoubleType()),
    T.StructField("cluster", T.IntegerType()),
])

# Decoded ledger block (the JSON a block decoder prints), reduced to the
# branches the listener and the explorer read.
_WRITE = T.StructType([T.StructField("key", S), T.StructField("value", S)])
_NS_RWSET = T.StructType([
    T.StructField("namespace", S),
    T.StructField("rwset", T.StructType([T.StructField("writes", T.ArrayType(_WRITE))])),
])
_ACTION = T.StructType([T.StructField("payload", T.StructType([
    T.StructField("chaincode_proposal_payload", T.StructType([
        T.StructField("input", T.StructType([
            T.StructField("chaincode_spec", T.StructType([
                T.StructField("chaincode_id", T.StructType([T.StructField("name", S)])),
                T.StructField("input", T.StructType([T.StructField("args", T.ArrayType(S))])),
            ])),
        ])),
    ])),
    T.StructField("action", T.StructType([
        T.StructField("proposal_response_payload", T.StructType([
            T.StructField("extension", T.StructType([
                T.StructField("results", T.StructType([
                    T.StructField("ns_rwset", T.ArrayType(_NS_RWSET)),
                ])),
            ])),
        ])),
    ])),
]))])
ENVELOPE = T.StructType([T.StructField("payload", T.StructType([
    T.StructField("header", T.StructType([
        T.StructField("channel_header", T.StructType([
            T.StructField("channel_id", S),
            T.StructField("tx_id", S),
            T.StructField("timestamp", S),
        ])),
        T.StructField("signature_header", T.StructType([
            T.StructField("creator", T.StructType([
                T.StructField("Mspid", S),
                T.StructField("IdBytes", S),
            ])),
        ])),
    ])),
    T.StructField("data", T.StructType([T.StructField("actions", T.ArrayType(_ACTION))])),
]))])
BLOCK = T.StructType([
    T.StructField("header", T.StructType([
        T.StructField("number", S),
        T.StructField("previous_hash", S),
        T.StructField("data_hash", S),
    ])),
    T.StructField("data", T.StructType([T.StructField("data", T.ArrayType(ENVELOPE))])),
])

# Bulk-load CSVs: ids declared as strings.
ORDERS_CSV = T.StructType([
    T.StructField("orderID", S),
    T.StructField("customerID", S),
    T.StructField("employeeID", T.IntegerType()),
    T.StructField("orderDate", S),
    T.StructField("requiredDate", S),
    T.StructField("shippedDate", S),
    T.StructField("shipperID", T.IntegerType()),
    T.StructField("freight", T.DoubleType()),
])
ORDER_DETAILS_CSV = T.StructType([
    T.StructField("orderID", S),
    T.StructField("productID", S),
    T.StructField("unitPrice", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("discount", T.DoubleType()),
])

# Lifecycle events (replay input).
LIFECYCLE_EVENT = T.StructType([
    T.StructField("orderId", S),
    T.StructField("block", T.LongType()),
    T.StructField("tx", T.IntegerType()),
    T.StructField("function", S),
    T.StructField("org", S),
    T.StructField("customerId", S),
    T.StructField("order", ORDER_META),
    T.StructField("orderDetails", T.StructType([
        T.StructField("total", T.DoubleType()),
        T.StructField("items", T.ArrayType(ITEM)),
    ])),
])

PRIVATE_ROW = T.StructType([
    T.StructField("collection", S),
    T.StructField("orderId", S),
    T.StructField("block", T.LongType()),
    T.StructField("value", S),
])
