"""Reads over the current order state.

``state`` is one row per order in the public order model (ten header fields
plus a nullable ``OrderDetail``), e.g. the output of
``ledger.latest_order_state``. A point lookup is a filter on the key, pushed
into the scan when the state is a table; the full scans are plain filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions import sha256_hex
from orderlake.schemas import HEADER_FIELDS


def header_only(state: DataFrame) -> DataFrame:
    return state.select(*HEADER_FIELDS)


def read_order(state: DataFrame, order_id: str) -> DataFrame:
    """The header of one order (empty frame when absent)."""
    return header_only(state.filter(F.col("orderId") == F.lit(order_id)))


def orders_by_customer(state: DataFrame, customer_id: str) -> DataFrame:
    """Orders whose stored hash equals SHA-256 of the given customer id."""
    return header_only(state.filter(F.col("customerIdHash") == sha256_hex(F.lit(customer_id))))


def approved_order_details(state: DataFrame) -> DataFrame:
    """Order id and details of approved orders (details null when unpublished)."""
    return state.filter(F.col("approvedByOrg1") == F.lit(True)).select(
        "orderId",
        F.col("OrderDetail.orderId").alias("detailOrderId"),
        F.col("OrderDetail.items").alias("items"),
        F.col("OrderDetail.total").alias("total"),
    )


def published_orders(state: DataFrame) -> DataFrame:
    """Orders that carry details (header + detail)."""
    return state.filter(F.col("OrderDetail").isNotNull())


def read_all_orders(state: DataFrame) -> DataFrame:
    """O2: every order header in key (text) order."""
    return header_only(state).orderBy("orderId")
