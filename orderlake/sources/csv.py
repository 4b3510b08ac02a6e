"""Bulk-load CSV scans (S4): ids are declared text, numbers typed by the schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlake.schemas import ORDER_DETAILS_CSV, ORDERS_CSV


def read_orders_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(ORDERS_CSV).csv(path)


def read_order_details_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(ORDER_DETAILS_CSV).csv(path)
