"""Bronze order documents -> silver header and item tables.

Both outputs are narrow (map-only) plans over the same source: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.functions import parse_ts, try_bool, try_double, try_int
from orderlake.schemas import ORDERS_HEADER, ORDERS_ITEMS

#: How a text leaf becomes a value of each silver type; what does not convert is null.
_READ = {T.StringType(): lambda c: c.cast("string"), T.IntegerType(): try_int, T.DoubleType(): try_double,
         T.TimestampType(): parse_ts, T.BooleanType(): try_bool}


def _typed(field: T.StructField, source: Column) -> Column:
    return _READ[field.dataType](source).alias(field.name)


def orders_header(bronze: DataFrame, *more: str) -> DataFrame:
    """The header columns of the silver schema, one row per document (unfiltered); ``more`` columns pass through."""
    return bronze.select(*[_typed(f, F.col(f.name)) for f in ORDERS_HEADER], *more)


def repair_discount(c="discount", low: float = 0.0, high: float = 1.0):
    """P5: a discount outside [low, high] becomes 0; null stays null."""
    d = F.col(c) if isinstance(c, str) else c
    return F.when(d.isNull() | d.between(low, high), d).otherwise(F.lit(0.0))


def _sold(line: DataFrame) -> Column:
    """A positive quantity at a price that is not negative."""
    return (line["quantity"] > 0) & (line["unitPrice"] >= 0)


def raw_items(bronze: DataFrame) -> DataFrame:
    """P2 + P3: one typed row per item of each document that has any."""
    lines = bronze.select(_typed(ORDERS_ITEMS["orderId"], F.col("orderId")), F.inline("OrderDetail.items"))
    return lines.select("orderId", *[_typed(f, F.col(f.name)) for f in ORDERS_ITEMS if f.name not in ("orderId", "totalPrice")])


def clean_items(items: DataFrame) -> DataFrame:
    """P4-P6 on typed item rows: items sold, discount repaired, line total added."""
    paid = items["quantity"] * items["unitPrice"] * (1 - repair_discount(items["discount"]))
    return items.where(_sold(items)).withColumns({"discount": repair_discount("discount"), "totalPrice": paid})


def orders_items(bronze: DataFrame) -> DataFrame:
    """Silver item table (P2-P6): items become rows first, so that all that follows runs in generated code."""
    return clean_items(raw_items(bronze))


def bronze_to_silver(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    return orders_header(bronze), orders_items(bronze)
