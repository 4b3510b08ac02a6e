"""orderlake: Spark-native order-ledger lakehouse.

Operators are plain functions ``f(DataFrame, ...) -> DataFrame`` built from
``pyspark.sql.functions``; they never open a session and never pull rows to
the driver.
"""

__version__ = "0.1.0"
