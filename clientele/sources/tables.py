"""Transaction lines read from stored tables, in the canonical columns.

CustomerID, InvoiceNo, StockCode (text), Quantity, UnitPrice (double), InvoiceDate (timestamp
without zone).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their order's customer and date; returned lines count as cancelled."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    invoice = F.col("l_orderkey").cast("string")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("CustomerID"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("C"), invoice))
        .otherwise(invoice).alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.col("l_quantity").alias("Quantity"),
        F.try_divide("l_extendedprice", "l_quantity").alias("UnitPrice"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("InvoiceDate"),
    )


def purchase_events(spark: SparkSession, folder: str) -> DataFrame:
    """Purchase events as one-item invoices; their dates carry a time of day."""
    return table(spark, folder, "events").where(F.col("event_type") == "purchase").select(
        F.col("user_id").cast("string").alias("CustomerID"),
        F.col("event_id").cast("string").alias("InvoiceNo"),
        F.col("props").alias("StockCode"),
        F.lit(1.0).alias("Quantity"),
        F.col("value").alias("UnitPrice"),
        F.col("ts").cast("timestamp_ntz").alias("InvoiceDate"),
    )
