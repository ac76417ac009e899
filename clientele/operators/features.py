"""One row of recency, frequency, monetary and behaviour features per customer.

The grouping runs in two steps, by customer and invoice and then by customer, and both combine
on the map side, so a customer who owns a large part of all lines sends one partial row per task
and invoice. Distinct products are counted the same way: Spark first groups by customer and
product. The customer table is stored before anything global is read from it, so the reference
date and the skewness scan two or three small columns and not the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.constants import (
    CLUSTER_FEATURES,
    CUSTOMER_FEATURES,
    SKEW_GATE,
    SKEWED_FEATURES,
)
from clientele.functions.moments import sample_skewness
from clientele.storage import materialize


def invoice_agg(lines: DataFrame, order_col: str | None = None) -> DataFrame:
    """One row per customer and invoice; lines without an invoice number are left out.

    The date is the first one known: in the order of ``order_col`` where the source keeps one,
    else the earliest.
    """
    date = F.min("InvoiceDate")
    if order_col is not None:
        known = F.when(F.col("InvoiceDate").isNotNull(), F.col(order_col))
        date = F.min_by("InvoiceDate", known)
    return (
        lines.where(F.col("InvoiceNo").isNotNull())
        .groupBy("CustomerID", "InvoiceNo")
        .agg(
            F.sum("TotalPrice").alias("TotalPrice"),
            date.alias("InvoiceDate"),
            F.sum("Quantity").alias("Quantity"),
        )
    )


def reference_date(table: DataFrame, column: str = "InvoiceDate") -> DataFrame:
    """One day after the last date, the time of day kept."""
    return table.agg((F.max(column) + F.expr("INTERVAL 1 DAY")).alias("reference_date"))


def customer_totals(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("CustomerID").agg(
        F.min("InvoiceDate").alias("first_date"),
        F.max("InvoiceDate").alias("last_date"),
        F.count("InvoiceDate").cast("double").alias("Frequency"),
        F.sum("TotalPrice").alias("Monetary"),
        F.avg("TotalPrice").alias("Avg_Transaction_Value"),
        F.max("TotalPrice").alias("Max_Transaction"),
        F.stddev_samp("TotalPrice").alias("Std_Transaction"),
        F.sum("Quantity").alias("Total_Items"),
        F.avg("Quantity").alias("Avg_Items_Per_Transaction"),
    )


def with_elapsed_days(totals: DataFrame) -> DataFrame:
    """Recency and Tenure in whole elapsed days; ``totals`` is read twice, so store it first."""
    reference = reference_date(totals, "last_date").scalar()

    def days(start: str) -> Column:
        return F.extract(F.lit("DAY"), reference - F.col(start)).cast("double")

    return totals.withColumns({"Recency": days("last_date"), "Tenure": days("first_date")}).drop(
        "first_date", "last_date"
    )


def rfm_agg(invoices: DataFrame) -> DataFrame:
    return with_elapsed_days(materialize(customer_totals(invoices), "totals"))


def behavioral_agg(lines: DataFrame) -> DataFrame:
    """Distinct products, and their share of the customer's lines."""
    products = F.count_distinct("StockCode")
    return lines.groupBy("CustomerID").agg(
        products.cast("double").alias("Unique_Products"),
        (products / F.count("*")).alias("Transaction_Variety"),
    )


def merge_features(rfm: DataFrame, behavior: DataFrame) -> DataFrame:
    return rfm.join(behavior, "CustomerID", "left")


def rate_features(df: DataFrame) -> DataFrame:
    """Per-day and per-transaction rates; a tenure of 0 counts as one day."""
    tenure = F.when(F.col("Tenure") == 0, F.lit(1.0)).otherwise(F.col("Tenure"))
    return df.withColumn("Tenure", tenure).withColumns({
        "Frequency_Rate": F.try_divide("Frequency", "Tenure"),
        "Monetary_Rate": F.try_divide("Monetary", "Tenure"),
        "Items_Per_Transaction": F.try_divide("Total_Items", "Frequency"),
    })


def log_features(df: DataFrame, mode: str = "auto") -> DataFrame:
    """``Log_`` columns of the skewed features.

    ``auto`` adds one only where the sample skewness is beyond the gate, which costs one
    aggregation; ``always`` and ``never`` fix the columns.
    """
    names = SKEWED_FEATURES
    if mode == "auto":
        skews = df.agg(*[sample_skewness(c).alias(c) for c in names]).first()
        names = [c for c in names if skews[c] is not None and abs(skews[c]) > SKEW_GATE]
    elif mode == "never":
        names = []
    elif mode != "always":
        raise ValueError(f"mode must be auto, always or never, not {mode!r}")
    return df.withColumns({f"Log_{c}": F.log1p(c) for c in names})


def fill_missing(df: DataFrame) -> DataFrame:
    return df.fillna(0.0)


def engineer_features(
    lines: DataFrame, log_mode: str = "auto", order_col: str | None = None
) -> DataFrame:
    """The customer feature table from clean lines."""
    totals = customer_totals(invoice_agg(lines, order_col))
    stored = materialize(merge_features(totals, behavioral_agg(lines)), "customers")
    rated = rate_features(with_elapsed_days(log_features(stored, log_mode)))
    logs = [c for c in rated.columns if c.startswith("Log_")]
    return fill_missing(rated.select("CustomerID", *CUSTOMER_FEATURES, *logs))


def feature_columns(df: DataFrame) -> list[str]:
    """The columns that clustering uses: those of the fixed list that exist, and all logs."""
    logs = [c for c in df.columns if c.startswith("Log_")]
    return [c for c in CLUSTER_FEATURES if c in df.columns] + logs


def select_features(df: DataFrame) -> DataFrame:
    return df.select("CustomerID", *feature_columns(df))
