"""From raw transaction lines to clean ones, step by step.

Every step takes and returns a DataFrame in the standard column names and skips itself when its
column is absent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.constants import ROLE_ALIASES, TRIM_PROBS
from clientele.functions import columns as cols
from clientele.functions.quantiles import exact_quantiles
from clientele.storage import materialize


def standard_lines(df: DataFrame) -> DataFrame:
    """Clean the names, find the roles and give the columns their standard names and types."""
    named = cols.clean_column_names(df)
    roles = cols.identify_key_columns(named.columns)
    if "customer_id" not in roles:
        raise ValueError(f"no customer id column; expected one of {ROLE_ALIASES['customer_id']}")
    return typed_lines(cols.standardize_columns(named, roles))


def typed_lines(df: DataFrame) -> DataFrame:
    df = normalize_customer_id(convert_date(df))
    numbers = [c for c in ("Quantity", "UnitPrice") if c in df.columns]
    texts = [c for c in ("InvoiceNo", "StockCode") if c in df.columns]
    return df.withColumns(
        {c: cols.number(df, c) for c in numbers} | {c: F.col(c).cast("string") for c in texts}
    )


def convert_date(df: DataFrame) -> DataFrame:
    if "InvoiceDate" not in df.columns:
        return df
    return df.withColumn("InvoiceDate", cols.timestamp(df, "InvoiceDate"))


def drop_missing_customer(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["CustomerID"])


def normalize_customer_id(df: DataFrame) -> DataFrame:
    return df.withColumn("CustomerID", cols.customer_key(df, "CustomerID"))


def filter_cancelled(df: DataFrame) -> DataFrame:
    return df.where(~cols.is_cancelled(F.col("InvoiceNo"))) if "InvoiceNo" in df.columns else df


def filter_positive_qty(df: DataFrame) -> DataFrame:
    return _positive(df, "Quantity")


def filter_positive_price(df: DataFrame) -> DataFrame:
    return _positive(df, "UnitPrice")


def _positive(df: DataFrame, name: str) -> DataFrame:
    return df.where(cols.number(df, name) > 0) if name in df.columns else df


def total_price(df: DataFrame) -> DataFrame:
    if not {"Quantity", "UnitPrice"} <= set(df.columns):
        return df
    return df.withColumn("TotalPrice", F.col("Quantity") * F.col("UnitPrice"))


def drop_duplicates(df: DataFrame, order_col: str | None = None) -> DataFrame:
    """One row for each set of equal rows; with ``order_col`` the earliest row's position stays.

    Equal rows meet in the map-side half of the aggregation, so many copies of one row cost
    each task one row.
    """
    if order_col is None:
        return df.dropDuplicates()
    # Readers clean column names, so the order column is found as Spark would find it, or clean.
    same = [c for c in df.columns if c.lower() == order_col.lower()]
    same = same or [c for c in df.columns if c.lower() == cols.clean_name(order_col)]
    if len(same) != 1:
        raise ValueError(f"no column {order_col!r}")
    others = [c for c in df.columns if c != same[0]]
    return df.groupBy(*others).agg(F.min(same[0]).alias(same[0]))


def trim_quantiles(
    df: DataFrame, column: str = "TotalPrice", probs: Sequence[float] = TRIM_PROBS
) -> DataFrame:
    """Rows whose value lies within the two quantiles, both ends included.

    The bounds are exact and enter the plan as literals, so the scan of a stored ``df`` skips
    row groups outside them.
    """
    if column not in df.columns:
        return df
    low, high = exact_quantiles(df, [column], probs)[column]
    return df.where(F.col(column).between(F.lit(low), F.lit(high)))


def valid_lines(df: DataFrame) -> DataFrame:
    """The row filters and the line total: one pass over the scan, no shuffle."""
    return (
        df.transform(drop_missing_customer)
        .transform(filter_cancelled)
        .transform(filter_positive_qty)
        .transform(filter_positive_price)
        .transform(total_price)
    )


def distinct_lines(df: DataFrame, order_col: str | None = None) -> DataFrame:
    """Valid lines without duplicates, stored: the trim and the features each read them again."""
    return materialize(drop_duplicates(valid_lines(df), order_col), "lines")


def clean_lines(
    df: DataFrame, probs: Sequence[float] = TRIM_PROBS, order_col: str | None = None
) -> DataFrame:
    """The whole cleaning of standard lines."""
    return trim_quantiles(distinct_lines(df, order_col), probs=probs)


def raw_stats(df: DataFrame) -> DataFrame:
    """Rows, columns and distinct customers of a raw table."""
    return df.agg(
        F.count("*").alias("raw_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("raw_columns"),
        _raw_customers(df).alias("raw_customers"),
    )


def _raw_customers(df: DataFrame) -> Column:
    # The first customer-like column that is not all null has a non-zero distinct count.
    named = [c for c in df.columns if "customer" in c.lower() or "client" in c.lower()]
    counts = [F.nullif(F.count_distinct(c), F.lit(0)) for c in named]
    return F.coalesce(*counts) if counts else F.lit(None).cast("bigint")


def clean_stats(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """What cleaning kept and removed, in rows and in customers."""
    kept = clean.agg(
        F.count("*").alias("clean_rows"), F.count_distinct("CustomerID").alias("clean_customers")
    )
    both = raw_stats(raw).withColumn("_one", F.lit(1)).join(
        kept.withColumn("_one", F.lit(1)), "_one"
    )
    return both.select(
        "clean_rows",
        "clean_customers",
        (F.col("raw_rows") - F.col("clean_rows")).alias("rows_removed"),
        (F.col("raw_customers") - F.col("clean_customers")).alias("customers_removed"),
        (F.try_divide("clean_customers", "raw_customers") * 100).alias("customer_retention_rate"),
        (F.try_divide("clean_rows", "raw_rows") * 100).alias("transaction_retention_rate"),
    )


def cleaning_audit(df: DataFrame, probs: Sequence[float] = TRIM_PROBS) -> DataFrame:
    """Rows removed by each step of the cleaning, in order; a step without its column removes none."""
    def positive(name: str):
        known = name in df.columns
        return F.coalesce(cols.number(df, name) > 0, F.lit(False)) if known else F.lit(True)

    missing = F.col("CustomerID").isNull()
    invoiced = "InvoiceNo" in df.columns
    cancelled = cols.is_cancelled(F.col("InvoiceNo")) if invoiced else F.lit(False)
    good_quantity, good_price = positive("Quantity"), positive("UnitPrice")
    known = ~missing & ~cancelled
    filters = df.agg(
        F.count_if(missing).alias("missing_customer"),
        F.count_if(~missing & cancelled).alias("cancelled"),
        F.count_if(known & ~good_quantity).alias("non_positive_quantity"),
        F.count_if(known & good_quantity & ~good_price).alias("non_positive_price"),
        F.count_if(known & good_quantity & good_price).alias("valid"),
    )
    stored = distinct_lines(df)
    inside = F.lit(True)
    if "TotalPrice" in stored.columns:
        low, high = exact_quantiles(stored, ["TotalPrice"], probs)["TotalPrice"]
        inside = F.col("TotalPrice").between(F.lit(low), F.lit(high))
    later = stored.agg(
        F.count("*").alias("distinct"), F.count_if(inside).alias("kept")
    )
    both = filters.withColumn("_one", F.lit(1)).join(later.withColumn("_one", F.lit(1)), "_one")
    steps = {
        "missing_customer": F.col("missing_customer"),
        "cancelled": F.col("cancelled"),
        "non_positive_quantity": F.col("non_positive_quantity"),
        "non_positive_price": F.col("non_positive_price"),
        "duplicates": F.col("valid") - F.col("distinct"),
        "extreme_totals": F.col("distinct") - F.col("kept"),
    }
    return both.select(F.inline(F.array(*[
        F.struct(
            F.lit(place).alias("step_no"), F.lit(step).alias("step"), removed.alias("rows_removed")
        )
        for place, (step, removed) in enumerate(steps.items(), 1)
    ])))
