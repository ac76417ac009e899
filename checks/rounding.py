"""Rounding that both engines agree on.

Sums of doubles differ in their last bits with the order of summation. Values are rounded before
they are compared, and shifted by less than a thousandth of the last place first, so that exact
halves (a mean over 8 or 16 invoices) do not fall either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6
LARGE = {
    "Monetary": 4, "Avg_Transaction_Value": 4, "Max_Transaction": 4, "Std_Transaction": 2,
    "TotalPrice": 4,
}


def digits_of(name: str, digits: dict[str, int] | int | None) -> int:
    if isinstance(digits, int):
        return digits
    return (digits or {}).get(name, LARGE.get(name, DIGITS))


def shift(places: int) -> float:
    return 3 * 10.0 ** -(places + 3)


def rounded(df: DataFrame, digits: dict[str, int] | int | None = None) -> DataFrame:
    def value(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            places = digits_of(field.name, digits)
            column = F.round(column + F.lit(shift(places)), places)
        return column.alias(field.name)

    return df.select(*[value(f) for f in df.schema])


def rounded_sql(sql: str, doubles: list[str], digits: dict[str, int] | int | None = None) -> str:
    """The same for a statement whose double columns are named."""
    parts = []
    for name in doubles:
        places = digits_of(name, digits)
        value = f'round("{name}" + {shift(places)!r}, {places})'
        parts.append(f'CASE WHEN {value} = 0 THEN 0.0::DOUBLE ELSE {value} END AS "{name}"')
    if not parts:
        return sql
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM (\n{sql}\n) AS result"
