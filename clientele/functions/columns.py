"""Column names and roles, and expressions that turn raw values into typed ones."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.constants import DATE_FORMATS, MISSING_TEXTS, ROLE_ALIASES, ROLE_NAMES


def clean_name(name: str) -> str:
    """Trimmed, lower case, punctuation dropped, runs of blanks as one underscore."""
    kept = re.sub(r"[^\w\s]", "", name.strip().lower())
    return re.sub(r"\s+", "_", kept)


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*map(clean_name, df.columns))


def identify_key_columns(columns: Sequence[str]) -> dict[str, str]:
    """For each role the first column, in table order, whose name is one of its spellings."""
    roles = {}
    for role, spellings in ROLE_ALIASES.items():
        match = next((c for c in columns if c.lower() in spellings), None)
        if match is not None:
            roles[role] = match
    return roles


def standardize_columns(df: DataFrame, roles: dict[str, str]) -> DataFrame:
    """Give every recognised column its standard name; the others keep theirs."""
    return df.withColumnsRenamed({column: ROLE_NAMES[role] for role, column in roles.items()})


def missing_to_null(column: Column) -> Column:
    return F.when(~column.isin(MISSING_TEXTS), column)


def number(df: DataFrame, name: str) -> Column:
    """The column as double, with texts that are no number and NaN as null."""
    value = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        value = F.expr(f"try_cast(`{name}` AS DOUBLE)")
    value = value.cast("double")
    return F.when(~F.isnan(value), value)


def timestamp(df: DataFrame, name: str) -> Column:
    """The column as timestamp without zone; a text that is no date gives null."""
    kind = df.schema[name].dataType
    value = F.col(name)
    if isinstance(kind, T.StringType):
        text = F.trim(value)
        # The cast is tried last: it reads ISO forms, the formats read month-first ones.
        tries = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in DATE_FORMATS]
        return F.coalesce(*tries, text.try_cast("timestamp_ntz"))
    return value.cast("timestamp_ntz")


def customer_key(df: DataFrame, name: str) -> Column:
    """The id as trimmed text; a whole number reads the same however its column was typed."""
    value = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        whole = value.try_cast("bigint")
        value = F.when(whole == value, whole.cast("string")).otherwise(value.cast("string"))
    text = F.trim(value.cast("string"))
    return F.regexp_replace(text, r"^(-?[0-9]+)\.0+$", "$1")


def is_cancelled(column: Column) -> Column:
    """Whether an invoice number marks a cancellation; a missing number does not."""
    text = F.lower(column.cast("string"))
    return F.coalesce(text.startswith("c") | text.startswith("void"), F.lit(False))
