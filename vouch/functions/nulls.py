"""One NULL for every way the inputs spell a missing value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The texts a CSV field may hold for "missing". Case-sensitive.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def quoted(name: str) -> str:
    """A column name as Spark takes it literally, dots and spaces included."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def tokens_to_null(value: Column) -> Column:
    """A text column with every null token replaced by NULL."""
    return F.when(~value.isin(*NULL_TOKENS), value)


def nan_to_null(df: DataFrame) -> DataFrame:
    """``df`` with NaN replaced by NULL in float and double columns."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    if not floating:
        return df
    return df.select(
        *[
            F.when(~F.isnan(column(c)), column(c)).alias(c) if c in floating else column(c)
            for c in df.columns
        ]
    )
