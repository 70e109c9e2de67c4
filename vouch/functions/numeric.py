"""Exact percentages and number text, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct(n: Column, d: Column, digits: int) -> Column:
    """``n / d * 100`` rounded half-even to ``digits`` decimals; 0.0 where ``d`` is 0.

    Works on integers throughout, so the result does not depend on floating point.
    Bigint holds ``n * 100 * 10**digits``: two decimals reach 9e14 rows.
    """
    n, d = n.cast("bigint"), d.cast("bigint")
    divisor = F.nullif(d, F.lit(0))
    scaled = F.abs(n) * F.lit(100 * 10**digits).cast("bigint")
    whole = F.call_function("div", scaled, divisor)
    rest = scaled % divisor
    round_up = (2 * rest > divisor) | ((2 * rest == divisor) & (whole % 2 == 1))
    rounded = (whole + F.when(round_up, 1).otherwise(0)).cast("double") / F.lit(float(10**digits))
    # + 0.0 turns a negative zero into zero
    return F.when(d == 0, F.lit(0.0)).otherwise(F.signum(n) * rounded + F.lit(0.0))


def count_or_zero(total: Column) -> Column:
    """A sum of counts as bigint, 0 where there was nothing to sum."""
    return F.coalesce(total, F.lit(0)).cast("bigint")


def number_text(value: Column) -> Column:
    """A double as text with plain digits from 1e-4 up to 1e16, exponents beyond."""
    size = F.abs(value)
    plain = F.regexp_replace(value.try_cast("decimal(38,20)").cast("string"), r"(\.[0-9]+?)0+$", "$1")
    # Spark itself writes plain digits only from 1e-3 up to 1e7
    widened = ((size >= 1e7) & (size < 1e16)) | ((size >= 1e-4) & (size < 1e-3))
    return F.when(widened, plain).otherwise((value + F.lit(0.0)).cast("string"))
