"""Rule checks.

A row check is a function ``(df, as_of) -> Column`` whose Column is true where a row
breaks the rule; NULL counts as not broken. Uniqueness and references need more than
one row, so they are plain descriptions that ``operators.evaluate`` turns into group-bys
and joins.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vouch.functions.nulls import column

RowCheck = Callable[[DataFrame, Column], Column]

ISO_DATE = "yyyy-MM-dd"
ISO_DATE_SHAPE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


@dataclass(frozen=True)
class Unique:
    """Every row of a group of equal keys breaks the rule; nulls equal each other."""

    columns: tuple[str, ...]


@dataclass(frozen=True)
class References:
    """The key must occur among the parent's non-null keys; a null key breaks the rule."""

    column: str
    parent_table: str
    parent_key: str


Check = RowCheck | Unique | References


def column_type(df: DataFrame, name: str) -> T.DataType | None:
    return next((f.dataType for f in df.schema if f.name == name), None)


def moment(df: DataFrame, name: str, date_format: str = ISO_DATE) -> Column:
    """A column as timestamp without zone; NULL for text that is not a date."""
    value = column(name)
    if isinstance(column_type(df, name), (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return value.cast("timestamp_ntz")
    text = value.cast("string")
    if date_format == ISO_DATE:
        # the shape test plus a plain date cast runs twice as fast as a format parser
        return F.when(text.rlike(ISO_DATE_SHAPE), text.try_cast("date")).cast("timestamp_ntz")
    return F.try_to_timestamp(text, F.lit(date_format)).cast("timestamp_ntz")


def plain_number(text: Column) -> Column:
    """Text without Java's ``12d`` and ``12f``, which a cast would take for numbers."""
    return F.when(~text.rlike(r"[0-9.]\s*[dDfF]\s*\z"), text)


def number(df: DataFrame, name: str) -> Column:
    """A column as double; NULL for text that is not a number."""
    value = column(name)
    if isinstance(column_type(df, name), T.StringType):
        value = plain_number(value)
    return value.try_cast("double")


def not_null(name: str) -> RowCheck:
    return lambda df, as_of: column(name).isNull()


def in_set(name: str, *allowed: str | int | float) -> RowCheck:
    """A value outside ``allowed`` breaks the rule; null does not.

    Values of other types than the column are compared as text.
    """

    def check(df: DataFrame, as_of: Column) -> Column:
        if isinstance(column_type(df, name), T.NumericType) and not any(
            isinstance(a, str) for a in allowed
        ):
            return ~column(name).isin(*allowed)
        if isinstance(column_type(df, name), T.BooleanType):
            return ~column(name).isin(*[str(a).lower() == "true" for a in allowed])
        return ~column(name).cast("string").isin(*[str(a) for a in allowed])

    return check


def matches(name: str, pattern: str) -> RowCheck:
    """A value whose whole text does not match ``pattern`` breaks the rule, as does null."""
    return lambda df, as_of: ~F.coalesce(
        column(name).cast("string").rlike(rf"\A(?:{pattern})\z"), F.lit(False)
    )


def past_date(name: str, date_format: str = ISO_DATE) -> RowCheck:
    """A date that is missing, unreadable or after ``as_of`` breaks the rule."""

    def check(df: DataFrame, as_of: Column) -> Column:
        value = moment(df, name, date_format)
        return value.isNull() | (value > as_of)

    return check


def date_order(earlier: str, later: str, date_format: str = ISO_DATE) -> RowCheck:
    """``later`` before ``earlier`` breaks the rule; missing or unreadable dates do not."""
    return lambda df, as_of: moment(df, later, date_format) < moment(df, earlier, date_format)


def not_future(name: str, date_format: str = ISO_DATE) -> RowCheck:
    """A date after ``as_of`` breaks the rule; a missing or unreadable one does not."""
    return lambda df, as_of: moment(df, name, date_format) > as_of


def at_least(name: str, bound: float) -> RowCheck:
    """A number below ``bound`` breaks the rule; null and text without a number do not."""
    return lambda df, as_of: number(df, name) < F.lit(float(bound))


def custom(violation: Callable[[DataFrame], Column]) -> RowCheck:
    """Any boolean Column over the table, true where a row breaks the rule."""
    return lambda df, as_of: violation(df)


def unique(*names: str) -> Unique:
    return Unique(names)


def references(name: str, parent_table: str, parent_key: str) -> References:
    return References(name, parent_table, parent_key)
