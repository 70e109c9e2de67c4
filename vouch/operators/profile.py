"""Column profiles: completeness, distinct values, range, mean and sample values."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vouch.functions.frames import union_all
from vouch.functions.nulls import column, nan_to_null
from vouch.functions.numeric import number_text, pct

SAMPLE_SIZE = 3

# Two to this power is the number of buckets of a distinct-value sketch.
SKETCH_BITS = 14

# Kinds of columns; all but text are numeric.
TEXT, WHOLE, FRACTION, EXACT, TRUTH = "text", "whole", "fraction", "exact", "truth"


@dataclass(frozen=True)
class ProfiledColumn:
    tag: str
    table_name: str
    position: int
    column_name: str
    kind: str
    carrier: str


def kind(data_type: T.DataType) -> str:
    if isinstance(data_type, T.BooleanType):
        return TRUTH
    if isinstance(data_type, T.IntegralType):
        return WHOLE
    if isinstance(data_type, T.DecimalType):
        return EXACT
    return FRACTION if isinstance(data_type, T.NumericType) else TEXT


def profile(
    tables: dict[str, DataFrame],
    samples: bool = True,
    distinct: str = "exact",
    group: int | None = None,
) -> DataFrame:
    """``data_profile``: one row per column of every table, in column order by ``position``.

    Exact profiles turn the columns of one type into rows of (column, value) and count those:
    Spark combines equal values before the one shuffle they need, and a table is read once
    per type among its columns, however many columns it has. ``group`` limits the columns that
    are turned at once, which reads the table more often and gives the same rows. Give it
    stored tables (``sources.staging``), not joins or text files, which would be worked out
    anew for every type.

    ``distinct="approx"`` estimates the distinct values (relative error about 1 %) and
    takes no samples; it needs one scan per table and no shuffle of values.
    """
    if distinct not in ("exact", "approx"):
        raise ValueError(f"distinct must be exact or approx, not {distinct!r}")
    tables = {name: nan_to_null(df) for name, df in tables.items()}
    columns = _columns(tables)
    spark = next(iter(tables.values())).sparkSession
    if distinct == "approx":
        sketched = [_sketched(df, [c for c in columns if c.table_name == name]) for name, df in tables.items()]
        estimate = F.hll_sketch_estimate(F.hll_union("sketch", "sketch")).alias("unique_count")
        return _rows(spark, columns, union_all(sketched).select("*", estimate).drop("sketch"))
    values = []
    for name, df in tables.items():
        for carrier in dict.fromkeys(c.carrier for c in columns if c.table_name == name):
            same = [c for c in columns if c.table_name == name and c.carrier == carrier]
            size = group or len(same)
            values += [(same[0].kind, _values(df, same[i : i + size])) for i in range(0, len(same), size)]
    rows = _rows(spark, columns, union_all([_measures(kind, counted) for kind, counted in values]))
    if not samples:
        return rows
    picked = union_all([_samples(kind, counted) for kind, counted in values])
    picked = picked.join(_column_frame(spark, columns).select("tag", "table_name", "position"), "tag")
    return (
        rows.join(picked.drop("tag"), ["table_name", "position"], "left")
        .select(*rows.columns, F.coalesce("sample_values", F.lit("[]")).alias("sample_values"))
    )


def completeness(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, position, column_name, total_count, null_count, null_pct of every column.

    The part of a profile that needs no distinct values: one scan per table, nothing shuffled.
    """
    tables = {name: nan_to_null(df) for name, df in tables.items()}
    columns, parts = _columns(tables), []
    for name, df in tables.items():
        own = [c for c in columns if c.table_name == name]
        nulls = [F.count_if(column(c.column_name).isNull()).alias(f"nulls_{c.position}") for c in own]
        rows = [F.struct(F.lit(c.tag).alias("tag"), "total_count", F.col(f"nulls_{c.position}").alias("null_count")) for c in own]
        parts.append(df.agg(F.count(F.lit(1)).alias("total_count"), *nulls).select(F.explode(F.array(*rows)).alias("row")).select("row.*"))
    share = F.when(F.col("total_count") > 0, pct(F.col("null_count"), F.col("total_count"), 2)).alias("null_pct")
    known = _column_frame(next(iter(tables.values())).sparkSession, columns).join(union_all(parts), "tag")
    return known.select("table_name", "position", "column_name", "total_count", "null_count", share)


def column_sketches(tables: dict[str, DataFrame], run_id: str | None = None) -> DataFrame:
    """run_id, table_name, position, column_name, total_count, null_count, sketch of every column.

    A sketch holds the distinct values of a column in a few kilobytes. Stored with a run, or made
    per part of a table, sketches merge later (``merged_estimates``) without reading the tables again.
    """
    tables = {name: nan_to_null(df) for name, df in tables.items()}
    columns = _columns(tables)
    sketched = union_all([_sketched(df, [c for c in columns if c.table_name == name]) for name, df in tables.items()])
    known = _column_frame(next(iter(tables.values())).sparkSession, columns).join(sketched, "tag")
    kept = ("table_name", "position", "column_name", "total_count", "null_count", "sketch")
    return known.select(F.lit(run_id).cast("string").alias("run_id"), *kept)


def merged_estimates(sketches: DataFrame) -> DataFrame:
    """table_name, column_name, total_count, null_count, unique_count over all sketches of a column.

    A sketch that never was merged estimates by the order of its values, so each is merged with
    itself first: parts merged in any order then give the same as one sketch over all their rows.
    """
    return sketches.groupBy("table_name", "column_name").agg(
        F.sum("total_count").alias("total_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg(F.hll_union("sketch", "sketch"))).alias("unique_count"),
    )


def _columns(tables: dict[str, DataFrame]) -> list[ProfiledColumn]:
    return [
        ProfiledColumn(f"{number}.{position}", name, position, field.name, kind(field.dataType), _carrier(field.dataType))
        for number, (name, df) in enumerate(tables.items())
        for position, field in enumerate(df.schema)
    ]


def _carrier(data_type: T.DataType) -> str:
    """The type that values are counted in: columns of equal carriers share a shuffle."""
    return "bigint" if isinstance(data_type, T.IntegralType) else data_type.simpleString()


def _column_frame(spark: SparkSession, columns: list[ProfiledColumn]) -> DataFrame:
    names = ("tag", "table_name", "position", "column_name", "kind")
    types = [(name, pa.int32() if name == "position" else pa.string()) for name in names]
    listed = [{name: getattr(c, name) for name in names} for c in columns]
    return spark.createDataFrame(pa.Table.from_pylist(listed, schema=pa.schema(types)))


def _values(df: DataFrame, columns: list[ProfiledColumn]) -> DataFrame:
    """tag, value, records: the distinct values of columns of one carrier, null included."""
    carried = df.select(*[column(c.column_name).cast(c.carrier).alias(c.tag) for c in columns])
    turned = carried.unpivot([], [column(c.tag) for c in columns], "tag", "value")
    return turned.groupBy("tag", "value").agg(F.count(F.lit(1)).alias("records"))


def _measures(kind: str, values: DataFrame) -> DataFrame:
    """Counts, range and mean per column, from its distinct values."""
    records, value, known = F.col("records"), F.col("value"), F.col("value").isNotNull()
    counted = values.groupBy("tag").agg(
        F.sum(records).alias("total_count"),
        F.sum(F.when(known, 0).otherwise(records)).alias("null_count"),
        F.count_if(known).alias("unique_count"),
        *_range(kind, value, records),
    )
    return counted.select("tag", "total_count", "null_count", "unique_count", *_range_texts(kind))


def _range(kind: str, value: Column, records: Column, suffix: str = "") -> list[Column]:
    """Aggregates behind range and mean: every kind adds up in a type that loses nothing."""
    if kind == TEXT:
        return []
    if kind == TRUTH:
        value = value.cast("int")
    exact = {WHOLE: "decimal(20,0)", TRUTH: "decimal(20,0)"}.get(kind)
    weighed = F.try_multiply(value.cast(exact) if exact else value, records.cast(exact or "bigint"))
    return [
        F.min(value).alias(f"least{suffix}"),
        F.max(value).alias(f"greatest{suffix}"),
        F.try_sum(weighed).alias(f"total{suffix}"),
        F.sum(F.when(value.isNotNull(), records)).cast("bigint").alias(f"known{suffix}"),
    ]


def _range_texts(kind: str, suffix: str = "") -> list[Column]:
    """min_value, max_value and mean_value from the aggregates of ``_range``."""
    if kind == TEXT:
        return [F.lit(None).cast(t).alias(n) for n, t in (("min_value", "string"), ("max_value", "string"), ("mean_value", "double"))]
    total, known = F.col(f"total{suffix}"), F.col(f"known{suffix}")
    if kind in (WHOLE, TRUTH):
        mean = _exact_mean(total, known)
    else:
        mean = F.bround(F.try_divide(total, known), 2).cast("double")
    # + 0.0 turns a negative zero into zero
    return [
        _number_text(kind, F.col(f"least{suffix}")).alias("min_value"),
        _number_text(kind, F.col(f"greatest{suffix}")).alias("max_value"),
        (mean + F.lit(0.0)).alias("mean_value"),
    ]


def _number_text(kind: str, value: Column) -> Column:
    if kind == TRUTH:
        return F.initcap(value.cast("boolean").cast("string"))
    if kind == EXACT:
        return F.regexp_replace(value.cast("string"), r"(\.[0-9]+?)0+$", "$1")
    return number_text(value.cast("double")) if kind == FRACTION else value.cast("string")


def _exact_mean(total: Column, known: Column) -> Column:
    """A sum of whole numbers over their count, half-even at two decimals, without a double on the way."""
    n = F.nullif(known, F.lit(0)).cast("decimal(20,0)")
    whole, rest = F.call_function("div", total, n), (total % n).cast("bigint")
    cents, left = F.call_function("div", F.abs(rest) * 100, known), (F.abs(rest) * 100) % known
    up = (2 * left > known) | ((2 * left == known) & (cents % 2 == 1))
    cents = F.signum(rest) * (cents + F.when(up, 1).otherwise(0))
    return whole.cast("double") + cents / F.lit(100.0)


def _sketched(df: DataFrame, columns: list[ProfiledColumn]) -> DataFrame:
    """Like ``_measures`` in one aggregate over the table, with a sketch in place of the distinct values.

    The sketches take a hash, as they skip empty text. They are merged even if there is but
    one, as a merged sketch estimates from its contents alone.
    """
    counts, rows = [F.count(F.lit(1)).alias("total_count")], []
    for c in columns:
        own, value = f"_{c.position}", column(c.column_name)
        hashed = F.when(value.isNotNull(), F.xxhash64(value.cast(c.carrier)))
        counts += [F.count_if(value.isNull()).alias(f"nulls{own}"), F.hll_sketch_agg(hashed, F.lit(SKETCH_BITS)).alias(f"sketch{own}")]
        counts += _range(c.kind, value, F.lit(1), own)
        nulls, sketch = F.col(f"nulls{own}").alias("null_count"), F.col(f"sketch{own}").alias("sketch")
        rows.append(F.struct(F.lit(c.tag).alias("tag"), "total_count", nulls, sketch, *_range_texts(c.kind, own)))
    return df.agg(*counts).select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def _rows(spark: SparkSession, columns: list[ProfiledColumn], measures: DataFrame) -> DataFrame:
    """The profile of every column; a table without records has no measures."""
    total, nulls, distinct = F.col("total_count"), F.col("null_count"), F.col("unique_count")
    return (
        _column_frame(spark, columns)
        .join(measures, "tag", "left")
        .na.fill(0, ["total_count", "null_count", "unique_count"])
        .select(
            "table_name",
            "position",
            "column_name",
            "total_count",
            "null_count",
            F.when(total > 0, pct(nulls, total, 2)).alias("null_pct"),
            "unique_count",
            pct(distinct, total, 2).alias("uniqueness_pct"),
            (F.col("kind") != TEXT).alias("is_numeric"),
            "min_value",
            "max_value",
            "mean_value",
        )
    )


def _samples(kind: str, values: DataFrame) -> DataFrame:
    """Up to three non-null values per column, in the order of a hash of their text.

    Distinct values come first, repeated ones fill up. They come from the counted values that
    the measures use; every task passes on three values per column.
    """
    text = F.col("value").cast("string")
    placed = values.where("value is not null").select("tag", "records", text.alias("plain"), _sample_text(kind).alias("text"), F.md5(text).alias("place"))
    first = Window.partitionBy("tag").orderBy("place", "plain")
    picked = placed.withColumn("number", F.row_number().over(first)).where(F.col("number") <= SAMPLE_SIZE)
    lines = F.sort_array(F.collect_list(F.struct("number", "text", F.least("records", F.lit(SAMPLE_SIZE)).cast("int").alias("records"))))
    listed = "concat(transform(lines, l -> l.text), flatten(transform(lines, l -> array_repeat(l.text, l.records - 1))))"
    joined = f"concat('[', array_join(slice({listed}, 1, {SAMPLE_SIZE}), ', '), ']') AS sample_values"
    return picked.groupBy("tag").agg(lines.alias("lines")).selectExpr("tag", joined)


def _sample_text(kind: str) -> Column:
    """A value as it shows in a list: numbers bare, all else in quotes."""
    if kind == TRUTH:
        return F.expr("initcap(cast(value AS string))")
    if kind != TEXT:
        return F.expr("cast(value AS string)")
    backslash, quote = r"'\\'", r"'\''"
    escaped = rf"replace(replace(cast(value AS string), {backslash}, '\\\\'), '\n', '\\n')"
    return F.expr(
        rf"""CASE WHEN contains(cast(value AS string), {quote}) AND NOT contains(cast(value AS string), '"') """
        rf"""THEN concat('"', {escaped}, '"') ELSE concat({quote}, replace({escaped}, {quote}, '\\\''), {quote}) END"""
    )
