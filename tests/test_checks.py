"""Every kind of check on literal rows with nulls, bad text and boundary values."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vouch.functions.checks import (
    at_least,
    custom,
    date_order,
    in_set,
    matches,
    not_future,
    not_null,
    past_date,
    references,
    unique,
)
from vouch.operators.evaluate import evaluate
from vouch.plans.rules import Rule


def broken(df, ctx, check):
    """Ids of the rows a row check reports."""
    violation = check(df, ctx.as_of_column())
    return {r.id for r in df.where(violation).collect()}


def failures(tables, check, ctx, table="t"):
    row = evaluate(tables, [Rule("R", table, "Validity", "High", "d", check)], ctx).first()
    return row.total_records, row.failed_records


def frame(spark, values, kind="string"):
    return spark.createDataFrame(list(enumerate(values)), f"id int, v {kind}")


def test_not_null(spark, ctx):
    assert broken(frame(spark, ["a", None, ""]), ctx, not_null("v")) == {1}


def test_not_null_counts_nan(spark, ctx):
    df = frame(spark, [1.0, None, float("nan")], "double")
    assert failures({"t": df}, not_null("v"), ctx) == (3, 2)


def test_in_set_lets_null_pass(spark, ctx):
    assert broken(frame(spark, ["M", "m", None, "UNKNOWN"]), ctx, in_set("v", "M", "F")) == {1, 3}


def test_in_set_across_types(spark, ctx):
    assert broken(frame(spark, [1, 7, None], "int"), ctx, in_set("v", "1", "x")) == {1}
    assert broken(frame(spark, [1, 7, None], "int"), ctx, in_set("v", 1, 2)) == {1}
    assert broken(frame(spark, ["1", "abc", None]), ctx, in_set("v", 1, 2)) == {1}


def test_matches_reports_null(spark, ctx):
    zips = ["12345", "01234", "0000", "123456", "12A45", None, "12345\n", " 12345", ""]
    assert broken(frame(spark, zips), ctx, matches("v", "[0-9]{5}")) == {2, 3, 4, 5, 6, 7, 8}


def test_matches_numbers_as_text(spark, ctx):
    assert broken(frame(spark, [12345, 123], "int"), ctx, matches("v", "[0-9]{5}")) == {1}


DATES = [
    "2024-01-01",
    "2024/01/02",
    "2024-02-30",
    "bad",
    None,
    "2026-01-02",
    "2026-01-01",
    "2024-1-1",
    "2024-01-01T",
    "2024-01-01\n",
]


def test_past_date(spark, ctx):
    assert broken(frame(spark, DATES), ctx, past_date("v")) == {1, 2, 3, 4, 5, 7, 8, 9}


def test_not_future(spark, ctx):
    assert broken(frame(spark, DATES), ctx, not_future("v")) == {5}


def test_declared_date_format(spark, ctx):
    assert broken(frame(spark, DATES), ctx, past_date("v", "yyyy/MM/dd")) == set(range(10)) - {1}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_dates_do_not_depend_on_the_session_zone(spark, ctx, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert broken(frame(spark, DATES), ctx, not_future("v")) == {5}
        typed = frame(spark, [datetime(2026, 1, 1), datetime(2026, 1, 2)], "timestamp_ntz")
        assert broken(typed, ctx, not_future("v")) == {1}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_date_columns_need_no_parsing(spark, ctx):
    df = frame(spark, ["2025-05-05", "2027-05-05", None]).select("id", F.to_date("v").alias("v"))
    assert broken(df, ctx, past_date("v")) == {1, 2}


def test_date_order_lets_missing_dates_pass(spark, ctx):
    rows = [
        (0, "2024-01-02", "2024-01-01"),
        (1, "2024-01-01", "2024-01-01"),
        (2, "2024-01-01", None),
        (3, None, "2024-01-01"),
        (4, "bad", "2024-01-01"),
        (5, "2024-01-01", "2024-01-09"),
    ]
    df = spark.createDataFrame(rows, "id int, first string, second string")
    assert broken(df, ctx, date_order("first", "second")) == {0}


def test_at_least_is_strict(spark, ctx):
    df = frame(spark, [-0.01, 0.0, None, 5.0, -999.0], "double")
    assert broken(df, ctx, at_least("v", 0)) == {0, 4}


def test_at_least_skips_text_that_is_no_number(spark, ctx):
    df = frame(spark, ["-1", " -2 ", "x", None, "-3d", "1e3", "-1000", "-inf", "", "NaN"])
    assert broken(df, ctx, at_least("v", 0)) == {0, 1, 6, 7}


def test_unique_reports_all_copies_and_equal_nulls(spark, ctx):
    df = frame(spark, ["a", "a", "b", None, None, "c"])
    assert failures({"t": df}, unique("v"), ctx) == (6, 4)
    assert failures({"t": df.where("id <> 3")}, unique("v"), ctx) == (5, 2)


def test_unique_over_several_columns(spark, ctx):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, "a")], "k int, v string")
    assert failures({"t": df}, unique("k", "v"), ctx) == (5, 4)


def test_references_reports_null_and_orphan(spark, ctx):
    child = frame(spark, ["a", "a", "b", None, "z"])
    parent = frame(spark, ["a", "a", "b", None, None])
    assert failures({"t": child, "p": parent}, references("v", "p", "v"), ctx) == (5, 2)


def test_references_with_empty_parent(spark, ctx):
    child = frame(spark, ["a", None])
    assert failures({"t": child, "p": child.where("false")}, references("v", "p", "v"), ctx) == (2, 2)


def test_references_between_text_and_number(spark, ctx):
    child, parent = frame(spark, ["1", "x", "2"]), frame(spark, [1, 3], "int")
    assert failures({"t": child, "p": parent}, references("v", "p", "v"), ctx) == (3, 2)


def test_custom_check(spark, ctx):
    df = frame(spark, [1, 2, None], "int")
    assert broken(df, ctx, custom(lambda df: F.col("v") % 2 == 0)) == {1}


@pytest.mark.parametrize("hot", ["a", None, "orphan"])
def test_key_checks_on_a_hot_key_match_brute_force(spark, ctx, hot):
    keys = [hot] * 4000 + [f"k{i % 3000}" for i in range(5000)] + [None] * 3 + ["b"]
    known = ["a", "b"] + [f"k{i}" for i in range(0, 3000, 2)] + [None]
    child = frame(spark, keys).repartition(7)
    tables = {"t": child, "p": frame(spark, known)}
    counts: dict = {}
    for k in keys:
        counts[k] = counts.get(k, 0) + 1
    copies = sum(n for n in counts.values() if n > 1)
    orphans = sum(n for k, n in counts.items() if k is None or k not in known)
    assert failures(tables, unique("v"), ctx) == (len(keys), copies)
    assert failures(tables, references("v", "p", "v"), ctx) == (len(keys), orphans)


def test_odd_column_names(spark, ctx):
    df = spark.createDataFrame([(1, None), (1, "x")], "`a.b` int, `c d` string")
    assert failures({"t": df}, not_null("c d"), ctx) == (2, 1)
    assert failures({"t": df}, unique("a.b"), ctx) == (2, 2)
