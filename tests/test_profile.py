from __future__ import annotations

import ast
import hashlib

import pytest
from pyspark.sql import functions as F

from vouch.operators.profile import column_sketches, completeness, merged_estimates, profile

ROWS = [
    (1, 0.5, True, "a", None),
    (2, -0.0, False, "a", None),
    (2, float("nan"), True, "it's", None),
    (None, 12345678.5, None, 'say "hi"', None),
    (3, 2.5, True, None, None),
]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(ROWS, "i int, d double, b boolean, s string, n string")


def by_name(df):
    return {r.column_name: r for r in df.collect()}


def test_measures(table):
    rows = by_name(profile({"t": table}, samples=False))
    assert [c for c, _ in sorted(rows.items(), key=lambda x: x[1].position)] == ["i", "d", "b", "s", "n"]
    i, d, b, s, n = (rows[c] for c in "idbsn")
    assert (i.total_count, i.null_count, i.null_pct, i.unique_count, i.uniqueness_pct) == (5, 1, 20.0, 3, 60.0)
    assert (i.is_numeric, i.min_value, i.max_value, i.mean_value) == (True, "1", "3", 2.0)
    assert (d.null_count, d.unique_count, d.min_value, d.max_value) == (1, 4, "0.0", "12345678.5")
    assert (b.is_numeric, b.min_value, b.max_value, b.mean_value) == (True, "False", "True", 0.75)
    assert (s.is_numeric, s.unique_count, s.min_value, s.mean_value) == (False, 3, None, None)
    assert (n.null_count, n.null_pct, n.unique_count, n.uniqueness_pct) == (5, 100.0, 0, 0.0)


def test_empty_table(table):
    rows = by_name(profile({"t": table.limit(0)}))
    assert len(rows) == 5
    for r in rows.values():
        assert (r.total_count, r.null_count, r.null_pct, r.unique_count, r.uniqueness_pct) == (0, 0, None, 0, 0.0)
        assert (r.min_value, r.mean_value, r.sample_values) == (None, None, "[]")


def test_samples_are_values_of_the_column(table):
    rows = by_name(profile({"t": table}))
    assert rows["n"].sample_values == "[]"
    assert sorted(ast.literal_eval(rows["i"].sample_values)) == [1, 2, 3]
    assert sorted(ast.literal_eval(rows["s"].sample_values)) == ["a", "it's", 'say "hi"']
    assert sorted(ast.literal_eval(rows["b"].sample_values), key=str)[0] is False
    assert len(ast.literal_eval(rows["b"].sample_values)) == 3


def test_samples_have_as_many_values_as_there_are_up_to_three(spark):
    df = spark.createDataFrame([("x", "a\\b\n"), ("x", None), ("x", None), ("x", None)], "same string, one string")
    rows = by_name(profile({"t": df}))
    assert ast.literal_eval(rows["same"].sample_values) == ["x", "x", "x"]
    assert ast.literal_eval(rows["one"].sample_values) == ["a\\b\n"]


def test_samples_are_repeatable(spark):
    df = spark.range(5000).select((F.col("id") % 700).alias("v"))
    first = profile({"t": df}).first().sample_values
    again = profile({"t": df.orderBy(F.rand(1)).repartition(13)}).first().sample_values
    assert first == again
    assert len(set(ast.literal_eval(first))) == 3


def test_whole_numbers_stay_exact(spark):
    df = spark.createDataFrame([(2**63 - 1,), (2**63 - 2,), (-(2**63),)], "v bigint")
    row = profile({"t": df}).first()
    assert (row.min_value, row.max_value) == (str(-(2**63)), str(2**63 - 1))


def test_mean_rounds_half_even(spark):
    df = spark.createDataFrame([(0.0,), (0.25,)], "v double")
    assert profile({"t": df}).first().mean_value == 0.12


def test_hot_value_and_nulls_match_brute_force(spark):
    values = ["hot"] * 3000 + [None] * 3000 + [f"v{i % 2500}" for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(6)
    row = profile({"t": df}).first()
    assert (row.total_count, row.null_count, row.unique_count) == (9000, 3000, 2501)


def test_several_tables_keep_their_columns_apart(spark, table):
    other = table.select("i", "s").where("i = 2")
    rows = {(r.table_name, r.column_name): r for r in profile({"t": table, "u": other}).collect()}
    assert len(rows) == 7
    assert (rows["t", "i"].total_count, rows["u", "i"].total_count) == (5, 2)


def test_estimated_distinct_values(table, spark):
    exact, estimated = (by_name(profile({"t": table}, samples=False, distinct=d)) for d in ("exact", "approx"))
    assert exact == estimated
    many = profile({"t": spark.range(20000)}, distinct="approx").first()
    assert abs(many.unique_count - 20000) < 1000
    blank = spark.createDataFrame([("",), ("",), ("x",), (None,)], "v string")
    assert profile({"t": blank}, distinct="approx").first().unique_count == 2
    empty = profile({"t": table.limit(0)}, distinct="approx").first()
    assert (empty.total_count, empty.unique_count, empty.null_pct) == (0, 0, None)
    with pytest.raises(ValueError, match="distinct"):
        profile({"t": table}, distinct="roughly")


def test_dates_and_odd_names(spark):
    df = spark.sql("SELECT DATE '2024-01-02' AS `a day`, 1.50BD AS `x.y`, 'v' AS `value`")
    rows = by_name(profile({"t": df}))
    assert (rows["a day"].is_numeric, rows["a day"].sample_values) == (False, "['2024-01-02']")
    assert (rows["x.y"].min_value, rows["x.y"].mean_value) == ("1.5", 1.5)
    assert by_name(profile({"t": df}, distinct="approx"))["x.y"].max_value == "1.5"


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("] parquet")


def test_scans_do_not_grow_with_columns(spark, tmp_path):
    for n in (4, 40):
        numbers = [(F.col("id") % (i + 2)).alias(f"n{i}") for i in range(n)]
        texts = [F.col("id").cast("string").alias(f"s{i}") for i in range(n)]
        spark.range(50).select(*numbers, *texts).write.parquet(str(tmp_path / str(n)))
        stored = spark.read.parquet(str(tmp_path / str(n)))
        assert scans(profile({"t": stored}, samples=False)) == 2  # one per type of column
        assert scans(profile({"t": stored}, distinct="approx")) == 1
    assert scans(profile({"t": stored}, samples=False, group=10)) == 8


def test_any_group_size_gives_equal_rows(spark, table):
    many = table.select("*", F.col("i").alias("i2"), F.upper("s").alias("s2"), (F.col("d") * 2).alias("d2"), F.col("i").cast("short").alias("h"))
    whole = sorted(map(repr, profile({"t": many, "u": table}).collect()))
    for size in (1, 2, 100):
        assert sorted(map(repr, profile({"t": many, "u": table}, group=size).collect())) == whole


def test_decimals_and_large_sums_stay_exact(spark):
    rows = [("12345678901234567.89", 2**62), ("-0.01", 2**62 + 4), (None, -(2**63)), ("5.00", None)]
    df = spark.createDataFrame(rows, "d string, n bigint").select(F.col("d").cast("decimal(38,2)").alias("d"), "n")
    for distinct in ("exact", "approx"):
        found = by_name(profile({"t": df}, samples=False, distinct=distinct))
        assert (found["d"].min_value, found["d"].max_value) == ("-0.01", "12345678901234567.89")
        assert found["n"].mean_value == 1.33  # 4 / 3, of numbers that doubles tell apart by 512 only
        assert (found["n"].min_value, found["n"].max_value) == (str(-(2**63)), str(2**62 + 4))


def test_means_of_whole_numbers_round_half_even(spark):
    values = {"a": [0] * 199 + [1], "b": [0] * 199 + [3], "c": [0] * 199 + [-1], "d": [-7] * 200}
    df = spark.createDataFrame(list(zip(*values.values())), list(values))
    assert {c: r.mean_value for c, r in by_name(profile({"t": df})).items()} == {"a": 0.0, "b": 0.02, "c": 0.0, "d": -7.0}


def test_samples_are_the_first_by_hash(spark):
    df = spark.range(3000).select((F.col("id") % 1000).cast("string").alias("v"), F.lit("x").alias("same")).repartition(7)
    rows = by_name(profile({"t": df}))
    first = sorted((str(i) for i in range(1000)), key=lambda v: hashlib.md5(v.encode()).hexdigest())[:3]
    assert ast.literal_eval(rows["v"].sample_values) == first
    assert ast.literal_eval(rows["same"].sample_values) == ["x", "x", "x"]


def test_samples_need_no_sort_of_a_whole_column(spark, tmp_path, table):
    table.write.parquet(str(tmp_path / "t"))
    plan = profile({"t": spark.read.parquet(str(tmp_path / "t"))})._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "WindowGroupLimit" in plan


def test_merged_sketches_equal_one_over_all_rows(spark):
    df = spark.range(30000).select((F.col("id") * 7919 % 25000).alias("n"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("s"))
    one = column_sketches({"t": df}, "r1")
    part = F.pmod(F.xxhash64("n", "s"), F.lit(5))
    merged = None
    for i in range(5):
        sketched = column_sketches({"t": df.where(part == i)}, f"p{i}")
        merged = sketched if merged is None else merged.unionByName(sketched)
    found, alone = (by_name(merged_estimates(s)) for s in (merged, one))
    assert {c: r.asDict() for c, r in found.items()} == {c: r.asDict() for c, r in alone.items()}
    assert abs(found["n"].unique_count - 25000) < 750 and found["s"].null_count == 10000
    assert by_name(profile({"t": df}, distinct="approx"))["n"].unique_count == alone["n"].unique_count
    again = by_name(merged_estimates(one.unionByName(one)))
    assert again["n"].unique_count == alone["n"].unique_count and again["n"].total_count == 60000


def test_completeness_is_the_profile_without_values(spark, table):
    tables = {"t": table, "e": table.limit(0)}
    columns = ("table_name", "position", "column_name", "total_count", "null_count", "null_pct")
    found = sorted((tuple(r) for r in completeness(tables).collect()), key=str)
    assert found == sorted((tuple(r) for r in profile(tables, samples=False).select(*columns).collect()), key=str)
    assert "SortMergeJoin" not in completeness({"t": table})._jdf.queryExecution().executedPlan().toString()
