from __future__ import annotations

import pytest
from conftest import DATA
from helpers import as_set
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from vouch.functions.checks import at_least, custom, in_set, not_null, references, unique
from vouch.operators.evaluate import evaluate, isolated
from vouch.plans.rules import HEALTHCARE_RULES, Rule, registry_frame, rules_for
from vouch.plans.run import run_all
from vouch.suite.fixtures import CONTEXT, JOINED_VIEWS, RAW_RULES, RAW_TABLES, dirty, raw

SF = f"{DATA}/sf0.01"

# table -> records and failed records per rule, in rule order
GOLDEN = {
    "patients": (1500, [0, 46, 60, 75, 30, 45, 16, 76, 150]),
    "encounters": (15000, [0, 38, 150, 455, 57, 24, 300, 174, 30]),
    "lab_results": (60000, [46, 1885, 606, 1133, 129, 366, 305]),
    "medications": (10000, [0, 303, 200, 30, 25]),
}
GOLDEN_RAW = {
    "SUP-001": 0, "SUP-002": 0, "SUP-003": 0, "SUP-004": 6, "PRT-001": 0, "PRT-002": 0, "PRT-003": 0,
    "PRT-004": 2000, "ORD-001": 0, "ORD-002": 0, "ORD-003": 5088, "CUS-001": 0, "CUS-002": 122, "CUS-003": 0,
}


def rule(rule_id, check, table="t", severity="High", category="Validity"):
    return Rule(rule_id, table, category, severity, "text", check)


def test_all_healthcare_rules(spark, ctx):
    rows = evaluate(dirty(spark, SF), HEALTHCARE_RULES, ctx).collect()
    assert len(rows) == 30
    for r in rows:
        assert r.failed_records + r.passed_records == r.total_records
        assert r.status == ("PASS" if r.failed_records == 0 else "FAIL")
    by_rule = {r.rule_id: r for r in rows}
    for table, (records, failed) in GOLDEN.items():
        rules = rules_for(HEALTHCARE_RULES, table)
        assert [by_rule[r.rule_id].failed_records for r in rules] == failed
        assert {by_rule[r.rule_id].total_records for r in rules} == {records}


def test_raw_rules(spark, ctx):
    results = evaluate(raw(spark, SF, *RAW_TABLES, "nation"), RAW_RULES, ctx)
    assert as_set(results, "rule_id", "failed_records") == set(GOLDEN_RAW.items())


def test_order_and_partitioning_do_not_matter(spark, ctx):
    tables = dirty(spark, f"{DATA}/sf0.001")
    shuffled = {name: df.orderBy(F.rand(7)).repartition(5) for name, df in tables.items()}
    columns = ("rule_id", "total_records", "failed_records")
    assert as_set(evaluate(tables, HEALTHCARE_RULES, ctx), *columns) == as_set(
        evaluate(shuffled, HEALTHCARE_RULES, ctx), *columns
    )


def test_empty_tables_pass_at_rate_zero(spark, ctx):
    tables = {name: df.limit(0) for name, df in dirty(spark, f"{DATA}/sf0.001").items()}
    rows = evaluate(tables, HEALTHCARE_RULES, ctx).collect()
    assert len(rows) == 30
    assert {(r.total_records, r.failed_records, r.pass_rate_pct, r.status) for r in rows} == {(0, 0, 0.0, "PASS")}


def test_faulty_checks_count_as_passed_and_are_reported(spark, ctx, caplog):
    df = spark.createDataFrame([("a",), (None,)], "v string")

    def explode(_df, _as_of):
        raise RuntimeError("boom")

    rules = [
        rule("R1", not_null("absent")),
        rule("R2", explode),
        rule("R3", custom(lambda d: F.col("v"))),
        rule("R4", unique("v", "absent")),
        rule("R5", not_null("v")),
    ]
    errors = []
    rows = {r.rule_id: r for r in evaluate({"t": df}, rules, ctx, errors).collect()}
    assert {k: (r.failed_records, r.status) for k, r in rows.items()} == {
        "R1": (0, "PASS"), "R2": (0, "PASS"), "R3": (0, "PASS"), "R4": (0, "PASS"), "R5": (1, "FAIL"),
    }
    assert {r.total_records for r in rows.values()} == {2}
    assert {e.rule_id for e in errors} == {"R1", "R2", "R3", "R4"}
    assert "R2" in caplog.text


def test_keys_that_cannot_be_compared_are_reported(spark, ctx):
    child = spark.createDataFrame([(1, {"x": 1}), (1, {"x": 2})], "v int, m map<string,int>")
    parent = spark.createDataFrame([([1],)], "k array<int>")
    rules = [rule("U", unique("m")), rule("P", references("v", "p", "k")), rule("V", unique("v"))]
    errors = []
    results = evaluate({"t": child, "p": parent}, rules, ctx, errors)
    assert as_set(results, "rule_id", "total_records", "failed_records") == {("U", 2, 0), ("P", 2, 0), ("V", 2, 2)}
    # maps can be compared, a number with a list cannot
    assert {e.rule_id for e in errors} == {"P"}
    assert "\n" not in errors[0].message


def test_reference_from_an_absent_column_holds(spark, ctx):
    df = spark.createDataFrame([("a",)], "v string")
    errors = []
    row = evaluate({"t": df, "p": df}, [rule("R", references("absent", "p", "v"))], ctx, errors).first()
    assert (row.failed_records, row.status, errors) == (0, "PASS", [])


def test_checks_of_one_key_share_its_counts(spark, ctx):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    parent = spark.createDataFrame([("a",)], "k string")
    other = spark.createDataFrame([("b",)], "k string")
    rules = [
        rule("U", unique("v")),
        rule("P", references("v", "p", "k")),
        rule("O", references("v", "o", "k")),
        rule("N", in_set("v", "a")),
    ]
    results = evaluate({"t": child, "p": parent, "o": other}, rules, ctx)
    assert as_set(results, "rule_id", "total_records", "failed_records") == {
        ("U", 4, 2), ("P", 4, 2), ("O", 4, 3), ("N", 4, 1),
    }


def test_misuse_is_refused(spark, ctx):
    df = spark.createDataFrame([("a",)], "v string")
    with pytest.raises(ValueError, match="no such tables: u"):
        evaluate({"t": df}, [rule("R", not_null("v"), table="u")], ctx)
    with pytest.raises(ValueError, match="no such tables: p"):
        evaluate({"t": df}, [rule("R", references("v", "p", "v"))], ctx)
    with pytest.raises(ValueError, match="unique"):
        evaluate({"t": df}, [rule("R", not_null("v")), rule("R", not_null("v"))], ctx)
    with pytest.raises(ValueError, match="severity"):
        rule("R", not_null("v"), severity="Severe")
    with pytest.raises(ValueError, match="category"):
        rule("R", not_null("v"), category="Beauty")


def test_registry(spark, ctx):
    rows = registry_frame(spark, HEALTHCARE_RULES, ctx).collect()
    assert [r.rule_id for r in rows] == [r.rule_id for r in HEALTHCARE_RULES]
    by_category = {}
    for r in rows:
        by_category[r.category] = by_category.get(r.category, 0) + 1
    assert by_category == {"Completeness": 15, "Validity": 11, "Uniqueness": 2, "Referential": 2}


def test_one_scan_for_all_row_checks(spark, ctx):
    tables = raw(spark, SF, "customer")
    rules = [rule(f"R{i}", in_set("c_mktsegment", "x"), table="customer") for i in range(5)]
    plan = evaluate(tables, rules, ctx)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "ReadSchema: struct<c_mktsegment:string>" in plan


def test_views_give_the_rows_that_tables_give(spark):
    tables = dirty(spark, f"{DATA}/sf0.001", "lab_results", "patients", "encounters")
    rules = rules_for(HEALTHCARE_RULES, "lab_results", "patients", "encounters")
    apart, once = (evaluate(tables, rules, CONTEXT, views=v) for v in ((), ("lab_results", "patients", "encounters")))
    columns = ("rule_id", "total_records", "failed_records", "status")
    assert as_set(apart, *columns) == as_set(once, *columns) and once.count() == 25
    empty = {name: df.where("false") for name, df in tables.items()}
    assert as_set(evaluate(empty, rules, CONTEXT, views=tables), "total_records", "failed_records") == {(0, 0)}


def scans_of(results, column):
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    return sum(line.lstrip(" +-:").startswith("Relation [") and column in line for line in plan.splitlines())


def test_one_join_of_lineitem_and_orders(spark):
    tables = dirty(spark, f"{DATA}/sf0.001", "lab_results", "patients")
    results = evaluate(tables, rules_for(HEALTHCARE_RULES, "lab_results"), CONTEXT, views=JOINED_VIEWS)
    assert scans_of(results, "l_orderkey#") == 1 and scans_of(results, "o_orderkey#") == 1


def test_a_bad_value_ends_no_run(spark, ctx):
    df = spark.createDataFrame([("1", 1), ("x", 0), (None, 2)], "t string, n int")
    rules = [
        Rule("A", "t", "Validity", "High", "plain", at_least("n", 1)),
        Rule("B", "t", "Validity", "High", "text as a number", custom(lambda df: F.col("t").cast("int") > 5)),
        Rule("C", "t", "Uniqueness", "High", "unique", unique("n")),
        Rule("D", "t", "Validity", "High", "division", custom(lambda df: F.lit(1) / F.col("n") > 5)),
        Rule("E", "u", "Validity", "High", "other table", at_least("n", 2)),
        Rule("F", "u", "Validity", "High", "absent", not_null("nothing")),
    ]
    for views in ((), ("t",)):
        errors = []
        results = isolated(evaluate, {"t": df, "u": df}, rules, ctx, errors, views)
        assert as_set(results, "rule_id", "total_records", "failed_records", "status") == {
            ("A", 3, 1, "FAIL"), ("B", 3, 0, "PASS"), ("C", 3, 0, "PASS"), ("D", 3, 0, "PASS"), ("E", 3, 2, "FAIL"), ("F", 3, 0, "PASS"),
        }
        assert sorted(e.rule_id for e in errors) == ["B", "D", "F"]
        assert "CAST_INVALID_INPUT" in next(e.message for e in errors if e.rule_id == "B")


def test_a_whole_run_outlives_a_bad_value(spark, ctx):
    df = spark.createDataFrame([("x", 1)], "t string, n int")
    errors = []
    rules = [Rule("B", "t", "Validity", "High", "text as a number", custom(lambda df: F.col("t").cast("int") > 5))]
    sent = spark.createDataFrame([], "table_name string, source_count bigint")
    frames = run_all({"t": df}, ctx, sent, rules, [], errors=errors)
    assert frames["dq_results"].first().status == "PASS" and [e.rule_id for e in errors] == ["B"]


def as_number(rule_id, table):
    return Rule(rule_id, table, "Validity", "High", "text as a number", custom(lambda df: F.col("t").cast("int") > 5))


def test_tables_that_fail_at_once_end_no_run(spark, ctx):
    df = spark.createDataFrame([("x", 1)], "t string, n int")
    tables = {f"t{i}": df for i in range(5)}
    for attempt in (1, 2, 3):
        # the tables of many rules, new in each attempt, keep the planner busy while the first ones fail
        good = [rule(f"G{n}-{i}", at_least("n", 1000 * attempt + i), n) for n in ("t3", "t4") for i in range(60)]
        errors = []
        results = isolated(evaluate, tables, [as_number(f"B{n}", n) for n in ("t0", "t1", "t2")] + good, ctx, errors)
        expected = {("Bt0", 1, 0), ("Bt1", 1, 0), ("Bt2", 1, 0)} | {(r.rule_id, 1, 1) for r in good}
        assert as_set(results, "rule_id", "total_records", "failed_records") == expected
        assert sorted(e.rule_id for e in errors) == ["Bt0", "Bt1", "Bt2"]
        assert all("CAST_INVALID_INPUT" in e.message for e in errors)


@pytest.fixture
def not_adaptive(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", False)
    yield
    spark.conf.set("spark.sql.adaptive.enabled", before)


def test_a_bad_value_in_a_broadcast_ends_no_run(spark, ctx, not_adaptive):
    df = spark.createDataFrame([("x", 1), ("y", 0)], "t string, n int")
    divided = F.udf(lambda n: 1 // n > 5, "boolean")
    rules = [
        Rule("A", "t", "Validity", "High", "plain", at_least("n", 1)),
        as_number("B", "t"),
        Rule("C", "t", "Validity", "High", "division in Python", custom(lambda df: divided("n"))),
    ]
    errors = []
    results = isolated(evaluate, {"t": df}, rules, ctx, errors)
    assert as_set(results, "rule_id", "total_records", "failed_records") == {("A", 2, 1), ("B", 2, 0), ("C", 2, 0)}
    assert [e.rule_id for e in errors] == ["B", "C"]
    assert "CAST_INVALID_INPUT" in errors[0].message


@pytest.mark.parametrize("tables", [1, 8])
@pytest.mark.parametrize("adaptive", [True, False])
def test_a_file_that_cannot_be_read_ends_the_run(spark, ctx, tmp_path, request, tables, adaptive):
    if not adaptive:
        request.getfixturevalue("not_adaptive")
    (tmp_path / "broken.parquet").write_bytes(b"no Parquet at all")
    df = spark.read.schema("t string, n int").parquet(str(tmp_path))
    names = [f"t{i}" for i in range(tables)]
    errors = []
    with pytest.raises(Py4JJavaError, match="FAILED_READ_FILE"):
        isolated(evaluate, dict.fromkeys(names, df), [as_number(f"B{n}", n) for n in names], ctx, errors)
    assert errors == []
