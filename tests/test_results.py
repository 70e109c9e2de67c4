"""Scores, impact, audit, runs and views over rule results written out by hand."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest
from helpers import as_set, results_frame
from pyspark.sql import functions as F

from vouch.operators.audit import audit_log
from vouch.operators.impact import downstream_impact, trigger_tables
from vouch.operators.runs import new_runs, run_record, run_summary
from vouch.operators.score import grade, score, total_issues
from vouch.operators.views import latest_scores, open_critical_issues
from vouch.plans.context import RunContext
from vouch.plans.reports import HEALTHCARE_REPORTS
from vouch.plans.rules import HEALTHCARE_RULES


def test_scores_of_the_healthcare_pattern(spark, ctx):
    scores = score(results_frame(spark, ctx))
    assert as_set(scores, "table_name", "total_rules", "passed_rules", "failed_rules", "dq_score", "grade") == {
        ("patients", 9, 2, 7, 30.8, "F"),
        ("encounters", 9, 4, 5, 48.5, "F"),
        ("lab_results", 7, 3, 4, 40.9, "F"),
        ("medications", 5, 2, 3, 40.0, "F"),
    }


def test_scores_with_other_weights(spark, ctx):
    scores = score(results_frame(spark, ctx), {"Critical": 1})
    assert ("medications", 100.0, "A") in as_set(scores, "table_name", "dq_score", "grade")
    nothing = score(results_frame(spark, ctx), {})
    assert as_set(nothing, "dq_score", "grade") == {(0.0, "F")}


def test_grade_edges(spark):
    edges = {59.9: "F", 60.0: "D", 69.9: "D", 70.0: "C", 79.9: "C", 80.0: "B", 89.9: "B", 90.0: "A", 100.0: "A", 0.0: "F"}
    rows = spark.createDataFrame([(s,) for s in edges], "s double").select("s", grade(F.col("s")).alias("g"))
    assert {r.s: r.g for r in rows.collect()} == edges


def test_no_results_give_empty_frames_with_columns(spark, ctx):
    none = results_frame(spark, ctx).limit(0)
    for frame in (score(none), downstream_impact(none, HEALTHCARE_REPORTS), audit_log(none, HEALTHCARE_RULES)):
        assert frame.count() == 0
        assert frame.columns
    assert total_issues(none).first().total_issues == 0


def test_total_issues_counts_failed_rules(spark, ctx):
    assert total_issues(results_frame(spark, ctx)).first().total_issues == 19 * 10


def test_impact_reaches_all_reports_in_order(spark, ctx):
    rows = downstream_impact(results_frame(spark, ctx), HEALTHCARE_REPORTS).collect()
    assert [r.report for r in rows] == [r.report for r in HEALTHCARE_REPORTS]
    by_report = {r.report: r for r in rows}
    assert by_report["Readmission KPI Dashboard"].affected_tables == "encounters, patients"
    assert by_report["Payer Mix Dashboard"].affected_tables == "patients, encounters"
    assert by_report["Regulatory Compliance Report"].total_issues == 190
    assert {r.criticality: r.impact_level for r in rows} == {"Critical": "High", "High": "Medium", "Medium": "Medium"}


def test_mild_failures_do_not_trigger_but_count(spark, ctx):
    failing = {"PAT-004", "PAT-009", "MED-002", "MED-005"}
    passing = {r.rule_id for r in HEALTHCARE_RULES} - failing
    results = results_frame(spark, ctx, passing)
    assert as_set(trigger_tables(results), "table_name", "issues") == {("medications", 20)}
    assert as_set(downstream_impact(results, HEALTHCARE_REPORTS), "report", "affected_tables", "total_issues") == {
        ("Medication Adherence Report", "medications", 20),
        ("Regulatory Compliance Report", "medications", 20),
        ("Clinical Quality Measures", "medications", 20),
    }


def test_clean_tables_have_no_impact_and_no_audit(spark, ctx):
    results = results_frame(spark, ctx, {r.rule_id for r in HEALTHCARE_RULES})
    assert downstream_impact(results, HEALTHCARE_REPORTS).count() == 0
    assert audit_log(results, HEALTHCARE_RULES).count() == 0
    assert as_set(score(results), "dq_score", "grade") == {(100.0, "A")}


def test_audit_numbers_failed_rules_in_registry_order(spark, ctx):
    results = results_frame(spark, ctx).orderBy(F.rand(3)).repartition(4)
    rows = sorted(audit_log(results, HEALTHCARE_RULES).collect(), key=lambda r: r.log_id)
    failed = [r for r in HEALTHCARE_RULES if r.rule_id in {x.rule_id for x in rows}]
    assert [r.log_id for r in rows] == [f"AUD{i:06d}" for i in range(1, 20)]
    assert [r.rule_id for r in rows] == [r.rule_id for r in failed]
    assert {(r.event_type, r.resolved, r.event_time) for r in rows} == {("DQ_VIOLATION", False, ctx.run_time)}
    assert {(r.severity, r.action_taken) for r in rows} == {
        ("Critical", "Quarantined pending remediation"),
        ("High", "Quarantined pending remediation"),
        ("Medium", "Flagged for review"),
        ("Low", "Flagged for review"),
    }


def test_audit_restarts_numbers_each_run_and_keeps_foreign_rules(spark, ctx):
    later = RunContext(datetime(2026, 2, 1))
    both = results_frame(spark, ctx).unionAll(results_frame(spark, later))
    numbers = as_set(audit_log(both, HEALTHCARE_RULES[:5]), "run_id", "log_id")
    assert len(numbers) == 38
    assert (later.run_id, "AUD000001") in numbers


def test_open_critical_issues_order(spark, ctx):
    audit = audit_log(results_frame(spark, ctx), HEALTHCARE_RULES)
    resolved = audit.withColumn("resolved", F.col("rule_id") == "PAT-002").withColumn(
        "records_affected", F.when(F.col("rule_id") == "LAB-006", 99).otherwise(F.col("records_affected"))
    )
    rows = open_critical_issues(resolved).collect()
    assert rows[0].rule_id == "LAB-006"
    assert {r.severity for r in rows} == {"Critical", "High"}
    assert [r.severity for r in rows] == sorted(r.severity for r in rows)
    assert "PAT-002" not in {r.rule_id for r in rows}


def test_latest_scores(spark):
    day = [datetime(2026, 1, d) for d in (1, 2, 3)]
    rows = [
        ("patients", "R1", day[0], 10.0),
        ("patients", "R2", day[1], 20.0),
        ("patients", "R3", day[2], 30.0),
        ("encounters", "R1", day[0], 11.0),
        ("encounters", "R2", day[1], 21.0),
        ("lab_results", "R2", day[2], 22.0),
        ("lab_results", "R3", day[2], 33.0),
    ]
    history = spark.createDataFrame(rows, "table_name string, run_id string, run_time timestamp, dq_score double")
    for name in ("total_rules", "passed_rules", "failed_rules"):
        history = history.withColumn(name, F.lit(1).cast("bigint"))
    latest = latest_scores(history.withColumn("grade", F.lit("F")))
    assert as_set(latest, "table_name", "dq_score") == {
        ("patients", 30.0), ("encounters", 21.0), ("lab_results", 33.0),
    }


def test_run_summary_and_record(spark, ctx):
    results = results_frame(spark, ctx)
    assert as_set(run_summary(results), "run_id", "total_tables", "total_rules", "total_issues") == {
        ("RUN_20260101_000000", 4, 30, 190)
    }
    record = run_record(results, triggered_by="test")
    assert record.first().status == "Completed"
    other = run_record(results_frame(spark, replace(ctx, name="RUN_X")))
    assert as_set(new_runs(record.unionAll(other), record), "run_id") == {("RUN_X",)}
    with pytest.raises(ValueError, match="status"):
        run_record(results, status="Lost")


def test_run_ids():
    moment = datetime(2026, 3, 4, 5, 6, 7)
    assert RunContext(moment).run_id == "RUN_20260304_050607"
    assert RunContext(moment, name="nightly").run_id == "nightly"
    assert RunContext.now().run_id.startswith("RUN_")
