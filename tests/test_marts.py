from __future__ import annotations

import pytest
from helpers import as_set, results_frame

from vouch.operators import marts
from vouch.operators.audit import audit_log
from vouch.operators.impact import downstream_impact
from vouch.operators.reconcile import reconcile
from vouch.operators.score import score
from vouch.plans.reports import HEALTHCARE_REPORTS
from vouch.plans.rules import HEALTHCARE_RULES


@pytest.fixture
def results(spark, ctx):
    return results_frame(spark, ctx)


def test_filter(results):
    chosen = marts.filter_results(results, ["patients"], ["Critical", "Low"])
    assert as_set(chosen, "rule_id") == {("PAT-001",), ("PAT-002",), ("PAT-007",), ("PAT-009",)}
    assert marts.filter_results(results).count() == 30
    assert marts.filter_results(results, []).count() == 0


def test_kpi_cards(results):
    cards = marts.kpi_cards(
        results,
        score(results),
        audit_log(results, HEALTHCARE_RULES),
        downstream_impact(results, HEALTHCARE_REPORTS),
    ).first()
    # mean of 30.8, 48.5, 40.9 and 40.0 is 40.05: half-even
    assert cards.asDict() == {
        "tables_scanned": 4,
        "total_rules": 30,
        "total_issues": 190,
        "critical_issues": 50,
        "rule_pass_rate": 36.7,
        "overall_score": 40.0,
        "open_audit_issues": 19,
        "reports_affected": 7,
    }


def test_kpi_cards_of_a_clean_run(spark, ctx):
    clean = results_frame(spark, ctx, {r.rule_id for r in HEALTHCARE_RULES})
    cards = marts.kpi_cards(
        clean, score(clean), audit_log(clean, HEALTHCARE_RULES), downstream_impact(clean, HEALTHCARE_REPORTS)
    ).first()
    assert (cards.total_issues, cards.open_audit_issues, cards.reports_affected) == (0, 0, 0)
    assert (cards.overall_score, cards.rule_pass_rate) == (100.0, 100.0)


def test_score_bands(spark):
    scores = spark.createDataFrame(
        [("a", 59.9, "F"), ("b", 60.0, "D"), ("c", 79.9, "C"), ("d", 80.0, "B"), ("e", 100.0, "A")],
        "table_name string, dq_score double, grade string",
    )
    assert as_set(marts.score_bands(scores), "table_name", "band") == {
        ("a", "0-60"), ("b", "60-80"), ("c", "60-80"), ("d", "80-100"), ("e", "80-100"),
    }


def test_record_flow_truncates_and_skips_tables_without_score(spark, ctx, results):
    tables = {"patients": spark.range(805), "lab_results": spark.range(100), "other": spark.range(3)}
    sent = spark.createDataFrame([("patients", 800)], "table_name string, source_count bigint")
    flow = marts.record_flow(reconcile(tables, sent, ctx), score(results))
    assert as_set(flow, "table_name", "source_count", "passed_records", "failed_records") == {
        ("patients", 800, 805 * 2 // 9, 805 - 805 * 2 // 9),
        ("lab_results", 100, 42, 58),
    }


def test_rule_summary_fills_missing_status(spark, ctx):
    passing = {r.rule_id for r in HEALTHCARE_RULES if r.table_name == "patients"}
    results = results_frame(spark, ctx, passing)
    assert as_set(marts.rule_summary(results, score(results)), "table_name", "passed", "failed", "grade") == {
        ("patients", 9, 0, "A"), ("encounters", 0, 9, "F"), ("lab_results", 0, 7, "F"), ("medications", 0, 5, "F"),
    }


def test_issue_totals(results):
    severities = [(r.severity, r.failed_records) for r in marts.issues_by_severity(results).collect()]
    assert severities == [("High", 100), ("Critical", 50), ("Medium", 30), ("Low", 10)]
    assert as_set(marts.issues_by_category(results), "category", "failed_records", "share_pct") == {
        ("Completeness", 100, 52.6), ("Validity", 70, 36.8), ("Referential", 20, 10.5),
    }
    assert ("medications", "High", 30) in as_set(
        marts.issues_by_table_severity(results), "table_name", "severity", "failed_records"
    )


def test_failed_rules_order(results):
    rows = marts.failed_rules(results).collect()
    ranks = ["Critical", "High", "Medium", "Low"]
    assert [ranks.index(r.severity) for r in rows] == sorted(ranks.index(r.severity) for r in rows)
    assert len(rows) == 19


def test_heatmap_and_radar_take_missing_as_100(results):
    heat = {r.table_name: r.asDict() for r in marts.heatmap(results).collect()}
    assert heat["medications"] == {
        "table_name": "medications", "Completeness": 33.3, "Validity": 50.0, "Uniqueness": 100.0, "Referential": 100.0,
        "Timeliness": 100.0, "Consistency": 100.0,
    }
    assert heat["patients"]["Uniqueness"] == 100.0
    assert heat["encounters"]["Referential"] == 0.0
    radar = {(r.table_name, r.category): r.pass_rate for r in marts.radar(results).collect()}
    assert radar == {(t, c): v for t, row in heat.items() for c, v in row.items() if c in marts.SHOWN_CATEGORIES}


def test_reconciliation_views(spark, ctx):
    sent = spark.createDataFrame([("t", 2), ("u", 3)], "table_name string, source_count bigint")
    recon = reconcile({"t": spark.range(2), "u": spark.range(4)}, sent, ctx)
    assert as_set(marts.reconciliation_long(recon), "table_name", "count_type", "records") == {
        ("t", "source_count", 2), ("t", "loaded_count", 2), ("u", "source_count", 3), ("u", "loaded_count", 4),
    }
    assert as_set(marts.reconciliation_display(recon), "table_name", "status_label") == {
        ("t", "✅ MATCH"), ("u", "⚠️ MISMATCH"),
    }


def test_impact_and_audit_views(results):
    impact = downstream_impact(results, HEALTHCARE_REPORTS)
    by_criticality = [(r.criticality, r.reports) for r in marts.impact_by_criticality(impact).collect()]
    assert by_criticality == [("Critical", 3), ("High", 3), ("Medium", 1)]
    assert marts.impact_by_report(impact).count() == marts.impact_detail(impact).count() == 7
    audit = audit_log(results, HEALTHCARE_RULES)
    assert marts.audit_kpis(audit).first() == (19, 19, 5)
    assert ("patients", "Low", 1) in as_set(marts.audit_by_table_severity(audit), "table_name", "severity", "entries")
    assert [r.severity for r in marts.audit_by_severity(audit).collect()][:2] == ["High", "Critical"]
    assert marts.audit_detail(audit).columns[0] == "log_id"


def test_profile_views(spark):
    rows = [("t", "a", 10.0, 5.0), ("t", "b", 30.0, 50.0), ("u", "c", 99.0, 99.0)]
    profile = spark.createDataFrame(
        rows, "table_name string, column_name string, null_pct double, uniqueness_pct double"
    )
    assert [r.column_name for r in marts.profile_null_rank(profile, "t").collect()] == ["b", "a"]
    assert [r.column_name for r in marts.profile_uniqueness_rank(profile, "t").collect()] == ["b", "a"]
