"""Summaries a dashboard shows, over rule results and what derives from them.

Inputs hold a row per rule, table, column, report or audit entry, never a row per record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vouch.functions.numeric import count_or_zero, pct
from vouch.operators.score import issues
from vouch.plans.rules import CATEGORIES, SEVERITY_RANKS

# Categories a radar shows, and the upper ends of the gauge bands.
SHOWN_CATEGORIES = ("Completeness", "Validity", "Uniqueness", "Referential")
GAUGE_BANDS = (60, 80, 100)

PASSED = "PASS"
FAILED = "FAIL"


def severity_rank(severity: str = "severity") -> Column:
    """0 for the worst severity; an unknown one ranks last."""
    ranks = F.create_map(*[F.lit(x) for pair in SEVERITY_RANKS.items() for x in pair])
    return F.coalesce(F.try_element_at(ranks, F.col(severity)), F.lit(len(SEVERITY_RANKS)))

#: Columns that keep runs apart, such as ``("run_id",)``: a mart then has its rows once per run, led by them.
By = Sequence[str]


def _is(status: str) -> Column:
    return F.col("status") == status


def filter_results(
    results: DataFrame, tables: list[str] | None = None, severities: list[str] | None = None
) -> DataFrame:
    """Results of the chosen tables and severities; None chooses all."""
    if tables is not None:
        results = results.where(F.col("table_name").isin(tables))
    if severities is not None:
        results = results.where(F.col("severity").isin(severities))
    return results


def kpi_cards(results: DataFrame, scores: DataFrame, audit: DataFrame, impact: DataFrame, by: By = ()) -> DataFrame:
    """One row of headline numbers."""
    of_results = results.groupBy(*by).agg(
        F.count_distinct("table_name").alias("tables_scanned"),
        F.count(F.lit(1)).alias("total_rules"),
        issues().alias("total_issues"),
        issues(F.col("severity") == "Critical").alias("critical_issues"),
        pct(F.count_if(_is(PASSED)), F.count(F.lit(1)), 1).alias("rule_pass_rate"),
    )
    # scores have one decimal: their mean is exact over whole tenths
    tenths = F.sum(F.round(F.col("dq_score") * 10).cast("bigint"))
    of_scores = scores.groupBy(*by).agg(
        pct(count_or_zero(tenths), F.count(F.lit(1)) * 1000, 1).alias("overall_score")
    )
    of_audit = audit.groupBy(*by).agg(F.count_if(~F.col("resolved")).alias("open_audit_issues"))
    of_impact = impact.groupBy(*by).agg(F.count(F.lit(1)).alias("reports_affected"))
    # four rows per run, each with its own columns filled, folded into one
    cards = of_results
    for part in (of_scores, of_audit, of_impact):
        cards = cards.unionByName(part, allowMissingColumns=True)
    counted = ("open_audit_issues", "reports_affected")  # a run without any has no row there
    numbers = [c for c in cards.columns if c not in by]
    folded = cards.groupBy(*by).agg(*[F.max(c).alias(c) for c in numbers])
    return folded.na.fill(0, list(counted)) if by else folded


def score_bands(scores: DataFrame, by: By = ()) -> DataFrame:
    """Each table's score with the gauge band it lies in."""
    low, middle, _ = GAUGE_BANDS
    band = (
        F.when(F.col("dq_score") < low, f"0-{low}")
        .when(F.col("dq_score") < middle, f"{low}-{middle}")
        .otherwise(f"{middle}-{GAUGE_BANDS[-1]}")
    )
    return scores.select(*by, "table_name", "dq_score", "grade", band.alias("band"))


def record_flow(reconciliation: DataFrame, scores: DataFrame, by: By = ()) -> DataFrame:
    """Loaded records split by the share of passed rules; tables without a score are left out."""
    share = scores.select(*by, "table_name", "passed_rules", "total_rules")
    passed = F.call_function("div", F.col("loaded_count") * F.col("passed_rules"), F.col("total_rules"))
    return (
        reconciliation.join(share, [*by, "table_name"])
        .withColumn("passed_records", passed)
        .select(
            *by,
            "table_name",
            "source_count",
            "loaded_count",
            "passed_records",
            (F.col("loaded_count") - F.col("passed_records")).alias("failed_records"),
        )
    )


def rule_summary(results: DataFrame, scores: DataFrame, by: By = ()) -> DataFrame:
    """Passed and failed rules per table, with its score and grade."""
    counts = (
        results.groupBy(*by, "table_name")
        .pivot("status", [PASSED, FAILED])
        .agg(F.count(F.lit(1)))
        .na.fill(0, [PASSED, FAILED])
        .select(*by, "table_name", F.col(PASSED).alias("passed"), F.col(FAILED).alias("failed"))
    )
    return counts.join(scores.select(*by, "table_name", "dq_score", "grade"), [*by, "table_name"])


def _issues_by(results: DataFrame, *keys: str) -> DataFrame:
    return (
        results.where(_is(FAILED))
        .groupBy(*keys)
        .agg(F.sum("failed_records").cast("bigint").alias("failed_records"))
    )


def issues_by_severity(results: DataFrame, by: By = ()) -> DataFrame:
    return _issues_by(results, *by, "severity").orderBy(*by, F.col("failed_records").desc(), "severity")


def issues_by_category(results: DataFrame, by: By = ()) -> DataFrame:
    """Issues per category and their share of all issues."""
    # a row per category and run, so the window stays small
    total = F.sum("failed_records").over(Window.partitionBy(*by))
    return _issues_by(results, *by, "category").select(
        *by, "category", "failed_records", pct(F.col("failed_records"), total, 1).alias("share_pct")
    )


def issues_by_table_severity(results: DataFrame, by: By = ()) -> DataFrame:
    return _issues_by(results, *by, "table_name", "severity")


def failed_rules(results: DataFrame, by: By = ()) -> DataFrame:
    """Failed rules, worst severity and most failures first."""
    return (
        results.where(_is(FAILED))
        .orderBy(*by, severity_rank(), F.col("failed_records").desc(), "rule_id")
        .select(
            *by,
            "rule_id",
            "table_name",
            "category",
            "severity",
            "description",
            "failed_records",
            "pass_rate_pct",
        )
    )


def _pass_rate() -> Column:
    return pct(F.count_if(_is(PASSED)), F.count(F.lit(1)), 1)


def heatmap(results: DataFrame, categories: tuple[str, ...] = tuple(CATEGORIES), by: By = ()) -> DataFrame:
    """Share of passed rules, a row per table and a column per category; 100 without rules."""
    rates = results.groupBy(*by, "table_name", "category").agg(_pass_rate().alias("pass_rate"))
    return (
        rates.groupBy(*by, "table_name")
        .pivot("category", list(categories))
        .agg(F.first("pass_rate"))
        .na.fill(100.0, list(categories))
    )


def radar(results: DataFrame, categories: tuple[str, ...] = SHOWN_CATEGORIES, by: By = ()) -> DataFrame:
    """Share of passed rules, a row per table and category; 100 without rules."""
    rates = []
    for category in categories:
        within = F.col("category") == category
        rate = F.when(
            F.count_if(within) > 0, pct(F.count_if(within & _is(PASSED)), F.count_if(within), 1)
        ).otherwise(100.0)
        rates.append(F.struct(F.lit(category).alias("category"), rate.alias("pass_rate")))
    return (
        results.groupBy(*by, "table_name")
        .agg(F.array(*rates).alias("rates"))
        .select(*by, "table_name", F.inline("rates"))
    )


def reconciliation_long(reconciliation: DataFrame, by: By = ()) -> DataFrame:
    """Source and loaded counts as two rows per table."""
    return reconciliation.unpivot(
        [*by, "table_name"], ["source_count", "loaded_count"], "count_type", "records"
    )


def reconciliation_display(reconciliation: DataFrame, by: By = ()) -> DataFrame:
    label = F.when(F.col("status") == "MATCH", "✅ MATCH").when(F.col("status") == "MISMATCH", "⚠️ MISMATCH")
    return reconciliation.select(
        *by, "table_name", "source_count", "loaded_count", "delta", "delta_pct", label.alias("status_label")
    )


def impact_by_report(impact: DataFrame, by: By = ()) -> DataFrame:
    return impact.select(
        *by, "report", "total_issues", "criticality", "owner", "refresh_cadence", "affected_tables"
    )


def impact_by_criticality(impact: DataFrame, by: By = ()) -> DataFrame:
    return (
        impact.groupBy(*by, "criticality")
        .agg(F.count(F.lit(1)).alias("reports"))
        .orderBy(*by, F.col("reports").desc(), "criticality")
    )


def impact_detail(impact: DataFrame, by: By = ()) -> DataFrame:
    return impact.select(
        *by,
        "report",
        "owner",
        "criticality",
        "refresh_cadence",
        "affected_tables",
        "total_issues",
        "impact_level",
    )


def profile_null_rank(profile: DataFrame, table: str) -> DataFrame:
    """Columns of a table, most nulls first."""
    return (
        profile.where(F.col("table_name") == table)
        .orderBy(F.col("null_pct").desc(), "column_name")
        .select("column_name", "null_pct")
    )


def profile_uniqueness_rank(profile: DataFrame, table: str) -> DataFrame:
    """Columns of a table, most distinct first."""
    return (
        profile.where(F.col("table_name") == table)
        .orderBy(F.col("uniqueness_pct").desc(), "column_name")
        .select("column_name", "uniqueness_pct")
    )


def profile_display(profile: DataFrame, table: str) -> DataFrame:
    return profile.where(F.col("table_name") == table).select(
        "column_name",
        "total_count",
        "null_count",
        "null_pct",
        "unique_count",
        "uniqueness_pct",
        "min_value",
        "max_value",
        "mean_value",
    )


def audit_kpis(audit: DataFrame, by: By = ()) -> DataFrame:
    unresolved = ~F.col("resolved")
    return audit.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_entries"),
        F.count_if(unresolved).alias("unresolved"),
        F.count_if(unresolved & (F.col("severity") == "Critical")).alias("critical_unresolved"),
    )


def audit_by_table_severity(audit: DataFrame, by: By = ()) -> DataFrame:
    return audit.groupBy(*by, "table_name", "severity").agg(F.count(F.lit(1)).alias("entries"))


def audit_by_severity(audit: DataFrame, by: By = ()) -> DataFrame:
    return (
        audit.groupBy(*by, "severity")
        .agg(F.sum("records_affected").cast("bigint").alias("records_affected"))
        .orderBy(*by, F.col("records_affected").desc(), "severity")
    )


def audit_detail(audit: DataFrame, by: By = ()) -> DataFrame:
    return audit.select(
        *by,
        "log_id",
        "table_name",
        "rule_id",
        "severity",
        "description",
        "records_affected",
        "action_taken",
        "resolved",
    )
