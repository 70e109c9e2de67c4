"""Which reports the failed rules reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouch.operators.score import issues
from vouch.plans.reports import Report, report_frame


def trigger_tables(results: DataFrame) -> DataFrame:
    """Tables with a failed rule of severity Critical or High, and all their issues."""
    severe = (F.col("status") == "FAIL") & F.col("severity").isin("Critical", "High")
    return (
        results.groupBy("run_id", "run_time", "table_name")
        .agg(F.count_if(severe).alias("severe_rules"), issues().alias("issues"))
        .where("severe_rules > 0")
        .select("run_id", "run_time", "table_name", "issues")
    )


def downstream_impact(results: DataFrame, reports: list[Report]) -> DataFrame:
    """``downstream_impact``: per report, its affected tables in registry order.

    Rule results hold a row per rule, so everything here stays small.
    """
    spark = results.sparkSession
    lines = report_frame(spark, reports).select(
        "report_order",
        "report",
        "owner",
        "refresh_cadence",
        "criticality",
        F.posexplode("tables").alias("position", "table_name"),
    )
    named = F.sort_array(F.collect_list(F.struct("position", "table_name")))
    return (
        lines.join(trigger_tables(results), "table_name")
        .groupBy("run_id", "run_time", "report_order", "report", "owner", "refresh_cadence", "criticality")
        .agg(
            F.array_join(F.transform(named, lambda line: line["table_name"]), ", ").alias("affected_tables"),
            F.sum("issues").cast("bigint").alias("total_issues"),
        )
        .orderBy("report_order")
        .select(
            "run_id",
            "report",
            "owner",
            "refresh_cadence",
            "criticality",
            "affected_tables",
            "total_issues",
            F.when(F.col("criticality") == "Critical", "High").otherwise("Medium").alias("impact_level"),
            "run_time",
        )
    )
