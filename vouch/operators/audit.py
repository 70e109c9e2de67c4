"""Audit entries for failed rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vouch.plans.rules import Rule, rule_frame


def audit_log(results: DataFrame, rules: list[Rule]) -> DataFrame:
    """``audit_log``: one entry per failed rule, numbered in registry order within a run."""
    order = rule_frame(results.sparkSession, rules).select("rule_id", "rule_order")
    # a run holds a row per rule, so its window stays small
    number = F.row_number().over(Window.partitionBy("run_id").orderBy(F.col("rule_order").asc_nulls_last(), "rule_id"))
    action = F.when(F.col("severity").isin("Medium", "Low"), "Flagged for review").otherwise(
        "Quarantined pending remediation"
    )
    return (
        results.where(F.col("status") == "FAIL")
        .join(order, "rule_id", "left")
        .withColumn("log_id", F.format_string("AUD%06d", number))
        .select(
            "run_id",
            "log_id",
            F.col("run_time").alias("event_time"),
            "table_name",
            "rule_id",
            F.lit("DQ_VIOLATION").alias("event_type"),
            "severity",
            "description",
            F.col("failed_records").alias("records_affected"),
            action.alias("action_taken"),
            F.lit(False).alias("resolved"),
        )
    )
