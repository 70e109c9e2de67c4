"""The record of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouch.operators.score import issues

# The states a run record may have.
RUN_STATES = ("Running", "Completed", "Failed")


def run_summary(results: DataFrame) -> DataFrame:
    """Per run: distinct tables, rules, and failed records over failed rules."""
    return results.groupBy("run_id", "run_time").agg(
        F.count_distinct("table_name").cast("int").alias("total_tables"),
        F.count(F.lit(1)).cast("int").alias("total_rules"),
        issues().alias("total_issues"),
    )


def run_record(results: DataFrame, triggered_by: str = "automated", status: str = "Completed", notes: str | None = None) -> DataFrame:
    """``dq_runs`` rows of the runs in ``results``."""
    if status not in RUN_STATES:
        raise ValueError(f"unknown run status {status!r}")
    return run_summary(results).select(
        "run_id",
        "run_time",
        F.lit(triggered_by).alias("triggered_by"),
        F.lit(status).alias("status"),
        "total_tables",
        "total_rules",
        "total_issues",
        F.lit(notes).cast("string").alias("notes"),
    )


def new_runs(records: DataFrame, recorded: DataFrame) -> DataFrame:
    """The records whose run id is not yet recorded."""
    return records.join(recorded.select("run_id"), "run_id", "left_anti")
