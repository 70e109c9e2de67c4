"""Weighted quality scores and issue totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouch.functions.numeric import count_or_zero, pct
from vouch.plans.rules import SEVERITY_WEIGHTS

# The lowest score of each grade; anything below the last is F.
GRADES = (("A", 90), ("B", 80), ("C", 70), ("D", 60))


def grade(score: Column) -> Column:
    letter = F.lit("F")
    for name, lowest in reversed(GRADES):
        letter = F.when(score >= lowest, name).otherwise(letter)
    return letter


def weight(severity: Column, weights: dict[str, int] | None = None) -> Column:
    """The weight of a severity, NULL for an unknown one."""
    chosen = None
    for name, value in (SEVERITY_WEIGHTS if weights is None else weights).items():
        chosen = F.when(severity == name, value) if chosen is None else chosen.when(severity == name, value)
    return F.lit(None).cast("int") if chosen is None else chosen


def score(results: DataFrame, weights: dict[str, int] | None = None) -> DataFrame:
    """``dq_scores``: per run and table, the weight of passed rules over all weight.

    A rule counts as a whole: how many of its records failed does not matter.
    """
    passed = F.col("status") == "PASS"
    weighed = weight(F.col("severity"), weights)
    totals = results.groupBy("run_id", "run_time", "table_name").agg(
        F.count(F.lit(1)).alias("total_rules"),
        F.count_if(passed).alias("passed_rules"),
        F.count_if(F.col("status") == "FAIL").alias("failed_rules"),
        pct(
            count_or_zero(F.sum(F.when(passed, weighed))), count_or_zero(F.sum(weighed)), 1
        ).alias("dq_score"),
    )
    return totals.select(
        "run_id",
        "table_name",
        "total_rules",
        "passed_rules",
        "failed_rules",
        "dq_score",
        grade(F.col("dq_score")).alias("grade"),
        "run_time",
    )


def total_issues(results: DataFrame) -> DataFrame:
    """Failed records over all failed rules; a record that breaks two rules counts twice."""
    return results.agg(issues().alias("total_issues"))


def issues(where: Column | None = None) -> Column:
    """Aggregate: failed records over FAIL rows, optionally of a part of them."""
    failed = F.col("status") == "FAIL"
    if where is not None:
        failed = failed & where
    return count_or_zero(F.sum(F.when(failed, F.col("failed_records"))))
