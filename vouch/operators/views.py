"""Standing views over the governance history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouch.operators.marts import severity_rank

LATEST_COLUMNS = (
    "table_name",
    "dq_score",
    "grade",
    "total_rules",
    "passed_rules",
    "failed_rules",
    "run_time",
)


def latest_scores(scores: DataFrame) -> DataFrame:
    """The newest score of every table; of equal times, the greatest run id.

    An aggregate combines before the shuffle, unlike a row number over each table.
    """
    newest = F.max_by(F.struct(*LATEST_COLUMNS), F.struct("run_time", "run_id"))
    return scores.groupBy("table_name").agg(newest.alias("newest")).select("newest.*")


def open_critical_issues(audit: DataFrame, results: DataFrame | None = None) -> DataFrame:
    """Unresolved Critical and High entries, worst severity and most records first.

    With the ``results`` of the same runs only each table's newest run counts: what it no longer
    finds is mended. A run without a violation has results but no entries.
    """
    if results is not None:
        newest = F.max_by("run_id", F.struct("run_time", "run_id")).alias("run_id")
        audit = audit.join(results.groupBy("table_name").agg(newest), ["table_name", "run_id"], "left_semi")
    return (
        audit.where(~F.col("resolved") & F.col("severity").isin("Critical", "High"))
        .orderBy(severity_rank(), F.col("records_affected").desc(), "log_id")
        .select(
            "run_id",
            "log_id",
            "table_name",
            "rule_id",
            "severity",
            "description",
            "records_affected",
            "action_taken",
            "event_time",
        )
    )
