"""Write results as files and as governance tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vouch.operators.views import latest_scores, open_critical_issues
from vouch.sources.commits import Commit, commit, committed, new_attempt, read_committed
from vouch.sources.schemas import GOVERNANCE_COLUMNS, GOVERNANCE_DEFAULTS
from vouch.sources.staging import remove


def write_results(frames: dict[str, DataFrame], path: str, file_format: str = "csv") -> None:
    """Each frame to ``path/<name>.<file_format>``, replacing what is there."""
    for name, frame in frames.items():
        writer = frame.write.mode("overwrite").format(file_format)
        if file_format == "csv":
            writer = writer.option("header", True).option("escape", '"')
        writer.save(f"{path}/{name}.{file_format}")


def governance_frame(name: str, frame: DataFrame) -> DataFrame:
    """The columns of ``frame`` that the governance table ``name`` keeps."""
    return frame.select(*GOVERNANCE_COLUMNS[name])


def load_governance(
    frames: dict[str, DataFrame],
    path: str,
    run_id: str,
    keep_history: bool = True,
    record: DataFrame | None = None,
) -> None:
    """Load the result frames into the governance tables under ``path``, all of them or none.

    The rows carry the run id as text. They become visible together once every table is written
    (``sources.commits``). Repeating a run replaces its own rows only; an empty frame does too, so
    that a mended violation disappears. ``record`` is the run's row of ``dq_runs``, which is kept as
    it was if the run has one. Without ``keep_history`` the other runs lose these tables
    afterwards, so a failure in between loses nothing.
    """
    spark = next(iter(frames.values())).sparkSession
    folder = new_attempt(run_id)
    for name, frame in frames.items():
        rows = governance_frame(name, frame)
        for column, default in GOVERNANCE_DEFAULTS.get(name, {}).items():
            rows = rows.withColumn(column, F.expr(default))
        rows.withColumn("run_id", F.lit(run_id)).write.parquet(f"{path}/{name}/{folder}")
    written = list(frames)
    if record is not None and "dq_runs" not in committed(spark, path, run_id).get(run_id, Commit(run_id)).tables:
        record.write.parquet(f"{path}/dq_runs/{folder}")
        written.append("dq_runs")
    judged = next((frames[n] for n in ("dq_results", "dq_scores") if n in frames), None)
    subjects = judged.select("table_name", F.col("run_time").cast("string")).distinct().collect() if judged is not None else []
    run_time = max((r.run_time for r in subjects), default="")
    commit(spark, path, run_id, dict.fromkeys(written, folder), run_time, tuple({r.table_name for r in subjects}), keep=("dq_runs",))
    if not keep_history:
        for other in committed(spark, path).values():
            if other.run_id != run_id and any(name in other.tables for name in frames):
                commit(spark, path, other.run_id, {}, drop=tuple(frames))
                for name in frames:
                    if name in other.tables:
                        remove(spark, f"{path}/{name}/{other.tables[name]}")


def read_governance(spark: SparkSession, path: str, name: str, newest: bool = False) -> DataFrame:
    """A governance table, all committed runs that it holds.

    ``newest`` opens only the runs that are the last to have judged some table, however long the
    history is.
    """
    return read_committed(spark, path, name, newest)


def register_views(spark: SparkSession, path: str) -> list[str]:
    """Temporary views over the governance tables under ``path``, for queries in SQL.

    They show the runs committed by now; register them again to see later ones.
    ``vw_open_critical_issues`` lists the entries of each table's newest run.
    """
    spark.read.parquet(f"{path}/dq_rule_registry").createOrReplaceTempView("dq_rule_registry")
    for name in ("dq_runs", *GOVERNANCE_COLUMNS):
        read_governance(spark, path, name).createOrReplaceTempView(name)
    scores, audit, results = (read_governance(spark, path, n, newest=True) for n in ("dq_scores", "audit_log", "dq_results"))
    latest_scores(scores).createOrReplaceTempView("vw_latest_dq_scores")
    open_critical_issues(audit, results).createOrReplaceTempView("vw_open_critical_issues")
    return ["dq_runs", "dq_rule_registry", *GOVERNANCE_COLUMNS, "vw_latest_dq_scores", "vw_open_critical_issues"]


def record_run(record: DataFrame, path: str) -> None:
    """Add the runs of ``record`` to ``dq_runs``, those that it does not list yet.

    Of several writers of a run id one adds its row.
    """
    spark = record.sparkSession
    for row in record.select("run_id").distinct().collect():  # the runs of one job
        if "dq_runs" in committed(spark, path, row.run_id).get(row.run_id, Commit(row.run_id)).tables:
            continue
        folder = new_attempt(row.run_id)
        record.where(F.col("run_id") == row.run_id).write.parquet(f"{path}/dq_runs/{folder}")
        found = commit(spark, path, row.run_id, {"dq_runs": folder}, keep=("dq_runs",))
        if found.tables["dq_runs"] != folder:
            remove(spark, f"{path}/dq_runs/{folder}")
