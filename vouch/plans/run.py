"""One data-quality run, from tables to governance frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouch.operators.audit import audit_log
from vouch.operators.evaluate import RuleError, evaluate, isolated
from vouch.operators.impact import downstream_impact
from vouch.operators.profile import profile
from vouch.operators.reconcile import reconcile
from vouch.operators.runs import run_record
from vouch.operators.score import score
from vouch.plans.context import RunContext
from vouch.plans.reports import HEALTHCARE_REPORTS, Report
from vouch.plans.rules import HEALTHCARE_RULES, Rule, registry_frame
from vouch.sources.sinks import load_governance
from vouch.sources.staging import new_folder, remove, settle, stage


def run_all(
    tables: dict[str, DataFrame],
    ctx: RunContext,
    source_counts: DataFrame,
    rules: list[Rule] = HEALTHCARE_RULES,
    reports: list[Report] = HEALTHCARE_REPORTS,
    distinct: str = "exact",
    stage_inputs: bool = False,
    errors: list[RuleError] | None = None,
) -> dict[str, DataFrame]:
    """The six result frames of a run, by governance table name.

    Rule results and profiles are worked out once and kept in the shared folder; the rest
    derives from them without touching the tables again. Set ``stage_inputs`` for text
    files, joins and views, which would otherwise be read anew by every pass; the staged
    copies go once results and profiles are settled.
    """
    spark = next(iter(tables.values())).sparkSession
    folder = new_folder(spark) if stage_inputs else None
    try:
        if folder:
            tables = stage(tables, folder)
        results = isolated(evaluate, tables, rules, ctx, [] if errors is None else errors)
        profiled = settle(profile(tables, samples=distinct == "exact", distinct=distinct))
    finally:
        if folder:
            remove(spark, folder)
    if "sample_values" not in profiled.columns:
        profiled = profiled.withColumn("sample_values", F.lit(None).cast("string"))
    # every column knows its table's count
    loaded = profiled.where("position = 0").select("table_name", F.col("total_count").alias("loaded_count"))
    return {
        "dq_results": results,
        "dq_scores": score(results),
        "data_profile": profiled,
        "reconciliation": reconcile(tables, source_counts, ctx, loaded),
        "downstream_impact": downstream_impact(results, reports),
        "audit_log": audit_log(results, rules),
    }


def write_governance(
    frames: dict[str, DataFrame],
    ctx: RunContext,
    path: str,
    rules: list[Rule] = HEALTHCARE_RULES,
    keep_history: bool = True,
    errors: Sequence[RuleError] = (),
    notes: Sequence[str] = (),
) -> None:
    """Load the frames of a run into the governance tables under ``path``.

    The tables and the run record become visible together: every run that a view shows is listed in
    ``dq_runs`` and has all its tables. The record's notes are the given ones, then the rules that
    could not be checked, which count as passed.
    """
    results = frames["dq_results"]
    registry_frame(results.sparkSession, rules, ctx).write.mode("overwrite").parquet(
        f"{path}/dq_rule_registry"
    )
    text = "; ".join([*notes, *[f"{e.rule_id} not checked: {e.message}" for e in errors]]) or None
    load_governance(frames, path, ctx.run_id, keep_history, run_record(results, notes=text))
