"""Runs appear whole or not at all, once, and views open no more of them than they need."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from helpers import as_set, results_frame
from pyspark.sql import functions as F

from vouch.operators.audit import audit_log
from vouch.operators.runs import run_record
from vouch.operators.score import score
from vouch.plans.context import RunContext
from vouch.plans.rules import HEALTHCARE_RULES, rules_for
from vouch.sources.commits import Commit, commit, committed, newest_runs, remove_abandoned
from vouch.sources.sinks import load_governance, read_governance, record_run, register_views
from vouch.plans.run import write_governance


def frames_of(spark, run, rules=HEALTHCARE_RULES):
    results = results_frame(spark, run, rules=rules)
    return {"dq_results": results, "dq_scores": score(results), "audit_log": audit_log(results, rules)}


def stopped(frames):
    """The frames with one that fails while it is written, after others have been."""
    broken = frames["audit_log"].withColumn("description", F.raise_error(F.lit("stopped")).cast("string"))
    return {**frames, "audit_log": broken}


def test_a_run_stopped_between_two_tables_is_invisible(spark, ctx, tmp_path):
    path, later = str(tmp_path), replace(ctx, run_time=datetime(2026, 1, 2), name="later")
    load_governance(frames_of(spark, ctx), path, ctx.run_id, record=run_record(results_frame(spark, ctx)))
    with pytest.raises(Exception, match="stopped"):
        load_governance(stopped(frames_of(spark, later)), path, later.run_id, record=run_record(results_frame(spark, later)))
    assert (tmp_path / "dq_results").exists() and len(list((tmp_path / "dq_results").glob("run=*"))) == 2
    for name in ("dq_results", "dq_scores", "audit_log", "dq_runs"):
        assert as_set(read_governance(spark, path, name), "run_id") == {(ctx.run_id,)}
        assert as_set(read_governance(spark, path, name, newest=True), "run_id") == {(ctx.run_id,)}
    assert remove_abandoned(spark, path) == 3  # two tables, and the empty folder of the third
    load_governance(frames_of(spark, later), path, later.run_id)
    assert as_set(read_governance(spark, path, "dq_results"), "run_id") == {(ctx.run_id,), ("later",)}


def test_a_stopped_repeat_leaves_the_run_as_it_was(spark, ctx, tmp_path):
    path = str(tmp_path)
    load_governance(frames_of(spark, ctx), path, ctx.run_id)
    with pytest.raises(Exception, match="stopped"):
        load_governance(stopped(frames_of(spark, ctx, rules_for(HEALTHCARE_RULES, "patients"))), path, ctx.run_id)
    assert read_governance(spark, path, "dq_results").count() == 30
    load_governance(frames_of(spark, ctx, rules_for(HEALTHCARE_RULES, "patients")), path, ctx.run_id)
    assert read_governance(spark, path, "dq_results").count() == 9
    assert remove_abandoned(spark, path) == 6 and read_governance(spark, path, "dq_results").count() == 9


def test_writers_of_one_run_leave_one_record(spark, ctx, tmp_path):
    path = str(tmp_path)

    def write(n):
        frames = frames_of(spark, ctx)
        load_governance(frames, path, ctx.run_id, record=run_record(frames["dq_results"], triggered_by=f"writer {n}"))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(4)))
    assert read_governance(spark, path, "dq_runs").count() == 1
    assert read_governance(spark, path, "dq_results").count() == 30
    assert committed(spark, path)[ctx.run_id].version == 4


def test_only_one_writer_claims_a_version(spark, tmp_path):
    path = str(tmp_path)
    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(lambda n: commit(spark, path, "r", {"dq_runs": f"f{n}", "t": f"t{n}"}, keep=("dq_runs",)), range(8)))
    assert sorted(c.version for c in found) == list(range(1, 9))
    assert len({c.tables["dq_runs"] for c in found}) == 1  # that of the first, in every version
    last = committed(spark, path)["r"]
    assert last.version == 8 and last.tables["t"] == next(c for c in found if c.version == 8).tables["t"]


def test_a_view_opens_the_newest_runs_only(spark, ctx, tmp_path):
    path = str(tmp_path)
    start = datetime(2026, 1, 1)
    patients = rules_for(HEALTHCARE_RULES, "patients")
    one = frames_of(spark, ctx)
    for n in range(50):
        run = RunContext(start + timedelta(days=n), name=f"run {n}")
        stamp = F.lit(run.run_time.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
        chosen = F.col("table_name") == "patients" if n == 49 else F.lit(True)
        frames = {k: f.where(chosen).withColumn("event_time" if k == "audit_log" else "run_time", stamp) for k, f in one.items()}
        load_governance(frames, path, run.run_id)
    scores = read_governance(spark, path, "dq_scores", newest=True)
    assert as_set(scores, "run_id") == {("run 48",), ("run 49",)}
    folders = {f.split("/run=")[1].split("/")[0] for f in scores.inputFiles()}
    assert len(folders) == 2 and len({f.split("/run=")[1].split("/")[0] for f in read_governance(spark, path, "dq_scores").inputFiles()}) == 50
    for name in ("dq_runs", "data_profile", "reconciliation", "downstream_impact"):
        spark.range(1).select(F.lit("run 49").alias("run_id")).write.parquet(f"{path}/{name}/x")
        commit(spark, path, "run 49", {name: "x"})
    spark.range(1).write.parquet(f"{path}/dq_rule_registry")
    register_views(spark, path)
    latest = spark.table("vw_latest_dq_scores")
    assert {f.split("/run=")[1].split("/")[0] for f in latest.inputFiles()} == folders
    times = {r.table_name: r.run_time for r in latest.collect()}
    assert times["patients"] == start + timedelta(days=49) and times["encounters"] == start + timedelta(days=48)
    assert patients and spark.table("vw_open_critical_issues").where("table_name = 'patients' and run_id <> 'run 49'").isEmpty()


def test_newest_runs_by_time_then_id():
    runs = [Commit("a", "2026-01-02", 1, {"t": "x"}, ("p", "q")), Commit("b", "2026-01-02", 1, {"t": "y"}, ("p",)), Commit("c", "2026-01-01", 1, {"t": "z"}, ("r",))]
    assert set(newest_runs({c.run_id: c for c in runs})) == {"a", "b", "c"}
    assert set(newest_runs({c.run_id: c for c in runs[:2]})) == {"a", "b"}
    assert newest_runs({}) == {}


def test_without_history_other_runs_go_afterwards(spark, ctx, tmp_path):
    path, later = str(tmp_path), replace(ctx, name="later")
    load_governance(frames_of(spark, ctx), path, ctx.run_id, record=run_record(results_frame(spark, ctx)))
    with pytest.raises(Exception, match="stopped"):
        load_governance(stopped(frames_of(spark, later)), path, "later", keep_history=False)
    assert as_set(read_governance(spark, path, "dq_results"), "run_id") == {(ctx.run_id,)}
    load_governance(frames_of(spark, later), path, "later", keep_history=False)
    assert as_set(read_governance(spark, path, "dq_results"), "run_id") == {("later",)}
    assert as_set(read_governance(spark, path, "dq_runs"), "run_id") == {(ctx.run_id,)}  # the record of runs stays


def test_records_are_read_like_tables(spark, ctx, tmp_path):
    record_run(run_record(results_frame(spark, ctx)), str(tmp_path))
    assert read_governance(spark, str(tmp_path), "dq_runs").count() == 1
    with pytest.raises(ValueError, match="no committed run"):
        read_governance(spark, str(tmp_path), "audit_log")


def test_write_governance_commits_once(spark, ctx, tmp_path):
    write_governance(frames_of(spark, ctx), ctx, str(tmp_path))
    known = committed(spark, str(tmp_path))[ctx.run_id]
    assert known.version == 1 and set(known.tables) == {"dq_results", "dq_scores", "audit_log", "dq_runs"}
    assert known.subjects == ("encounters", "lab_results", "medications", "patients")
