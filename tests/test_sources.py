from __future__ import annotations

from dataclasses import replace

import pytest
from helpers import as_set, results_frame
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from vouch.__main__ import main
from vouch.functions.nulls import NULL_TOKENS
from vouch.operators.audit import audit_log
from vouch.operators.runs import run_record
from vouch.operators.score import score
from vouch.operators.views import latest_scores, open_critical_issues
from vouch.plans.run import run_all, write_governance
from vouch.plans.rules import HEALTHCARE_RULES
from vouch.sources.load import MalformedInput, load_checked, load_tables
from vouch.sources.schemas import GOVERNANCE_COLUMNS, GOVERNANCE_DEFAULTS, HEALTHCARE_SCHEMAS
from vouch.sources.sinks import load_governance, read_governance, record_run, register_views, write_results
from vouch.sources.staging import new_folder, remove, settle, shared_folder, stage
from vouch.suite.fixtures import dirty

SCHEMA = T.StructType(
    [
        T.StructField("a", T.StringType()),
        T.StructField("b", T.IntegerType()),
        T.StructField("c", T.DoubleType()),
        T.StructField("d", T.BooleanType()),
    ]
)


def load(spark, tmp_path, text, **options):
    (tmp_path / "t.csv").write_text(text)
    return load_tables(spark, str(tmp_path), {"t": SCHEMA}, **options)["t"]


def test_every_null_token_is_null(spark, tmp_path):
    lines = [f"{token},{token},{token},{token},x" for token in NULL_TOKENS]
    df = load(spark, tmp_path, "a,b,c,d,e\n" + "\n".join(lines) + "\n")
    assert df.count() == len(NULL_TOKENS)
    assert as_set(df, "a", "b", "c", "d") == {(None, None, None, None)}


def test_other_spellings_stay(spark, tmp_path):
    df = load(spark, tmp_path, "a\nNull\nnone\nnA\n NA\n-\n")
    assert as_set(df, "a") == {("Null",), ("none",), ("nA",), (" NA",), ("-",)}


def test_declared_types(spark, tmp_path):
    df = load(spark, tmp_path, "c,a,b,d,extra\n1.5,0012,3.0,True,7\nx,0000,2.5,maybe,8\n-1e3,1,4,FALSE,9\n")
    assert dict(df.dtypes) == {"c": "double", "a": "string", "b": "int", "d": "boolean", "extra": "string"}
    assert [tuple(r) for r in df.select("a", "b", "c", "d", "extra").collect()] == [
        ("0012", 3, 1.5, True, "7"),
        ("0000", None, None, None, "8"),
        ("1", 4, -1000.0, False, "9"),
    ]


def test_quotes_and_missing_columns(spark, tmp_path):
    df = load(spark, tmp_path, 'a\n"x, ""y"""\n""\n')
    assert df.columns == ["a"]
    assert as_set(df, "a") == {('x, "y"',), (None,)}


def test_line_breaks_in_fields(spark, tmp_path):
    df = load(spark, tmp_path, 'a,b\n"x\ny",1\n', multi_line=True)
    assert df.first().a == "x\ny"


def test_parquet_nan_becomes_null(spark, tmp_path):
    spark.createDataFrame([(float("nan"),), (1.0,)], "c double").write.parquet(str(tmp_path / "t.parquet"))
    df = load_tables(spark, str(tmp_path), {"t": SCHEMA}, file_format="parquet")["t"]
    assert as_set(df, "c") == {(None,), (1.0,)}


def test_healthcare_schemas_cover_the_rules():
    assert {k: len(s) for k, s in HEALTHCARE_SCHEMAS.items()} == {
        "patients": 13, "encounters": 12, "lab_results": 13, "medications": 13,
    }


def test_stage_reads_back_the_same_rows(spark):
    tables = {"a": spark.range(10).toDF("x"), "b": spark.range(3).toDF("y")}
    staged = stage(tables)
    assert {n: as_set(staged[n], *df.columns) for n, df in tables.items()} == {
        n: as_set(df, *df.columns) for n, df in tables.items()
    }
    assert stage({}) == {}


def test_staged_copies_can_be_removed(spark):
    folder = new_folder(spark)
    stage({"a": spark.range(10)}, folder)
    kept = settle(spark.read.parquet(f"{folder}/a"))
    remove(spark, folder)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{folder}/a")
    assert kept.count() == 10


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == (named or spark.sparkContext.getCheckpointDir())


def test_results_round_trip(spark, ctx, tmp_path):
    results = results_frame(spark, ctx)
    frames = {"dq_results": results, "dq_scores": score(results)}
    for file_format in ("csv", "parquet"):
        write_results(frames, str(tmp_path), file_format)
        write_results(frames, str(tmp_path), file_format)
        reader = spark.read.option("header", True).option("escape", '"')
        back = reader.format(file_format).load(f"{tmp_path}/dq_results.{file_format}")
        assert back.columns == results.columns
        assert as_set(back, "rule_id", "description") == as_set(results, "rule_id", "description")


def test_governance_history(spark, ctx, tmp_path):
    path, later = str(tmp_path), replace(ctx, name="RUN_B")
    for run in (ctx, later, later):
        results = results_frame(spark, run)
        load_governance({"dq_results": results, "dq_scores": score(results)}, path, run.run_id)
    scores = read_governance(spark, path, "dq_scores")
    assert scores.count() == 8
    assert as_set(scores, "run_id") == {(ctx.run_id,), ("RUN_B",)}
    assert as_set(latest_scores(scores), "table_name", "dq_score") == as_set(
        score(results_frame(spark, ctx)), "table_name", "dq_score"
    )


def test_an_empty_frame_replaces_stale_rows(spark, ctx, tmp_path):
    audit = audit_log(results_frame(spark, ctx), HEALTHCARE_RULES)
    for keep_history in (True, False):
        path = f"{tmp_path}/{keep_history}"
        load_governance({"audit_log": audit}, path, ctx.run_id, keep_history)
        assert read_governance(spark, path, "audit_log").count() == 19
        load_governance({"audit_log": audit.limit(0)}, path, ctx.run_id, keep_history)
        assert read_governance(spark, path, "audit_log").count() == 0


def test_a_recorded_run_is_kept(spark, ctx, tmp_path):
    results = results_frame(spark, ctx)
    record_run(run_record(results, triggered_by="first"), str(tmp_path))
    record_run(run_record(results, triggered_by="second"), str(tmp_path))
    record_run(run_record(results_frame(spark, replace(ctx, name="RUN_B"))), str(tmp_path))
    assert as_set(spark.read.parquet(f"{tmp_path}/dq_runs"), "run_id", "triggered_by") == {
        (ctx.run_id, "first"), ("RUN_B", "automated"),
    }


@pytest.mark.parametrize("stage_inputs,distinct", [(True, "exact"), (False, "approx")])
def test_a_whole_run_from_csv(spark, ctx, tmp_path, stage_inputs, distinct):
    for name, df in dirty(spark, "/root/testdata/sf0.001").items():
        df.write.option("header", True).option("escape", '"').csv(f"{tmp_path}/in/{name}.csv")
    tables = load_tables(spark, f"{tmp_path}/in")
    sent = spark.createDataFrame([("patients", 149)], "table_name string, source_count bigint")
    frames = run_all(tables, ctx, sent, stage_inputs=stage_inputs, distinct=distinct)
    assert list(frames) == list(GOVERNANCE_COLUMNS)
    write_governance(frames, ctx, f"{tmp_path}/out")
    write_governance(frames, ctx, f"{tmp_path}/out")
    read = {n: read_governance(spark, f"{tmp_path}/out", n) for n in GOVERNANCE_COLUMNS}
    for name, columns in GOVERNANCE_COLUMNS.items():
        assert set(read[name].columns) == {*columns, *GOVERNANCE_DEFAULTS.get(name, {}), "run_id"}
    assert read["dq_results"].count() == 30
    assert read["data_profile"].count() == 29
    recon = {r.table_name: r for r in read["reconciliation"].collect()}
    assert (recon["patients"].delta, recon["patients"].status) == (1, "MISMATCH")
    assert recon["lab_results"].status == "MATCH"
    assert spark.read.parquet(f"{tmp_path}/out/dq_runs").count() == 1
    assert spark.read.parquet(f"{tmp_path}/out/dq_rule_registry").count() == 30
    register_views(spark, f"{tmp_path}/out")
    assert spark.sql("SELECT count(*) FROM vw_latest_dq_scores").first()[0] == 4
    worst = spark.sql("SELECT DISTINCT severity FROM vw_open_critical_issues")
    assert as_set(worst, "severity") == {("Critical",), ("High",)}
    unsent = spark.sql("SELECT count(*) AS n FROM downstream_impact WHERE NOT notified").first().n
    assert unsent == read["downstream_impact"].count()


def test_command_line(spark, tmp_path, capsys):
    for name, df in dirty(spark, "/root/testdata/sf0.001").items():
        df.write.parquet(f"{tmp_path}/in/{name}.parquet")
    (tmp_path / "counts.csv").write_text("table_name,source_count\npatients,100\n")
    main(
        [
            f"{tmp_path}/in", f"{tmp_path}/out", "--format", "parquet", "--as-of", "2026-01-01",
            "--source-counts", f"{tmp_path}/counts.csv",
        ]
    )
    assert "patients" in capsys.readouterr().out
    recon = spark.read.option("header", True).csv(f"{tmp_path}/out/results/reconciliation.csv")
    assert ("patients", "100", "150", "50.0") in as_set(recon, "table_name", "source_count", "loaded_count", "delta_pct")
    assert read_governance(spark, f"{tmp_path}/out/governance", "audit_log").count() > 20


def test_views_follow_the_newest_run(spark, ctx, tmp_path):
    path, later = str(tmp_path), replace(ctx, name="a/b")
    for run, passing in ((replace(ctx, name="007"), set()), (later, {r.rule_id for r in HEALTHCARE_RULES})):
        results = results_frame(spark, run, passing=passing)
        frames = {"dq_results": results, "audit_log": audit_log(results, HEALTHCARE_RULES)}
        load_governance(frames, path, run.run_id)
    audit, results = (read_governance(spark, path, n) for n in ("audit_log", "dq_results"))
    assert as_set(results, "run_id") == {("007",), ("a/b",)}
    assert open_critical_issues(audit, results).count() == 0
    load_governance({"dq_results": results_frame(spark, later)}, path, "a/b", keep_history=False)
    assert as_set(read_governance(spark, path, "dq_results"), "run_id") == {("a/b",)}


def test_files_with_other_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n")
    (folder / "2.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_tables(spark, str(tmp_path), {"t": SCHEMA})["t"].collect()


def test_failed_runs_leave_no_copies(spark, ctx, tmp_path, monkeypatch):
    from vouch.plans import run

    folder = str(tmp_path / "staged")
    monkeypatch.setattr(run, "new_folder", lambda spark: folder)
    monkeypatch.setattr(run, "evaluate", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_all({"t": spark.range(3)}, ctx, spark.range(0), stage_inputs=True)
    assert not (tmp_path / "staged").exists()


def test_notes_name_unchecked_rules(spark, ctx):
    record = run_record(results_frame(spark, ctx), notes="PAT-001 not checked: no column x")
    assert record.first().notes.startswith("PAT-001")


FAULTY = 'a,b,c\n1,x,2\n1,x,2,3\n1,x,2,\n1,"open,2\n"q""q","y,y",3\nshort,1\n\n,"z",\n'


def checked(spark, tmp_path, text, **options):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "1.csv").write_text(text)
    (folder / "2.csv").write_text("a,b,c\n5,5,5\n")
    return load_checked(spark, str(tmp_path), {"t": T.StructType().add("c", T.IntegerType())}, **options)


def test_malformed_lines_are_set_apart_and_counted(spark, tmp_path):
    loaded = checked(spark, tmp_path, FAULTY, max_malformed=3)
    assert as_set(loaded.tables["t"], "a", "b", "c") == {
        ("1", "x", 2), ('q"q', "y,y", 3), ("short", "1", None), (None, "z", None), ("5", "5", 5),
    }
    assert as_set(loaded.malformed, "table_name", "reason", "line") == {
        ("t", "surplus_fields", "1,x,2,3"), ("t", "surplus_fields", "1,x,2,"), ("t", "unclosed_quote", '1,"open,2'),
    }
    assert all(f.endswith("1.csv") for (f,) in as_set(loaded.malformed, "file"))
    assert loaded.report.first().asDict() == {
        "table_name": "t", "loaded_count": 5, "malformed_count": 3, "surplus_fields": 2, "unclosed_quote": 1,
    }


def test_too_many_malformed_lines_end_the_load(spark, tmp_path):
    with pytest.raises(MalformedInput, match=r"t: 3.*1,x,2"):
        checked(spark, tmp_path, FAULTY, max_malformed=2)


def test_a_quoted_line_break_is_two_malformed_lines_or_one_record(spark, tmp_path):
    text = 'a,b,c\n1,"two\nlines",3\n1,2,3,4\n1,2,3,,5\n1,2\n'
    lines = checked(spark, tmp_path, text, max_malformed=None)
    assert lines.report.first().malformed_count == 4 and lines.report.first().unclosed_quote == 2
    records = load_checked(spark, str(tmp_path), {"t": T.StructType()}, max_malformed=None, multi_line=True)
    assert records.report.first().asDict() == {
        "table_name": "t", "loaded_count": 3, "malformed_count": 2, "surplus_fields": 2, "unclosed_quote": 0,
    }
    assert as_set(records.tables["t"], "a", "b", "c") == {("1", "two\nlines", "3"), ("1", "2", None), ("5", "5", "5")}


def test_good_and_empty_files_have_no_faults(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a\n")
    loaded = load_checked(spark, str(tmp_path), {"t": T.StructType()})
    assert loaded.tables["t"].columns == ["a"] and loaded.tables["t"].count() == 0
    assert loaded.report.first().malformed_count == 0 and loaded.malformed.count() == 0


def test_the_command_line_refuses_malformed_files(spark, tmp_path, capsys):
    for name, df in dirty(spark, "/root/testdata/sf0.001").items():
        df.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{tmp_path}/in/{name}.csv")
    (part,) = (tmp_path / "in" / "patients.csv").glob("part-*.csv")
    part.write_text(part.read_text() + "1,2,3,4,5,6,7,8\n")
    for check in (tmp_path / "in" / "patients.csv").glob(".*.crc"):
        check.unlink()
    arguments = [f"{tmp_path}/in", f"{tmp_path}/out", "--as-of", "2026-01-01"]
    with pytest.raises(MalformedInput, match="patients: 1"):
        main(arguments)
    main([*arguments, "--max-malformed", "1"])
    assert "patients: 1 malformed" in capsys.readouterr().out
    runs = read_governance(spark, f"{tmp_path}/out/governance", "dq_runs")
    assert runs.count() == 1 and runs.first().notes == "patients: 1 malformed records left out"
