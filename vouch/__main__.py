"""Run the healthcare rules over a folder of tables and load the governance tables.

    python -m vouch INPUT OUTPUT [--format csv] [--as-of 2026-01-01]
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from vouch.operators.evaluate import RuleError
from vouch.operators.score import total_issues
from vouch.plans.context import RunContext
from vouch.plans.run import run_all, write_governance
from vouch.sources.load import load_checked, load_tables, read_csv
from vouch.sources.sinks import write_results
from vouch.sources.staging import new_folder, remove


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="vouch", description=__doc__.splitlines()[0])
    parser.add_argument("input", help="folder with patients.csv, encounters.csv, ...")
    parser.add_argument("output", help="folder for result files and governance tables")
    parser.add_argument("--format", default="csv", help="format of the input tables")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="the clock of the date rules")
    parser.add_argument("--source-counts", help="CSV with table_name, source_count")
    parser.add_argument("--approx", action="store_true", help="estimate distinct values")
    parser.add_argument("--multi-line", action="store_true", help="line breaks inside quoted fields")
    parser.add_argument("--max-malformed", type=int, default=0, help="malformed records of a CSV table that do not end the run")
    parser.add_argument("--replace", action="store_true", help="keep the last run only")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("vouch").getOrCreate()
    ctx = RunContext(datetime.now(), options.as_of)
    folder, notes = new_folder(spark), []
    if options.format == "csv":
        loaded = load_checked(spark, options.input, None, options.max_malformed, options.multi_line, folder)
        tables = loaded.tables
        notes = [f"{r.table_name}: {r.malformed_count} malformed records left out" for r in loaded.report.where("malformed_count > 0").collect()]
    else:
        tables = load_tables(spark, options.input, file_format=options.format)
    if options.source_counts:
        counts = read_csv(spark, options.source_counts)
    else:
        counts = spark.createDataFrame([], "table_name string, source_count bigint")
    errors: list[RuleError] = []
    frames = run_all(
        tables,
        ctx,
        counts,
        distinct="approx" if options.approx else "exact",
        errors=errors,
    )
    write_results(frames, f"{options.output}/results")
    write_governance(frames, ctx, f"{options.output}/governance", keep_history=not options.replace, errors=errors, notes=notes)
    remove(spark, folder)
    for note in notes:
        print(note)
    for error in errors:
        print(f"{error.rule_id} not checked, counted as passed: {error.message}")
    frames["dq_scores"].select("table_name", "dq_score", "grade").show()
    total_issues(frames["dq_results"]).show()


if __name__ == "__main__":
    main()
