"""The registered queries: name -> function of session and data folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.errors import SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vouch.functions.checks import References, Unique
from vouch.functions.frames import union_all
from vouch.operators import marts
from vouch.operators.audit import audit_log
from vouch.operators.evaluate import RuleError, evaluate, isolated
from vouch.operators.impact import downstream_impact, trigger_tables
from vouch.operators.profile import column_sketches, completeness, merged_estimates, profile
from vouch.operators.reconcile import count_records, reconcile
from vouch.operators.runs import new_runs, run_record, run_summary
from vouch.operators.score import score, total_issues, weight
from vouch.operators.views import latest_scores, open_critical_issues
from vouch.plans.reports import HEALTHCARE_REPORTS, report_frame
from vouch.plans.rules import HEALTHCARE_RULES, registry_frame, rules_for
from vouch.sources.load import load_checked, load_tables
from vouch.sources.schemas import HEALTHCARE_SCHEMAS
from vouch.sources.sinks import governance_frame, load_governance, read_governance, write_results
from vouch.sources.staging import new_folder, remove, settle, stage
from vouch.suite import fixtures
from vouch.suite.fixtures import AS_OF, CONTEXT, RAW_REPORTS, RAW_RULES, RAW_TABLES, dirty, from_sql, raw

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Rules that show each kind of check: query name -> rule ids.
RULE_KINDS = {
    "rule_not_null": [r for r in HEALTHCARE_RULES if r.category == "Completeness"],
    "rule_allowed_set": [r for r in HEALTHCARE_RULES if r.rule_id in ("PAT-005", "LAB-007", "MED-005")],
    "rule_pattern": [r for r in HEALTHCARE_RULES if r.rule_id == "PAT-006"],
    "rule_valid_past_date": [r for r in HEALTHCARE_RULES if r.rule_id == "PAT-008"],
    "rule_date_order": [r for r in HEALTHCARE_RULES if r.rule_id in ("ENC-005", "LAB-005", "MED-004")],
    "rule_not_future": [r for r in HEALTHCARE_RULES if r.rule_id == "ENC-006"],
    "rule_min_value": [r for r in HEALTHCARE_RULES if r.rule_id in ("ENC-007", "LAB-004")],
    "rule_unique": [r for r in HEALTHCARE_RULES if isinstance(r.check, Unique)],
    "rule_referential": [r for r in HEALTHCARE_RULES if isinstance(r.check, References)],
}

# Runs of a history: later clock, fewer tables, and two runs at the same time.
LATER = datetime(2028, 1, 1)
RUN_1 = replace(CONTEXT, name="RUN_1")
RUN_2 = replace(CONTEXT, run_time=datetime(2026, 1, 2), as_of=LATER, name="RUN_2")
FIRST_RUN, SECOND_RUN = replace(RUN_1, name="007"), replace(RUN_2, name="a/b")
RUN_3 = replace(CONTEXT, run_time=datetime(2026, 1, 2), as_of=AS_OF, name="RUN_3")
HISTORY = (
    (RUN_1, ("patients", "encounters", "lab_results", "medications")),
    (RUN_2, ("patients", "encounters", "lab_results")),
    (RUN_3, ("encounters",)),
)

FILTER_TABLES = ["patients", "lab_results"]
FILTER_SEVERITIES = ["Critical", "Medium"]


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(dirty(spark, sf_dir), HEALTHCARE_RULES, CONTEXT, views=fixtures.JOINED_VIEWS)


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_results(spark, sf_dir))


def _impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return downstream_impact(_results(spark, sf_dir), HEALTHCARE_REPORTS)


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_log(_results(spark, sf_dir), HEALTHCARE_RULES)


def _raw_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(raw(spark, sf_dir, *RAW_TABLES, "nation"), RAW_RULES, CONTEXT)


def _without_time(df: DataFrame) -> DataFrame:
    return df.drop("run_id", "run_time", "event_time")


def _time_text(df: DataFrame, name: str = "run_time") -> DataFrame:
    return df.withColumn(name, F.date_format(name, "yyyy-MM-dd HH:mm:ss"))


# --- sources and governance tables


@query("load_counts")
def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four tables written as CSV, loaded back, and counted."""
    folder = new_folder(spark)
    try:
        for name, df in dirty(spark, sf_dir).items():
            _write_csv(df, f"{folder}/{name}.csv")
        return settle(count_records(load_tables(spark, folder)))
    finally:
        remove(spark, folder)


@query("load_null_tokens")
def load_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = {"patients": "patient_id STRING, state STRING, balance DOUBLE"}
    return _load_text(spark, sf_dir, fixtures.TOKEN_CSV, schema)


@query("load_typed")
def load_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = HEALTHCARE_SCHEMAS["encounters"]
    schema = {
        "encounters": ", ".join(
            [f"{c} {declared[c].dataType.simpleString()}" for c in ("length_of_stay", "total_charges_usd")]
            + ["is_active BOOLEAN"]
        )
    }
    return _load_text(spark, sf_dir, fixtures.TYPED_CSV, schema)


@query("load_malformed")
def load_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faulty lines counted by fault, and what the table holds without them."""
    folder = new_folder(spark)
    (lines,) = from_sql(spark, sf_dir, fixtures.MALFORMED_CSV)
    try:
        text = lines.select(F.col("line").alias("id,name,nation"))
        text.write.option("header", True).option("sep", "\u0001").option("quote", "").option("escape", "").csv(f"{folder}/in/t.csv")
        types = StructType.fromDDL("id BIGINT, name STRING, nation INT")
        loaded = load_checked(spark, f"{folder}/in", {"t": types}, max_malformed=None, folder=f"{folder}/staged")
        held = loaded.tables["t"].agg(
            F.sum("id").alias("sum_ids"), F.count("nation").alias("nations"), F.count_if(F.col("name") == 'a, "b"').alias("quoted")
        )
        return settle(loaded.report.join(held.withColumn("table_name", F.lit("t")), "table_name"))
    finally:
        remove(spark, folder)


def _load_text(spark: SparkSession, sf_dir: str, text: str, schema: dict[str, str]) -> DataFrame:
    folder = new_folder(spark)
    (name, columns), = schema.items()
    (contents,) = from_sql(spark, sf_dir, text)
    try:
        _write_csv(contents, f"{folder}/{name}.csv")
        types = StructType.fromDDL(columns)
        return settle(load_tables(spark, folder, {name: types})[name])
    finally:
        remove(spark, folder)


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("escape", '"').csv(path)


@query("gov_dq_results")
def gov_dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _time_text(governance_frame("dq_results", _results(spark, sf_dir)))


@query("gov_dq_scores")
def gov_dq_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _time_text(governance_frame("dq_scores", _scores(spark, sf_dir)))


@query("dq_runs_append")
def dq_runs_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run already recorded is kept as it was, a new one is added."""
    folder = new_folder(spark)
    try:
        tables = stage(dirty(spark, sf_dir), folder)
        recorded = settle(run_record(evaluate(tables, rules_for(HEALTHCARE_RULES, "patients"), RUN_1)))
        again = run_record(evaluate(tables, HEALTHCARE_RULES, RUN_1), triggered_by="again")
        later = run_record(evaluate(tables, HEALTHCARE_RULES, RUN_2))
        return settle(_time_text(recorded.unionByName(new_runs(again.unionByName(later), recorded))))
    finally:
        remove(spark, folder)


@query("dq_run_summary")
def dq_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(_results(spark, sf_dir)).drop("run_time")


@query("rule_registry")
def rule_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry with the outcome of each rule on the given tables."""
    outcome = _results(spark, sf_dir).select("rule_id", "failed_records", "status")
    return registry_frame(spark, HEALTHCARE_RULES, CONTEXT).drop("created_at").join(outcome, "rule_id")


def _staged_profile(spark: SparkSession, sf_dir: str, *names: str, samples: bool = False) -> DataFrame:
    """The profile of dirty views, which are staged for it and removed after it."""
    folder = new_folder(spark)
    try:
        return settle(profile(stage(dirty(spark, sf_dir, *names), folder), samples))
    finally:
        remove(spark, folder)


# --- rules


def _register_kind(name: str) -> None:
    rules = RULE_KINDS[name]
    names = {r.table_name for r in rules}
    names |= {r.check.parent_table for r in rules if isinstance(r.check, References)}

    @query(name)
    def kind(spark: SparkSession, sf_dir: str) -> DataFrame:
        results = evaluate(dirty(spark, sf_dir, *sorted(names)), rules, CONTEXT)
        return results.select("table_name", "rule_id", "total_records", "failed_records")


for _name in RULE_KINDS:
    _register_kind(_name)


@query("dq_results")
def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _results(spark, sf_dir).drop("run_time")


def _register_table(table: str) -> None:
    names = {table}
    names |= {r.check.parent_table for r in rules_for(HEALTHCARE_RULES, table) if isinstance(r.check, References)}

    @query(f"dq_results_{table}")
    def table_results(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = dirty(spark, sf_dir, *sorted(names))
        return _without_time(evaluate(tables, rules_for(HEALTHCARE_RULES, table), CONTEXT, views=fixtures.JOINED_VIEWS))

    @query(f"profile_{table}")
    def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _staged_profile(spark, sf_dir, table)


for _name in fixtures.DIRTY_VIEWS:
    _register_table(_name)


# --- scores


@query("severity_weights")
def severity_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weight of each severity, and how much of it the rules passed."""
    weighed = _results(spark, sf_dir).withColumn("weight", weight(F.col("severity")))
    return weighed.groupBy("severity", "weight").agg(
        F.sum("weight").cast("bigint").alias("total_weight"),
        F.sum(F.when(F.col("status") == "PASS", F.col("weight")).otherwise(0))
        .cast("bigint")
        .alias("passed_weight"),
    )


@query("dq_scores")
def dq_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_time(_scores(spark, sf_dir))


@query("grade_boundaries")
def grade_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades over both rule sets, which reach A to D and F."""
    both = _results(spark, sf_dir).unionByName(_raw_results(spark, sf_dir))
    return score(both).select("table_name", "dq_score", "grade")


@query("total_issues")
def all_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_issues(_results(spark, sf_dir))


@query("dq_results_raw")
def dq_results_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_time(_raw_results(spark, sf_dir))


@query("dq_results_faulty")
def dq_results_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that cannot be checked count as passed; all but the reference from no column are noted."""
    errors: list[RuleError] = []
    results = isolated(evaluate, raw(spark, sf_dir, "orders", "customer"), fixtures.FAULTY_RULES, CONTEXT, errors)
    noted = F.col("rule_id").isin([e.rule_id for e in errors])
    return results.select("table_name", "rule_id", "total_records", "failed_records", "pass_rate_pct", "status", noted.alias("noted"))


@query("dq_scores_raw")
def dq_scores_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_time(score(_raw_results(spark, sf_dir)))


@query("downstream_impact_raw")
def downstream_impact_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_time(downstream_impact(_raw_results(spark, sf_dir), RAW_REPORTS))


# --- profiles


@query("profile_all")
def profile_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged_profile(spark, sf_dir)


@query("profile_sample")
def profile_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiled = _staged_profile(spark, sf_dir, samples=True)
    return profiled.select("table_name", "column_name", "sample_values")


@query("profile_raw")
def profile_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(raw(spark, sf_dir, "lineitem", "supplier"), samples=False)


@query("profile_approx")
def profile_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An estimated profile beside exact counts, and whether the two agree."""
    folder = new_folder(spark)
    try:
        staged = stage(dirty(spark, sf_dir), folder)
        exact = profile(staged, samples=False).select("table_name", "position", F.col("unique_count").alias("exact_count"))
        near = F.abs(F.col("unique_count") - F.col("exact_count")) <= 0.03 * F.col("exact_count")
        both = profile(staged, distinct="approx").join(exact, ["table_name", "position"]).withColumn("within_3_pct", near)
        return settle(both.drop("unique_count", "uniqueness_pct"))
    finally:
        remove(spark, folder)


@query("profile_sketches")
def profile_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of two runs, one of them by halves, merged: the estimates are those of one sketch over all rows."""
    tables = raw(spark, sf_dir, "lineitem", "supplier")
    whole = settle(column_sketches(tables, RUN_1.run_id))
    parts = whole
    for half in (0, 1):
        dealt = {"lineitem": F.pmod("l_orderkey", F.lit(2)), "supplier": F.pmod("s_suppkey", F.lit(2))}
        parts = parts.unionByName(column_sketches({n: tables[n].where(dealt[n] == half) for n in tables}, RUN_2.run_id))
    alone = merged_estimates(whole).select("table_name", "column_name", F.col("unique_count").alias("alone"))
    same = (F.col("unique_count") == F.col("alone")).alias("as_one")
    both = merged_estimates(parts).join(alone, ["table_name", "column_name"])
    return both.select("table_name", "column_name", "total_count", "null_count", same)


@query("profile_null_rank")
def profile_null_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.profile_null_rank(completeness(dirty(spark, sf_dir, "patients")), "patients")


@query("profile_uniqueness_rank")
def profile_uniqueness_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.profile_uniqueness_rank(_staged_profile(spark, sf_dir, "patients"), "patients")


@query("profile_display")
def profile_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.profile_display(_staged_profile(spark, sf_dir, "encounters"), "encounters")


# --- reconciliation

# What the sources claim to have sent, from the tables behind the views.
SOURCE_COUNTS = """
SELECT 'patients' AS table_name, count(*) - 8 AS source_count FROM {customer}
UNION ALL SELECT 'encounters', count(*) FROM {orders}
UNION ALL SELECT 'lab_results', count(*) + 125 FROM {lineitem}
UNION ALL SELECT 'medications', count(*) FROM {events}
"""
# One table without a count, one whose source claims to be empty.
PARTIAL_COUNTS = """
SELECT 'patients' AS table_name, count(*) AS source_count FROM {customer}
UNION ALL SELECT 'encounters', count(*) - count(o_orderkey) FROM {orders}
UNION ALL SELECT 'lab_results', 2 * count(*) FROM {lineitem}
"""


def _loaded(results: DataFrame) -> DataFrame:
    """The records of each table, as the rules have counted them already."""
    return results.groupBy("table_name").agg(F.max("total_records").alias("loaded_count"))


def _reconciled(spark: SparkSession, sf_dir: str, counts: str = SOURCE_COUNTS) -> DataFrame:
    (sent,) = from_sql(spark, sf_dir, counts)
    return reconcile(dirty(spark, sf_dir), sent, CONTEXT)


@query("reconcile")
def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_time(_reconciled(spark, sf_dir))


@query("reconcile_missing_source")
def reconcile_missing_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_time(_reconciled(spark, sf_dir, PARTIAL_COUNTS))


@query("recon_long")
def recon_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.reconciliation_long(_reconciled(spark, sf_dir))


@query("recon_display")
def recon_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.reconciliation_display(_reconciled(spark, sf_dir))


@query("record_flow")
def record_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = settle(_results(spark, sf_dir))
    (sent,) = from_sql(spark, sf_dir, SOURCE_COUNTS)
    return marts.record_flow(reconcile({}, sent, CONTEXT, _loaded(results)), score(results))


# --- impact


@query("report_registry")
def report_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports with the tables they read and how many records those hold."""
    lines = report_frame(spark, HEALTHCARE_REPORTS).select(
        "report",
        "owner",
        "refresh_cadence",
        "criticality",
        F.posexplode("tables").alias("position", "table_name"),
    )
    return lines.join(_loaded(_results(spark, sf_dir)), "table_name")


@query("impact_trigger_tables")
def impact_trigger_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _results(spark, sf_dir).unionByName(_raw_results(spark, sf_dir))
    return trigger_tables(both).select("table_name", "issues")


@query("downstream_impact")
def impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_time(_impact(spark, sf_dir))


@query("impact_by_report")
def impact_by_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.impact_by_report(_impact(spark, sf_dir))


@query("impact_by_criticality")
def impact_by_criticality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.impact_by_criticality(_impact(spark, sf_dir))


@query("impact_detail")
def impact_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.impact_detail(_impact(spark, sf_dir))


# --- audit and standing views


@query("audit_log")
def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_time(_audit(spark, sf_dir))


@query("audit_kpis")
def audit_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.audit_kpis(_audit(spark, sf_dir))


@query("audit_by_table_severity")
def audit_by_table_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.audit_by_table_severity(_audit(spark, sf_dir))


@query("audit_by_severity")
def audit_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.audit_by_severity(_audit(spark, sf_dir))


@query("audit_detail")
def audit_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.audit_detail(_audit(spark, sf_dir))


@query("latest_dq_scores")
def latest_dq_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest score per table over a history of three runs."""
    folder = new_folder(spark)
    try:
        tables = stage(dirty(spark, sf_dir), folder)
        runs = [score(evaluate(tables, rules_for(HEALTHCARE_RULES, *names), ctx)) for ctx, names in HISTORY]
        return settle(_time_text(latest_scores(union_all(runs))))
    finally:
        remove(spark, folder)


@query("open_critical_issues")
def open_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_time(open_critical_issues(_audit(spark, sf_dir)))


# --- dashboard summaries


def _chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.filter_results(_results(spark, sf_dir), severities=["Critical", "High", "Medium"])


@query("results_filtered")
def results_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_time(marts.filter_results(_results(spark, sf_dir), FILTER_TABLES, FILTER_SEVERITIES))


@query("kpi_cards")
def kpi_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = settle(_results(spark, sf_dir))
    return marts.kpi_cards(
        results,
        score(results),
        audit_log(results, HEALTHCARE_RULES),
        downstream_impact(results, HEALTHCARE_REPORTS),
    )


@query("score_band")
def score_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _results(spark, sf_dir).unionByName(_raw_results(spark, sf_dir))
    return marts.score_bands(score(both))


@query("rule_summary")
def rule_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = settle(_results(spark, sf_dir))
    chosen = marts.filter_results(results, severities=["Critical", "High", "Medium"])
    return marts.rule_summary(chosen, score(results))


@query("issues_by_severity")
def issues_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.issues_by_severity(_chosen(spark, sf_dir))


@query("issues_by_category")
def issues_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.issues_by_category(_chosen(spark, sf_dir))


@query("failed_rules")
def failed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.failed_rules(_chosen(spark, sf_dir))


@query("dq_heatmap_raw")
def dq_heatmap_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under rules of categories that a radar does not show."""
    return marts.heatmap(evaluate(raw(spark, sf_dir, "orders"), fixtures.ORDER_RULES, CONTEXT))


def _stored(spark: SparkSession, sf_dir: str, keep_history: bool, read: Callable[[str], DataFrame]) -> DataFrame:
    """What ``read`` finds in a governance folder after two runs; the second finds orders mended."""
    folder = new_folder(spark)
    tables = raw(spark, sf_dir, "orders", "customer")
    try:
        for run, rules in ((FIRST_RUN, fixtures.STORED_RULES), (SECOND_RUN, fixtures.MENDED_RULES)):
            results = settle(evaluate(tables, rules, run))
            frames = {"dq_results": results, "audit_log": audit_log(results, rules)}
            load_governance(frames, folder, run.run_id, keep_history)
        return settle(read(folder))
    finally:
        remove(spark, folder)


@query("gov_history_open_issues")
def gov_history_open_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    def read(folder: str) -> DataFrame:
        audit, results = (read_governance(spark, folder, n) for n in ("audit_log", "dq_results"))
        return open_critical_issues(audit, results).select("run_id", "rule_id", "records_affected")

    return _stored(spark, sf_dir, True, read)


@query("gov_run_id_text")
def gov_run_id_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("run_id", "rule_id", "status", "failed_records")
    return _stored(spark, sf_dir, True, lambda f: read_governance(spark, f, "dq_results").select(*columns))


@query("gov_replace_runs")
def gov_replace_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("run_id", "rule_id", "status", "failed_records")
    return _stored(spark, sf_dir, False, lambda f: read_governance(spark, f, "dq_results").select(*columns))


@query("gov_uncommitted_run")
def gov_uncommitted_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see of a run that stopped after its first table: the run before it alone."""
    folder = new_folder(spark)
    tables = raw(spark, sf_dir, "orders", "customer")
    try:
        for run, rules in ((FIRST_RUN, fixtures.STORED_RULES), (SECOND_RUN, fixtures.MENDED_RULES)):
            results = settle(evaluate(tables, rules, run))
            audit = audit_log(results, rules)
            if run is SECOND_RUN:
                audit = audit.withColumn("severity", F.raise_error(F.lit("stopped")).cast("string"))
            try:
                load_governance({"dq_results": results, "audit_log": audit}, folder, run.run_id, record=run_record(results))
            except SparkRuntimeException:
                if run is not SECOND_RUN:
                    raise
        listed = read_governance(spark, folder, "dq_runs").select("run_id", F.lit(True).alias("listed"))
        newest = read_governance(spark, folder, "dq_results", newest=True).select("run_id", "rule_id", "status", "failed_records")
        return settle(newest.join(listed, "run_id", "left"))
    finally:
        remove(spark, folder)


@query("gov_data_profile")
def gov_data_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return governance_frame("data_profile", profile(raw(spark, sf_dir, "supplier", "nation")))


@query("gov_reconciliation")
def gov_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _time_text(governance_frame("reconciliation", _reconciled(spark, sf_dir)))


@query("gov_downstream_impact")
def gov_downstream_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _time_text(governance_frame("downstream_impact", _impact(spark, sf_dir)))


@query("gov_audit_log")
def gov_audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _time_text(governance_frame("audit_log", _audit(spark, sf_dir)), "event_time")


@query("written_results")
def written_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result files written twice, read back as text and as typed columns."""
    folder = new_folder(spark)
    results = settle(_raw_results(spark, sf_dir))
    try:
        for file_format in ("csv", "parquet"):
            for _ in range(2):
                write_results({"dq_results": results}, folder, file_format)
        text = spark.read.option("header", True).option("escape", '"').csv(f"{folder}/dq_results.csv")
        typed = spark.read.parquet(f"{folder}/dq_results.parquet")
        columns = ("table_name", "rule_id", "description", "failed_records", "status")
        as_text = text.select(*columns).withColumn("failed_records", F.col("failed_records").cast("bigint"))
        return settle(as_text.withColumn("file", F.lit("csv")).unionByName(typed.select(*columns).withColumn("file", F.lit("parquet"))))
    finally:
        remove(spark, folder)


@query("empty_results")
def empty_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What follows from results without a failed rule, and from none at all: the columns stay, the rows go."""
    results = settle(_raw_results(spark, sf_dir))
    counts = []
    for name, kept in (("passed", F.col("status") == "PASS"), ("none", F.lit(False))):
        some = results.where(kept)
        frames = {"scores": score(some), "audit": audit_log(some, RAW_RULES), "impact": downstream_impact(some, RAW_REPORTS)}
        for derived, frame in frames.items():
            columns = F.lit(",".join(frame.columns)).alias("columns")
            counts.append(frame.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("results"), F.lit(derived).alias("derived"), columns, "n_rows"))
    return union_all(counts)


@query("dq_heatmap")
def dq_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.heatmap(_chosen(spark, sf_dir))


@query("issues_by_table_severity")
def issues_by_table_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.issues_by_table_severity(_chosen(spark, sf_dir))


@query("dq_radar")
def dq_radar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.radar(_chosen(spark, sf_dir))


# --- marts over two runs


def _two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results of two runs, the second with a later clock and without the medications."""
    tables = dirty(spark, sf_dir)
    runs = [evaluate(tables, rules_for(HEALTHCARE_RULES, *names), ctx, views=fixtures.JOINED_VIEWS) for ctx, names in HISTORY[:2]]
    return settle(runs[0].unionByName(runs[1]))


BY_RUN = ("run_id",)


@query("rule_summary_history")
def rule_summary_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _two_runs(spark, sf_dir)
    return marts.rule_summary(results, score(results), by=BY_RUN)


@query("dq_heatmap_history")
def dq_heatmap_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.heatmap(_two_runs(spark, sf_dir), by=BY_RUN)


@query("issues_by_category_history")
def issues_by_category_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.issues_by_category(_two_runs(spark, sf_dir), by=BY_RUN)


@query("kpi_cards_history")
def kpi_cards_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _two_runs(spark, sf_dir)
    audit, impact = audit_log(results, HEALTHCARE_RULES), downstream_impact(results, HEALTHCARE_REPORTS)
    return marts.kpi_cards(results, score(results), audit, impact, by=BY_RUN)


@query("audit_by_severity_history")
def audit_by_severity_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.audit_by_severity(audit_log(_two_runs(spark, sf_dir), HEALTHCARE_RULES), by=BY_RUN)
