"""The SQL each registered query is checked against, over the given tables only."""

from __future__ import annotations

from vouch.plans.reports import HEALTHCARE_REPORTS, Report
from vouch.plans.rules import HEALTHCARE_RULES, Rule
from vouch.suite import fixtures
from vouch.suite.fixtures import DIRTY_VIEWS, RAW_REPORTS, RAW_RULES, plain
from vouch.suite.queries import (
    FILTER_SEVERITIES,
    FILTER_TABLES,
    HISTORY,
    PARTIAL_COUNTS,
    RULE_KINDS,
    RUN_1,
    RUN_2,
    SOURCE_COUNTS,
)

AS_OF = "TIMESTAMP '2026-01-01 00:00:00'"


def _unknown(key: str, parent: str, parent_key: str) -> str:
    return f"({key} IS NULL OR {key} NOT IN (SELECT {parent_key} FROM {parent} WHERE {parent_key} IS NOT NULL))"


def _copies(key: str) -> str:
    return f"count(*) OVER (PARTITION BY {key}) > 1"


def _before(first: str, second: str) -> str:
    return f"try_cast({first} AS TIMESTAMP) < try_cast({second} AS TIMESTAMP)"


def _null(key: str) -> str:
    return f"{key} IS NULL"


# rule id -> condition that is true for a record that breaks the rule; {now} is the clock
VIOLATIONS = {
    "PAT-001": _null("patient_id"),
    "PAT-002": _null("date_of_birth"),
    "PAT-003": _null("gender"),
    "PAT-004": _null("state"),
    "PAT-005": "gender NOT IN ('M', 'F', 'Other')",
    "PAT-006": "zip_code IS NULL OR NOT regexp_full_match(zip_code, '[0-9]{{5}}')",
    "PAT-007": _copies("patient_id"),
    "PAT-008": "try_cast(date_of_birth AS TIMESTAMP) IS NULL OR try_cast(date_of_birth AS TIMESTAMP) > {now}",
    "PAT-009": _null("email"),
    "ENC-001": _null("encounter_id"),
    "ENC-002": _null("patient_id"),
    "ENC-003": _null("admission_date"),
    "ENC-004": _null("primary_diagnosis"),
    "ENC-005": _before("discharge_date", "admission_date"),
    "ENC-006": "try_cast(discharge_date AS TIMESTAMP) > {now}",
    "ENC-007": "total_charges_usd < 0",
    "ENC-008": _unknown("patient_id", "patients", "patient_id"),
    "ENC-009": _copies("encounter_id"),
    "LAB-001": _null("lab_id"),
    "LAB-002": _null("result_value"),
    "LAB-003": _null("unit"),
    "LAB-004": "result_value < -999",
    "LAB-005": _before("result_date", "collection_date"),
    "LAB-006": _unknown("patient_id", "patients", "patient_id"),
    "LAB-007": "status NOT IN ('Final', 'Preliminary', 'Corrected', 'Cancelled')",
    "MED-001": _null("med_id"),
    "MED-002": _null("dose"),
    "MED-003": _null("start_date"),
    "MED-004": _before("end_date", "start_date"),
    "MED-005": "frequency NOT IN ('Daily', 'BID', 'TID', 'QID', 'Weekly', 'PRN', 'Monthly')",
    "SUP-001": _null("s_suppkey"),
    "SUP-002": _copies("s_suppkey"),
    "SUP-003": _unknown("s_nationkey", "nation", "n_nationkey"),
    "SUP-004": "s_acctbal < 0",
    "PRT-001": _null("p_partkey"),
    "PRT-002": _copies("p_partkey"),
    "PRT-003": "p_size < 1",
    "PRT-004": _copies("p_name"),
    "ORD-001": _null("o_orderkey"),
    "ORD-002": _unknown("o_custkey", "customer", "c_custkey"),
    "ORD-003": "o_orderstatus NOT IN ('O', 'F')",
    "CUS-001": _null("c_custkey"),
    "CUS-002": "c_acctbal < 0",
    "CUS-003": _unknown("c_nationkey", "nation", "n_nationkey"),
    **{f"BAD-00{n}": "false" for n in range(1, 7)},
}

WEIGHT = "CASE severity WHEN 'Critical' THEN 4 WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 WHEN 'Low' THEN 1 END"
RANK = "CASE severity WHEN 'Critical' THEN 0 WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END"
VIEWS = ", ".join(f"{name} AS ({plain(text)})" for name, text in DIRTY_VIEWS.items())


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _pct(n: str, d: str, digits: int) -> str:
    """Half-even percentage over whole numbers."""
    scaled = f"(abs({n}) * {100 * 10**digits})"
    whole, rest = f"({scaled} // ({d}))", f"({scaled} % ({d}))"
    up = f"CASE WHEN 2 * {rest} > ({d}) OR (2 * {rest} = ({d}) AND {whole} % 2 = 1) THEN 1 ELSE 0 END"
    return f"(CASE WHEN ({d}) = 0 THEN 0.0::DOUBLE ELSE sign({n}) * ({whole} + {up}) / {10**digits}::DOUBLE END)"


def _rule_rows(rules: list[Rule], now: str = AS_OF, run_id: str = "RUN_20260101_000000", run_time: str = "2026-01-01 00:00:00") -> str:
    """One row per rule with its position, records and failed records."""
    parts = []
    for position, rule in enumerate(rules):
        violation = VIOLATIONS[rule.rule_id].format(now=now)
        parts.append(
            f"SELECT {position} AS position, {_text(run_id)} AS run_id, {_text(run_time)} AS run_time, "
            f"{_text(rule.table_name)} AS table_name, {_text(rule.rule_id)} AS rule_id, "
            f"{_text(rule.category)} AS category, {_text(rule.severity)} AS severity, "
            f"{_text(rule.description)} AS description, count(*) AS total_records, "
            f"count(*) FILTER (WHERE violated) AS failed_records "
            f"FROM (SELECT {violation} AS violated FROM {rule.table_name})"
        )
    return " UNION ALL ".join(parts)


def _results(rows: str) -> str:
    return (
        "SELECT *, total_records - failed_records AS passed_records, "
        f"{_pct('(total_records - failed_records)', 'total_records', 2)} AS pass_rate_pct, "
        f"CASE WHEN failed_records = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({rows})"
    )


SCORES = f"""
SELECT *, CASE WHEN dq_score >= 90 THEN 'A' WHEN dq_score >= 80 THEN 'B' WHEN dq_score >= 70 THEN 'C'
  WHEN dq_score >= 60 THEN 'D' ELSE 'F' END AS grade
FROM (SELECT run_id, run_time, table_name, count(*) AS total_rules,
    count(*) FILTER (WHERE status = 'PASS') AS passed_rules,
    count(*) FILTER (WHERE status = 'FAIL') AS failed_rules,
    {_pct("passed_weight", "total_weight", 1)} AS dq_score
  FROM (SELECT *, cast(coalesce(sum({WEIGHT}) FILTER (WHERE status = 'PASS') OVER (PARTITION BY run_id, table_name), 0) AS BIGINT) AS passed_weight,
      cast(sum({WEIGHT}) OVER (PARTITION BY run_id, table_name) AS BIGINT) AS total_weight FROM results)
  GROUP BY run_id, run_time, table_name, passed_weight, total_weight)
"""

AUDIT = """
SELECT 'AUD' || lpad(cast(row_number() OVER (ORDER BY position) AS VARCHAR), 6, '0') AS log_id,
  table_name, rule_id, 'DQ_VIOLATION' AS event_type, severity, description,
  failed_records AS records_affected,
  CASE WHEN severity IN ('Medium', 'Low') THEN 'Flagged for review' ELSE 'Quarantined pending remediation' END AS action_taken,
  false AS resolved
FROM results WHERE status = 'FAIL'
"""

TRIGGERS = """
SELECT table_name, cast(sum(failed_records) AS BIGINT) AS issues FROM results WHERE status = 'FAIL'
GROUP BY table_name HAVING bool_or(severity IN ('Critical', 'High'))
"""


def _report_lines(reports: list[Report]) -> str:
    values = [
        f"({i}, {_text(r.report)}, {_text(r.owner)}, {_text(r.refresh_cadence)}, {_text(r.criticality)}, {p}, {_text(t)})"
        for i, r in enumerate(reports)
        for p, t in enumerate(r.tables)
    ]
    return (
        "SELECT * FROM (VALUES " + ", ".join(values) + ") "
        "AS v(report_order, report, owner, refresh_cadence, criticality, position, table_name)"
    )


IMPACT = """
SELECT report, owner, refresh_cadence, criticality,
  string_agg(table_name, ', ' ORDER BY position) AS affected_tables,
  cast(sum(issues) AS BIGINT) AS total_issues,
  CASE WHEN criticality = 'Critical' THEN 'High' ELSE 'Medium' END AS impact_level
FROM report_lines JOIN triggers USING (table_name)
GROUP BY report_order, report, owner, refresh_cadence, criticality
"""


def _with_results(select: str, rules: list[Rule] = HEALTHCARE_RULES, reports: list[Report] = HEALTHCARE_REPORTS) -> str:
    return (
        f"WITH {VIEWS}, results AS ({_results(_rule_rows(rules))}), scores AS ({SCORES}), audit AS ({AUDIT}), "
        f"triggers AS ({TRIGGERS}), report_lines AS ({_report_lines(reports)}), impact AS ({IMPACT}), "
        "chosen AS (SELECT * FROM results WHERE severity IN ('Critical', 'High', 'Medium')) "
        f"{select}"
    )


def _with_views(select: str) -> str:
    return f"WITH {VIEWS} {select}"


RESULT_COLUMNS = (
    "table_name, rule_id, category, severity, description, total_records, failed_records, "
    "passed_records, pass_rate_pct, status"
)
SCORE_COLUMNS = "table_name, total_rules, passed_rules, failed_rules, dq_score, grade"
RULE_COUNTS = "table_name, rule_id, total_records, failed_records"
BOTH_RULES = HEALTHCARE_RULES + RAW_RULES


# --- profiles

# columns of the profiled tables with how their type is profiled
PROFILED = {
    "patients": ("patient_id", "date_of_birth", "gender", "state", "zip_code", "email", "insurance_type"),
    "encounters": (
        "encounter_id", "patient_id", "admission_date", "discharge_date", "primary_diagnosis",
        "length_of_stay:number", "total_charges_usd:number",
    ),
    "lab_results": (
        "lab_id", "patient_id", "result_value:number", "unit", "is_abnormal:boolean",
        "collection_date", "result_date", "status",
    ),
    "medications": (
        "med_id", "patient_id", "dose", "frequency", "start_date", "end_date", "is_active:boolean",
    ),
    "lineitem": (
        "l_orderkey:number", "l_partkey:number", "l_suppkey:number", "l_linenumber:number",
        "l_quantity:number", "l_extendedprice:number", "l_discount:number", "l_tax:number",
        "l_returnflag", "l_linestatus", "l_shipdate",
    ),
    "nation": ("n_nationkey:number", "n_name", "n_regionkey:number"),
    "supplier": ("s_suppkey:number", "s_name", "s_nationkey:number", "s_acctbal:number"),
}


def _profile(*tables: str) -> str:
    parts = []
    for table in tables:
        for position, spec in enumerate(PROFILED[table]):
            name, _, kind = spec.partition(":")
            least = greatest = "cast(NULL AS VARCHAR)"
            mean = "cast(NULL AS DOUBLE)"
            if kind == "number":
                # a zero may come as -0.0
                least, greatest = (f"cast({f}({name}) + 0 AS VARCHAR)" for f in ("min", "max"))
                mean = f"cast(round_even(avg({name}), 2) AS DOUBLE)"
            if kind == "boolean":
                least = f"CASE WHEN bool_and({name}) THEN 'True' ELSE 'False' END"
                greatest = f"CASE WHEN bool_or({name}) THEN 'True' ELSE 'False' END"
                mean = f"cast(round_even(avg(CASE WHEN {name} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 2) AS DOUBLE)"
            parts.append(
                f"SELECT {_text(table)} AS table_name, {position} AS position, {_text(name)} AS column_name, "
                f"count(*) AS total_count, count(*) - count({name}) AS null_count, "
                f"{_pct(f'(count(*) - count({name}))', 'count(*)', 2)} AS null_pct, "
                f"count(DISTINCT {name}) AS unique_count, "
                f"{_pct(f'count(DISTINCT {name})', 'count(*)', 2)} AS uniqueness_pct, "
                f"{'true' if kind else 'false'} AS is_numeric, {least} AS min_value, {greatest} AS max_value, "
                f"{mean} AS mean_value FROM {table}"
            )
    return " UNION ALL ".join(parts)


def _samples(*tables: str) -> str:
    """Up to three values in the order of the MD5 of their text, distinct ones before repeated ones."""
    escaped = r"replace(replace(v, '\', '\\'), chr(10), '\n')"
    quotes = rf"""CASE WHEN contains(v, '''') AND NOT contains(v, '"') THEN '"' || {escaped} || '"' ELSE '''' || replace({escaped}, '''', '\''') || '''' END"""
    shown = {"": quotes, "number": "v", "boolean": "CASE v WHEN 'true' THEN 'True' ELSE 'False' END"}
    listed = "list_concat(list(text ORDER BY number), flatten(list(list_transform(range(1, least(n, 3)), lambda i: text) ORDER BY number)))"
    parts = []
    for table in tables:
        for spec in PROFILED[table]:
            name, _, kind = spec.partition(":")
            parts.append(f"""SELECT {_text(table)} AS table_name, {_text(name)} AS column_name,
                coalesce('[' || array_to_string(list_slice({listed}, 1, 3), ', ') || ']', '[]') AS sample_values
              FROM (SELECT {shown[kind]} AS text, n, row_number() OVER (ORDER BY md5(v), v) AS number FROM
                (SELECT cast({name} AS VARCHAR) AS v, count(*) AS n FROM {table} WHERE {name} IS NOT NULL GROUP BY {name}) QUALIFY number <= 3)""")
    return " UNION ALL ".join(parts)


def _approximate(*tables: str) -> str:
    """The columns of an estimated profile: every estimate is to lie within 3 % of the exact count."""
    return (
        "SELECT table_name, position, column_name, total_count, null_count, null_pct, is_numeric, min_value, max_value, mean_value, "
        f"unique_count AS exact_count, true AS within_3_pct FROM ({_profile(*tables)})"
    )


def _merged(*tables: str) -> str:
    """Sketches of two runs over the same tables: twice the rows, the distinct values of one."""
    return (
        "SELECT table_name, column_name, 2 * total_count AS total_count, 2 * null_count AS null_count, "
        f"true AS as_one FROM ({_profile(*tables)})"
    )


# --- reconciliation


def _reconciliation(counts: str) -> str:
    loaded = " UNION ALL ".join(
        f"SELECT {_text(t)} AS table_name, count(*) AS loaded_count FROM {t}" for t in DIRTY_VIEWS
    )
    return (
        "SELECT *, loaded_count - source_count AS delta, "
        f"{_pct('(loaded_count - source_count)', 'source_count', 2)} AS delta_pct, "
        "CASE WHEN loaded_count = source_count THEN 'MATCH' ELSE 'MISMATCH' END AS status FROM "
        "(SELECT l.table_name, cast(coalesce(s.source_count, l.loaded_count) AS BIGINT) AS source_count, l.loaded_count "
        f"FROM ({loaded}) l LEFT JOIN ({plain(counts)}) s ON l.table_name = s.table_name)"
    )


def _with_reconciliation(select: str) -> str:
    return _with_results(
        f"SELECT * FROM ({select.format(recon='(' + _reconciliation(SOURCE_COUNTS) + ')')})"
    )


# --- runs


def _history_rows(runs: int = len(HISTORY)) -> str:
    parts = []
    for ctx, names in HISTORY[:runs]:
        rules = [r for r in HEALTHCARE_RULES if r.table_name in names]
        parts.append(
            _rule_rows(rules, f"TIMESTAMP '{ctx.as_of or ctx.run_time}'", ctx.run_id, f"{ctx.run_time}")
        )
    return " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


def _two_runs(select: str) -> str:
    """Results of two runs with their scores and the reports that each run's triggers reach."""
    triggers = TRIGGERS.replace("SELECT table_name", "SELECT run_id, table_name").replace("GROUP BY table_name", "GROUP BY run_id, table_name")
    return (
        f"WITH {VIEWS}, results AS ({_results(_history_rows(2))}), scores AS ({SCORES}), triggers AS ({triggers}), "
        f"report_lines AS ({_report_lines(HEALTHCARE_REPORTS)}) {select}"
    )


def _run_record(rows: str, triggered_by: str) -> str:
    return (
        f"SELECT run_id, run_time, {_text(triggered_by)} AS triggered_by, 'Completed' AS status, "
        "cast(count(DISTINCT table_name) AS INTEGER) AS total_tables, cast(count(*) AS INTEGER) AS total_rules, "
        "cast(sum(failed_records) AS BIGINT) AS total_issues, cast(NULL AS VARCHAR) AS notes "
        f"FROM ({rows}) GROUP BY run_id, run_time"
    )


def _runs_append() -> str:
    patient_rules = [r for r in HEALTHCARE_RULES if r.table_name == "patients"]
    recorded = _rule_rows(patient_rules, AS_OF, RUN_1.run_id, str(RUN_1.run_time))
    again = _rule_rows(HEALTHCARE_RULES, AS_OF, RUN_1.run_id, str(RUN_1.run_time))
    later = _rule_rows(HEALTHCARE_RULES, f"TIMESTAMP '{RUN_2.as_of}'", RUN_2.run_id, str(RUN_2.run_time))
    return (
        f"WITH {VIEWS}, recorded AS ({_run_record(recorded, 'automated')}), "
        f"fresh AS ({_run_record(again, 'again')} UNION ALL {_run_record(later, 'automated')}) "
        "SELECT * FROM recorded UNION ALL SELECT * FROM fresh WHERE run_id NOT IN (SELECT run_id FROM recorded)"
    )


def _radar(category: str) -> str:
    passed = f"count(*) FILTER (WHERE category = '{category}' AND status = 'PASS')"
    total = f"count(*) FILTER (WHERE category = '{category}')"
    return f"CASE WHEN {total} = 0 THEN 100.0::DOUBLE ELSE {_pct(passed, total, 1)} END"


CATEGORIES = ("Completeness", "Validity", "Uniqueness", "Referential")
HEATMAP_CATEGORIES = (*CATEGORIES, "Consistency", "Timeliness")


#: Columns of the frames that derive from rule results, which stay when these are empty.
DERIVED_COLUMNS = {
    "scores": "run_id,table_name,total_rules,passed_rules,failed_rules,dq_score,grade,run_time",
    "audit": "run_id,log_id,event_time,table_name,rule_id,event_type,severity,description,records_affected,action_taken,resolved",
    "impact": "run_id,report,owner,refresh_cadence,criticality,affected_tables,total_issues,impact_level,run_time",
}


def _share(broken: str) -> str:
    return f"(CASE WHEN count(*) FILTER (WHERE {broken}) > 0 THEN 0.0 ELSE 100.0 END)::DOUBLE"


def _stored(run_id: str, mended: bool) -> str:
    """Results of the stored rules: of orders in another state than O or F, and of negative balances."""
    orders = "o_orderkey IS NULL" if mended else "o_orderstatus NOT IN ('O', 'F')"
    return " UNION ALL ".join(
        f"""SELECT '{run_id}' AS run_id, '{rule}' AS rule_id, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status, n AS failed_records
            FROM (SELECT count(*)::BIGINT AS n FROM {table} WHERE {broken})"""
        for rule, table, broken in (("ORD-003", "orders", orders), ("CUS-002", "customer", "c_acctbal < 0"))
    )


def oracle_sql() -> dict[str, str]:
    sql = {
        "load_counts": _with_views(
            " UNION ALL ".join(
                f"SELECT {_text(t)} AS table_name, count(*) AS loaded_count FROM {t}" for t in DIRTY_VIEWS
            )
        ),
        "load_null_tokens": f"""
            SELECT patient_id,
              CASE WHEN state IN ('', 'NA', 'null', 'None', 'N/A', 'nan', '#N/A', '<NA>', '-1.#IND', 'NULL') THEN NULL ELSE state END AS state,
              CASE WHEN balance NOT IN ('NaN', 'n/a', 'unknown') THEN cast(balance AS DOUBLE) END AS balance
            FROM ({plain(fixtures.TOKEN_CSV)})""",
        "load_malformed": """
            SELECT 't' AS table_name, count(*) FILTER (WHERE k NOT IN (1, 2, 3)) AS loaded_count,
              count(*) FILTER (WHERE k IN (1, 2)) + 2 * count(*) FILTER (WHERE k = 3) AS malformed_count,
              count(*) FILTER (WHERE k = 1) AS surplus_fields,
              count(*) FILTER (WHERE k = 2) + 2 * count(*) FILTER (WHERE k = 3) AS unclosed_quote,
              cast(sum(c_custkey) FILTER (WHERE k NOT IN (1, 2, 3)) AS BIGINT) AS sum_ids,
              count(*) FILTER (WHERE k NOT IN (1, 2, 3, 4)) AS nations, count(*) FILTER (WHERE k = 5) AS quoted
            FROM (SELECT c_custkey, c_custkey % 10 AS k FROM customer)""",
        "load_typed": f"""
            SELECT encounter_id, zip_code,
              CASE WHEN length_of_stay NOT IN ('three', '2.5') THEN cast(replace(length_of_stay, '.0', '') AS INTEGER) END AS length_of_stay,
              try_cast(total_charges_usd AS DOUBLE) AS total_charges_usd,
              CASE is_active WHEN 'True' THEN true WHEN 'False' THEN false END AS is_active
            FROM ({plain(fixtures.TYPED_CSV)})""",
        "gov_dq_results": _with_results(f"SELECT run_id, run_time, {RESULT_COLUMNS} FROM results"),
        "gov_dq_scores": _with_results(f"SELECT run_time, {SCORE_COLUMNS} FROM scores"),
        "dq_runs_append": _runs_append(),
        "dq_run_summary": _with_results(
            "SELECT run_id, cast(count(DISTINCT table_name) AS INTEGER) AS total_tables, "
            "cast(count(*) AS INTEGER) AS total_rules, cast(sum(failed_records) AS BIGINT) AS total_issues "
            "FROM results GROUP BY run_id"
        ),
        "rule_registry": _with_results(
            "SELECT rule_id, table_name, category, severity, description, cast(NULL AS VARCHAR) AS remediation, "
            "true AS is_active, failed_records, status FROM results"
        ),
        "dq_results": _with_results(f"SELECT run_id, {RESULT_COLUMNS} FROM results"),
        "severity_weights": _with_results(
            "SELECT severity, weight, cast(sum(weight) AS BIGINT) AS total_weight, "
            "cast(coalesce(sum(weight) FILTER (WHERE status = 'PASS'), 0) AS BIGINT) AS passed_weight "
            f"FROM (SELECT *, {WEIGHT} AS weight FROM results) GROUP BY severity, weight"
        ),
        "dq_scores": _with_results(f"SELECT {SCORE_COLUMNS} FROM scores"),
        "grade_boundaries": _with_results("SELECT table_name, dq_score, grade FROM scores", BOTH_RULES),
        "total_issues": _with_results("SELECT cast(sum(failed_records) AS BIGINT) AS total_issues FROM results"),
        "dq_results_raw": _with_results(f"SELECT {RESULT_COLUMNS} FROM results", RAW_RULES),
        "dq_results_faulty": _with_results(
            "SELECT table_name, rule_id, total_records, failed_records, pass_rate_pct, status, "
            "rule_id LIKE 'BAD-%' AND rule_id <> 'BAD-004' AS noted FROM results",
            fixtures.FAULTY_RULES,
        ),
        "dq_scores_raw": _with_results(f"SELECT {SCORE_COLUMNS} FROM scores", RAW_RULES),
        "downstream_impact_raw": _with_results("SELECT * FROM impact", RAW_RULES, RAW_REPORTS),
        "profile_all": _with_views(_profile(*DIRTY_VIEWS)),
        "profile_raw": _profile("lineitem", "supplier"),
        "profile_sample": _with_views(_samples(*DIRTY_VIEWS)),
        "profile_approx": _with_views(_approximate(*DIRTY_VIEWS)),
        "profile_sketches": _merged("lineitem", "supplier"),
        "profile_null_rank": _with_views(f"SELECT column_name, null_pct FROM ({_profile('patients')})"),
        "profile_uniqueness_rank": _with_views(
            f"SELECT column_name, uniqueness_pct FROM ({_profile('patients')})"
        ),
        "profile_display": _with_views(
            "SELECT column_name, total_count, null_count, null_pct, unique_count, uniqueness_pct, "
            f"min_value, max_value, mean_value FROM ({_profile('encounters')})"
        ),
        "reconcile": _with_views(_reconciliation(SOURCE_COUNTS)),
        "reconcile_missing_source": _with_views(_reconciliation(PARTIAL_COUNTS)),
        "recon_long": _with_reconciliation(
            "SELECT table_name, 'source_count' AS count_type, source_count AS records FROM {recon} "
            "UNION ALL SELECT table_name, 'loaded_count', loaded_count FROM {recon}"
        ),
        "recon_display": _with_reconciliation(
            "SELECT table_name, source_count, loaded_count, delta, delta_pct, "
            "CASE status WHEN 'MATCH' THEN '✅ MATCH' ELSE '⚠️ MISMATCH' END AS status_label FROM {recon}"
        ),
        "record_flow": _with_reconciliation(
            "SELECT table_name, source_count, loaded_count, "
            "loaded_count * passed_rules // total_rules AS passed_records, "
            "loaded_count - loaded_count * passed_rules // total_rules AS failed_records "
            "FROM {recon} JOIN scores USING (table_name)"
        ),
        "report_registry": _with_results(
            "SELECT report, owner, refresh_cadence, criticality, position, table_name, loaded_count "
            "FROM report_lines JOIN (SELECT DISTINCT table_name, total_records AS loaded_count FROM results) USING (table_name)"
        ),
        "impact_trigger_tables": _with_results("SELECT * FROM triggers", BOTH_RULES),
        "downstream_impact": _with_results("SELECT * FROM impact"),
        "impact_by_report": _with_results(
            "SELECT report, total_issues, criticality, owner, refresh_cadence, affected_tables FROM impact"
        ),
        "impact_by_criticality": _with_results(
            "SELECT criticality, count(*) AS reports FROM impact GROUP BY criticality"
        ),
        "impact_detail": _with_results(
            "SELECT report, owner, criticality, refresh_cadence, affected_tables, total_issues, impact_level FROM impact"
        ),
        "audit_log": _with_results("SELECT * FROM audit"),
        "audit_kpis": _with_results(
            "SELECT count(*) AS total_entries, count(*) FILTER (WHERE NOT resolved) AS unresolved, "
            "count(*) FILTER (WHERE NOT resolved AND severity = 'Critical') AS critical_unresolved FROM audit"
        ),
        "audit_by_table_severity": _with_results(
            "SELECT table_name, severity, count(*) AS entries FROM audit GROUP BY table_name, severity"
        ),
        "audit_by_severity": _with_results(
            "SELECT severity, cast(sum(records_affected) AS BIGINT) AS records_affected FROM audit GROUP BY severity"
        ),
        "audit_detail": _with_results(
            "SELECT log_id, table_name, rule_id, severity, description, records_affected, action_taken, resolved FROM audit"
        ),
        "latest_dq_scores": (
            f"WITH {VIEWS}, results AS ({_results(_history_rows())}), scores AS ({SCORES}) "
            f"SELECT {SCORE_COLUMNS}, run_time FROM (SELECT *, row_number() OVER "
            "(PARTITION BY table_name ORDER BY run_time DESC, run_id DESC) AS place FROM scores) WHERE place = 1"
        ),
        "open_critical_issues": _with_results(
            "SELECT log_id, table_name, rule_id, severity, description, records_affected, action_taken "
            "FROM audit WHERE NOT resolved AND severity IN ('Critical', 'High') "
            f"ORDER BY {RANK}, records_affected DESC"
        ),
        "results_filtered": _with_results(
            f"SELECT {RESULT_COLUMNS} FROM results WHERE table_name IN ({', '.join(map(_text, FILTER_TABLES))}) "
            f"AND severity IN ({', '.join(map(_text, FILTER_SEVERITIES))})"
        ),
        "kpi_cards": _with_results(
            "SELECT r.*, overall_score, open_audit_issues, reports_affected FROM "
            "(SELECT count(DISTINCT table_name) AS tables_scanned, count(*) AS total_rules, "
            "cast(sum(failed_records) AS BIGINT) AS total_issues, "
            "cast(sum(failed_records) FILTER (WHERE severity = 'Critical') AS BIGINT) AS critical_issues, "
            f"{_pct('count(*) FILTER (WHERE failed_records = 0)', 'count(*)', 1)} AS rule_pass_rate FROM results) r, "
            "(SELECT round_even(cast(sum(cast(dq_score AS DECIMAL(6, 1))) AS DOUBLE) / count(*), 1) AS overall_score FROM scores), "
            "(SELECT count(*) AS open_audit_issues FROM audit WHERE NOT resolved), "
            "(SELECT count(*) AS reports_affected FROM impact)"
        ),
        "score_band": _with_results(
            "SELECT table_name, dq_score, grade, CASE WHEN dq_score < 60 THEN '0-60' WHEN dq_score < 80 THEN '60-80' "
            "ELSE '80-100' END AS band FROM scores",
            BOTH_RULES,
        ),
        "rule_summary": _with_results(
            "SELECT c.table_name, count(*) FILTER (WHERE status = 'PASS') AS passed, "
            "count(*) FILTER (WHERE status = 'FAIL') AS failed, dq_score, grade "
            "FROM chosen c JOIN scores s ON c.table_name = s.table_name GROUP BY c.table_name, dq_score, grade"
        ),
        "rule_summary_history": _two_runs(
            "SELECT r.run_id, r.table_name, count(*) FILTER (WHERE status = 'PASS') AS passed, count(*) FILTER (WHERE status = 'FAIL') AS failed, "
            "dq_score, grade FROM results r JOIN scores s ON r.run_id = s.run_id AND r.table_name = s.table_name GROUP BY r.run_id, r.table_name, dq_score, grade"
        ),
        "dq_heatmap_history": _two_runs(
            f"SELECT run_id, table_name, {', '.join(f'{_radar(c)} AS {_quoted(c)}' for c in HEATMAP_CATEGORIES)} FROM results GROUP BY run_id, table_name"
        ),
        "issues_by_category_history": _two_runs(
            "SELECT run_id, category, failed_records, "
            f"{_pct('failed_records', 'total', 1)} AS share_pct FROM "
            "(SELECT run_id, category, cast(sum(failed_records) AS BIGINT) AS failed_records, "
            "cast(sum(sum(failed_records)) OVER (PARTITION BY run_id) AS BIGINT) AS total FROM results WHERE status = 'FAIL' GROUP BY run_id, category)"
        ),
        "kpi_cards_history": _two_runs(
            "SELECT * FROM (SELECT run_id, count(DISTINCT table_name) AS tables_scanned, count(*) AS total_rules, cast(sum(failed_records) AS BIGINT) AS total_issues, "
            "cast(sum(failed_records) FILTER (WHERE severity = 'Critical') AS BIGINT) AS critical_issues, "
            f"{_pct('count(*) FILTER (WHERE failed_records = 0)', 'count(*)', 1)} AS rule_pass_rate, "
            "count(*) FILTER (WHERE status = 'FAIL') AS open_audit_issues FROM results GROUP BY run_id) r "
            "JOIN (SELECT run_id, round_even(cast(sum(cast(dq_score AS DECIMAL(6, 1))) AS DOUBLE) / count(*), 1) AS overall_score FROM scores GROUP BY run_id) USING (run_id) "
            "JOIN (SELECT run_id, count(DISTINCT report) AS reports_affected FROM triggers JOIN report_lines USING (table_name) GROUP BY run_id) USING (run_id)"
        ),
        "audit_by_severity_history": _two_runs(
            "SELECT run_id, severity, cast(sum(failed_records) AS BIGINT) AS records_affected FROM results WHERE status = 'FAIL' GROUP BY run_id, severity"
        ),
        "issues_by_severity": _with_results(
            "SELECT severity, cast(sum(failed_records) AS BIGINT) AS failed_records FROM chosen WHERE status = 'FAIL' GROUP BY severity"
        ),
        "issues_by_category": _with_results(
            "SELECT category, failed_records, "
            f"{_pct('failed_records', '(SELECT cast(sum(failed_records) AS BIGINT) FROM chosen)', 1)} AS share_pct FROM "
            "(SELECT category, cast(sum(failed_records) AS BIGINT) AS failed_records FROM chosen WHERE status = 'FAIL' GROUP BY category)"
        ),
        "failed_rules": _with_results(
            "SELECT rule_id, table_name, category, severity, description, failed_records, pass_rate_pct "
            f"FROM chosen WHERE status = 'FAIL' ORDER BY {RANK}, failed_records DESC"
        ),
        "dq_heatmap": _with_results(
            f"SELECT table_name, {', '.join(f'{_radar(c)} AS {_quoted(c)}' for c in HEATMAP_CATEGORIES)} FROM chosen GROUP BY table_name"
        ),
        "dq_heatmap_raw": f"""SELECT 'orders' AS table_name, {_share("o_orderkey IS NULL")} AS "Completeness",
            100.0::DOUBLE AS "Validity", 100.0::DOUBLE AS "Uniqueness", 100.0::DOUBLE AS "Referential",
            {_share("o_totalprice < 50000")} AS "Consistency",
            {_share("o_orderdate::DATE >= DATE '1998-01-01'")} AS "Timeliness" FROM orders""",
        "gov_history_open_issues": """SELECT 'a/b' AS run_id, 'CUS-002' AS rule_id, count(*)::BIGINT AS records_affected
            FROM customer WHERE c_acctbal < 0 HAVING count(*) > 0""",
        "gov_run_id_text": f"{_stored('007', False)} UNION ALL {_stored('a/b', True)}",
        "gov_replace_runs": _stored("a/b", True),
        "gov_uncommitted_run": f"SELECT *, true AS listed FROM ({_stored('007', False)})",
        "gov_data_profile": (
            f"SELECT p.* EXCLUDE (position), sample_values FROM ({_profile('supplier', 'nation')}) p "
            f"JOIN ({_samples('supplier', 'nation')}) s ON p.table_name = s.table_name AND p.column_name = s.column_name"
        ),
        "gov_reconciliation": _with_views(f"SELECT '2026-01-01 00:00:00' AS run_time, * FROM ({_reconciliation(SOURCE_COUNTS)})"),
        "gov_downstream_impact": _with_results("SELECT '2026-01-01 00:00:00' AS run_time, * FROM impact"),
        "gov_audit_log": _with_results("SELECT *, '2026-01-01 00:00:00' AS event_time FROM audit"),
        "written_results": _with_results(
            "SELECT table_name, rule_id, description, failed_records, status, file FROM results, (VALUES ('csv'), ('parquet')) v(file)", RAW_RULES
        ),
        "empty_results": _with_results(
            f"""SELECT results, derived, columns, CASE WHEN results = 'passed' AND derived = 'scores' THEN scored ELSE 0 END AS n_rows
            FROM (VALUES ('scores', '{DERIVED_COLUMNS["scores"]}'), ('audit', '{DERIVED_COLUMNS["audit"]}'), ('impact', '{DERIVED_COLUMNS["impact"]}')) d(derived, columns),
              (VALUES ('passed'), ('none')) r(results),
              (SELECT count(DISTINCT table_name) AS scored FROM results WHERE status = 'PASS')""",
            RAW_RULES,
            RAW_REPORTS,
        ),
        "issues_by_table_severity": _with_results(
            "SELECT table_name, severity, cast(sum(failed_records) AS BIGINT) AS failed_records "
            "FROM chosen WHERE status = 'FAIL' GROUP BY table_name, severity"
        ),
        "dq_radar": _with_results(
            " UNION ALL ".join(
                f"SELECT table_name, {_text(c)} AS category, {_radar(c)} AS pass_rate FROM chosen GROUP BY table_name"
                for c in CATEGORIES
            )
        ),
    }
    for name, rules in RULE_KINDS.items():
        sql[name] = _with_results(f"SELECT {RULE_COUNTS} FROM results", rules)
    for table in DIRTY_VIEWS:
        rules = [r for r in HEALTHCARE_RULES if r.table_name == table]
        sql[f"dq_results_{table}"] = _with_results(f"SELECT {RESULT_COLUMNS} FROM results", rules)
        sql[f"profile_{table}"] = _with_views(_profile(table))
    return sql


def _quoted(name: str) -> str:
    return '"' + name + '"'
