from __future__ import annotations

from vouch.plans.rules import HEALTHCARE_RULES

RESULT_SCHEMA = (
    "run_id string, run_time timestamp, table_name string, rule_id string, category string, "
    "severity string, description string, total_records bigint, failed_records bigint, "
    "passed_records bigint, pass_rate_pct double, status string"
)

# Rules that pass on the healthcare data the rule set was made for; the others fail.
PASSING = {
    "PAT-001", "PAT-007", "ENC-001", "ENC-002", "ENC-005", "ENC-009",
    "LAB-001", "LAB-005", "LAB-007", "MED-001", "MED-005",
}


def results_frame(spark, ctx, passing=PASSING, rules=HEALTHCARE_RULES, failed=10, total=100):
    rows = [
        (
            ctx.run_id, ctx.run_time, r.table_name, r.rule_id, r.category, r.severity, r.description,
            total, 0 if r.rule_id in passing else failed, total if r.rule_id in passing else total - failed,
            100.0, "PASS" if r.rule_id in passing else "FAIL",
        )
        for r in rules
    ]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def as_set(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.collect()}
