"""Rules as data, and the healthcare rule set."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vouch.functions.checks import (
    Check,
    at_least,
    date_order,
    in_set,
    matches,
    not_future,
    not_null,
    past_date,
    references,
    unique,
)
from vouch.plans.context import RunContext

# Severities from worst to mildest with their weights, and categories.
SEVERITY_WEIGHTS = {"Critical": 4, "High": 3, "Medium": 2, "Low": 1}
SEVERITY_RANKS = {"Critical": 0, "High": 1, "Medium": 2, "Low": 3}
CATEGORIES = (
    "Completeness",
    "Validity",
    "Uniqueness",
    "Referential",
    "Timeliness",
    "Consistency",
)


@dataclass(frozen=True)
class Rule:
    rule_id: str
    table_name: str
    category: str
    severity: str
    description: str
    check: Check

    def __post_init__(self) -> None:
        if self.category not in CATEGORIES:
            raise ValueError(f"{self.rule_id}: unknown category {self.category!r}")
        if self.severity not in SEVERITY_WEIGHTS:
            raise ValueError(f"{self.rule_id}: unknown severity {self.severity!r}")


# The healthcare rules (id, table, category, severity, description, check).
HEALTHCARE_RULES = [
    Rule("PAT-001", "patients", "Completeness", "Critical", "patient_id must not be null",
         not_null("patient_id")),
    Rule("PAT-002", "patients", "Completeness", "Critical", "date_of_birth must not be null",
         not_null("date_of_birth")),
    Rule("PAT-003", "patients", "Completeness", "High", "gender must not be null",
         not_null("gender")),
    Rule("PAT-004", "patients", "Completeness", "Medium", "state must not be null",
         not_null("state")),
    Rule("PAT-005", "patients", "Validity", "High", "gender must be M, F, or Other",
         in_set("gender", "M", "F", "Other")),
    Rule("PAT-006", "patients", "Validity", "Medium", "zip_code must be 5 digits",
         matches("zip_code", "[0-9]{5}")),
    Rule("PAT-007", "patients", "Uniqueness", "Critical", "patient_id must be unique",
         unique("patient_id")),
    Rule("PAT-008", "patients", "Validity", "High", "date_of_birth must be a valid past date",
         past_date("date_of_birth")),
    Rule("PAT-009", "patients", "Completeness", "Low", "email should be populated",
         not_null("email")),
    Rule("ENC-001", "encounters", "Completeness", "Critical", "encounter_id must not be null",
         not_null("encounter_id")),
    Rule("ENC-002", "encounters", "Completeness", "Critical", "patient_id must not be null",
         not_null("patient_id")),
    Rule("ENC-003", "encounters", "Completeness", "High", "admission_date must not be null",
         not_null("admission_date")),
    Rule("ENC-004", "encounters", "Completeness", "High", "primary_diagnosis must not be null",
         not_null("primary_diagnosis")),
    Rule("ENC-005", "encounters", "Validity", "Critical",
         "discharge_date must not be before admission_date",
         date_order("admission_date", "discharge_date")),
    Rule("ENC-006", "encounters", "Validity", "Critical",
         "discharge_date must not be in the future",
         not_future("discharge_date")),
    Rule("ENC-007", "encounters", "Validity", "High", "total_charges_usd must be positive",
         at_least("total_charges_usd", 0)),
    Rule("ENC-008", "encounters", "Referential", "Critical",
         "patient_id must exist in patients table",
         references("patient_id", "patients", "patient_id")),
    Rule("ENC-009", "encounters", "Uniqueness", "Critical", "encounter_id must be unique",
         unique("encounter_id")),
    Rule("LAB-001", "lab_results", "Completeness", "Critical", "lab_id must not be null",
         not_null("lab_id")),
    Rule("LAB-002", "lab_results", "Completeness", "Critical", "result_value must not be null",
         not_null("result_value")),
    Rule("LAB-003", "lab_results", "Completeness", "Medium", "unit must not be null",
         not_null("unit")),
    Rule("LAB-004", "lab_results", "Validity", "High",
         "result_value must be >= -999 (extreme outlier check)",
         at_least("result_value", -999)),
    Rule("LAB-005", "lab_results", "Validity", "High",
         "result_date must not precede collection_date",
         date_order("collection_date", "result_date")),
    Rule("LAB-006", "lab_results", "Referential", "Critical",
         "patient_id must exist in patients table",
         references("patient_id", "patients", "patient_id")),
    Rule("LAB-007", "lab_results", "Validity", "Medium",
         "status must be Final, Preliminary, Corrected, or Cancelled",
         in_set("status", "Final", "Preliminary", "Corrected", "Cancelled")),
    Rule("MED-001", "medications", "Completeness", "Critical", "med_id must not be null",
         not_null("med_id")),
    Rule("MED-002", "medications", "Completeness", "High", "dose must not be null",
         not_null("dose")),
    Rule("MED-003", "medications", "Completeness", "High", "start_date must not be null",
         not_null("start_date")),
    Rule("MED-004", "medications", "Validity", "High", "end_date must not precede start_date",
         date_order("start_date", "end_date")),
    Rule("MED-005", "medications", "Validity", "Medium", "frequency must be a known value",
         in_set("frequency", "Daily", "BID", "TID", "QID", "Weekly", "PRN", "Monthly")),
]


def rules_for(rules: list[Rule], *table_names: str) -> list[Rule]:
    return [r for r in rules if r.table_name in table_names]


def rule_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """The rules as a frame, in registry order by ``rule_order``."""
    texts = ("rule_id", "table_name", "category", "severity", "description")
    rows = [{"rule_order": i, **{c: getattr(r, c) for c in texts}} for i, r in enumerate(rules)]
    schema = pa.schema([("rule_order", pa.int32())] + [(c, pa.string()) for c in texts])
    # an Arrow table becomes a local relation whose size the planner knows
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))


def registry_frame(spark: SparkSession, rules: list[Rule], ctx: RunContext) -> DataFrame:
    """``dq_rule_registry``."""
    return rule_frame(spark, rules).select(
        "rule_id",
        "table_name",
        "category",
        "severity",
        "description",
        F.lit(None).cast("string").alias("remediation"),
        F.lit(True).alias("is_active"),
        ctx.run_time_column().alias("created_at"),
    )
