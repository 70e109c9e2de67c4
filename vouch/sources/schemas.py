"""Declared types of the healthcare tables and columns of the governance tables."""

from __future__ import annotations

from pyspark.sql import types as T



def _schema(names: str, **typed: T.DataType) -> T.StructType:
    """Text columns of these names, apart from those given a type."""
    return T.StructType([T.StructField(n, typed.get(n, T.StringType())) for n in names.split()])


# The four input tables. Dates stay text; the rules read them.
HEALTHCARE_SCHEMAS = {
    "patients": _schema(
        "patient_id first_name last_name date_of_birth gender race ethnicity state zip_code "
        "phone email insurance_type created_at"
    ),
    "encounters": _schema(
        "encounter_id patient_id encounter_type admission_date discharge_date "
        "primary_diagnosis attending_provider facility_id disposition length_of_stay "
        "total_charges_usd created_at",
        length_of_stay=T.IntegerType(),
        total_charges_usd=T.DoubleType(),
    ),
    "lab_results": _schema(
        "lab_id patient_id test_name result_value unit reference_low reference_high "
        "is_abnormal collection_date result_date ordering_provider status created_at",
        result_value=T.DoubleType(),
        reference_low=T.DoubleType(),
        reference_high=T.DoubleType(),
        is_abnormal=T.BooleanType(),
    ),
    "medications": _schema(
        "med_id patient_id brand_name generic_name indication dose route frequency start_date "
        "end_date prescriber_id is_active created_at",
        is_active=T.BooleanType(),
    ),
}

# The governance tables and the columns loaded into each.
GOVERNANCE_COLUMNS = {
    "dq_results": (
        "run_id", "run_time", "table_name", "rule_id", "category", "severity", "description",
        "total_records", "failed_records", "passed_records", "pass_rate_pct", "status",
    ),
    "dq_scores": (
        "run_time", "table_name", "total_rules", "passed_rules", "failed_rules", "dq_score",
        "grade",
    ),
    "data_profile": (
        "table_name", "column_name", "total_count", "null_count", "null_pct", "unique_count",
        "uniqueness_pct", "is_numeric", "min_value", "max_value", "mean_value",
        "sample_values",
    ),
    "reconciliation": (
        "run_time", "table_name", "source_count", "loaded_count", "delta", "delta_pct",
        "status",
    ),
    "downstream_impact": (
        "run_time", "report", "owner", "refresh_cadence", "criticality", "affected_tables",
        "total_issues", "impact_level",
    ),
    "audit_log": (
        "log_id", "event_time", "table_name", "rule_id", "event_type", "severity",
        "description", "records_affected", "action_taken", "resolved",
    ),
}

# Columns of the governance tables that no run fills, as SQL defaults.
GOVERNANCE_DEFAULTS = {
    "reconciliation": {"notes": "cast(NULL AS string)"},
    "downstream_impact": {"notified": "false"},
    "audit_log": {
        "resolved_by": "cast(NULL AS string)",
        "resolved_at": "cast(NULL AS timestamp)",
    },
}
