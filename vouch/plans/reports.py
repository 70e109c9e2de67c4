"""Reports that read the governed tables."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Report:
    report: str
    tables: tuple[str, ...]
    owner: str
    refresh_cadence: str
    criticality: str


# The healthcare reports (name, tables in order, owner, refresh, criticality).
HEALTHCARE_REPORTS = [
    Report("Patient Demographics Report", ("patients",), "Analytics Team", "Daily", "High"),
    Report("Readmission KPI Dashboard", ("encounters", "patients"), "Quality Team", "Daily", "Critical"),
    Report("Lab Trends Dashboard", ("lab_results", "patients"), "Clinical Team", "Weekly", "High"),
    Report("Medication Adherence Report", ("medications", "patients"), "Pharmacy Team", "Monthly", "Medium"),
    Report("Payer Mix Dashboard", ("patients", "encounters"), "Finance Team", "Weekly", "High"),
    Report(
        "Regulatory Compliance Report",
        ("patients", "encounters", "lab_results", "medications"),
        "Compliance",
        "Monthly",
        "Critical",
    ),
    Report(
        "Clinical Quality Measures",
        ("lab_results", "medications", "encounters"),
        "Quality Team",
        "Daily",
        "Critical",
    ),
]


def report_frame(spark: SparkSession, reports: list[Report]) -> DataFrame:
    """The reports as a frame, in list order by ``report_order``."""
    rows = [
        {
            "report_order": i,
            "report": r.report,
            "tables": list(r.tables),
            "owner": r.owner,
            "refresh_cadence": r.refresh_cadence,
            "criticality": r.criticality,
        }
        for i, r in enumerate(reports)
    ]
    schema = pa.schema(
        [
            ("report_order", pa.int32()),
            ("report", pa.string()),
            ("tables", pa.list_(pa.string())),
            ("owner", pa.string()),
            ("refresh_cadence", pa.string()),
            ("criticality", pa.string()),
        ]
    )
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))
