from __future__ import annotations

from vouch.operators.reconcile import count_records, reconcile


def frames(spark, **sizes):
    return {name: spark.range(size) for name, size in sizes.items()}


def expected(spark, rows):
    return spark.createDataFrame(rows, "table_name string, source_count bigint")


def test_counts_deltas_and_status(spark, ctx):
    tables = frames(spark, patients=805, encounters=10, lab_results=90, medications=7, empty=0)
    sent = expected(spark, [("patients", 800), ("encounters", 0), ("lab_results", 100), ("empty", 0), ("other", 5)])
    rows = {r.table_name: r for r in reconcile(tables, sent, ctx).collect()}
    got = {k: (r.source_count, r.loaded_count, r.delta, r.delta_pct, r.status) for k, r in rows.items()}
    assert got == {
        "patients": (800, 805, 5, 0.62, "MISMATCH"),
        "encounters": (0, 10, 10, 0.0, "MISMATCH"),
        "lab_results": (100, 90, -10, -10.0, "MISMATCH"),
        "medications": (7, 7, 0, 0.0, "MATCH"),
        "empty": (0, 0, 0, 0.0, "MATCH"),
    }


def test_known_counts_save_the_scan(spark, ctx):
    tables = frames(spark, patients=3)
    loaded = count_records(tables)
    sent = expected(spark, [("patients", 3)])
    assert reconcile({}, sent, ctx, loaded).first().status == "MATCH"
