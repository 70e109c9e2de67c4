"""Compare the record counts a source reports with those loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouch.functions.frames import union_all
from vouch.functions.numeric import pct
from vouch.plans.context import RunContext


def count_records(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, loaded_count`` of every table."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("loaded_count")).select(
                F.lit(name).alias("table_name"), "loaded_count"
            )
            for name, df in tables.items()
        ],
    )


def reconcile(
    tables: dict[str, DataFrame],
    source_counts: DataFrame,
    ctx: RunContext,
    loaded: DataFrame | None = None,
) -> DataFrame:
    """``reconciliation``: expected against loaded counts per table.

    ``source_counts`` has ``table_name, source_count``; a table it lacks is expected to
    hold what was loaded. A listed table whose count is null, no whole number or given twice
    with different values does not match. ``loaded`` may hand in counts already known.
    """
    counts = count_records(tables) if loaded is None else loaded
    whole = F.col("source_count").try_cast("decimal(38,6)")
    whole = F.when(whole == F.floor(whole), whole).try_cast("bigint")
    agreed = F.when((F.min("n") == F.max("n")) & (F.count("n") == F.count("*")), F.min("n"))
    expected = source_counts.select("table_name", whole.alias("n")).groupBy("table_name")
    expected = expected.agg(agreed.alias("source_count"), F.lit(True).alias("listed"))
    delta = F.col("loaded_count") - F.col("source_count")
    return (
        counts.join(expected, "table_name", "left")
        .withColumn("source_count", F.when(F.col("listed"), F.col("source_count")).otherwise(F.col("loaded_count")))
        .select(
            "table_name",
            "source_count",
            "loaded_count",
            delta.alias("delta"),
            pct(delta, F.col("source_count"), 2).alias("delta_pct"),
            F.when(F.coalesce(delta == 0, F.lit(False)), "MATCH").otherwise("MISMATCH").alias("status"),
            ctx.run_time_column().alias("run_time"),
        )
    )
