"""vouch: data quality and governance for Spark DataFrames."""

from vouch.plans.context import RunContext
from vouch.plans.run import run_all, write_governance

__all__ = ["RunContext", "run_all", "write_governance"]
