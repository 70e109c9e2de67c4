"""Identity and clock of one run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_FORMAT = "%Y-%m-%d %H:%M:%S"


@dataclass(frozen=True)
class RunContext:
    """``as_of`` is the "now" of the date rules; it defaults to ``run_time``.

    The default run id has a grain of one second, so give ``name`` where two runs may
    start within one.
    """

    run_time: datetime
    as_of: datetime | None = None
    name: str | None = None

    @classmethod
    def now(cls) -> RunContext:
        return cls(datetime.now())

    @property
    def run_id(self) -> str:
        return self.name or self.run_time.strftime("RUN_%Y%m%d_%H%M%S")

    def run_time_column(self) -> Column:
        return F.lit(self.run_time.strftime(TIME_FORMAT)).cast("timestamp")

    def as_of_column(self) -> Column:
        as_of = self.as_of or self.run_time
        return F.lit(as_of.strftime(TIME_FORMAT + ".%f")).cast("timestamp_ntz")
