"""Run context: one batch id and one clock per run (instead of one per layer).

All audit values are literals taken from here, so a plan never calls
``current_timestamp()`` and a replayed run writes identical rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def _now() -> datetime:
    """UTC, so that no hour occurs twice, to the microsecond."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class RunContext:
    as_of: datetime = field(default_factory=_now)
    batch_id: str = ""
    # Logical table names written by the run (two-level, OSS catalog style).
    tables: dict = field(default_factory=dict)

    def __post_init__(self):
        if not self.batch_id:
            object.__setattr__(
                self, "batch_id",
                f"batch_{self.as_of:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}")

    # Literal columns -------------------------------------------------------
    def ts_lit(self, value: datetime | None = None) -> Column:
        v = value or self.as_of
        return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")

    def date_lit(self) -> Column:
        return F.lit(self.as_of.strftime("%Y-%m-%d")).cast("date")

    def batch_lit(self) -> Column:
        return F.lit(self.batch_id)
