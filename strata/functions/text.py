"""Text rendering of numbers for QC messages.

Percentages are rendered from the integer counts (half-up to 0.01 %), so the
text is exact and does not depend on floating-point formatting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def int_div(a: Column, b: Column) -> Column:
    """Exact floor division of non-negative BIGINTs (no double rounding)."""
    return F.floor(a.cast("decimal(38,0)") / b.cast("decimal(38,0)")).cast("long")


def pct_text(part, whole) -> Column:
    """``part / whole`` as ``12.34%`` (half-up); ``0.00%`` when whole is 0."""
    p, w = _c(part).cast("long"), _c(whole).cast("long")
    hundredths = F.when(w > 0, int_div(p * 20000 + w, w * 2)).otherwise(F.lit(0).cast("long"))
    whole_pct = int_div(hundredths, F.lit(100).cast("long"))
    frac = hundredths - whole_pct * 100
    return F.concat(whole_pct.cast("string"), F.lit("."),
                    F.lpad(frac.cast("string"), 2, "0"), F.lit("%"))


def ratio(part, whole) -> Column:
    """part / whole as DOUBLE, 0.0 when whole is 0 (reference convention)."""
    p, w = _c(part), _c(whole)
    return F.when(w > 0, p.cast("double") / w.cast("double")).otherwise(F.lit(0.0))


def py_pct(x: float) -> str:
    """Driver-side rendering of a configured threshold (a literal)."""
    return f"{x:.2%}"


def num_text(v) -> str:
    """Driver-side rendering of a configured bound, as the user wrote it."""
    return str(v)
