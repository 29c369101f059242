"""Date parsing helpers (built-in expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two day-first formats accepted for sign-up dates,
# tried in this order.
SIGNUP_DATE_FORMATS = ("dd/MM/yyyy", "dd/MM/yy")


def parse_multi_format_date(c, formats=SIGNUP_DATE_FORMATS) -> Column:
    """First format that parses wins; anything else (including impossible
    dates such as 31/02) becomes NULL instead of failing the job."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(*[F.try_to_date(col, f) for f in formats])


def normalize_date_text(c, formats=SIGNUP_DATE_FORMATS) -> Column:
    """Day-first text date -> ISO ``yyyy-MM-dd`` text (NULL if unparseable)."""
    return parse_multi_format_date(c, formats).cast("string")
