"""Keyed de-duplication with a total order.

``row_number() = 1`` over a key window is what a Spark user writes; Catalyst
turns it into a ``WindowGroupLimit`` that already keeps one row per key on
the map side before the shuffle, so a key holding a third of all rows costs
one row per map task, not a third of the table in one task.

The order is total: the caller's order columns first, then every other
orderable column.  Rows that tie on all of them are identical, so the result
does not depend on how the input was partitioned (unlike ordering on an
``_updated_at`` shared by the whole load).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

DEFAULT_ORDER = ("_updated_at", "_ingestion_date")


def tie_break_columns(df: DataFrame, keys: Sequence[str],
                      order_by: Sequence[str] | None = None,
                      ignore: Sequence[str] = ()) -> list[str]:
    if order_by is None:
        order_by = [c for c in DEFAULT_ORDER if c in df.columns][:1]
    order = [c for c in order_by if c in df.columns]
    orderable = {f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)}
    rest = [c for c in df.columns
            if c not in keys and c not in order and c in orderable and c not in ignore]
    return list(order) + rest


def dedup(df: DataFrame, keys: Sequence[str], keep: str = "first",
          order_by: Sequence[str] | None = None, ignore: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key (NULL keys form one group).

    keep="first": smallest by (order_by, other columns), NULLs first;
    keep="last":  largest, NULLs last.
    ``ignore``: columns left out of the tie-break (e.g. stamps that are
    overwritten right after, so rows differing only there are equivalent).
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', got {keep!r}")
    cols = tie_break_columns(df, keys, order_by, ignore)
    ordering = [F.col(c).asc_nulls_first() if keep == "first" else F.col(c).desc_nulls_last()
                for c in cols]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*ordering)
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1)
              .drop("__rn"))
