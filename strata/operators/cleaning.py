"""Row-local cleaning operators (projections only: no shuffle, one codegen
stage).  Each is a single ``withColumns`` so the analyzer sees one Project
instead of a chain of ``withColumn`` calls."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import SIGNUP_DATE_FORMATS, normalize_date_text


def _present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in columns if c in have]


def trim_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Trim surrounding spaces; columns not in the frame are skipped."""
    cols = _present(df, columns)
    return df.withColumns({c: F.trim(F.col(c)) for c in cols}) if cols else df


def standardize_case(df: DataFrame, columns: Iterable[str], case: str = "upper") -> DataFrame:
    """Upper- or lower-case string columns; columns not present are skipped."""
    fn = {"upper": F.upper, "lower": F.lower}.get(case)
    if fn is None:
        raise ValueError(f"case must be 'upper' or 'lower', got {case!r}")
    cols = _present(df, columns)
    return df.withColumns({c: fn(F.col(c)) for c in cols}) if cols else df


def fill_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """coalesce(column, default).  A default of None leaves the column as is
    (the column is required and will be caught by the null check)."""
    cols = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()
            if v is not None and c in df.columns}
    return df.withColumns(cols) if cols else df


def convert_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; a value that does not convert becomes NULL (try_cast)
    instead of failing the whole job under ANSI mode."""
    cols = {c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns}
    return df.withColumns(cols) if cols else df


def drop_all_null(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Drop rows whose (data) columns are all NULL, e.g. blank CSV lines."""
    return df.na.drop(how="all", subset=list(subset) if subset else None)


def normalize_dates(df: DataFrame, column: str = "signup_date",
                    formats=SIGNUP_DATE_FORMATS) -> DataFrame:
    """Day-first text dates -> ISO text; no-op when the column is absent."""
    if column not in df.columns:
        return df
    return df.withColumn(column, normalize_date_text(column, formats))


def drop_if_present(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)
