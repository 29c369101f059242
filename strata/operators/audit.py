"""Audit columns, stamped from the RunContext (literals, not clock calls)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext


def add_bronze_audit(df: DataFrame, ctx: RunContext,
                     record_ingestion_ts: datetime | Column | None = None,
                     source_file: str | Column | None = None) -> DataFrame:
    """Bronze stamp: ingestion date, batch id, update time, the load's
    ingestion timestamp (the watermark column) and optionally the source file.

    ``source_file`` may be a Column such as ``_metadata.file_name`` so that
    one multi-file scan keeps per-row lineage."""
    if record_ingestion_ts is None:
        rit = ctx.ts_lit()
    elif isinstance(record_ingestion_ts, Column):
        rit = record_ingestion_ts.cast("timestamp_ntz")
    else:
        rit = ctx.ts_lit(record_ingestion_ts)
    cols = {
        "_ingestion_date": ctx.date_lit(),
        "_batch_id": ctx.batch_lit(),
        "_updated_at": ctx.ts_lit(),
        "_record_ingestion_ts": rit,
    }
    if source_file is not None:
        cols["_source_file"] = source_file if isinstance(source_file, Column) else F.lit(source_file)
    return df.withColumns(cols)


def add_audit(df: DataFrame, ctx: RunContext, source_file: str | None = None) -> DataFrame:
    """Silver/gold stamp: re-stamps ingestion date, batch id and update time;
    keeps ``_record_ingestion_ts`` as it came from bronze."""
    cols = {"_ingestion_date": ctx.date_lit(), "_batch_id": ctx.batch_lit(),
            "_updated_at": ctx.ts_lit()}
    if source_file is not None:
        cols["_source_file"] = F.lit(source_file)
    return df.withColumns(cols)


AUDIT_ONLY = ("_ingestion_date", "_batch_id", "_updated_at", "_source_file")


def strip_audit(df: DataFrame, keep_ingestion_ts: bool = True) -> DataFrame:
    drop = list(AUDIT_ONLY) + ([] if keep_ingestion_ts else ["_record_ingestion_ts"])
    return df.drop(*drop)
