"""High-watermark incremental reads and the load-audit (watermark) log.

The watermark of a target table is ``max(log_ts)`` of its audit rows
(default 1900-01-01).  A read takes source rows with an ingestion timestamp
strictly greater than it (NULL timestamps are never selected).

``resolve=True`` evaluates the one-row watermark first and filters with a
literal: the predicate then reaches the Parquet reader (row-group skipping).
``resolve=False`` keeps it as an uncorrelated scalar subquery (fully lazy,
but only ``IsNotNull`` is pushed to the scan).

A bronze table is partitioned by the day of its loads, and a row's ingestion
time lies on that day.  Given that ``date_col``, the read also asks for days
from the watermark's on, so it lists and opens the folders of later loads
only, however long the history is.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..schemas import LOAD_AUDIT

DEFAULT_WATERMARK = "1900-01-01 00:00:00"
TS_COL = "_record_ingestion_ts"


def watermark_frame(audit: DataFrame, table_name: str) -> DataFrame:
    return (audit.filter(F.col("table_name") == table_name)
                 .agg(F.coalesce(F.max("log_ts"),
                                 F.lit(DEFAULT_WATERMARK).cast("timestamp_ntz")).alias("wm")))


def watermark(audit: DataFrame, table_name: str, resolve: bool = True) -> Column:
    wf = watermark_frame(audit, table_name)
    if resolve:
        v = wf.collect()[0]["wm"]
        return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return wf.select("wm").scalar()


def after(wm: Column, ts_col: str = TS_COL, date_col: str | None = None) -> Column:
    """The predicate of rows beyond a watermark, with that of their days."""
    later = F.col(ts_col) > wm
    return later & (F.col(date_col) >= wm.cast("date")) if date_col else later


def incremental_read(source: DataFrame, audit: DataFrame | None, table_name: str,
                     ts_col: str = TS_COL, resolve: bool = True, date_col: str | None = None) -> DataFrame:
    """Rows of ``source`` newer than the target's watermark.  With no audit
    log at all (first run) the whole source is read.  ``date_col``: the
    source's partition column that holds the day of ``ts_col``."""
    if audit is None:
        return source
    return source.filter(after(watermark(audit, table_name, resolve), ts_col, date_col))


def newer_than_target(source: DataFrame, target: DataFrame, ts_col: str = TS_COL) -> DataFrame:
    """Alternative watermark: the target's own max ingestion timestamp."""
    wm = target.agg(F.max(ts_col).alias("__wm")).select("__wm").scalar()
    return source.filter(F.col(ts_col) > wm)


def audit_row(batch: DataFrame, ctx: RunContext, table_name: str,
              start_time: datetime | Column | None = None,
              end_time: datetime | Column | None = None,
              ts_col: str = TS_COL) -> DataFrame:
    """The audit row of a processed batch: log_ts = max ingestion ts of the
    (deduplicated) batch.  An empty batch yields no row, so its run is not
    logged and the watermark does not move."""
    def ts(v):
        if v is None:
            return ctx.ts_lit()
        return v if isinstance(v, Column) else ctx.ts_lit(v)
    # start/end may be expressions of log_ts and _rows (rows in the batch).
    a = (batch.agg(F.max(ts_col).alias("log_ts"), F.count(F.lit(1)).alias("_rows"))
              .filter(F.col("log_ts").isNotNull()))
    return a.select(ctx.batch_lit().alias("batch_id"), F.lit(table_name).alias("table_name"),
                    F.col("log_ts").cast("timestamp_ntz").alias("log_ts"),
                    ts(start_time).alias("start_time"), ts(end_time).alias("end_time"))


def last_watermarks(audit: DataFrame) -> DataFrame:
    return audit.groupBy("table_name").agg(F.max("log_ts").alias("last_processed_ts"))


def history(audit: DataFrame) -> DataFrame:
    return (audit.select("table_name", "batch_id", "log_ts", "start_time", "end_time",
                         F.expr("timestampdiff(SECOND, start_time, end_time)").alias("processing_seconds"))
                 .orderBy(F.col("log_ts").desc(), "table_name", "batch_id"))


def pending_count(source: DataFrame, audit: DataFrame, table_name: str,
                  ts_col: str = TS_COL) -> DataFrame:
    """How many rows the next run of ``table_name`` would take (lazy)."""
    wm = watermark(audit, table_name, resolve=False)
    return (source.filter(F.col(ts_col) > wm)
                  .agg(F.count(F.lit(1)).alias("new_records"))
                  .select(F.lit(table_name).alias("table_name"), "new_records"))


def empty_audit(spark) -> DataFrame:
    return spark.createDataFrame([], LOAD_AUDIT)
