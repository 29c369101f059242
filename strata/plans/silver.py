"""Bronze -> silver transform for one entity, compiled from its EntitySpec.

trim -> case -> defaults are one projection; dedup is one shuffle on the
dedup keys, or none where the rows are gathered by them first
(``sinks.gathered``).  The audit stamp is re-applied and the file lineage
column is dropped (silver rows can merge several files)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import RunContext
from ..operators import cleaning
from ..operators.audit import AUDIT_ONLY, add_audit
from ..operators.dedup import dedup
from ..operators.upsert import merge_update_all
from ..sinks import tables
from ..sinks.gathered import Gather
from ..specs import EntitySpec

# Batch ids of streams begin so.
STREAM_PREFIX = "stream_"

# Load order: the bronze load's ingestion time, then the other columns.
DEDUP_ORDER = ("_record_ingestion_ts",)


def clean(df: DataFrame, spec: EntitySpec) -> DataFrame:
    df = cleaning.trim_columns(df, spec.trim)
    df = cleaning.standardize_case(df, spec.upper, "upper")
    return cleaning.fill_nulls(df, spec.defaults)


def unstamped(bronze: DataFrame, spec: EntitySpec, gather: Gather | None = None) -> DataFrame:
    """The silver rows without the stamps that all rows of a batch share."""
    df = clean(bronze.drop(*AUDIT_ONLY), spec)
    # Audit stamps are re-stamped later, so they do not decide between rows.
    def one_each(rows):
        return dedup(rows, list(spec.dedup_keys), keep=spec.keep, order_by=list(DEDUP_ORDER))
    near, spread = gather(df, list(spec.dedup_keys)) if gather else (df, None)
    return one_each(near) if spread is None else one_each(near).unionByName(one_each(spread))


def stamped(rows: DataFrame, bronze: DataFrame, ctx: RunContext) -> DataFrame:
    """``rows`` with the silver stamp, in bronze's order of columns."""
    df = add_audit(rows, ctx)
    first = [c for c in bronze.columns if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def to_silver(bronze: DataFrame, spec: EntitySpec, ctx: RunContext) -> DataFrame:
    return stamped(unstamped(bronze, spec), bronze, ctx)


def write_first(bronze: DataFrame, spec: EntitySpec, target: str, ctx: RunContext, gather: Gather | None, watch) -> tuple[str, DataFrame]:
    """The first batch of a silver table, written once: the folder and the
    rows of a snapshot that no reader sees before :func:`show_first`.  Rows
    are dealt to the table's partitions without the stamps."""
    rows = unstamped(bronze, spec, gather)
    part = []
    if spec.partition:
        col, expr = spec.partition
        rows, part = rows.withColumn(col, F.expr(expr)), [col]

    def stamp(dealt):
        df = stamped(dealt, bronze, ctx)
        return df.select(*[c for c in df.columns if c not in part], *part)
    path, schema = tables.write_snapshot(rows, target, ctx.batch_id, part, watch=watch, stamp=stamp)
    return path, bronze.sparkSession.read.schema(schema).parquet(path)


def show_first(spark: SparkSession, target: str, spec: EntitySpec, path: str, written: DataFrame) -> None:
    tables.show_snapshot(spark, target, path, written.schema, [spec.partition[0]] if spec.partition else [])


def write_silver(staged: DataFrame, spec: EntitySpec, target: str, ctx: RunContext,
                 replayed: Column | None = None) -> None:
    """Merge a staged batch into its silver table: the one write path of the
    scheduled job and the stream.  ``replayed`` tells the target's rows that
    an earlier attempt of this batch left (see ``operators.upsert``), so a
    replay changes nothing but its audit stamps, rows with NULL keys
    included."""
    spark = staged.sparkSession
    keys = list(spec.merge_keys)
    if spec.partition:
        col, expr = spec.partition
        tables.merge_partitioned(staged.withColumn(col, F.expr(expr)), target, keys, col, check_unique=True, replayed=replayed)
    elif tables.exists(spark, target):
        tables.publish(merge_update_all(tables.read(spark, target), staged, keys, replayed=replayed), target, tag=ctx.batch_id)
    else:
        tables.publish(staged, target, tag=ctx.batch_id)
