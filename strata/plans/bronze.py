"""CSV landing folder -> bronze table, each file exactly once.

A bronze table is partitioned by (day of the load, batch).  A batch's files
are written to a folder that follows from these two alone, and nothing reads
the folder before the catalog knows it:

1. discover new files (listing anti-joined with the ledger);
2. one typed scan of at most ``max_files`` of them -> drop blank rows ->
   audit stamp with the per-row source path -> schema check (FAIL stops the
   run) -> the batch's folder.  Row counts, per-file counts and the watermark
   are observed by this write; bronze is not read again;
3. ledger rows for every listed file (0 rows for an empty file), as one file:
   **the commit**;
4. the batch becomes a partition, and its load-audit row (watermark) is
   appended.

A crash before 3 leaves a folder that no reader sees and no ledger row: the
next run ingests the files as a batch of its own, and bronze holds them once.
A crash after 3 leaves 4 to be done, which every run does first for all
batches in the ledger (:func:`finish_committed`).  So a file is neither lost
nor repeated, wherever a run ends.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..context import RunContext
from ..operators import cleaning, qc
from ..operators.audit import add_bronze_audit
from ..schemas import ENTITY_SCHEMAS, LOAD_AUDIT, PROCESSED_FILES, bronze_schema
from ..sinks import tables
from ..sources import files
from ..specs import TABLES

#: Partition columns of a bronze table.  A row's ``_record_ingestion_ts``
#: lies on its ``_ingestion_date``.
DATE_COL, BATCH_COL = "_ingestion_date", "_batch_id"
#: Files of one batch: their paths reach the driver, as a reader needs them.
MAX_FILES = 10_000


@dataclass
class IngestResult:
    entity: str
    files: list
    rows: int
    schema_check: list
    row_count_check: list


@dataclass
class Loaded:
    """A batch whose files are written but not committed."""
    ctx: RunContext
    rows: int
    log_ts: datetime | None
    file_rows: dict[str, int]


def scan_new(spark: SparkSession, ctx: RunContext, entity: str, paths: list[str]) -> DataFrame:
    schema = ENTITY_SCHEMAS[entity]
    df = files.read_csv(spark, paths, schema)
    df = cleaning.drop_all_null(df, subset=schema.fieldNames())
    df = add_bronze_audit(df, ctx, record_ingestion_ts=ctx.as_of, source_file=F.col("_source_path"))
    return cleaning.normalize_dates(df.drop("_source_path"), "signup_date")


def _partition(ctx: RunContext) -> dict:
    return {DATE_COL: ctx.as_of.strftime("%Y-%m-%d"), BATCH_COL: ctx.batch_id}


def observed_files(n: int):
    """An aggregate that counts rows by file while they are written.  It is a
    frequent-items sketch with twice the room that ``n`` files need, and such
    a sketch is exact as long as nothing has to be dropped."""
    return F.expr(f"approx_top_k(_source_file, {n}, {2 * max(n, 8)})")


def write_batch(df: DataFrame, target: str, ctx: RunContext, n_files: int) -> Loaded:
    """Write a scanned batch to its folder in one pass, without a commit."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.max("_record_ingestion_ts").alias("log_ts"),
                         observed_files(n_files).alias("files"))
    tables.write_batch(counted, target, _partition(ctx))
    got = seen.get
    return Loaded(ctx, got["rows"], got["log_ts"], {r["item"]: r["count"] for r in got["files"] or ()})


def commit(spark: SparkSession, loaded: Loaded, paths: list[str], ledger: str, label: str) -> None:
    """The ledger rows of a written batch: from the listing, so that a file
    without rows is recorded as well."""
    ctx = loaded.ctx
    rows = [(p, ctx.batch_id, loaded.file_rows.get(p, 0), ctx.as_of, label) for p in paths]
    # One file: the ledger has all rows of the batch or none.
    tables.append(spark.createDataFrame(rows, PROCESSED_FILES).coalesce(1), ledger, tag=ctx.batch_id)


def show(spark: SparkSession, target: str, audit: str, label: str, ctx: RunContext, rows: int, logged: bool = False) -> None:
    """What follows the commit: the partition, then the audit row (none for a
    batch without rows)."""
    values = _partition(ctx)
    tables.add_partition(spark, target, values, tables.batch_path(spark, target, values))
    if rows and not logged:
        log = [(ctx.batch_id, label, ctx.as_of, ctx.as_of, ctx.as_of)]
        tables.append(spark.createDataFrame(log, LOAD_AUDIT).coalesce(1), audit, tag=ctx.batch_id)


def finish_committed(spark: SparkSession, target: str, ledger: str, audit: str, label: str) -> list[str]:
    """Show the batches of ``label`` that are in the ledger but not in the
    catalog or the audit log: those of runs that ended between the two.
    Returns their ids; only these reach the driver."""
    if not (tables.exists(spark, target) and tables.exists(spark, ledger)):
        return []
    done = (tables.read(spark, ledger).filter(F.col("table_name") == label).groupBy("batch_id")
                  .agg(F.max("processed_at").alias("as_of"), F.sum("row_count").alias("n")))
    shown = tables.partitions(spark, target).select(F.col(BATCH_COL).alias("batch_id"), F.lit(True).alias("shown")).distinct()
    left = done.join(shown, "batch_id", "left")
    logged = F.lit(None).cast("boolean")
    if tables.exists(spark, audit):
        log = tables.read(spark, audit).filter(F.col("table_name") == label)
        left = left.join(log.select("batch_id", F.lit(True).alias("logged")).distinct(), "batch_id", "left")
        logged = F.col("logged")
    late = left.withColumn("logged", logged).filter("shown is null or (logged is null and n > 0)").collect()
    for r in late:
        show(spark, target, audit, label, RunContext(as_of=r.as_of, batch_id=r.batch_id), r.n, bool(r.logged))
    return [r.batch_id for r in late]


def _free_ids(spark: SparkSession, ctx: RunContext, ledger: str, label: str):
    """Batch ids that the ledger doesn't have yet: the run's, then numbered
    ones."""
    n = 0
    if tables.exists(spark, ledger):
        own = (F.col("batch_id") == ctx.batch_id) | F.col("batch_id").startswith(ctx.batch_id + ".")
        n = tables.read(spark, ledger).filter((F.col("table_name") == label) & own).agg(F.count_distinct("batch_id")).first()[0]
    while True:
        yield f"{ctx.batch_id}.{n}" if n else ctx.batch_id
        n += 1


def create_bronze(spark: SparkSession, target: str, entity: str) -> None:
    tables.create_empty(spark, target, bronze_schema(entity), [DATE_COL, BATCH_COL])


def _batches(found: DataFrame, max_files: int):
    """Lists of at most ``max_files`` new paths, in order."""
    paths = found.select("path")
    first = [r.path for r in paths.orderBy("path").limit(max_files + 1).collect()]
    if len(first) <= max_files:
        if first:
            yield first
        return
    rest = tables.materialize(paths, "new-files")  # one listing for all batches
    batch = first[:max_files]
    while batch:
        yield batch
        batch = [r.path for r in rest.filter(F.col("path") > batch[-1]).orderBy("path").limit(max_files).collect()]


def ingest_csv_to_bronze(spark: SparkSession, ctx: RunContext, entity: str, landing: str,
                         target: str | None = None, ledger: str | None = None,
                         audit: str | None = None, keyword: str | None = None,
                         label: str | None = None, max_files: int = MAX_FILES,
                         archive_dir: str | None = None, suffix: str = ".csv") -> IngestResult | None:
    """``label``: logical table name used in check results, ledger and audit
    rows (defaults to ``target``).  ``suffix``: of the files' names, e.g.
    ``.csv.gz``.  ``archive_dir`` (outside ``landing``)
    takes files that are committed, so that listing the landing folder stays
    as cheap as its new files are few.  None if no file is new."""
    target = target or TABLES["bronze"][entity]
    label = label or target
    ledger = ledger or TABLES["processed_files"]
    audit = audit or TABLES["load_audit"]
    finish_committed(spark, target, ledger, audit, label)
    led = tables.read(spark, ledger) if tables.exists(spark, ledger) else None
    def found():
        return files.match_entity(files.list_files(spark, landing), keyword or entity, suffix)
    if archive_dir and led is not None:  # of runs that ended before they moved them
        for paths in _batches(files.committed_files(found(), led), max_files):
            files.archive(spark, paths, archive_dir)
    new = files.new_files(found(), led)
    ids = _free_ids(spark, ctx, ledger, label)
    result = None
    for paths in _batches(new, max_files):
        own = replace(ctx, batch_id=next(ids))
        df = scan_new(spark, own, entity, paths)
        checked = [r.asDict() for r in qc.check_schema(df, label, bronze_schema(entity)).collect()]
        if checked[0]["status"] == "FAIL":
            raise qc.QCFailure(checked)
        create_bronze(spark, target, entity)
        loaded = write_batch(df, target, own, len(paths))
        commit(spark, loaded, paths, ledger, label)
        show(spark, target, audit, label, own, loaded.rows)
        if archive_dir:
            files.archive(spark, paths, archive_dir)
        result = result or IngestResult(entity, [], 0, checked, [])
        result.files += paths
        result.rows += loaded.rows
    if result:
        # Reported, not gated (the write has already committed).
        counted = qc.row_count_result(spark, result.rows, label)
        result.row_count_check = [r.asDict() for r in counted.collect()]
    return result
