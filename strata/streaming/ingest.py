"""Exactly-once file ingestion with Structured Streaming.

The file source's checkpoint records which files were taken, so it replaces
the hand-kept ledger: each run (``trigger(availableNow=True)``) processes
exactly the files that landed since the last run and then stops.  Each
micro-batch is cleaned, de-duplicated, staged once, checked and merged into
the silver table in ``foreachBatch``, by the scheduled job's own merge.  The
target records the last epoch of each stream (its checkpoint); a replayed
epoch that is recorded writes nothing, and one that failed before is merged
again: rows with a key by their key, rows with a NULL key by the epoch's batch
id.  An equal row of another epoch is another row.  File names match an entity
in any case, as in batch discovery.

Late data needs no event-time watermark here: a late file simply arrives
with a later ingestion time, is merged into silver, and the marts are
recomputed from silver.
"""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import RunContext
from ..operators import cleaning, qc
from ..operators.audit import add_bronze_audit
from ..operators.incremental import audit_row
from ..plans.silver import STREAM_PREFIX, to_silver, write_silver
from ..schemas import ENTITY_SCHEMAS
from ..sinks import tables
from ..sources.files import CSV_READ, source_path
from ..specs import ENTITIES


def any_case(glob: str) -> str:
    """The glob with each letter in either case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() and c.lower() != c.upper() else c for c in glob)


def file_stream(spark: SparkSession, landing: str, entity: str, keyword: str | None = None,
                max_files_per_trigger: int | None = None,
                archive_dir: str | None = None) -> DataFrame:
    """``max_files_per_trigger`` bounds a micro-batch; ``archive_dir`` moves
    committed files out of the landing folder (``cleanSource=archive``) so
    the listing each trigger does stays proportional to the new files."""
    r = (spark.readStream.schema(ENTITY_SCHEMAS[entity]).options(**CSV_READ)
              .option("pathGlobFilter", any_case(f"*{keyword or entity}*.csv")))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return r.csv(landing).withColumn("_source_path", source_path())


def upsert_batch(batch: DataFrame, entity: str, target: str, ctx: RunContext, gate: bool = False,
                 audit: str | None = None) -> None:
    """Clean, stage once, check, merge, log: the scheduled job's silver step
    on one micro-batch.  ``gate`` stops the merge (and the stream) on a failed
    check; ``audit`` is the load-audit table.  ``ctx.batch_id`` must be the
    micro-batch's own, and the same when it is replayed."""
    spec = ENTITIES[entity]
    b = cleaning.drop_all_null(batch, subset=ENTITY_SCHEMAS[entity].fieldNames())
    b = add_bronze_audit(b, ctx, record_ingestion_ts=ctx.as_of, source_file=F.col("_source_path"))
    s = to_silver(cleaning.normalize_dates(b.drop("_source_path"), "signup_date"), spec, ctx)
    watch = qc.Watch(spec.silver_table, spec.qc, gate) if gate else None
    # Without a check, a log or rows to merge with, the one write reads the batch.
    once = not (gate or audit or tables.exists(batch.sparkSession, target))
    staged = s if once else tables.materialize(s, f"stream-{entity}", watch)
    if watch:
        watch.check(staged)
    write_silver(staged, spec, target, ctx, F.col("_batch_id") == ctx.batch_id)
    if audit:
        tables.append(audit_row(staged, ctx, spec.silver_table), audit, tag=ctx.batch_id)


def upsert_epoch(batch: DataFrame, epoch_id: int, checkpoint: str, entity: str, target: str,
                 gate: bool = False, audit: str | None = None, **clock) -> bool:
    """One epoch of the stream of ``checkpoint``; False if the target has it."""
    spark = batch.sparkSession
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    done = tables.last_commit(spark, target, f"stream-{stream}")
    if done is not None and epoch_id <= int(done):
        return False
    ctx = RunContext(batch_id=f"{STREAM_PREFIX}{entity}_{stream}_{epoch_id}", **clock)
    upsert_batch(batch, entity, target, ctx, gate=gate, audit=audit)
    tables.record_commit(spark, target, f"stream-{stream}", epoch_id)
    return True


def run_available(spark: SparkSession, landing: str, entity: str, target: str, checkpoint: str,
                  as_of: datetime | None = None, max_files_per_trigger: int | None = None,
                  archive_dir: str | None = None, gate: bool = False, audit: str | None = None) -> int:
    """Process every file that landed since the last run, then stop.
    Returns the number of micro-batches run."""
    epochs = []

    def each(batch: DataFrame, epoch_id: int):
        clock = {"as_of": as_of} if as_of else {}
        epochs.append(upsert_epoch(batch, epoch_id, checkpoint, entity, target, gate=gate, audit=audit, **clock))

    q = (file_stream(spark, landing, entity, max_files_per_trigger=max_files_per_trigger,
                     archive_dir=archive_dir)
         .writeStream.foreachBatch(each)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(epochs)
