"""The scheduled job: landing files -> bronze -> silver -> gold -> validation.

Each layer reads the previous layer's tables, so a layer can be re-run on
its own after a failure (the job is a chain of restartable steps), and state
crosses steps only through tables in the shared storage.

silver, per entity (dimensions first, then transactions, whose foreign-key
checks read the silver dimensions):
  watermark read of new bronze rows (days from the watermark's on) -> clean
  -> dedup -> stage once (the first batch as the table's snapshot), observing
  the row-level checks -> QC gate (these, one duplicate aggregate, FK anti
  joins) -> show the snapshot or MERGE (anti join + union, new snapshot)
  -> audit row.
An empty batch is a no-op: nothing is checked, written or logged.

gold: four marts from the silver tables -> snapshot, observing the checks ->
QC gate -> publish.  The daily mart's files hold ascending ranges of days.
validation: all layer suites -> appended to the results table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import RunContext
from ..operators import gold, qc
from ..operators import incremental as inc
from ..operators.audit import add_audit
from ..schemas import LOAD_AUDIT, QC_RESULT_STORED
from ..sinks import tables
from ..sinks.gathered import Stages
from ..specs import ENTITIES, GOLD_SUITE, TABLES
from . import validation
from .bronze import DATE_COL, ingest_csv_to_bronze
from .silver import STREAM_PREFIX, show_first, stamped, unstamped, write_first, write_silver

#: Sort columns of marts that are read by ranges of them.
CLUSTERED = {"daily_sales": ("sale_date",)}

ORDER = ("customers", "products", "stores", "transactions")


@dataclass(frozen=True)
class Namespace:
    """Logical table name -> physical table.  The default is the identity;
    a database name isolates a whole run (e.g. a replay or a test) while
    results and audit rows keep the logical names."""
    db: str | None = None

    def __call__(self, logical: str) -> str:
        return logical if not self.db else f"{self.db}.{logical.replace('.', '__')}"


@dataclass
class RunReport:
    ctx: RunContext
    bronze: dict = field(default_factory=dict)
    silver_rows: dict = field(default_factory=dict)
    results: list = field(default_factory=list)


class MissingLayer(RuntimeError):
    """A layer that later steps read has not been written yet."""


def _audit(spark: SparkSession, ns: Namespace) -> DataFrame:
    name = ns(TABLES["load_audit"])
    return tables.read(spark, name) if tables.exists(spark, name) else spark.createDataFrame([], LOAD_AUDIT)


def silver_step(spark: SparkSession, ctx: RunContext, entity: str, gate: bool = True,
                fail_on_empty: bool = False, ns: Namespace = Namespace()) -> int:
    """Returns the number of rows merged (0 for an empty batch)."""
    spec = ENTITIES[entity]
    label = spec.silver_table
    target, source = ns(spec.silver_table), ns(spec.bronze_table)
    bronze = tables.read(spark, source)
    first = not tables.exists(spark, target)
    wm = None if first else inc.watermark(_audit(spark, ns), label)
    batch = bronze if first else bronze.filter(inc.after(wm, date_col=DATE_COL))
    watch = qc.Watch(label, spec.qc)
    path = None
    with Stages(spark) as stages:
        # Facts are worth a stage; a dimension's rows are few and narrow.
        gather = stages.gather if spec.partition else None
        if first:  # no rows to merge with: what is checked is the table's first snapshot
            path, staged = write_first(batch, spec, target, ctx, gather, watch)
        else:
            staged = tables.materialize(stamped(unstamped(batch, spec, gather), batch, ctx), f"silver-batch-{entity}", watch)
    results = watch.results(staged)
    if spec.foreign_keys:
        fk = [qc.check_referential_integrity(
                  staged.filter(F.col(c).isNotNull()) if pre else staged, label, c,
                  tables.read(spark, ns(ENTITIES[ref].silver_table)), key, seq=100 + i)
              for i, (c, ref, key, pre) in enumerate(spec.foreign_keys)]
        results = qc.union_all([results] + fk)
    res = results.collect()
    n = next(r["row_count"] for r in res if r["check_name"] == "row_count")
    if n == 0 and not fail_on_empty:
        return 0
    if gate:
        qc.raise_failures(res)
    if first and not tables.exists(spark, target):
        show_first(spark, target, spec, path, staged)
    else:
        # Beyond the watermark the target holds what attempts that failed before
        # their audit row have left, and what a stream has written.
        replayed = None if first else inc.after(wm) & ~F.col("_batch_id").startswith(STREAM_PREFIX)
        write_silver(staged, spec, target, ctx, replayed)
    tables.append(inc.audit_row(staged, ctx, label), ns(TABLES["load_audit"]), tag=ctx.batch_id)
    return n


def gold_step(spark: SparkSession, ctx: RunContext, gate: bool = True,
              ns: Namespace = Namespace()) -> None:
    s = {e: tables.read(spark, ns(ENTITIES[e].silver_table)) for e in ORDER}
    tx = s["transactions"]
    marts = {
        "customer_summary": lambda g: gold.customer_summary(s["customers"], tx, gather=g),
        "product_sales": lambda g: gold.product_sales(s["products"], tx, gather=g),
        "store_performance": lambda g: gold.store_performance(s["stores"], tx, gather=g),
        "daily_sales": lambda g: gold.daily_sales(tx, gather=g),
    }
    for m, mart in marts.items():
        watch = qc.Watch(TABLES["gold"][m], GOLD_SUITE[m], gate)
        # The customer summary's schema is replaced, the other marts' columns
        # are merged with those of earlier runs.
        write = tables.publish if m == "customer_summary" else tables.overwrite_merge_schema
        with Stages(spark) as stages:
            write(add_audit(mart(stages.gather), ctx), ns(TABLES["gold"][m]), tag=ctx.batch_id, cluster_by=CLUSTERED.get(m, ()), watch=watch)


def validation_step(spark: SparkSession, ctx: RunContext, raise_on_fail: bool = False,
                    ns: Namespace = Namespace()) -> DataFrame:
    b = {e: tables.read(spark, ns(ENTITIES[e].bronze_table)) for e in ORDER}
    s = {e: tables.read(spark, ns(ENTITIES[e].silver_table)) for e in ORDER}
    g = {m: tables.read(spark, ns(t)) for m, t in TABLES["gold"].items()}
    res = validation.all_layers(b, s, g).select(
        *[c for c in QC_RESULT_STORED.fieldNames() if c not in ("checked_at", "batch_id")],
        ctx.ts_lit().alias("checked_at"), ctx.batch_lit().alias("batch_id"))
    results_table = ns(TABLES["validation_results"])
    tables.append(res, results_table, tag=ctx.batch_id)
    stored = tables.read(spark, results_table).filter(F.col("batch_id") == ctx.batch_id)
    if raise_on_fail:
        qc.gate(stored)
    return stored


def run_layers(spark: SparkSession, ctx: RunContext, landing: str, gate: bool = True,
               validate: bool = True, ns: Namespace = Namespace(),
               raise_on_validation_fail: bool | None = None, suffix: str = ".csv") -> RunReport:
    """bronze -> silver -> gold -> validation.  ``gate`` stops a layer's
    write on a failed check; the validation results are stored first and the
    run then raises if any FAILed (default: same as ``gate``).  ``suffix``: of
    the landed files' names."""
    if raise_on_validation_fail is None:
        raise_on_validation_fail = gate
    rep = RunReport(ctx)
    for e in ORDER:
        r = ingest_csv_to_bronze(spark, ctx, e, landing, target=ns(ENTITIES[e].bronze_table),
                                 ledger=ns(TABLES["processed_files"]), audit=ns(TABLES["load_audit"]),
                                 label=ENTITIES[e].bronze_table, suffix=suffix)
        rep.bronze[e] = r.rows if r else 0
    for e in ORDER:
        if tables.exists(spark, ns(ENTITIES[e].bronze_table)):
            rep.silver_rows[e] = silver_step(spark, ctx, e, gate=gate, ns=ns)
    missing = [e for e in ORDER if not tables.exists(spark, ns(ENTITIES[e].silver_table))]
    if missing:
        raise MissingLayer(f"no silver table for {', '.join(missing)}: gold and validation were not run")
    gold_step(spark, ctx, gate=gate, ns=ns)
    if validate:
        rep.results = [r.asDict() for r in validation_step(spark, ctx, ns=ns).collect()]
        if raise_on_validation_fail:
            qc.raise_failures(rep.results)
    return rep
