"""Queries over written tables and files: upserts, incremental reads, the
load audit, snapshots, CSV landing/discovery/ledger, streaming ingest.

Fixture history: the transaction loads before 1998 form the initial silver
load; the later loads arrive as the incremental batch."""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..context import RunContext
from ..operators import gold
from ..operators import incremental as inc
from ..operators import upsert
from ..operators.audit import strip_audit
from ..plans import bronze as ingest
from ..plans.bronze import BATCH_COL, DATE_COL, ingest_csv_to_bronze
from ..plans.silver import to_silver
from ..schemas import ENTITY_SCHEMAS
from ..session import scratch_path
from ..sinks import bucketed, tables
from ..sources import files
from ..sources import fixtures as fx
from ..specs import ENTITIES, TABLES
from ..streaming.ingest import run_available
from . import layers as L
from .catalog import register
from .oracle import CTES, dedup_sql, DEDUP

CUTOFF = "1998-01-01 00:00:00"
CUT = f"TIMESTAMP '{CUTOFF}'"
ST = TABLES["silver"]["transactions"]
KEYS = list(ENTITIES["transactions"].merge_keys)
TXD = ["transaction_id", "transaction_line_id", "transaction_ts", "channel", "store_id",
       "customer_id", "sku", "quantity", "unit_price", "discount", "currency"]
#: Least buckets of the query's table; a larger one gets more, by its rows.
BUCKETS = 16
CTX_A = RunContext(as_of=datetime(1998, 1, 1, 2, 0, 0), batch_id="batch_A")
CTX_B = RunContext(as_of=datetime(2002, 1, 1, 2, 0, 0), batch_id="batch_B")


def _cut():
    return F.lit(CUTOFF).cast("timestamp_ntz")


def _name(prefix: str) -> str:
    return f"strata_q.{prefix}_{uuid.uuid4().hex[:10]}"


# SQL: the initial load and the incremental batch -------------------------
CTES["silver_initial"] = dedup_sql(f"(SELECT * FROM clean_transactions WHERE _record_ingestion_ts < {CUT})",
                                   *DEDUP["transactions"])
CTES["silver_incr"] = dedup_sql(
    "(SELECT * FROM clean_transactions WHERE _record_ingestion_ts > "
    f"(SELECT max(_record_ingestion_ts) FROM silver_initial))", *DEDUP["transactions"])
CTES["upsert_all"] = """
SELECT * FROM silver_initial t WHERE NOT EXISTS (SELECT 1 FROM silver_incr s
  WHERE s.transaction_id = t.transaction_id AND s.transaction_line_id = t.transaction_line_id)
UNION ALL SELECT * FROM silver_incr"""


def _initial_table(spark, d, stage=True):
    """Initial silver load published as a table; returns (name, audit,
    bronze).  Bronze is staged once for queries that read its rows again; the
    initial load and the incremental batch are parts without a common row, and
    the filters that part them reach the scan of the fact table."""
    bronze = L.bronze(spark, d, "transactions")
    bronze = tables.materialize(bronze, "bronze-tx") if stage else bronze
    s0 = to_silver(bronze.filter(F.col("_record_ingestion_ts") < _cut()), ENTITIES["transactions"], CTX_A)
    name = _name("silver_tx")
    tables.publish(s0, name, tag="initial")
    audit = inc.audit_row(tables.read(spark, name), CTX_A, ST)
    return name, audit, bronze


def _incremental_batch(spark, d):
    name, audit, bronze = _initial_table(spark, d, stage=False)
    batch = inc.incremental_read(bronze, audit, ST)
    # The batch is staged once: the merge-key assertion and the merge read it.
    return name, audit, tables.materialize(to_silver(batch, ENTITIES["transactions"], CTX_B), "silver-batch")


@register("upsert_initial", "SELECT * FROM silver_initial")
def q_upsert_initial(spark, d):
    name, _, _ = _initial_table(spark, d)
    return strip_audit(tables.read(spark, name))


@register("upsert_update_all", "SELECT * FROM upsert_all")
def q_upsert_update_all(spark, d):
    name, _, s1 = _incremental_batch(spark, d)
    tables.publish(upsert.merge_update_all(tables.read(spark, name), s1, KEYS), name, tag="merge")
    return strip_audit(tables.read(spark, name))


@register("upsert_partitioned", "SELECT *, strftime(transaction_ts, '%Y-%m') AS tx_month FROM upsert_all")
def q_upsert_partitioned(spark, d):
    """Same merge as upsert_update_all into a table partitioned by month:
    only the touched months are rewritten."""
    name = _name("silver_tx_part")
    bronze = L.bronze(spark, d, "transactions")
    month = F.date_format("transaction_ts", "yyyy-MM")
    s0 = to_silver(bronze.filter(F.col("_record_ingestion_ts") < _cut()), ENTITIES["transactions"], CTX_A)
    tables.merge_partitioned(s0.withColumn("tx_month", month), name, KEYS, "tx_month")
    audit = inc.audit_row(tables.read(spark, name), CTX_A, ST)
    batch = to_silver(inc.incremental_read(bronze, audit, ST), ENTITIES["transactions"], CTX_B)
    staged = tables.materialize(batch.withColumn("tx_month", month), "silver-batch")
    tables.merge_partitioned(staged, name, KEYS, "tx_month")
    return strip_audit(tables.read(spark, name))


def _months(df):
    return df.withColumn("tx_month", F.date_format("transaction_ts", "yyyy-MM"))


def _partitioned(spark, d):
    """The initial load in a table partitioned by month, and the staged
    incremental batch."""
    bronze = L.bronze(spark, d, "transactions")
    s0 = to_silver(bronze.filter(F.col("_record_ingestion_ts") < _cut()), ENTITIES["transactions"], CTX_A)
    name = _name("silver_tx_part")
    tables.publish(_months(s0), name, tag="initial", partition_by=["tx_month"])
    audit = inc.audit_row(tables.read(spark, name), CTX_A, ST)
    batch = to_silver(inc.incremental_read(bronze, audit, ST), ENTITIES["transactions"], CTX_B)
    return name, tables.materialize(_months(batch), "silver-batch")


UPD = ["quantity", "unit_price", "discount"]


def _pick(c):
    if c in KEYS:
        return f"coalesce(t.{c}, s.{c}) AS {c}"
    if c in UPD:
        return f"CASE WHEN s.transaction_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}"
    return f"CASE WHEN t.transaction_id IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}"


@register("upsert_partial", "SELECT " + ", ".join(_pick(c) for c in TXD + ["_record_ingestion_ts"])
          + " FROM silver_initial t FULL OUTER JOIN silver_incr s ON t.transaction_id = s.transaction_id"
          " AND t.transaction_line_id = s.transaction_line_id")
def q_upsert_partial(spark, d):
    name, _, s1 = _incremental_batch(spark, d)
    merged = upsert.merge_update_columns(tables.read(spark, name), s1, KEYS, UPD)
    tables.publish(merged, name, tag="merge")
    return strip_audit(tables.read(spark, name))


@register("upsert_partial_partitioned", "SELECT *, strftime(transaction_ts, '%Y-%m') AS tx_month FROM (SELECT "
          + ", ".join(_pick(c) for c in TXD + ["_record_ingestion_ts"])
          + " FROM silver_initial t FULL OUTER JOIN silver_incr s ON t.transaction_id = s.transaction_id"
          " AND t.transaction_line_id = s.transaction_line_id)")
def q_upsert_partial_partitioned(spark, d):
    """upsert_partial into a table partitioned by month: months that the batch
    neither matches nor adds to keep their files."""
    name, batch = _partitioned(spark, d)
    tables.merge_columns_partitioned(batch, name, KEYS, "tx_month", UPD)
    return strip_audit(tables.read(spark, name))


@register("upsert_bucketed", "SELECT * FROM upsert_all")
def q_upsert_bucketed(spark, d):
    """upsert_update_all into a table bucketed by its keys: only the batch is
    shuffled."""
    bronze = L.bronze(spark, d, "transactions")
    s0 = to_silver(bronze.filter(F.col("_record_ingestion_ts") < _cut()), ENTITIES["transactions"], CTX_A)
    s0 = tables.materialize(s0, "silver-initial")  # counted, checked and written
    name = _name("silver_tx_bucketed")
    bucketed.create(s0, name, KEYS, bucketed.enough_buckets(s0, BUCKETS))
    audit = inc.audit_row(bucketed.read(spark, name), CTX_A, ST)
    batch = to_silver(inc.incremental_read(bronze, audit, ST), ENTITIES["transactions"], CTX_B)
    bucketed.merge(tables.materialize(batch, "silver-batch"), name, CTX_B.batch_id)
    return strip_audit(bucketed.read(spark, name))


@register("conditional_update_partitioned", "SELECT * REPLACE (CASE WHEN channel = 'ECOM' AND store_id IS NULL AND "
          "transaction_ts >= TIMESTAMP '1997-07-01' THEN 'WEB' ELSE store_id END AS store_id), "
          "strftime(transaction_ts, '%Y-%m') AS tx_month FROM silver_initial")
def q_conditional_update_partitioned(spark, d):
    """An UPDATE that rewrites only the months in which it changes a row."""
    name, _ = _partitioned(spark, d)
    pred = (F.col("channel") == "ECOM") & F.col("store_id").isNull() & (F.col("tx_month") >= "1997-07")
    tables.update_partitioned(spark, name, pred, {"store_id": "WEB"})
    return strip_audit(tables.read(spark, name))


@register("conditional_update", "SELECT * REPLACE (CASE WHEN channel = 'ECOM' AND store_id IS NULL "
          "THEN 'WEB' ELSE store_id END AS store_id) FROM upsert_all")
def q_conditional_update(spark, d):
    name, _, s1 = _incremental_batch(spark, d)
    tables.publish(upsert.merge_update_all(tables.read(spark, name), s1, KEYS), name, tag="merge")
    t = tables.read(spark, name)
    pred = (F.col("channel") == "ECOM") & F.col("store_id").isNull()
    tables.publish(upsert.update_where(t, pred, {"store_id": "WEB"}), name, tag="update")
    return strip_audit(tables.read(spark, name))


# Incremental reads and the audit log --------------------------------------

INCR_SQL = ("SELECT * FROM bronze_transactions WHERE _record_ingestion_ts > "
            "(SELECT coalesce(max(_record_ingestion_ts), TIMESTAMP '1900-01-01') FROM silver_initial)")


def _bronze_table(spark, bronze):
    """Bronze transactions as a table of daily loads, as the ingest lays it."""
    name = _name("bronze_tx")
    year = F.year("_record_ingestion_ts").cast("string")
    loads = bronze.withColumns({DATE_COL: F.to_date("_record_ingestion_ts"), BATCH_COL: F.concat(F.lit("load_"), year)})
    tables.publish(loads, name, partition_by=[DATE_COL, BATCH_COL])
    return tables.read(spark, name)


@register("incremental_read", INCR_SQL)
def q_incremental_read(spark, d):
    """Only the folders of later loads are read."""
    _, audit, bronze = _initial_table(spark, d)
    return strip_audit(inc.incremental_read(_bronze_table(spark, bronze), audit, ST, date_col=DATE_COL))


@register("incremental_from_target", INCR_SQL)
def q_incremental_from_target(spark, d):
    name, _, bronze = _initial_table(spark, d)
    return strip_audit(inc.newer_than_target(bronze, tables.read(spark, name)))


@register("pending_by_transaction",
          f"SELECT transaction_id, count(*) AS pending_lines FROM ({INCR_SQL}) GROUP BY transaction_id")
def q_pending_by_transaction(spark, d):
    name, _, bronze = _initial_table(spark, d)
    return (inc.newer_than_target(bronze, tables.read(spark, name))
               .groupBy("transaction_id").agg(F.count(F.lit(1)).alias("pending_lines")))


def _audit_log(spark, d):
    """Audit rows of the fixture history: the initial load of every silver
    table, then the incremental run (an empty batch logs nothing)."""
    frames = []
    for e in ("customers", "products", "stores", "transactions"):
        bronze = L.bronze(spark, d, e)
        table = TABLES["silver"][e]
        s0 = to_silver(bronze.filter(F.col("_record_ingestion_ts") < _cut()), ENTITIES[e], CTX_A)
        start = F.col("log_ts") + F.expr("INTERVAL 2 HOURS")
        end = F.timestamp_add("MILLISECOND", F.col("_rows"), start)
        a0 = inc.audit_row(s0, CTX_A, table, start, end)
        s1 = to_silver(inc.incremental_read(bronze, a0, table), ENTITIES[e], CTX_B)
        a1 = inc.audit_row(s1, CTX_B, table, start, end)
        frames += [a0, a1]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _audit_sql() -> str:
    parts = []
    for e in ("customers", "products", "stores", "transactions"):
        keys, order = DEDUP[e]
        s0 = dedup_sql(f"(SELECT * FROM clean_{e} WHERE _record_ingestion_ts < {CUT})", keys, order)
        s1 = dedup_sql(f"(SELECT * FROM clean_{e} WHERE _record_ingestion_ts > "
                       f"(SELECT max(_record_ingestion_ts) FROM ({s0})))", keys, order)
        for b, src in (("batch_A", s0), ("batch_B", s1)):
            parts.append(f"SELECT '{b}' AS batch_id, '{TABLES['silver'][e]}' AS table_name, "
                         f"max(_record_ingestion_ts) AS log_ts, count(*) AS _rows FROM ({src}) "
                         f"HAVING max(_record_ingestion_ts) IS NOT NULL")
    return ("SELECT batch_id, table_name, log_ts, log_ts + INTERVAL 2 HOUR AS start_time, "
            "log_ts + INTERVAL 2 HOUR + to_milliseconds(_rows) AS end_time FROM ("
            + " UNION ALL ".join(parts) + ")")


CTES["audit_log"] = _audit_sql()


@register("load_audit_row", "SELECT table_name, log_ts FROM audit_log")
def q_load_audit_row(spark, d):
    return _audit_log(spark, d).select("table_name", "log_ts")


@register("audit_last_watermark",
          "SELECT table_name, max(log_ts) AS last_processed_ts FROM audit_log GROUP BY table_name")
def q_audit_last_watermark(spark, d):
    return inc.last_watermarks(_audit_log(spark, d))


@register("audit_history", "SELECT table_name, batch_id, log_ts, start_time, end_time, "
          "date_diff('second', start_time, end_time) AS processing_seconds FROM audit_log")
def q_audit_history(spark, d):
    return inc.history(_audit_log(spark, d))


@register("pending_rows", """
SELECT t.table_name, (SELECT count(*) FROM bronze_customers WHERE _record_ingestion_ts >
   (SELECT coalesce(max(log_ts), TIMESTAMP '1900-01-01') FROM audit_log a WHERE a.table_name = t.table_name
    AND a.batch_id = 'batch_A')) AS new_records
FROM (SELECT 'silver.silver_customers' AS table_name) t
UNION ALL
SELECT 'silver.silver_products', (SELECT count(*) FROM bronze_products WHERE _record_ingestion_ts >
   (SELECT max(log_ts) FROM audit_log WHERE table_name = 'silver.silver_products' AND batch_id = 'batch_A'))
UNION ALL
SELECT 'silver.silver_stores', (SELECT count(*) FROM bronze_stores WHERE _record_ingestion_ts >
   (SELECT max(log_ts) FROM audit_log WHERE table_name = 'silver.silver_stores' AND batch_id = 'batch_A'))
UNION ALL
SELECT 'silver.silver_transactions', (SELECT count(*) FROM bronze_transactions WHERE _record_ingestion_ts >
   (SELECT max(log_ts) FROM audit_log WHERE table_name = 'silver.silver_transactions' AND batch_id = 'batch_A'))
""")
def q_pending_rows(spark, d):
    audit = _audit_log(spark, d).filter(F.col("batch_id") == "batch_A")
    frames = [inc.pending_count(L.bronze(spark, d, e), audit, TABLES["silver"][e])
              for e in ("customers", "products", "stores", "transactions")]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# Snapshots and appends ----------------------------------------------------

@register("snapshot_overwrite", "SELECT * FROM gold_customer_summary")
def q_snapshot_overwrite(spark, d):
    name = _name("gold_cs")
    g = L.gold_mart(spark, d, "customer_summary")
    tables.publish(g.limit(0), name, tag="v1")
    tables.publish(g, name, tag="v2")
    return tables.read(spark, name)


@register("snapshot_overwrite_merge_schema",
          "SELECT *, CAST(NULL AS INTEGER) AS legacy_rank FROM gold_product_sales")
def q_snapshot_overwrite_merge_schema(spark, d):
    name = _name("gold_ps")
    g = tables.materialize(L.gold_mart(spark, d, "product_sales"), "gold-ps")  # published twice, computed once
    tables.publish(g.withColumn("legacy_rank", F.lit(1)), name, tag="v1")
    tables.overwrite_merge_schema(g, name, tag="v2")
    return tables.read(spark, name)


@register("append_align", "SELECT *, CASE WHEN _record_ingestion_ts < " + CUT +
          " THEN NULL ELSE 'transactions_' || CAST(year(_record_ingestion_ts) AS VARCHAR) END AS _load_name"
          " FROM bronze_transactions")
def q_append_align(spark, d):
    name = _name("bronze_tx")
    b = strip_audit(L.bronze(spark, d, "transactions"))
    tables.publish(b.filter(F.col("_record_ingestion_ts") < _cut()), name, tag="first")
    later = b.filter(F.col("_record_ingestion_ts") >= _cut()).withColumn(
        "_load_name", F.concat(F.lit("transactions_"), F.year("_record_ingestion_ts").cast("string")))
    tables.append(later.select("_load_name", *b.columns), name, tag="second")
    return tables.read(spark, name)


@register("scan_table", "SELECT * FROM bronze_stores")
def q_scan_table(spark, d):
    name = _name("bronze_st")
    tables.publish(strip_audit(L.bronze(spark, d, "stores")), name)
    return spark.sql(f"SELECT * FROM {name}")


# Files --------------------------------------------------------------------

def _landing_frame(spark, d):
    t = fx.raw_transactions(spark, d)
    return t.withColumn("_file", F.concat(F.lit("transactions_"),
                                          F.year("_record_ingestion_ts").cast("string")))


def _stage_landing(spark, d, folder, before_cutoff: bool):
    t = _landing_frame(spark, d)
    cond = F.col("_record_ingestion_ts") < _cut()
    t = t.filter(cond if before_cutoff else ~cond)
    files.stage_csv(t.select(*TXD, "_file"), folder, "_file")


RAW_NAMED = ("SELECT " + ", ".join(TXD) + ", 'transactions_' || CAST(year(_record_ingestion_ts) AS VARCHAR)"
             " AS source_name FROM raw_transactions")


@register("csv_scan", RAW_NAMED)
def q_csv_scan(spark, d):
    folder = scratch_path(spark, "landing")
    _stage_landing(spark, d, folder, True)
    _stage_landing(spark, d, folder, False)
    found = files.match_entity(files.list_files(spark, folder), "transactions")
    paths = [r["path"] for r in found.select("path").collect()]
    df = files.read_csv(spark, paths, ENTITY_SCHEMAS["transactions"])
    return df.select(*TXD, files.logical_name().alias("source_name"))


@register("csv_scan_inferred", "SELECT sku, product_key, category, list_price FROM raw_products")
def q_csv_scan_inferred(spark, d):
    folder = scratch_path(spark, "landing")
    p = fx.raw_products(spark, d, with_ts=False).withColumn("_file", F.lit("products"))
    files.stage_csv(p, folder, "_file")
    df = files.read_csv(spark, [folder], infer=True)
    return df.select("sku", "product_key", "category", "list_price")


@register("ingest_new_files", "SELECT 'transactions_' || CAST(year(_record_ingestion_ts) AS VARCHAR) "
          f"AS source_name, count(*) AS row_count FROM raw_transactions WHERE _record_ingestion_ts >= {CUT} "
          "GROUP BY 1")
def q_ingest_new_files(spark, d):
    folder = scratch_path(spark, "landing")
    _stage_landing(spark, d, folder, True)
    # Other entities land in the same folder and must not match.
    cu = fx.raw_customers(spark, d, with_ts=False).withColumn("_file", F.lit("customers"))
    files.stage_csv(cu, folder, "_file")
    ledger = (files.match_entity(files.list_files(spark, folder), "transactions")
                   .select(F.col("path").alias("file_path")))
    ledger_name = _name("ledger")
    tables.publish(ledger, ledger_name)
    _stage_landing(spark, d, folder, False)
    found = files.match_entity(files.list_files(spark, folder), "transactions")
    new = files.new_files(found, tables.read(spark, ledger_name))
    paths = [r["path"] for r in new.select("path").collect()]
    df = files.read_csv(spark, paths, ENTITY_SCHEMAS["transactions"])
    return (df.groupBy(files.logical_name().alias("source_name"))
              .agg(F.count(F.lit(1)).alias("row_count")))


def _two_runs(spark, d):
    folder = scratch_path(spark, "landing")
    names = {k: _name(k) for k in ("bronze", "ledger", "audit")}
    _stage_landing(spark, d, folder, True)
    ingest_csv_to_bronze(spark, CTX_A, "transactions", folder, names["bronze"], names["ledger"], names["audit"])
    _stage_landing(spark, d, folder, False)
    ingest_csv_to_bronze(spark, CTX_B, "transactions", folder, names["bronze"], names["ledger"], names["audit"])
    return names


BATCH_OF = (f"CASE WHEN _record_ingestion_ts < {CUT} THEN 'batch_A' ELSE 'batch_B' END")


@register("file_row_counts", "SELECT 'transactions_' || CAST(year(_record_ingestion_ts) AS VARCHAR) AS source_name, "
          f"{BATCH_OF} AS batch_id, count(*) AS row_count FROM raw_transactions GROUP BY 1, 2")
def q_file_row_counts(spark, d):
    names = _two_runs(spark, d)
    led = tables.read(spark, names["ledger"])
    return (led.groupBy(files.logical_name("file_path").alias("source_name"), "batch_id")
               .agg(F.sum("row_count").alias("row_count")))


@register("bronze_ingest_transactions", "SELECT " + ", ".join(TXD) +
          ", 'transactions_' || CAST(year(_record_ingestion_ts) AS VARCHAR) AS source_name, "
          f"CASE WHEN _record_ingestion_ts < {CUT} THEN TIMESTAMP '1998-01-01 02:00:00' "
          "ELSE TIMESTAMP '2002-01-01 02:00:00' END AS _record_ingestion_ts FROM raw_transactions")
def q_bronze_ingest_transactions(spark, d):
    names = _two_runs(spark, d)
    b = tables.read(spark, names["bronze"])
    return b.select(*TXD, files.logical_name("_source_file").alias("source_name"), "_record_ingestion_ts")


@register("bronze_replay_after_crash", "SELECT " + ", ".join(TXD) +
          ", 'transactions_' || CAST(year(_record_ingestion_ts) AS VARCHAR) AS source_name, "
          f"{BATCH_OF} AS _batch_id FROM raw_transactions")
def q_bronze_replay_after_crash(spark, d):
    """The first run ends between its files and the ledger, the third one
    between the ledger and the catalog; the runs after them repeat and lose
    nothing."""
    folder = scratch_path(spark, "landing")
    names = [_name(k) for k in ("bronze", "ledger", "audit")]
    target, ledger, audit = names

    def ended_early(ctx):
        found = files.match_entity(files.list_files(spark, folder), "transactions")
        led = tables.read(spark, ledger) if tables.exists(spark, ledger) else None
        paths = [r.path for r in files.new_files(found, led).select("path").collect()]
        ingest.create_bronze(spark, target, "transactions")
        return ingest.write_batch(ingest.scan_new(spark, ctx, "transactions", paths), target, ctx, len(paths)), paths

    _stage_landing(spark, d, folder, True)
    ended_early(RunContext(as_of=CTX_A.as_of, batch_id="batch_lost"))
    ingest_csv_to_bronze(spark, CTX_A, "transactions", folder, *names)
    _stage_landing(spark, d, folder, False)
    loaded, paths = ended_early(CTX_B)
    ingest.commit(spark, loaded, paths, ledger, target)
    ingest_csv_to_bronze(spark, RunContext(as_of=datetime(2003, 1, 1), batch_id="batch_C"), "transactions", folder, *names)
    return tables.read(spark, target).select(*TXD, files.logical_name("_source_file").alias("source_name"), "_batch_id")


NAMES = "SELECT DISTINCT 'transactions_' || CAST(year(_record_ingestion_ts) AS VARCHAR) AS source_name FROM raw_transactions"


@register("discover_files", f"""
SELECT 'any case' AS rule, source_name FROM ({NAMES})
UNION ALL SELECT 'exact case', 'customers'
UNION ALL SELECT 'whole path', source_name FROM ({NAMES})
UNION ALL SELECT 'whole path', 'customers'
UNION ALL SELECT 'any suffix', 'customers'
UNION ALL SELECT 'any suffix', 'customers.txt'""")
def q_discover_files(spark, d):
    """The options of discovery: names in any case (the default) or as they
    are, patterns on the whole path, files of any suffix."""
    folder = scratch_path(spark, "Landing")
    _stage_landing(spark, d, folder, True)
    _stage_landing(spark, d, folder, False)
    cu = fx.raw_customers(spark, d, with_ts=False).withColumn("_file", F.lit("customers"))
    files.stage_csv(cu, folder, "_file")
    files.stage_csv(cu, folder, "_file", suffix=".txt")
    found = files.list_files(spark, folder)
    rules = {"any case": files.match_entity(found, "TransActions"),
             "exact case": files.match_entity(found, "customers", case_sensitive=True)
                                .unionByName(files.match_entity(found, "Transactions", case_sensitive=True)),
             "whole path": files.match_entity(found, "/strata/Landing-", case_sensitive=True, on="path"),
             "any suffix": files.match_entity(found, "customers", suffix=None)}
    out = [f.select(F.lit(r).alias("rule"), F.regexp_replace(F.regexp_replace("file_name", r"-\d+(?=\.)", ""), r"\.csv$", "")
                    .alias("source_name")).distinct() for r, f in rules.items()]
    return reduce(lambda a, b: a.unionByName(b), out)


# Late files: the later loads arrive first, then those of the days before.
CTES["late_first"] = dedup_sql(f"(SELECT * REPLACE (TIMESTAMP '1998-01-01 02:00:00' AS _record_ingestion_ts) FROM clean_transactions "
                               f"WHERE _record_ingestion_ts >= {CUT})", *DEDUP["transactions"])
CTES["late_second"] = dedup_sql(f"(SELECT * REPLACE (TIMESTAMP '2002-01-01 02:00:00' AS _record_ingestion_ts) FROM clean_transactions "
                                f"WHERE _record_ingestion_ts < {CUT})", *DEDUP["transactions"])


@register("stream_late_files", """
SELECT CAST(transaction_ts AS DATE) AS sale_date, _record_ingestion_ts, count(*) AS total_transactions
FROM (SELECT * FROM late_first t WHERE NOT EXISTS (SELECT 1 FROM late_second s
        WHERE s.transaction_id = t.transaction_id AND s.transaction_line_id = t.transaction_line_id)
      UNION ALL SELECT * FROM late_second)
GROUP BY 1, 2""")
def q_stream_late_files(spark, d):
    """Files of earlier days that land late enter by their ingestion time, and
    the mart is computed from silver again."""
    folder, ckpt, target = scratch_path(spark, "landing"), scratch_path(spark, "stream-ckpt"), _name("silver_late")
    _stage_landing(spark, d, folder, False)
    run_available(spark, folder, "transactions", target, ckpt, as_of=CTX_A.as_of)
    _stage_landing(spark, d, folder, True)
    run_available(spark, folder, "transactions", target, ckpt, as_of=CTX_B.as_of)
    return gold.daily_sales(tables.read(spark, target)).select("sale_date", "_record_ingestion_ts", "total_transactions")


@register("truncate_table", f"SELECT * FROM bronze_transactions WHERE _record_ingestion_ts >= {CUT}")
def q_truncate_table(spark, d):
    """What is appended after a truncation is all that the table holds."""
    name = _name("truncated")
    b = strip_audit(L.bronze(spark, d, "transactions"))
    tables.publish(b.filter(F.col("_record_ingestion_ts") < _cut()), name)
    tables.truncate(spark, name)
    tables.append(b.filter(F.col("_record_ingestion_ts") >= _cut()), name)
    return tables.read(spark, name)


@register("create_table", "SELECT * FROM bronze_stores")
def q_create_table(spark, d):
    """A table made from a schema, partitioned, and left alone when it is
    asked for again."""
    name = _name("created")
    b = strip_audit(L.bronze(spark, d, "stores"))
    tables.create_empty(spark, name, b.schema, ["region"])
    tables.append(b, name)
    tables.create_empty(spark, name, b.schema, ["region"])
    return tables.read(spark, name)


@register("daily_sales_layout", "SELECT count(*) AS days, min(sale_date) AS first_day, max(sale_date) AS last_day, "
          "0 AS overlaps, 0 AS descents FROM gold_daily_sales")
def q_daily_sales_layout(spark, d):
    """The daily mart as written: files that hold days of another file, and
    rows of an earlier day than the one before them in their file."""
    name = _name("gold_days")
    tables.publish(L.gold_mart(spark, d, "daily_sales"), name, cluster_by=["sale_date"])
    rows = tables.read(spark, name).select("sale_date", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = F.lag("sale_date").over(Window.partitionBy("file").orderBy("at"))
    in_file = rows.withColumn("falls", before > F.col("sale_date")).groupBy("file").agg(
        F.count(F.lit(1)).alias("days"), F.min("sale_date").alias("lo"), F.max("sale_date").alias("hi"), F.count_if("falls").alias("descents"))
    # one row a file
    overlap = F.lag("hi").over(Window.orderBy("lo", "hi")) > F.col("lo")
    return in_file.withColumn("overlap", overlap).agg(
        F.sum("days").alias("days"), F.min("lo").alias("first_day"), F.max("hi").alias("last_day"),
        F.count_if("overlap").cast("int").alias("overlaps"), F.sum("descents").cast("int").alias("descents"))


@register("stream_ingest", "SELECT " + ", ".join(TXD) + " FROM upsert_all")
def q_stream_ingest(spark, d):
    folder = scratch_path(spark, "landing")
    ckpt = scratch_path(spark, "stream-ckpt")
    target = _name("silver_stream")
    _stage_landing(spark, d, folder, True)
    run_available(spark, folder, "transactions", target, ckpt, as_of=CTX_A.as_of)
    _stage_landing(spark, d, folder, False)
    run_available(spark, folder, "transactions", target, ckpt, as_of=CTX_B.as_of)
    return tables.read(spark, target).select(*TXD)
