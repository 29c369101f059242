"""Quality-check queries (checks, layer suites, result reports)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import qc
from ..plans import validation
from ..specs import BRONZE_SUITE, ENTITIES, GOLD_SUITE, SILVER_SUITE, TABLES, TRANSACTIONS
from . import layers as L
from . import qc_sql as Q
from .catalog import register

ENT = ("customers", "products", "stores", "transactions")
MARTS = ("customer_summary", "product_sales", "store_performance", "daily_sales")
COLS = {
    "customers": ["customer_id", "name", "signup_date", "_record_ingestion_ts"],
    "products": ["sku", "product_key", "category", "list_price", "_record_ingestion_ts"],
    "stores": ["store_id", "name", "region", "_record_ingestion_ts"],
    "transactions": ["transaction_id", "transaction_line_id", "transaction_ts", "channel", "store_id",
                     "customer_id", "sku", "quantity", "unit_price", "discount", "currency",
                     "_record_ingestion_ts"],
    "customer_summary": ["customer_id", "total_sales", "total_transactions"],
    "product_sales": ["sku", "total_revenue", "total_quantity_sold"],
    "store_performance": ["store_id", "total_revenue", "total_transactions"],
    "daily_sales": ["sale_date", "total_revenue", "total_transactions"],
}
BT, ST = TABLES["bronze"]["transactions"], TABLES["silver"]["transactions"]

# ------------------------------------------------------------ checks -----

RC_SPEC = {"row_count": {"min_rows": 1}}
RC_WARN = {"row_count": {"min_rows": 1, "expected_rows": 1000}}
PENDING = "(SELECT * FROM bronze_transactions WHERE _record_ingestion_ts > (SELECT max(_record_ingestion_ts) FROM silver_transactions))"


def _pending_after_last_load(spark, d):
    b = L.bronze(spark, d, "transactions")
    wm = L.silver(spark, d, "transactions").agg(F.max("_record_ingestion_ts").alias("__wm"))
    # Uncorrelated scalar subquery: the watermark is one value.
    return b.filter(F.col("_record_ingestion_ts") > wm.select("__wm").scalar())


@register("qc_row_count", Q.assemble([
    Q.evaluate("bronze_transactions", BT, RC_SPEC, COLS["transactions"], tag="a"),
    Q.evaluate("silver_stores", TABLES["silver"]["stores"], RC_WARN, COLS["stores"], tag="b"),
    Q.evaluate(PENDING, "pending." + ST, RC_SPEC, COLS["transactions"], tag="c"),
]))
def q_qc_row_count(spark, d):
    return qc.union_all([
        qc.evaluate(L.bronze(spark, d, "transactions"), BT, RC_SPEC),
        qc.evaluate(L.silver(spark, d, "stores"), TABLES["silver"]["stores"], RC_WARN),
        qc.evaluate(_pending_after_last_load(spark, d), "pending." + ST, RC_SPEC),
    ])


NULL_SPEC = {"nulls": {"columns": COLS["transactions"][:11], "max_null_percentage": 0.1}}


@register("qc_nulls", Q.assemble([Q.evaluate("bronze_transactions", BT, NULL_SPEC, COLS["transactions"])]))
def q_qc_nulls(spark, d):
    return qc.evaluate(L.bronze(spark, d, "transactions"), BT, NULL_SPEC)


KEYS = ["transaction_id", "transaction_line_id"]
GATE_SPEC = {"row_count": {"min_rows": 1}, "nulls": {"columns": ["store_id", "sku"], "max_null_percentage": 0.0},
             "duplicates": {"key_columns": ["transaction_id"], "max_duplicate_percentage": 0.0},
             "value_ranges": {"quantity": {"min_value": 1, "max_value": 10}, "discount": {"min_value": 0.0, "max_value": 100.0}},
             "valid_values": {"channel": ["ECOM"]}}


@register("qc_gate", Q.assemble([Q.evaluate("silver_transactions", ST, GATE_SPEC, COLS["transactions"])],
                                final="SELECT table_name, check_name, message, 0 AS written FROM qc_rows WHERE status = 'FAIL'"))
def q_qc_gate(spark, d):
    """What the gate raises when a table is published with rows that fail,
    and the rows that it then has: none, as before."""
    import uuid
    from ..sinks import tables
    name = f"strata_q.gated_{uuid.uuid4().hex[:10]}"
    rows = L.silver(spark, d, "transactions")
    tables.create_empty(spark, name, rows.schema)
    try:
        tables.publish(rows, name, watch=qc.Watch(ST, GATE_SPEC))
        failed = []
    except qc.QCFailure as e:
        failed = [(f["table_name"], f["check_name"], f["message"]) for f in e.failures]
    found = spark.createDataFrame(failed, "table_name string, check_name string, message string")
    return found.withColumn("written", F.lit(tables.read(spark, name).count()).cast("int"))


DUP_FAIL = {"duplicates": {"key_columns": KEYS, "max_duplicate_percentage": 0.05}}
DUP_WARN = {"duplicates": {"key_columns": KEYS, "max_duplicate_percentage": 0.5}}


@register("qc_duplicates", Q.assemble([
    Q.evaluate("bronze_transactions", BT, DUP_FAIL, COLS["transactions"], tag="a"),
    Q.evaluate("bronze_transactions", BT, DUP_WARN, COLS["transactions"], tag="b"),
    Q.evaluate("silver_transactions", ST, DUP_FAIL, COLS["transactions"], tag="c"),
]))
def q_qc_duplicates(spark, d):
    b = L.bronze(spark, d, "transactions")
    return qc.union_all([qc.evaluate(b, BT, DUP_FAIL), qc.evaluate(b, BT, DUP_WARN),
                         qc.evaluate(L.silver(spark, d, "transactions"), ST, DUP_FAIL)])


RANGE_TX = {"value_ranges": {"quantity": {"min_value": 1, "max_value": 1000},
                             "unit_price": {"min_value": 0.0, "max_value": 10000.0},
                             "discount": {"min_value": 0.0, "max_value": 100.0},
                             "transaction_ts": {}}}
RANGE_PR = {"value_ranges": {"list_price": {"max_value": 1500.0}, "missing_col": {"min_value": 0}}}


@register("qc_value_range", Q.assemble([
    Q.evaluate("silver_transactions", ST, RANGE_TX, COLS["transactions"], tag="a"),
    Q.evaluate("bronze_products", TABLES["bronze"]["products"], RANGE_PR, COLS["products"], tag="b"),
]))
def q_qc_value_range(spark, d):
    return qc.union_all([
        qc.evaluate(L.silver(spark, d, "transactions"), ST, RANGE_TX),
        qc.evaluate(L.bronze(spark, d, "products"), TABLES["bronze"]["products"], RANGE_PR)])


VV = {"valid_values": {"channel": ["ECOM", "POS"], "currency": ["INR"]}}


@register("qc_valid_values", Q.assemble([
    Q.evaluate("bronze_transactions", BT, VV, COLS["transactions"], tag="a"),
    Q.evaluate("silver_transactions", ST, VV, COLS["transactions"], tag="b"),
]))
def q_qc_valid_values(spark, d):
    return qc.union_all([qc.evaluate(L.bronze(spark, d, "transactions"), BT, VV),
                         qc.evaluate(L.silver(spark, d, "transactions"), ST, VV)])


def _fk_query(i):
    fk_col, ref_e, ref_key, pre = TRANSACTIONS.foreign_keys[i]

    def fn(spark, d):
        tx = L.silver(spark, d, "transactions")
        src = tx.filter(F.col(fk_col).isNotNull()) if pre else tx
        return qc.check_referential_integrity(src, ST, fk_col, L.silver(spark, d, ref_e), ref_key)
    sql = Q.assemble([Q.fk("silver_transactions", ST, fk_col, f"silver_{ref_e}", ref_key, 1, "a", pre)])
    return fn, sql


for _i, _name in enumerate(("qc_fk_customer", "qc_fk_store", "qc_fk_sku")):
    _fn, _sql = _fk_query(_i)
    register(_name, _sql)(_fn)


@register("qc_suite_transactions", Q.assemble([
    Q.evaluate("silver_transactions", ST, TRANSACTIONS.qc, COLS["transactions"])]))
def q_qc_suite_transactions(spark, d):
    return qc.evaluate(L.silver(spark, d, "transactions"), ST, TRANSACTIONS.qc)


# ------------------------------------------------------------- layers ----

def _bronze_sql():
    return [Q.evaluate(f"bronze_{e}", TABLES["bronze"][e], BRONZE_SUITE[e], COLS[e], tag=f"b{i}")
            for i, e in enumerate(ENT)]


def _silver_sql():
    parts = [Q.evaluate(f"silver_{e}", TABLES["silver"][e], SILVER_SUITE[e], COLS[e], tag=f"s{i}")
             for i, e in enumerate(ENT)]
    seq = validation._suite_len(SILVER_SUITE["transactions"])
    for j, (fk_col, ref_e, ref_key, pre) in enumerate(ENTITIES["transactions"].foreign_keys):
        parts.append(Q.fk("silver_transactions", ST, fk_col, f"silver_{ref_e}", ref_key, seq + j + 1,
                          f"s{j}", pre))
    return parts


def _gold_sql():
    parts = [Q.evaluate(f"gold_{m}", TABLES["gold"][m], GOLD_SUITE[m], COLS[m], tag=f"g{i}")
             for i, m in enumerate(MARTS)]
    parts.append(Q.positive_total("gold_customer_summary", TABLES["gold"]["customer_summary"],
                                  "total_sales", "business_rule_total_sales",
                                  validation._suite_len(GOLD_SUITE["customer_summary"]) + 1, "g"))
    return parts


def _bronze(spark, d):
    return {e: L.bronze(spark, d, e) for e in ENT}


def _silver(spark, d):
    return {e: L.silver(spark, d, e) for e in ENT}


def _gold(spark, d):
    return {m: L.gold_mart(spark, d, m) for m in MARTS}


def all_results(spark, d):
    lay = L.build_all(spark, d, materialize=True)
    return validation.all_layers(lay["bronze"], lay["silver"], lay["gold"])


ALL_SQL = _bronze_sql() + _silver_sql() + _gold_sql()


@register("qc_bronze_layer", Q.assemble(_bronze_sql()))
def q_qc_bronze_layer(spark, d):
    return validation.bronze_layer(_bronze(spark, d))


@register("qc_silver_layer", Q.assemble(_silver_sql()))
def q_qc_silver_layer(spark, d):
    return validation.silver_layer(_silver(spark, d))


@register("qc_gold_layer", Q.assemble(_gold_sql()))
def q_qc_gold_layer(spark, d):
    return validation.gold_layer(_gold(spark, d))


@register("qc_total_sales_positive", Q.assemble([Q.positive_total(
    "gold_customer_summary", TABLES["gold"]["customer_summary"], "total_sales",
    "business_rule_total_sales", 1, "a")]))
def q_qc_total_sales_positive(spark, d):
    return qc.business_rule_positive_total(L.gold_mart(spark, d, "customer_summary"),
                                           TABLES["gold"]["customer_summary"])


# ------------------------------------------------------------ reports ----

@register("qc_summary", Q.assemble(ALL_SQL, final=(
    "SELECT status, check_count, table_count, "
    + "(CAST(h // 100 AS VARCHAR) || '.' || lpad(CAST(h % 100 AS VARCHAR), 2, '0') || '%') AS share "
    + "FROM (SELECT *, (check_count * 20000 + tot) // (2 * tot) AS h FROM ("
    + "SELECT status, count(*) AS check_count, count(DISTINCT table_name) AS table_count, "
    + "sum(count(*)) OVER () AS tot FROM qc_rows GROUP BY status))")))
def q_qc_summary(spark, d):
    return qc.summary(all_results(spark, d))


@register("qc_report_by_status", Q.assemble(ALL_SQL, final=(
    "SELECT status, count(*) AS check_count, count(DISTINCT table_name) AS table_count "
    "FROM qc_rows GROUP BY status")))
def q_qc_report_by_status(spark, d):
    from ..operators import reports
    return reports.qc_by_status(all_results(spark, d))


@register("qc_report_by_table", Q.assemble(ALL_SQL, final=(
    "SELECT table_name, count(*) AS total_checks, "
    "count(*) FILTER (WHERE status = 'PASS') AS passed, "
    "count(*) FILTER (WHERE status = 'FAIL') AS failed, "
    "count(*) FILTER (WHERE status = 'WARNING') AS warnings FROM qc_rows GROUP BY table_name")))
def q_qc_report_by_table(spark, d):
    from ..operators import reports
    return reports.qc_by_table(all_results(spark, d))


@register("qc_results_latest", Q.assemble(ALL_SQL, final=(
    "SELECT table_name, check_name, status, message, row_count, failed_rows, TIMESTAMP '2002-01-02 02:00:00' AS timestamp, "
    "'batch_20020102_020000_fixture' AS batch_id FROM qc_rows")))
def q_qc_results_latest(spark, d):
    """Results are appended to a results table (stamped with the run's
    batch id and check time), then the report reads the table."""
    import uuid
    from ..operators import reports
    from ..sinks import tables
    name = f"strata_q.validation_results_{uuid.uuid4().hex[:10]}"
    res = all_results(spark, d).select("*", L.QCTX.ts_lit().alias("checked_at"),
                                       L.QCTX.batch_lit().alias("batch_id"))
    tables.append(res, name, tag=L.QCTX.batch_id)
    stored = tables.read(spark, name).filter(F.col("batch_id") == L.QCTX.batch_id)
    return reports.qc_latest(stored)


# --------------------------------------------------- the scheduled job ----

LANDED = ".csv.gz"


def _stage_raw_landing(spark, d, folder):
    """The raw inputs as landed CSV files, compressed: one logical file per
    dimension and one per transaction load year."""
    from ..sources import files
    from ..sources import fixtures as fx
    for e in ("customers", "products", "stores"):
        files.stage_csv(fx.raw(spark, d, e, with_ts=False).withColumn("_file", F.lit(e)), folder, "_file", LANDED)
    t = fx.raw_transactions(spark, d)
    t = t.withColumn("_file", F.concat(F.lit("transactions_"), F.year("_record_ingestion_ts").cast("string")))
    files.stage_csv(t.drop("_record_ingestion_ts"), folder, "_file", LANDED)


@register("run_layers_validation", Q.assemble(ALL_SQL))
def q_run_layers_validation(spark, d):
    """The whole scheduled job over files landed from the test tables
    (CSV -> bronze -> silver with merge and watermark -> gold -> validation
    table), gates off so the failing checks are recorded instead of raised;
    returns the stored validation results of the run."""
    import uuid
    from datetime import datetime
    from ..context import RunContext
    from ..plans.run import Namespace, run_layers
    from ..session import scratch_path
    from ..sinks import tables
    ns = Namespace(f"strata_run_{uuid.uuid4().hex[:10]}")
    landing = scratch_path(spark, "landing")
    _stage_raw_landing(spark, d, landing)
    ctx = RunContext(as_of=datetime(2002, 1, 2, 2, 0, 0), batch_id="batch_run")
    run_layers(spark, ctx, landing, gate=False, validate=True, ns=ns, suffix=LANDED)
    stored = tables.read(spark, ns(TABLES["validation_results"])).filter(F.col("batch_id") == ctx.batch_id)
    return stored.select("seq", "table_name", "check_name", "status", "message", "row_count",
                         "failed_rows", "threshold", "actual_value")
