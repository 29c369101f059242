"""Single-operator queries: cleaning steps, dedup, measures, unions, keys,
counts, reports, type conformance and the rule dictionary."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from ..operators import cleaning, gold, qc, reports
from ..operators.audit import add_audit, add_bronze_audit, strip_audit
from ..operators.dedup import dedup
from ..plans.silver import DEDUP_ORDER, clean, to_silver
from ..schemas import TRANSACTIONS
from ..session import scratch_path
from ..sinks import tables
from ..sources import files
from ..sources import fixtures as fx
from ..specs import ENTITIES, TABLES, VALIDATION_RULES
from . import layers as L
from . import qc_sql as Q
from . import oracle as O
from .catalog import register
from .oracle import CTES, DEDUP, dedup_sql

TXD = TRANSACTIONS.fieldNames()
RIT = "_record_ingestion_ts"

# Cleaning steps -------------------------------------------------------------


@register("clean_trim", "SELECT trim(customer_id) AS customer_id, trim(name) AS name, signup_date, "
          "_record_ingestion_ts FROM bronze_customers")
def q_clean_trim(spark, d):
    b = strip_audit(L.bronze(spark, d, "customers"))
    return cleaning.trim_columns(b, ["customer_id", "name", "not_a_column"])


@register("clean_case", "SELECT * REPLACE (upper(channel) AS channel, upper(currency) AS currency, "
          "lower(sku) AS sku) FROM bronze_transactions")
def q_clean_case(spark, d):
    b = strip_audit(L.bronze(spark, d, "transactions"))
    return cleaning.standardize_case(cleaning.standardize_case(b, ["channel", "currency"], "upper"),
                                     ["sku"], "lower")


@register("fill_nulls", "SELECT * REPLACE (coalesce(quantity, 1) AS quantity, coalesce(unit_price, 0.0) "
          "AS unit_price, coalesce(discount, 0.0) AS discount, coalesce(currency, 'INR') AS currency) "
          "FROM bronze_transactions")
def q_fill_nulls(spark, d):
    b = strip_audit(L.bronze(spark, d, "transactions"))
    return cleaning.fill_nulls(b, ENTITIES["transactions"].defaults)


CTES["transactions_text"] = """
SELECT CASE WHEN blank THEN NULL ELSE transaction_id END AS transaction_id,
       CASE WHEN blank THEN NULL ELSE transaction_line_id END AS transaction_line_id,
       CASE WHEN blank THEN NULL WHEN _ok % 89 = 0 THEN 'unknown'
            ELSE strftime(transaction_ts, '%Y-%m-%d %H:%M:%S') END AS transaction_ts,
       CASE WHEN blank THEN NULL ELSE channel END AS channel,
       CASE WHEN blank THEN NULL ELSE store_id END AS store_id,
       CASE WHEN blank THEN NULL ELSE customer_id END AS customer_id,
       CASE WHEN blank THEN NULL ELSE sku END AS sku,
       CASE WHEN blank THEN NULL WHEN _ok % 61 = 0 THEN 'n/a' ELSE CAST(quantity AS VARCHAR) END AS quantity,
       CASE WHEN blank THEN NULL WHEN _ok % 67 = 0 THEN 'free'
            ELSE CAST(CAST(unit_price AS DECIMAL(12,2)) AS VARCHAR) END AS unit_price,
       CASE WHEN blank THEN NULL WHEN _ok % 71 = 0 THEN 'none'
            ELSE CAST(CAST(discount AS INTEGER) AS VARCHAR) END AS discount,
       CASE WHEN blank THEN NULL ELSE currency END AS currency
FROM (SELECT *, (_ok % 53 = 0 AND _ln = 1) AS blank FROM raw_transactions_k)"""

TYPES = {"transaction_ts": "timestamp_ntz", "quantity": "int", "unit_price": "double",
         "discount": "double"}


@register("convert_types", "SELECT * REPLACE (try_cast(transaction_ts AS TIMESTAMP) AS transaction_ts, "
          "try_cast(quantity AS INTEGER) AS quantity, try_cast(unit_price AS DOUBLE) AS unit_price, "
          "try_cast(discount AS DOUBLE) AS discount) FROM transactions_text")
def q_convert_types(spark, d):
    return cleaning.convert_types(fx.transactions_text(spark, d), TYPES)


@register("drop_all_null", "SELECT * FROM transactions_text WHERE NOT (" +
          " AND ".join(f"{c} IS NULL" for c in TXD) + ")")
def q_drop_all_null(spark, d):
    return cleaning.drop_all_null(fx.transactions_text(spark, d))


@register("parse_dates", "SELECT r.customer_id, r.signup_date AS signup_date_raw, b.signup_date "
          "FROM raw_customers r JOIN bronze_customers b ON r.customer_id = b.customer_id")
def q_parse_dates(spark, d):
    r = fx.raw_customers(spark, d, with_ts=False)
    return r.select("customer_id", F.col("signup_date").alias("signup_date_raw"),
                    "signup_date").transform(lambda df: cleaning.normalize_dates(df, "signup_date"))


AUDITED = ("DATE '2002-01-02' AS _ingestion_date, 'batch_20020102_020000_fixture' AS _batch_id, "
           "TIMESTAMP '2002-01-02 02:00:00' AS _updated_at, _record_ingestion_ts")


@register("audit_columns", f"SELECT store_id, name, region, {AUDITED}, 'stores.csv' AS _source_file FROM bronze_stores")
def q_audit_columns(spark, d):
    return add_bronze_audit(fx.raw_stores(spark, d), L.QCTX, record_ingestion_ts=F.col(RIT), source_file="stores.csv")


@register("drop_source_file", f"SELECT store_id, name, region, {AUDITED} FROM silver_stores")
def q_drop_source_file(spark, d):
    """Silver has all columns of bronze but the source file."""
    raw = fx.raw_stores(spark, d)
    return to_silver(add_bronze_audit(raw, L.QCTX, record_ingestion_ts=F.col(RIT), source_file="stores.csv"),
                     ENTITIES["stores"], L.QCTX)


# Dedup ---------------------------------------------------------------------

def _clean_tx(spark, d):
    return clean(L.bronze(spark, d, "transactions").drop("_source_file"), ENTITIES["transactions"])


@register("dedup_first", "SELECT * FROM silver_transactions")
def q_dedup_first(spark, d):
    return strip_audit(dedup(_clean_tx(spark, d), list(ENTITIES["transactions"].dedup_keys),
                             "first", list(DEDUP_ORDER)))


CTES["dedup_last_tx"] = dedup_sql("clean_transactions", *DEDUP["transactions"], desc=True)


@register("dedup_last", "SELECT * FROM dedup_last_tx")
def q_dedup_last(spark, d):
    return strip_audit(dedup(_clean_tx(spark, d), list(ENTITIES["transactions"].dedup_keys),
                             "last", list(DEDUP_ORDER)))


# Measures, unions, keys, counts ----------------------------------------------

@register("line_measures", f"SELECT transaction_id, transaction_line_id, {O.cents(O.net())} AS net_amount, "
          f"{O.cents(O.disc())} AS discount_amount FROM silver_transactions")
def q_line_measures(spark, d):
    return gold.line_measures(L.silver(spark, d, "transactions"))


@register("union_batches", "SELECT " + ", ".join(TXD) + ", 'transactions_' || CAST(year(_record_ingestion_ts) AS VARCHAR)"
          " AS source_name FROM bronze_transactions")
def q_union_batches(spark, d):
    """Landed files read one by one and put together by column name: what the
    single scan of all of them gives."""
    folder = scratch_path(spark, "landing")
    t = fx.raw_transactions(spark, d)
    named = t.withColumn("_file", F.concat(F.lit("transactions_"), F.year(RIT).cast("string")))
    files.stage_csv(named.select(*TXD, "_file"), folder, "_file")
    paths = [r.path for r in files.list_files(spark, folder).select("path").collect()]
    frames = [files.read_csv(spark, [p], TRANSACTIONS) for p in paths]
    read = cleaning.drop_all_null(reduce(lambda a, b: a.unionByName(b), frames), subset=TXD)
    return read.select(*TXD, files.logical_name().alias("source_name"))


@register("latest_batch", "SELECT arg_max('batch_' || CAST(year(_record_ingestion_ts) AS VARCHAR), "
          "(CAST(_record_ingestion_ts AS DATE), _record_ingestion_ts)) AS latest_batch_id "
          "FROM bronze_transactions")
def q_latest_batch(spark, d):
    b = L.bronze(spark, d, "transactions").withColumns({
        "_batch_id": F.concat(F.lit("batch_"), F.year(RIT).cast("string")),
        "_ingestion_date": F.to_date(RIT), "_updated_at": F.col(RIT)})
    return reports.latest_batch(b)


@register("distinct_keys", "SELECT DISTINCT customer_id FROM silver_transactions WHERE customer_id IS NOT NULL")
def q_distinct_keys(spark, d):
    return (L.silver(spark, d, "transactions").filter(F.col("customer_id").isNotNull())
             .select("customer_id").distinct())


_COUNT_SRC = ([(TABLES["bronze"][e], f"bronze_{e}") for e in ENTITIES]
              + [(TABLES["silver"][e], f"silver_{e}") for e in ENTITIES]
              + [(TABLES["gold"][m], f"gold_{m}") for m in TABLES["gold"]])


@register("table_row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {c}" for t, c in _COUNT_SRC))
def q_table_row_counts(spark, d):
    """The layers written as tables, each from the tables of the one before,
    and counted there."""
    db, stored = f"strata_q_{uuid.uuid4().hex[:10]}", {}

    def put(layer, frames):
        out = {}
        for e, df in frames.items():
            name = f"{db}.{TABLES[layer][e].replace('.', '__')}"
            tables.publish(df, name)
            out[e] = stored[TABLES[layer][e]] = tables.read(spark, name)
        return out

    bronze = put("bronze", {e: L.bronze(spark, d, e) for e in L.ENTITY_NAMES})
    silver = put("silver", {e: to_silver(df, ENTITIES[e], L.QCTX) for e, df in bronze.items()})
    put("gold", L.marts(silver))
    return reports.row_counts(stored)


# Reports -----------------------------------------------------------------------

@register("report_top_customers", "SELECT customer_id, name, total_sales, total_transactions, total_quantity "
          "FROM gold_customer_summary ORDER BY total_sales DESC, customer_id LIMIT 10")
def q_report_top_customers(spark, d):
    return reports.top_customers(L.gold_mart(spark, d, "customer_summary"))


@register("report_top_products", "SELECT sku, category, total_revenue, total_quantity_sold, unique_customers "
          "FROM gold_product_sales ORDER BY total_revenue DESC, sku LIMIT 10")
def q_report_top_products(spark, d):
    return reports.top_products(L.gold_mart(spark, d, "product_sales"))


@register("report_daily_trend", "SELECT sale_date, _record_ingestion_ts, total_revenue, total_transactions, "
          "unique_customers, avg_transaction_value FROM gold_daily_sales "
          "ORDER BY sale_date DESC, _record_ingestion_ts DESC LIMIT 30")
def q_report_daily_trend(spark, d):
    return reports.daily_trend(L.gold_mart(spark, d, "daily_sales"))


@register("report_region", "SELECT region, count(*) AS store_count, "
          "CAST(round(CAST(sum(CAST(total_revenue AS DECIMAL(20,2)) * 100) AS DECIMAL(36,4)) * 0.01, 2) "
          "AS DOUBLE) AS total_revenue, CAST(sum(total_transactions) AS BIGINT) AS total_transactions, "
          "(round(CAST(sum(CAST(avg_transaction_value AS DECIMAL(20,2))) * 100 AS DOUBLE) / "
          "count(avg_transaction_value)) / CAST(100 AS DOUBLE)) "
          "AS avg_transaction_value FROM gold_store_performance GROUP BY region")
def q_report_region(spark, d):
    return reports.store_region(L.gold_mart(spark, d, "store_performance"))


# Type conformance and the rule dictionary ---------------------------------------

SCHEMA_MSG = ("Type mismatches: transaction_ts: expected timestamp_ntz, got string, quantity: expected int, "
              "got string, unit_price: expected double, got string, discount: expected double, got string")
_TYPED = [("transaction_ts", "TIMESTAMP", "timestamp_ntz"), ("quantity", "INTEGER", "int"),
          ("unit_price", "DOUBLE", "double"), ("discount", "DOUBLE", "double")]


@register("qc_type_conformance", Q.assemble([
    ([], [Q.row(1, "raw.transactions_csv", "schema_check", "'WARNING'", Q.q(SCHEMA_MSG))]),
    Q.type_conformance("transactions_text", "raw.transactions_csv", _TYPED, 1, "a")]))
def q_qc_type_conformance(spark, d):
    folder = scratch_path(spark, "landing")
    t = fx.transactions_text(spark, d).withColumn("_file", F.lit("transactions_text"))
    files.stage_csv(t, folder, "_file")
    text_schema = ", ".join(f"{c} string" for c in TXD)
    text = files.read_csv(spark, [folder], schema=text_schema).drop("_source_path")  # its schema alone is looked at
    typed = files.read_csv(spark, [folder], TRANSACTIONS, corrupt=True)
    return qc.union_all([qc.check_schema(text, "raw.transactions_csv", TRANSACTIONS, seq=1),
                         qc.check_captured(typed, "raw.transactions_csv", TRANSACTIONS, files.as_text(TRANSACTIONS), seq_start=1)])


@register("qc_type_conformance_text", Q.assemble([Q.type_conformance("transactions_text", "raw.transactions_csv", _TYPED, 0, "a")]))
def q_qc_type_conformance_text(spark, d):
    """The same counts from a frame of text."""
    return qc.check_type_conformance(fx.transactions_text(spark, d), "raw.transactions_csv", TRANSACTIONS)


def _rules_sql():
    parts = []
    cols = {"customers": ["customer_id", "name", "signup_date"],
            "products": ["sku", "product_key", "category", "list_price"],
            "stores": ["store_id", "name", "region"],
            "transactions": TXD}
    for i, (e, rules) in enumerate(VALIDATION_RULES.items()):
        src, table = f"silver_{e}", TABLES["silver"][e]
        seq = 0
        sels, ctes = [], []
        req = rules.get("required_columns", [])
        if req:
            seq += 1
            missing = [x for x in req if x not in cols[e]]
            sels.append(Q.row(seq, table, "required_columns", "'FAIL'" if missing else "'PASS'",
                              Q.q(f"Missing required columns: {missing}" if missing
                                  else "All required columns present")))
        spec = {}
        if rules.get("not_null_columns"):
            spec["nulls"] = {"columns": rules["not_null_columns"], "max_null_percentage": 0.0}
        if rules.get("unique_columns"):
            spec["duplicates"] = {"key_columns": rules["unique_columns"], "max_duplicate_percentage": 0.0}
        if rules.get("min_values"):
            spec["value_ranges"] = {c: {"min_value": v} for c, v in rules["min_values"].items()}
        c2, s2 = Q.evaluate(src, table, spec, cols[e], seq_start=seq, tag=f"r{i}")
        seq += len(s2)
        ctes += c2
        sels += s2
        typed = [(c, "DATE", "date", "date_format") for c in rules.get("date_columns", [])] + \
                [(c, "DOUBLE", "double", "numeric") for c in rules.get("numeric_columns", [])]
        if typed:
            metrics = ["count(*) AS n"] + [
                f"count(*) FILTER (WHERE {c} IS NOT NULL AND try_cast({c} AS {t}) IS NULL) AS k{j}"
                for j, (c, t, _, _) in enumerate(typed)]
            a = f"rt_{i}"
            ctes.append(f"{a} AS (SELECT {', '.join(metrics)} FROM {src})")
            for j, (c, t, label, prefix) in enumerate(typed):
                seq += 1
                k = f"k{j}"
                sels.append(Q.row(
                    seq, table, f"{prefix}_{c}", f"CASE WHEN {k} > 0 THEN 'FAIL' ELSE 'PASS' END",
                    f"CASE WHEN {k} > 0 THEN 'Found ' || CAST({k} AS VARCHAR) || "
                    f"{Q.q(f' values in {c} that are not a valid {label}')} "
                    f"ELSE {Q.q(f'All values in {c} are valid {label}')} END",
                    "n", f"CASE WHEN {k} > 0 THEN {k} END", Q.ND,
                    f"CASE WHEN {k} > 0 THEN CAST({k} AS DOUBLE) / CAST(n AS DOUBLE) END", a))
        for j, (fk_col, target) in enumerate((rules.get("foreign_keys") or {}).items()):
            seq += 1
            ref_e, ref_key = target.split(".", 1)
            c3, s3 = Q.fk(src, table, fk_col, f"silver_{ref_e}", ref_key, seq, f"r{i}_{j}", False)
            ctes += c3
            sels += s3
        parts.append((ctes, sels))
    return Q.assemble(parts)


@register("qc_rules_dict", _rules_sql())
def q_qc_rules_dict(spark, d):
    silver = {e: L.silver(spark, d, e) for e in ENTITIES}
    return qc.union_all([qc.evaluate_rules(silver[e], TABLES["silver"][e], rules, silver)
                         for e, rules in VALIDATION_RULES.items()])


# Rows behind a failed foreign-key check -----------------------------------------
#
# Reference rows whose key ends in 7 land late: until then the facts that name
# them are orphans, beside those whose key no reference row ever has.

def _orphans_sql(fk: str, ref: str, key: str) -> str:
    return (f"SELECT t.* FROM silver_transactions t WHERE t.{fk} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM silver_{ref} r WHERE r.{key} = t.{fk} AND right(r.{key}, 1) <> '7')")


def _orphans(fk: str, ref: str, key: str):
    def fn(spark, d):
        landed = L.silver(spark, d, ref).filter(F.right(key, F.lit(1)) != "7")
        return qc.orphan_rows(L.data(L.silver(spark, d, "transactions")), fk, landed, key)
    return fn


for _fk, _ref, _key, _ in ENTITIES["transactions"].foreign_keys:
    register(f"fk_orphans_{_ref}", _orphans_sql(_fk, _ref, _key))(_orphans(_fk, _ref, _key))
