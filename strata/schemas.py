"""Fixed schemas of the data model.

Timestamps are TIMESTAMP_NTZ throughout: ingestion and transaction times are
wall-clock values, and a time-zone-free type keeps date keys independent of
the session or machine time zone.
"""

from __future__ import annotations

from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType,
                               TimestampNTZType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, I, L, D = StringType(), IntegerType(), LongType(), DoubleType()
TS, DT = TimestampNTZType(), DateType()

# Data columns of each landed CSV file (what a typed scan reads).
CUSTOMERS = _s(("customer_id", S), ("name", S), ("signup_date", S))
PRODUCTS = _s(("sku", S), ("product_key", S), ("category", S), ("list_price", D))
STORES = _s(("store_id", S), ("name", S), ("region", S))
TRANSACTIONS = _s(
    ("transaction_id", S), ("transaction_line_id", S), ("transaction_ts", TS),
    ("channel", S), ("store_id", S), ("customer_id", S), ("sku", S),
    ("quantity", I), ("unit_price", D), ("discount", D), ("currency", S))

ENTITY_SCHEMAS = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "stores": STORES,
    "transactions": TRANSACTIONS,
}

# Audit columns stamped by the engine (never read from a file).
AUDIT_BRONZE = _s(("_ingestion_date", DT), ("_batch_id", S), ("_updated_at", TS),
                  ("_record_ingestion_ts", TS), ("_source_file", S))


def bronze_schema(entity: str) -> StructType:
    return StructType(ENTITY_SCHEMAS[entity].fields + AUDIT_BRONZE.fields)


# One row per check; batch_id/checked_at are stamped by the sink.
QC_RESULT = _s(("seq", I), ("table_name", S), ("check_name", S), ("status", S),
               ("message", S), ("row_count", L), ("failed_rows", L),
               ("threshold", D), ("actual_value", D))
QC_RESULT_STORED = StructType(QC_RESULT.fields + [
    StructField("checked_at", TS, True), StructField("batch_id", S, True)])

# File ledger and load audit (watermark) tables.  The ledger is shared by all
# bronze tables; ``table_name`` is the one a batch belongs to.
PROCESSED_FILES = _s(("file_path", S), ("batch_id", S), ("row_count", L),
                     ("processed_at", TS), ("table_name", S))
LOAD_AUDIT = _s(("batch_id", S), ("table_name", S), ("log_ts", TS),
                ("start_time", TS), ("end_time", TS))

QC_STATUSES = ("PASS", "FAIL", "WARNING")
