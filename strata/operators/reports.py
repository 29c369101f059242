"""Reporting queries over gold marts, QC results and the load audit.

Top-k reports use ``orderBy(..).limit(k)`` (planned as TakeOrderedAndProject:
each task keeps its own top k, the driver merges k x tasks rows) with a
unique key as the last sort column so ties do not make the output random.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import money


# QC results ----------------------------------------------------------------

def qc_latest(results: DataFrame) -> DataFrame:
    """The stored results, in eight columns."""
    return (results.select("table_name", "check_name", "status", "message", "row_count",
                           "failed_rows", F.col("checked_at").alias("timestamp"), "batch_id")
                   .orderBy("table_name", "check_name"))


def qc_by_status(results: DataFrame) -> DataFrame:
    return (results.groupBy("status")
                   .agg(F.count(F.lit(1)).alias("check_count"),
                        F.count_distinct("table_name").alias("table_count"))
                   .orderBy("status"))


def qc_by_table(results: DataFrame) -> DataFrame:
    s = F.col("status")
    return (results.groupBy("table_name")
                   .agg(F.count(F.lit(1)).alias("total_checks"),
                        F.count_if(s == "PASS").alias("passed"),
                        F.count_if(s == "FAIL").alias("failed"),
                        F.count_if(s == "WARNING").alias("warnings"))
                   .orderBy("table_name"))


# Gold ---------------------------------------------------------------------

def top_customers(summary: DataFrame, k: int = 10) -> DataFrame:
    return (summary.select("customer_id", "name", "total_sales", "total_transactions",
                           "total_quantity")
                   .orderBy(F.col("total_sales").desc(), F.col("customer_id").asc())
                   .limit(k))


def top_products(sales: DataFrame, k: int = 10) -> DataFrame:
    return (sales.select("sku", "category", "total_revenue", "total_quantity_sold",
                         "unique_customers")
                 .orderBy(F.col("total_revenue").desc(), F.col("sku").asc())
                 .limit(k))


def daily_trend(daily: DataFrame, k: int = 30) -> DataFrame:
    return (daily.select("sale_date", "_record_ingestion_ts", "total_revenue",
                         "total_transactions", "unique_customers", "avg_transaction_value")
                 .orderBy(F.col("sale_date").desc(), F.col("_record_ingestion_ts").desc())
                 .limit(k))


def store_region(perf: DataFrame) -> DataFrame:
    """Per region: store count, revenue, transactions and the mean of the
    stores' average line value (exact sums, cents rounded once)."""
    return (perf.groupBy("region")
                .agg(F.count(F.lit(1)).alias("store_count"),
                     money.cents(F.sum(F.col("total_revenue").cast("decimal(20,2)") * 100))
                     .alias("total_revenue"),
                     F.sum("total_transactions").alias("total_transactions"),
                     money.mean_price(F.sum(F.col("avg_transaction_value").cast("decimal(20,2)")),
                                      F.count("avg_transaction_value")).alias("avg_transaction_value"))
                .orderBy(F.col("total_revenue").desc(), "region"))


# Tables ---------------------------------------------------------------------

def latest_batch(df: DataFrame) -> DataFrame:
    """Batch id of the newest load by (_ingestion_date, _updated_at): one
    partial/final aggregate, no sort of the table."""
    return df.agg(F.max_by("_batch_id", F.struct("_ingestion_date", "_updated_at"))
                  .alias("latest_batch_id"))


def row_counts(frames: dict) -> DataFrame:
    """One row per table: a one-row count per table, unioned."""
    out = None
    for name, df in frames.items():
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"),
                                                                  "row_count")
        out = c if out is None else out.unionByName(c)
    return out
