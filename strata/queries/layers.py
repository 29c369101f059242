"""The layers built from the given test tables, as lazy DataFrames.

bronze = raw entity -> drop blank rows -> audit stamp -> date normalization
silver = bronze -> clean -> dedup -> audit re-stamp
gold   = marts over silver
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import RunContext
from ..operators import cleaning, gold
from ..operators.audit import add_bronze_audit, strip_audit
from ..plans.silver import to_silver
from ..schemas import ENTITY_SCHEMAS
from ..sinks import tables
from ..sources import fixtures
from ..specs import ENTITIES

# One fixed run context so registered queries are deterministic.
QCTX = RunContext(as_of=datetime(2002, 1, 2, 2, 0, 0), batch_id="batch_20020102_020000_fixture")


def bronze(spark: SparkSession, d: str, entity: str) -> DataFrame:
    df = fixtures.raw(spark, d, entity)
    df = cleaning.drop_all_null(df, subset=ENTITY_SCHEMAS[entity].fieldNames())
    df = add_bronze_audit(df, QCTX, record_ingestion_ts=F.col("_record_ingestion_ts"))
    return cleaning.normalize_dates(df, "signup_date")


def silver(spark: SparkSession, d: str, entity: str) -> DataFrame:
    return to_silver(bronze(spark, d, entity), ENTITIES[entity], QCTX)


def gold_mart(spark: SparkSession, d: str, mart: str) -> DataFrame:
    tx = silver(spark, d, "transactions")
    if mart == "customer_summary":
        return gold.customer_summary(silver(spark, d, "customers"), tx)
    if mart == "product_sales":
        # Reads the transactions several times: they are written once.
        return gold.product_sales(silver(spark, d, "products"), tables.materialize(tx, "silver-tx"))
    if mart == "store_performance":
        return gold.store_performance(silver(spark, d, "stores"), tx)
    if mart == "daily_sales":
        return gold.daily_sales(tx)
    raise KeyError(mart)


ENTITY_NAMES = ("customers", "products", "stores", "transactions")
MART_NAMES = ("customer_summary", "product_sales", "store_performance", "daily_sales")


def build_all(spark: SparkSession, d: str, materialize: bool = True) -> dict:
    """All three layers; with ``materialize`` each layer is written once to
    the shared folder and the next layer (and every check) reads it, as the
    scheduled job does with its tables."""
    def keep(df, purpose, entity):
        # Only the fact table has enough consumers to pay for a write; the
        # dimensions are re-derived (each is a small scan + projection).
        return tables.materialize(df, purpose) if materialize and entity == "transactions" else df
    b = {e: keep(bronze(spark, d, e), f"bronze-{e}", e) for e in ENTITY_NAMES}
    s = {e: keep(to_silver(b[e], ENTITIES[e], QCTX), f"silver-{e}", e) for e in ENTITY_NAMES}
    return {"bronze": b, "silver": s, "gold": marts(s)}


def marts(s: dict) -> dict:
    """The four marts over silver frames."""
    tx = s["transactions"]
    return {
        "customer_summary": gold.customer_summary(s["customers"], tx),
        "product_sales": gold.product_sales(s["products"], tx),
        "store_performance": gold.store_performance(s["stores"], tx),
        "daily_sales": gold.daily_sales(tx),
    }


def data(df: DataFrame) -> DataFrame:
    """Drop run-specific audit stamps (batch id, stamp times) from output."""
    return strip_audit(df)
