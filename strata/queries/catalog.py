"""Registry of queries: name -> (Spark builder, oracle SQL or None).

Every builder takes (spark, sf_dir) and returns a lazy DataFrame over the
given tables (or files/tables Spark writes from them)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import layers as L
from . import oracle as O

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    if sql and not sql.lstrip().upper().startswith("WITH"):
        sql = O.with_ctes(sql)

    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql or None)
        return fn
    return deco


# ---------------------------------------------------------------- gold ----

@register("gold_customer_summary", "SELECT * FROM gold_customer_summary")
def q_gold_customer_summary(spark, d):
    return L.gold_mart(spark, d, "customer_summary")


@register("gold_product_sales", "SELECT * FROM gold_product_sales")
def q_gold_product_sales(spark, d):
    return L.gold_mart(spark, d, "product_sales")


@register("gold_store_performance", "SELECT * FROM gold_store_performance")
def q_gold_store_performance(spark, d):
    return L.gold_mart(spark, d, "store_performance")


@register("gold_daily_sales", "SELECT * FROM gold_daily_sales")
def q_gold_daily_sales(spark, d):
    return L.gold_mart(spark, d, "daily_sales")


# -------------------------------------------------------------- silver ----

for _e in ("customers", "products", "stores", "transactions"):
    def _mk(e):
        def fn(spark, d):
            return L.data(L.silver(spark, d, e))
        fn.__name__ = f"q_silver_{e}"
        return fn
    register(f"silver_{_e}", f"SELECT * FROM silver_{_e}")(_mk(_e))


@register("bronze_customers", "SELECT * FROM bronze_customers")
def q_bronze_customers(spark, d):
    return L.data(L.bronze(spark, d, "customers"))


def queries() -> dict[str, Builder]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1]}


# Query groups register themselves on import.
from . import q_quality  # noqa: E402,F401
from . import q_io  # noqa: E402,F401
from . import q_ops  # noqa: E402,F401
