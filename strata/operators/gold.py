"""Gold marts: one grouped aggregate over silver transactions, left-joined
to its dimension, with zero-filled measures for dimension rows that had no
sales.

Plan shape (per mart): Parquet scan with pruned columns -> partial
HashAggregate -> Exchange(key) -> final HashAggregate -> join with the
dimension.  ``count(DISTINCT ..)`` uses Catalyst's distinct rewrite, whose
first shuffle is keyed on (group key, distinct value), so a hot group key is
spread over many tasks.  That rewrite puts all measures on every row of every
distinct column, and where the groups are many and small neither shuffle
reduces anything; the product mart counts each column from its (key, value)
pairs alone (:func:`_with_distinct_counts`).  The join strategy is left to AQE: it broadcasts a
side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merge joins.

Money is summed exactly (see functions.money).

``distinct`` is what counts distinct values of a column: exactly by default,
or ``sketches.approx_distinct``, which needs no second shuffle and no row for
each group and value.

With ``gather`` (``sinks.gathered``) the columns that a mart reads are first
brought together by its key, and a task counts a key's distinct values as sets:
no pair and no partial sum is shuffled.  Keys with very many rows take the plan
above.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money

Distinct = Callable[[str], Column]
Gather = Callable[[DataFrame, Sequence[str]], tuple[DataFrame, DataFrame | None]]

NET = "__net_x100"
DISC = "__disc_x100"


def _with_line_measures(tx: DataFrame) -> DataFrame:
    return tx.withColumns({
        NET: money.line_net_x100("unit_price", "quantity", "discount"),
        DISC: money.line_discount_x100("unit_price", "quantity", "discount"),
    })


def _money_aggs(revenue_name: str, avg_line_name: str | None) -> list:
    aggs = [
        F.sum(NET).alias("__net_sum"),
        F.sum(DISC).alias("__disc_sum"),
    ]
    if avg_line_name:
        aggs.append(F.count(NET).alias("__net_n"))
    return aggs


def _finish_money(df: DataFrame, revenue_name: str, avg_line_name: str | None) -> DataFrame:
    cols = {revenue_name: money.cents("__net_sum"), "total_discount": money.cents("__disc_sum")}
    if avg_line_name:
        cols[avg_line_name] = money.mean_cents_from_x100("__net_sum", "__net_n")
    return df.withColumns(cols).drop("__net_sum", "__disc_sum", "__net_n")


def _size_of_set(column: str) -> Column:
    return F.size(F.collect_set(column)).cast("long")


def _stats(stats: Callable[[DataFrame, Distinct], DataFrame], tx: DataFrame, distinct: Distinct, gather: Gather | None,
           keys: Sequence[str], reads: Sequence[str]) -> DataFrame:
    """``stats`` of ``tx``, which groups by ``keys`` and reads ``reads`` besides.
    Approximate counts are small states: gathering rows would not help them."""
    if gather is None or distinct is not F.count_distinct:
        return stats(tx, distinct)
    near, spread = gather(tx.select(*keys, *reads), keys)
    out = stats(near, _size_of_set)
    return out if spread is None else out.unionByName(stats(spread, distinct))


_LINE = ("quantity", "unit_price", "discount")


def customer_stats(tx: DataFrame, distinct: Distinct = F.count_distinct) -> DataFrame:
    t = _with_line_measures(tx.filter(F.col("customer_id").isNotNull()))
    agg = t.groupBy("customer_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        distinct("transaction_id").alias("unique_transactions"),
        F.sum("quantity").cast("long").alias("total_quantity"),
        *_money_aggs("total_sales", None),
        money.price_sum("unit_price").alias("__price_sum"),
        F.count("unit_price").alias("__price_n"),
        F.max("transaction_ts").alias("last_transaction_date"),
    )
    agg = _finish_money(agg, "total_sales", None)
    return (agg.withColumn("avg_unit_price", money.mean_price("__price_sum", "__price_n"))
               .drop("__price_sum", "__price_n"))


def customer_summary(customers: DataFrame, tx: DataFrame, distinct: Distinct = F.count_distinct, gather: Gather | None = None) -> DataFrame:
    """G1: one row per silver customer."""
    s = _stats(customer_stats, tx.filter(F.col("customer_id").isNotNull()), distinct, gather, ["customer_id"],
               ["transaction_id", *_LINE, "transaction_ts"])
    c = customers.select("customer_id", "name", "signup_date", "_record_ingestion_ts")
    j = c.join(s, "customer_id", "left")
    return j.select(
        "customer_id", "name", "signup_date",
        F.coalesce("total_transactions", F.lit(0).cast("long")).alias("total_transactions"),
        F.coalesce("unique_transactions", F.lit(0).cast("long")).alias("unique_transactions"),
        F.coalesce("total_quantity", F.lit(0).cast("long")).alias("total_quantity"),
        F.coalesce("total_sales", F.lit(0.0)).alias("total_sales"),
        F.coalesce("total_discount", F.lit(0.0)).alias("total_discount"),
        F.coalesce("avg_unit_price", F.lit(0.0)).alias("avg_unit_price"),
        "last_transaction_date", "_record_ingestion_ts")


def _with_distinct_counts(t: DataFrame, key: str, aggs: list, distinct: Distinct, counts: dict[str, str]) -> DataFrame:
    """``t`` (no NULL ``key``) grouped by ``key``: ``aggs`` and, by name, the
    distinct values of columns.  Exact counts read ``t`` once for each column:
    its pairs with the key are all that is held and shuffled."""
    if distinct is not F.count_distinct:
        return t.groupBy(key).agg(*aggs, *[distinct(c).alias(name) for name, c in counts.items()])
    out = t.groupBy(key).agg(*aggs)
    for name, c in counts.items():
        pairs = t.filter(F.col(c).isNotNull()).select(key, c).distinct()
        out = out.join(pairs.groupBy(key).agg(F.count(F.lit(1)).alias(name)), key, "left")
    return out.withColumns({name: F.coalesce(name, F.lit(0).cast("long")) for name in counts})


def product_stats(tx: DataFrame, distinct: Distinct = F.count_distinct) -> DataFrame:
    """One row per sku (rows without one are left out)."""
    t = _with_line_measures(tx.filter(F.col("sku").isNotNull()))
    agg = _with_distinct_counts(t, "sku", [
        F.count("transaction_id").alias("total_transactions"),
        F.sum("quantity").cast("long").alias("total_quantity_sold"),
        *_money_aggs("total_revenue", None),
        money.price_sum("unit_price").alias("__price_sum"),
        F.count("unit_price").alias("__price_n"),
        F.round(F.min("unit_price"), 2).alias("min_selling_price"),
        F.round(F.max("unit_price"), 2).alias("max_selling_price"),
    ], distinct, {"unique_transactions": "transaction_id", "unique_customers": "customer_id", "unique_stores": "store_id"})
    agg = _finish_money(agg, "total_revenue", None)
    return (agg.withColumn("avg_selling_price", money.mean_price("__price_sum", "__price_n"))
               .drop("__price_sum", "__price_n"))


def product_sales(products: DataFrame, tx: DataFrame, distinct: Distinct = F.count_distinct, gather: Gather | None = None) -> DataFrame:
    """G2: one row per silver product (the NULL-sku group never joins)."""
    s = _stats(product_stats, tx.filter(F.col("sku").isNotNull()), distinct, gather, ["sku"],
               ["transaction_id", "customer_id", "store_id", *_LINE])
    p = products.select("sku", "product_key", "category", "list_price", "_record_ingestion_ts")
    j = p.join(s, "sku", "left")
    z, zd = F.lit(0).cast("long"), F.lit(0.0)
    return j.select(
        "sku", "product_key", "category", "list_price",
        F.coalesce("total_transactions", z).alias("total_transactions"),
        F.coalesce("unique_transactions", z).alias("unique_transactions"),
        F.coalesce("total_quantity_sold", z).alias("total_quantity_sold"),
        F.coalesce("total_revenue", zd).alias("total_revenue"),
        F.coalesce("total_discount", zd).alias("total_discount"),
        F.coalesce("avg_selling_price", zd).alias("avg_selling_price"),
        F.coalesce("min_selling_price", zd).alias("min_selling_price"),
        F.coalesce("max_selling_price", zd).alias("max_selling_price"),
        F.coalesce("unique_customers", z).alias("unique_customers"),
        F.coalesce("unique_stores", z).alias("unique_stores"),
        "_record_ingestion_ts")


def store_stats(tx: DataFrame, distinct: Distinct = F.count_distinct) -> DataFrame:
    t = _with_line_measures(tx.filter(F.col("store_id").isNotNull()))
    agg = t.groupBy("store_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        distinct("transaction_id").alias("unique_transactions"),
        distinct("customer_id").alias("unique_customers"),
        distinct("sku").alias("unique_products"),
        F.sum("quantity").cast("long").alias("total_quantity_sold"),
        *_money_aggs("total_revenue", "avg_transaction_value"),
        F.max("transaction_ts").alias("last_transaction_date"),
    )
    return _finish_money(agg, "total_revenue", "avg_transaction_value")


def store_performance(stores: DataFrame, tx: DataFrame, distinct: Distinct = F.count_distinct, gather: Gather | None = None) -> DataFrame:
    """G3: one row per silver store."""
    s = _stats(store_stats, tx.filter(F.col("store_id").isNotNull()), distinct, gather, ["store_id"],
               ["transaction_id", "customer_id", "sku", *_LINE, "transaction_ts"])
    st = stores.select("store_id", "name", "region", "_record_ingestion_ts")
    j = st.join(s, "store_id", "left")
    z, zd = F.lit(0).cast("long"), F.lit(0.0)
    return j.select(
        "store_id", "name", "region",
        F.coalesce("total_transactions", z).alias("total_transactions"),
        F.coalesce("unique_transactions", z).alias("unique_transactions"),
        F.coalesce("unique_customers", z).alias("unique_customers"),
        F.coalesce("unique_products", z).alias("unique_products"),
        F.coalesce("total_quantity_sold", z).alias("total_quantity_sold"),
        F.coalesce("total_revenue", zd).alias("total_revenue"),
        F.coalesce("total_discount", zd).alias("total_discount"),
        F.coalesce("avg_transaction_value", zd).alias("avg_transaction_value"),
        "last_transaction_date", "_record_ingestion_ts")


def daily_stats(tx: DataFrame, distinct: Distinct = F.count_distinct) -> DataFrame:
    t = _with_line_measures(tx)
    agg = t.groupBy("sale_date", "_record_ingestion_ts").agg(
        F.count("transaction_id").alias("total_transactions"),
        distinct("transaction_id").alias("unique_transactions"),
        distinct("customer_id").alias("unique_customers"),
        distinct("store_id").alias("unique_stores"),
        distinct("sku").alias("unique_products"),
        F.sum("quantity").cast("long").alias("total_quantity_sold"),
        *_money_aggs("total_revenue", "avg_transaction_value"),
        F.max("transaction_ts").alias("last_transaction_time"),
    )
    return _finish_money(agg, "total_revenue", "avg_transaction_value")


def daily_sales(tx: DataFrame, distinct: Distinct = F.count_distinct, gather: Gather | None = None) -> DataFrame:
    """G4: one row per (sale date, load batch); a day that arrived in two
    loads has two rows, and NULL timestamps form their own group."""
    return _stats(daily_stats, tx.withColumn("sale_date", F.to_date("transaction_ts")), distinct, gather,
                  ["sale_date", "_record_ingestion_ts"], ["transaction_id", "customer_id", "store_id", "sku", *_LINE, "transaction_ts"])


def line_measures(tx: DataFrame) -> DataFrame:
    """P11: per-line net and discount amounts in cents."""
    return tx.select(
        "transaction_id", "transaction_line_id",
        money.line_net("unit_price", "quantity", "discount").alias("net_amount"),
        money.line_discount("unit_price", "quantity", "discount").alias("discount_amount"))
