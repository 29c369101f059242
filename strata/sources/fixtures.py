"""The given TPC-H-style test tables, reshaped into the four raw retail
inputs (customers, products, stores, transactions).

Defects (NULLs, padding, mixed case, unparseable dates, orphans, duplicate
keys, out-of-range prices) are injected deterministically from the keys so
that every failure path of the engine is exercised on real volumes.  The
mapping is plain column expressions plus two joins: it scales with the
tables and pushes column pruning into the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the dimension files are loaded once, at this ingestion time.
DIMENSION_LOAD_TS = "1995-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _dim_ts() -> Column:
    return F.lit(DIMENSION_LOAD_TS).cast("timestamp_ntz")


def raw_customers(spark: SparkSession, sf_dir: str, with_ts: bool = True) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    day = F.lpad(_s(1 + k % 28), 2, "0")
    month = F.lpad(_s(1 + k % 12), 2, "0")
    signup = (F.when(k % 3 == 0, F.concat(day, F.lit("/"), month, F.lit("/"), _s(2015 + k % 10)))
               .when(k % 3 == 1, F.concat(day, F.lit("/"), month, F.lit("/"), _s(15 + k % 10)))
               .otherwise(F.lit("n/a")))
    cols = [
        F.concat(F.lit(" c"), _s(k), F.lit(" ")).alias("customer_id"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("c_name"), F.lit(" "))).alias("name"),
        signup.alias("signup_date"),
    ]
    if with_ts:
        cols.append(_dim_ts().alias("_record_ingestion_ts"))
    return c.select(*cols)


def raw_products(spark: SparkSession, sf_dir: str, with_ts: bool = True) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    cols = [
        F.concat(F.lit("sku-"), _s(k)).alias("sku"),
        F.concat(F.lit("pk-"), _s(k)).alias("product_key"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("category"),
        F.when(k % 19 == 0, F.lit(None).cast("double")).otherwise(F.col("p_retailprice")).alias("list_price"),
    ]
    if with_ts:
        cols.append(_dim_ts().alias("_record_ingestion_ts"))
    return p.select(*cols)


def raw_stores(spark: SparkSession, sf_dir: str, with_ts: bool = True) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # No hint: AQE broadcasts nation/region after measuring them.
    j = (s.join(n, s.s_nationkey == n.n_nationkey)
          .join(r, F.col("n_regionkey") == r.r_regionkey))
    cols = [F.concat(F.lit("s"), _s("s_suppkey")).alias("store_id"),
            F.col("s_name").alias("name"), F.col("r_name").alias("region")]
    if with_ts:
        cols.append(_dim_ts().alias("_record_ingestion_ts"))
    return j.select(*cols)


def raw_transactions(spark: SparkSession, sf_dir: str, with_ts: bool = True,
                     keep_keys: bool = False) -> DataFrame:
    """lineitem joined to orders on the order key (a shuffle join on both big
    tables; AQE picks broadcast only if orders turns out small)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    is_open = F.col("l_linestatus") == "O"
    cols = [
        F.concat(F.lit("t"), _s(ok)).alias("transaction_id"),
        _s("l_linenumber").alias("transaction_line_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("transaction_ts"),
        F.when(is_open, F.lit("ecom")).otherwise(F.lit(" pos")).alias("channel"),
        F.when(is_open, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("s"), _s(sk))).alias("store_id"),
        F.when(ok % 17 == 0, F.lit(None).cast("string"))
         .when(ok % 101 == 0, F.lit("c999999"))
         .otherwise(F.concat(F.lit("c"), _s("o_custkey"))).alias("customer_id"),
        F.concat(F.lit("sku-"), _s(pk)).alias("sku"),
        F.when(pk % 97 == 0, F.lit(None).cast("int"))
         .otherwise(F.col("l_quantity").cast("int")).alias("quantity"),
        (F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("double")
         / F.lit(100.0)).alias("unit_price"),
        F.when(sk % 23 == 0, F.lit(None).cast("double"))
         .otherwise(F.round(F.col("l_discount") * 100, 0).cast("int").cast("double")).alias("discount"),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string"))
         .otherwise(F.lit("inr")).alias("currency"),
    ]
    if with_ts:
        # One load batch per ship year: 1995 .. 2001.
        cols.append(F.make_timestamp_ntz(F.year("l_shipdate"), F.lit(1), F.lit(1),
                                         F.lit(0), F.lit(0), F.lit(0)).alias("_record_ingestion_ts"))
    if keep_keys:
        cols += [ok.alias("_ok"), F.col("l_linenumber").alias("_ln")]
    return j.select(*cols)


RAW = {
    "customers": raw_customers,
    "products": raw_products,
    "stores": raw_stores,
    "transactions": raw_transactions,
}


def raw(spark: SparkSession, sf_dir: str, entity: str, with_ts: bool = True) -> DataFrame:
    return RAW[entity](spark, sf_dir, with_ts)


def transactions_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as the text a CSV file would hold, with typing defects
    (words in numeric/time fields) and blank lines injected from the keys."""
    base = raw_transactions(spark, sf_dir, with_ts=False, keep_keys=True)
    ok = F.col("_ok")
    blank = (ok % 53 == 0) & (F.col("_ln") == 1)

    def txt(c: Column, bad: Column | None = None, word: str = "") -> Column:
        out = F.when(blank, F.lit(None).cast("string"))
        if bad is not None:
            out = out.when(bad, F.lit(word))
        return out.otherwise(c.cast("string"))

    return base.select(
        txt(F.col("transaction_id")).alias("transaction_id"),
        txt(F.col("transaction_line_id")).alias("transaction_line_id"),
        txt(F.date_format("transaction_ts", "yyyy-MM-dd HH:mm:ss"), ok % 89 == 0, "unknown").alias("transaction_ts"),
        txt(F.col("channel")).alias("channel"),
        txt(F.col("store_id")).alias("store_id"),
        txt(F.col("customer_id")).alias("customer_id"),
        txt(F.col("sku")).alias("sku"),
        txt(F.col("quantity"), ok % 61 == 0, "n/a").alias("quantity"),
        txt(F.col("unit_price").cast("decimal(12,2)"), ok % 67 == 0, "free").alias("unit_price"),
        txt(F.col("discount").cast("int"), ok % 71 == 0, "none").alias("discount"),
        txt(F.col("currency")).alias("currency"),
    )
