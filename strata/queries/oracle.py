"""Independent SQL statement of every registered query, for DuckDB.

Each query is a final SELECT over named common table expressions; the CTEs a
query needs are pulled in (with their dependencies) automatically.
Everything is written from the data contract, not generated from the Spark
plans, so the two implementations check each other.
"""

from __future__ import annotations

import re

# ---------------------------------------------------------------- helpers --


def net(p="unit_price", q="quantity", d="discount") -> str:
    """price * quantity * (1 - discount / 100)"""
    return f"(CAST({p} AS DECIMAL(16,6)) * CAST({q} AS DECIMAL(10,0)) * (1 - CAST({d} AS DECIMAL(7,4)) * 0.01))"


def disc(p="unit_price", q="quantity", d="discount") -> str:
    """price * quantity * discount / 100"""
    return f"(CAST({p} AS DECIMAL(16,6)) * CAST({q} AS DECIMAL(10,0)) * (CAST({d} AS DECIMAL(7,4)) * 0.01))"


def cents(s: str) -> str:
    return f"CAST(round({s}, 2) AS DOUBLE)"


def mean_cents(s: str, n: str) -> str:
    return f"(round(CAST(CAST({s} AS DECIMAL(34,6)) * 100 AS DOUBLE) / {n}) / CAST(100 AS DOUBLE))"


def mean_price(s: str, n: str) -> str:
    return f"(round(CAST(CAST({s} AS DECIMAL(34,4)) * 100 AS DOUBLE) / {n}) / CAST(100 AS DOUBLE))"


def pct_text(part: str, whole: str) -> str:
    h = f"(CASE WHEN ({whole}) > 0 THEN (CAST({part} AS BIGINT) * 20000 + ({whole})) // (2 * ({whole})) ELSE 0 END)"
    return (f"(CAST({h} // 100 AS VARCHAR) || '.' || lpad(CAST({h} % 100 AS VARCHAR), 2, '0') || '%')")


def ratio(part: str, whole: str) -> str:
    return f"(CASE WHEN ({whole}) > 0 THEN CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) ELSE 0.0 END)"


def not_all_null(cols) -> str:
    return "NOT (" + " AND ".join(f"{c} IS NULL" for c in cols) + ")"


def order_nf(cols) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


# ------------------------------------------------------------------- CTEs --

DIM_TS = "TIMESTAMP '1995-01-01 00:00:00'"

CTES: dict[str, str] = {}

CTES["raw_customers"] = f"""
SELECT ' c' || CAST(c_custkey AS VARCHAR) || ' ' AS customer_id,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name || ' ' END AS name,
       CASE WHEN c_custkey % 3 = 0 THEN lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') || '/'
                 || lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0') || '/' || CAST(2015 + c_custkey % 10 AS VARCHAR)
            WHEN c_custkey % 3 = 1 THEN lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') || '/'
                 || lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0') || '/' || CAST(15 + c_custkey % 10 AS VARCHAR)
            ELSE 'n/a' END AS signup_date,
       {DIM_TS} AS _record_ingestion_ts
FROM customer"""

CTES["raw_products"] = f"""
SELECT 'sku-' || CAST(p_partkey AS VARCHAR) AS sku,
       'pk-' || CAST(p_partkey AS VARCHAR) AS product_key,
       CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_type END AS category,
       CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_retailprice END AS list_price,
       {DIM_TS} AS _record_ingestion_ts
FROM part"""

CTES["raw_stores"] = f"""
SELECT 's' || CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS name, r_name AS region,
       {DIM_TS} AS _record_ingestion_ts
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

CTES["raw_transactions_k"] = """
SELECT 't' || CAST(l_orderkey AS VARCHAR) AS transaction_id,
       CAST(l_linenumber AS VARCHAR) AS transaction_line_id,
       l_shipdate AS transaction_ts,
       CASE WHEN l_linestatus = 'O' THEN 'ecom' ELSE ' pos' END AS channel,
       CASE WHEN l_linestatus = 'O' THEN NULL ELSE 's' || CAST(l_suppkey AS VARCHAR) END AS store_id,
       CASE WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_orderkey % 101 = 0 THEN 'c999999'
            ELSE 'c' || CAST(o_custkey AS VARCHAR) END AS customer_id,
       'sku-' || CAST(l_partkey AS VARCHAR) AS sku,
       CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS quantity,
       CAST(floor(l_extendedprice * 100 / l_quantity) AS DOUBLE) / CAST(100 AS DOUBLE) AS unit_price,
       CASE WHEN l_suppkey % 23 = 0 THEN NULL
            ELSE CAST(CAST(round(l_discount * 100, 0) AS INTEGER) AS DOUBLE) END AS discount,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE 'inr' END AS currency,
       make_timestamp(year(l_shipdate), 1, 1, 0, 0, 0) AS _record_ingestion_ts,
       l_orderkey AS _ok, l_linenumber AS _ln
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTES["raw_transactions"] = """
SELECT * EXCLUDE (_ok, _ln) FROM raw_transactions_k"""

TX_DATA = ["transaction_id", "transaction_line_id", "transaction_ts", "channel", "store_id",
           "customer_id", "sku", "quantity", "unit_price", "discount", "currency"]

CTES["bronze_customers"] = f"""
SELECT customer_id, name,
       CAST(CAST(COALESCE(CASE WHEN length(signup_date) = 10 THEN try_strptime(signup_date, '%d/%m/%Y') END,
                          CASE WHEN length(signup_date) = 8 THEN try_strptime(signup_date, '%d/%m/%y') END)
                 AS DATE) AS VARCHAR) AS signup_date,
       _record_ingestion_ts
FROM raw_customers WHERE {not_all_null(['customer_id', 'name', 'signup_date'])}"""

CTES["bronze_products"] = f"""
SELECT * FROM raw_products WHERE {not_all_null(['sku', 'product_key', 'category', 'list_price'])}"""

CTES["bronze_stores"] = f"""
SELECT * FROM raw_stores WHERE {not_all_null(['store_id', 'name', 'region'])}"""

CTES["bronze_transactions"] = f"""
SELECT * FROM raw_transactions WHERE {not_all_null(TX_DATA)}"""

CTES["clean_customers"] = """
SELECT upper(trim(customer_id)) AS customer_id, coalesce(trim(name), 'Unknown') AS name,
       signup_date, _record_ingestion_ts
FROM bronze_customers"""

CTES["clean_products"] = """
SELECT upper(trim(sku)) AS sku, upper(trim(product_key)) AS product_key,
       coalesce(trim(category), 'Unknown') AS category, coalesce(list_price, 0.0) AS list_price,
       _record_ingestion_ts
FROM bronze_products"""

CTES["clean_stores"] = """
SELECT upper(trim(store_id)) AS store_id, coalesce(trim(name), 'Unknown') AS name,
       coalesce(trim(region), 'Unknown') AS region, _record_ingestion_ts
FROM bronze_stores"""

CTES["clean_transactions"] = """
SELECT upper(trim(transaction_id)) AS transaction_id, trim(transaction_line_id) AS transaction_line_id,
       transaction_ts, upper(trim(channel)) AS channel, upper(trim(store_id)) AS store_id,
       upper(trim(customer_id)) AS customer_id, upper(trim(sku)) AS sku,
       coalesce(quantity, 1) AS quantity, coalesce(unit_price, 0.0) AS unit_price,
       coalesce(discount, 0.0) AS discount, coalesce(upper(trim(currency)), 'INR') AS currency,
       _record_ingestion_ts
FROM bronze_transactions"""

DEDUP = {
    "customers": (["customer_id"], ["_record_ingestion_ts", "name", "signup_date"]),
    "products": (["sku"], ["_record_ingestion_ts", "product_key", "category", "list_price"]),
    "stores": (["store_id"], ["_record_ingestion_ts", "name", "region"]),
    "transactions": (["transaction_id", "transaction_line_id"],
                     ["_record_ingestion_ts", "transaction_ts", "channel", "store_id", "customer_id",
                      "sku", "quantity", "unit_price", "discount", "currency"]),
}


def dedup_sql(src: str, keys, order, desc: bool = False) -> str:
    o = (", ".join(f"{c} DESC NULLS LAST" for c in order)) if desc else order_nf(order)
    return (f"SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {o}) AS __rn FROM {src}) WHERE __rn = 1")


for _e, (_k, _o) in DEDUP.items():
    CTES[f"silver_{_e}"] = dedup_sql(f"clean_{_e}", _k, _o)

# Gold marts ---------------------------------------------------------------

CTES["customer_stats"] = f"""
SELECT customer_id,
       count(transaction_id) AS total_transactions,
       count(DISTINCT transaction_id) AS unique_transactions,
       CAST(sum(quantity) AS BIGINT) AS total_quantity,
       {cents('sum(' + net() + ')')} AS total_sales,
       {cents('sum(' + disc() + ')')} AS total_discount,
       {mean_price('sum(CAST(unit_price AS DECIMAL(16,6)))', 'count(unit_price)')} AS avg_unit_price,
       max(transaction_ts) AS last_transaction_date
FROM silver_transactions WHERE customer_id IS NOT NULL GROUP BY customer_id"""

CTES["gold_customer_summary"] = """
SELECT c.customer_id, c.name, c.signup_date,
       coalesce(s.total_transactions, 0) AS total_transactions,
       coalesce(s.unique_transactions, 0) AS unique_transactions,
       coalesce(s.total_quantity, 0) AS total_quantity,
       coalesce(s.total_sales, 0.0) AS total_sales,
       coalesce(s.total_discount, 0.0) AS total_discount,
       coalesce(s.avg_unit_price, 0.0) AS avg_unit_price,
       s.last_transaction_date, c._record_ingestion_ts
FROM silver_customers c LEFT JOIN customer_stats s ON c.customer_id = s.customer_id"""

CTES["product_stats"] = f"""
SELECT sku,
       count(transaction_id) AS total_transactions,
       count(DISTINCT transaction_id) AS unique_transactions,
       CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
       {cents('sum(' + net() + ')')} AS total_revenue,
       {cents('sum(' + disc() + ')')} AS total_discount,
       {mean_price('sum(CAST(unit_price AS DECIMAL(16,6)))', 'count(unit_price)')} AS avg_selling_price,
       round(min(unit_price), 2) AS min_selling_price,
       round(max(unit_price), 2) AS max_selling_price,
       count(DISTINCT customer_id) AS unique_customers,
       count(DISTINCT store_id) AS unique_stores
FROM silver_transactions GROUP BY sku"""

CTES["gold_product_sales"] = """
SELECT p.sku, p.product_key, p.category, p.list_price,
       coalesce(s.total_transactions, 0) AS total_transactions,
       coalesce(s.unique_transactions, 0) AS unique_transactions,
       coalesce(s.total_quantity_sold, 0) AS total_quantity_sold,
       coalesce(s.total_revenue, 0.0) AS total_revenue,
       coalesce(s.total_discount, 0.0) AS total_discount,
       coalesce(s.avg_selling_price, 0.0) AS avg_selling_price,
       coalesce(s.min_selling_price, 0.0) AS min_selling_price,
       coalesce(s.max_selling_price, 0.0) AS max_selling_price,
       coalesce(s.unique_customers, 0) AS unique_customers,
       coalesce(s.unique_stores, 0) AS unique_stores,
       p._record_ingestion_ts
FROM silver_products p LEFT JOIN product_stats s ON p.sku = s.sku"""

CTES["store_stats"] = f"""
SELECT store_id,
       count(transaction_id) AS total_transactions,
       count(DISTINCT transaction_id) AS unique_transactions,
       count(DISTINCT customer_id) AS unique_customers,
       count(DISTINCT sku) AS unique_products,
       CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
       {cents('sum(' + net() + ')')} AS total_revenue,
       {cents('sum(' + disc() + ')')} AS total_discount,
       {mean_cents('sum(' + net() + ')', 'count(' + net() + ')')} AS avg_transaction_value,
       max(transaction_ts) AS last_transaction_date
FROM silver_transactions WHERE store_id IS NOT NULL GROUP BY store_id"""

CTES["gold_store_performance"] = """
SELECT st.store_id, st.name, st.region,
       coalesce(s.total_transactions, 0) AS total_transactions,
       coalesce(s.unique_transactions, 0) AS unique_transactions,
       coalesce(s.unique_customers, 0) AS unique_customers,
       coalesce(s.unique_products, 0) AS unique_products,
       coalesce(s.total_quantity_sold, 0) AS total_quantity_sold,
       coalesce(s.total_revenue, 0.0) AS total_revenue,
       coalesce(s.total_discount, 0.0) AS total_discount,
       coalesce(s.avg_transaction_value, 0.0) AS avg_transaction_value,
       s.last_transaction_date, st._record_ingestion_ts
FROM silver_stores st LEFT JOIN store_stats s ON st.store_id = s.store_id"""

CTES["gold_daily_sales"] = f"""
SELECT CAST(transaction_ts AS DATE) AS sale_date, _record_ingestion_ts,
       count(transaction_id) AS total_transactions,
       count(DISTINCT transaction_id) AS unique_transactions,
       count(DISTINCT customer_id) AS unique_customers,
       count(DISTINCT store_id) AS unique_stores,
       count(DISTINCT sku) AS unique_products,
       CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
       {cents('sum(' + net() + ')')} AS total_revenue,
       {cents('sum(' + disc() + ')')} AS total_discount,
       {mean_cents('sum(' + net() + ')', 'count(' + net() + ')')} AS avg_transaction_value,
       max(transaction_ts) AS last_transaction_time
FROM silver_transactions GROUP BY CAST(transaction_ts AS DATE), _record_ingestion_ts"""

# -------------------------------------------------------------- assembling --

_NAME = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(sql: str, exclude: str | None = None) -> list[str]:
    seen = []
    for tok in _NAME.findall(sql):
        if tok in CTES and tok != exclude and tok not in seen:
            seen.append(tok)
    return seen


def with_ctes(final_sql: str, extra: list[str] | None = None) -> str:
    """Prefix ``final_sql`` with every CTE it (transitively) references.
    ``extra`` are ready-made ``name AS (...)`` CTEs placed after those."""
    order: list[str] = []
    extra = extra or []

    def visit(name: str, stack=()):
        if name in order:
            return
        for d in _deps(CTES[name], exclude=name):
            if d not in stack:
                visit(d, stack + (name,))
        order.append(name)

    for d in _deps(final_sql + " " + " ".join(extra)):
        visit(d)
    parts = [f"{n} AS ({CTES[n].strip()})" for n in order] + extra
    if not parts:
        return final_sql.strip()
    return "WITH " + ",\n".join(parts) + "\n" + final_sql.strip()
