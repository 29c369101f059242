"""What the larger tables need: nothing is written or counted twice, and
buckets follow the rows."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.operators import gold, sketches
from strata.queries import catalog
from strata.sinks import bucketed, tables
from strata.streaming import ingest


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Small tables of the given schema: 40 orders of 3 lines in 1995-2000."""
    d = str(tmp_path_factory.mktemp("small"))

    def put(name, n, *columns):
        spark.range(n).selectExpr(*columns).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    put("region", 2, "cast(id as int) r_regionkey", "concat('R', id) r_name")
    put("nation", 3, "cast(id as int) n_nationkey", "concat('N', id) n_name", "cast(id % 2 as int) n_regionkey")
    put("customer", 9, "id c_custkey", "concat('C', id) c_name", "cast(id % 3 as int) c_nationkey")
    put("supplier", 5, "id s_suppkey", "concat('S', id) s_name", "cast(id % 3 as int) s_nationkey")
    put("part", 7, "id p_partkey", "'T' p_type", "10D + id p_retailprice")
    put("orders", 40, "id o_orderkey", "id % 9 o_custkey")
    put("lineitem", 120, "id div 3 l_orderkey", "id % 7 l_partkey", "id % 5 l_suppkey", "cast(id % 2 as int) l_linenumber",
        "1D + id % 4 l_quantity", "100D + id l_extendedprice", "0.05D l_discount", "if(id % 3 = 0, 'R', 'N') l_returnflag",
        "if(id % 2 = 0, 'O', 'F') l_linestatus", "make_timestamp_ntz(cast(1995 + id % 6 as int), 2, 3, 0, 0, 0) l_shipdate")
    return d


def _seen(monkeypatch, module, name):
    """The arguments with which a function is called from now on."""
    calls, real = [], getattr(module, name)

    def call(*args, **kw):
        calls.append(args)
        return real(*args, **kw)
    monkeypatch.setattr(module, name, call)
    return calls


def test_product_counts_hold_pairs_only(spark):
    tx = spark.createDataFrame(
        [("A", "t1", "c1", "s1"), ("A", "t1", "c2", "s1"), ("A", "t2", "c2", None), ("A", None, None, None),
         ("B", "t3", "c1", None), (None, "t4", "c9", "s9")], "sku string, transaction_id string, customer_id string, store_id string"
    ).withColumns({"quantity": F.lit(2), "unit_price": F.lit(1.5), "discount": F.lit(0.0)})
    products = spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "sku string").withColumns(
        {"product_key": F.col("sku"), "category": F.lit("x"), "list_price": F.lit(1.0), "_record_ingestion_ts": F.lit(None)})
    out = gold.product_sales(products, tx)
    got = {r.sku: (r.total_transactions, r.unique_transactions, r.unique_customers, r.unique_stores, r.total_revenue) for r in out.collect()}
    assert got == {"A": (3, 2, 2, 1, 12.0), "B": (1, 1, 1, 0, 3.0), "C": (0, 0, 0, 0, 0.0), None: (0, 0, 0, 0, 0.0)}
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    approx = gold.product_sales(products, tx, sketches.approx_distinct)
    assert sorted(map(str, approx.collect())) == sorted(map(str, out.collect()))


def test_a_mart_published_twice_is_computed_once(spark, small, monkeypatch):
    published = _seen(monkeypatch, tables, "publish")
    assert catalog.queries()["snapshot_overwrite_merge_schema"](spark, small).count() == 7
    assert len(published) == 2
    assert all("Aggregate" not in a[0]._jdf.queryExecution().optimizedPlan().toString() for a in published)


def test_counted_layers_are_written_once(spark, small, monkeypatch):
    staged, published = _seen(monkeypatch, tables, "materialize"), _seen(monkeypatch, tables, "publish")
    n = {r.table_name.split(".")[1]: r.row_count for r in catalog.queries()["table_row_counts"](spark, small).collect()}
    assert (n["bronze_transactions"], n["silver_transactions"], n["gold_product_sales"]) == (120, 80, 7)
    assert len(published) == 12 and not staged


@pytest.mark.parametrize("query", ["upsert_partitioned", "upsert_partial_partitioned", "upsert_bucketed", "conditional_update"])
def test_bronze_parts_are_not_staged_whole(spark, small, monkeypatch, query):
    staged = _seen(monkeypatch, tables, "materialize")
    assert catalog.queries()[query](spark, small).count() == 80
    assert all(a[1] in ("silver-batch", "silver-initial") for a in staged)


def test_buckets_follow_the_rows(spark, small, monkeypatch):
    assert bucketed.enough_buckets(spark.range(1001), 2, 100) == 11
    assert bucketed.enough_buckets(spark.range(5), 2, 100) == 2
    assert bucketed.enough_buckets(spark.range(0)) == 1
    created = _seen(monkeypatch, bucketed, "create")
    monkeypatch.setattr(bucketed, "ROWS_A_BUCKET", 2)
    assert catalog.queries()["upsert_bucketed"](spark, small).count() == 80
    rows, name, _, n = created[0]
    assert n == -(-rows.count() // 2) > 16 and bucketed.buckets_of(spark, name)[0] == n


def test_first_epoch_is_written_once(spark, small, monkeypatch):
    staged = _seen(monkeypatch, tables, "materialize")
    merged = _seen(monkeypatch, ingest, "write_silver")
    assert catalog.queries()["stream_ingest"](spark, small).count() == 80
    assert len(merged) == 2 and len(staged) == 1  # the second epoch alone is staged


def test_written_files_are_compressed_with_zstd(spark):
    path = tables.publish(spark.range(100).selectExpr("id", "id % 2 part"), "zstd_table", partition_by=["part"])
    files = glob.glob(f"{path.removeprefix('file:')}/part=*/*.parquet")
    assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
    spark.sql("DROP TABLE zstd_table")
