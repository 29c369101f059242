"""Rows gathered by key: marts and silver rows come out as without, nothing is
shuffled or written twice, nothing is left behind."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_scale_r03 import _seen, small  # noqa: F401

from strata.context import RunContext
from strata.operators import gold, sketches
from strata.plans.run import Namespace, run_layers
from strata.plans.silver import to_silver, unstamped
from strata.queries import catalog
from strata.schemas import TRANSACTIONS as TX_SCHEMA
from strata.sinks import gathered, tables
from strata.sinks.bucketed import buckets_of
from strata.sources import files
from strata.specs import TRANSACTIONS

CTX = RunContext(as_of=datetime(2024, 2, 1), batch_id="b")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tx(spark):
    """Lines with NULL keys and values, a key that is common and repeated lines."""
    def maybe(every, value):
        return f"if(id % {every} = 0, null, {value})"
    rows = spark.range(400).selectExpr(
        f"{maybe(23, 'concat(chr(84), id div 3)')} transaction_id", "cast(id % 3 as string) transaction_line_id",
        f"{maybe(19, 'make_timestamp_ntz(2024, 1, cast(1 + id % 9 as int), cast(id % 24 as int), 0, 0)')} transaction_ts",
        "'ECOM' channel", f"{maybe(7, 'if(id % 2 = 0, chr(83), concat(chr(83), id % 5))')} store_id",
        f"{maybe(11, 'if(id % 3 = 0, chr(67), concat(chr(67), id % 17))')} customer_id", f"{maybe(29, 'concat(chr(75), id % 13)')} sku",
        f"{maybe(31, 'cast(id % 9 as int)')} quantity", f"{maybe(37, 'id * 0.25D')} unit_price", f"{maybe(41, 'cast(id % 20 as double)')} discount",
        "'INR' currency", "make_timestamp_ntz(2024, 2, cast(1 + id % 2 as int), 0, 0, 0) _record_ingestion_ts")
    return tables.materialize(rows.unionByName(rows.limit(50)).repartition(5), "gathered-tx")


@pytest.fixture
def few(monkeypatch):
    """Keys of more than a few rows are common, buckets hold a few rows."""
    monkeypatch.setattr(gathered, "ROWS_A_KEY", 20)
    monkeypatch.setattr(gathered, "ROWS_A_BUCKET", 100)


def test_each_key_is_in_one_part_and_one_bucket(spark, tx, few):
    with gathered.Stages(spark) as stages:
        near, spread = stages.gather(tx, ["customer_id"])
        (name, path), = stages._made
        both = near.unionByName(spread)
        assert both.count() == 450 and both.exceptAll(tx).isEmpty() and tx.exceptAll(both).isEmpty()
        common = {r[0] for r in spread.select("customer_id").distinct().collect()}
        assert common == {"C", None} and not common & {r[0] for r in near.select("customer_id").distinct().collect()}
        assert "Exchange" not in _plan(near.groupBy("customer_id").count())
        assert buckets_of(spark, name) == (5, ["customer_id"])  # 450 rows, 100 a bucket
    assert not tables.exists(spark, name) and not os.path.exists(path.removeprefix("file:"))
    with gathered.Stages(spark) as stages:
        near, spread = stages.gather(tx.limit(0), ["customer_id"])
        assert spread is None and near.count() == 0


def test_a_failing_step_leaves_no_stage(spark, tx):
    with pytest.raises(ZeroDivisionError), gathered.Stages(spark) as stages:
        stages.gather(tx, ["sku"])
        made = list(stages._made)
        raise ZeroDivisionError
    assert made and not any(tables.exists(spark, n) or os.path.exists(p.removeprefix("file:")) for n, p in made)


def _marts(spark, tx, **kw):
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    customers = tx.select("customer_id").distinct().withColumns({"name": F.lit("n"), "signup_date": F.lit("d"), "_record_ingestion_ts": stamp})
    products = tx.select("sku").distinct().withColumns({"product_key": F.col("sku"), "category": F.lit("x"), "list_price": F.lit(1.0), "_record_ingestion_ts": stamp})
    stores = tx.select("store_id").distinct().withColumns({"name": F.lit("n"), "region": F.lit("r"), "_record_ingestion_ts": stamp})
    return [gold.customer_summary(customers, tx, **kw), gold.product_sales(products, tx, **kw),
            gold.store_performance(stores, tx, **kw), gold.daily_sales(tx, **kw)]


@pytest.mark.parametrize("common", [False, True])
def test_marts_are_the_same_when_gathered(spark, tx, request, common):
    if common:
        request.getfixturevalue("few")
    with gathered.Stages(spark) as stages:
        parts = []

        def gather(rows, keys):
            parts.append(stages.gather(rows, keys))
            return parts[-1]
        for plain, near in zip(_marts(spark, tx), _marts(spark, tx, gather=gather), strict=True):
            assert near.columns == plain.columns and [f.dataType for f in near.schema] == [f.dataType for f in plain.schema]
            assert sorted(map(str, near.collect())) == sorted(map(str, plain.collect()))
        assert [p[1] is None for p in parts] == [not common] * 4


def test_gathered_marts_shuffle_no_line(spark, tx):
    with gathered.Stages(spark) as stages:
        daily = gold.daily_sales(tx, gather=stages.gather)
        assert "Exchange" not in _plan(daily) and "Expand" not in _plan(daily)
        assert "Expand" in gold.daily_sales(tx)._jdf.queryExecution().optimizedPlan().toString()
        assert len(stages._made) == 1
        gold.daily_sales(tx, sketches.approx_distinct, stages.gather)
        assert len(stages._made) == 1  # sketches need no gathered rows


@pytest.mark.parametrize("common", [False, True])
def test_silver_rows_are_the_same_when_gathered(spark, tx, request, common):
    if common:
        request.getfixturevalue("few")
    bronze = tx.withColumns({"_updated_at": CTX.ts_lit(), "_source_file": F.lit("f")})
    bronze = bronze.unionByName(bronze.limit(60).withColumns({"transaction_id": F.lit(" t1"), "transaction_line_id": F.lit("0")}))
    plain = to_silver(bronze, TRANSACTIONS, CTX)
    assert plain.columns == [*tx.columns, "_updated_at", "_ingestion_date", "_batch_id"]
    with gathered.Stages(spark) as stages:
        rows = unstamped(bronze, TRANSACTIONS, stages.gather)
        assert sorted(map(str, rows.collect())) == sorted(map(str, plain.select(rows.columns).collect()))
        assert ("Exchange" in _plan(rows)) == common  # without a common key no row is shuffled


def test_the_job_writes_its_first_silver_batch_once(spark, small, monkeypatch):  # noqa: F811
    staged, landed = _seen(monkeypatch, tables, "materialize"), _seen(monkeypatch, files, "stage_csv")
    gathers = []
    real = gathered.Stages.gather
    monkeypatch.setattr(gathered.Stages, "gather", lambda self, rows, keys: gathers.append(list(keys)) or real(self, rows, keys))
    assert catalog.queries()["run_layers_validation"](spark, small).count() == 50
    assert not staged and {a[3] for a in landed} == {".csv.gz"}
    assert gathers == [["transaction_id", "transaction_line_id"], ["customer_id"], ["sku"], ["store_id"], ["sale_date", "_record_ingestion_ts"]]
    assert spark.sql(f"SHOW TABLES IN {gathered.DB}").isEmpty()


def test_compressed_files_land_and_only_the_named_ones(spark, tmp_path):
    land = f"file:{tmp_path}/landing"
    lines = spark.range(6).selectExpr("concat('T', id) transaction_id", "'1' transaction_line_id", "cast(null as timestamp_ntz) transaction_ts", "' pos' channel",
                                      "'S1' store_id", "'C1' customer_id", "'K1' sku", "2 quantity", "1.5D unit_price", "0D discount", "'inr' currency")
    assert lines.columns == TX_SCHEMA.fieldNames()
    for e, rows in (("customers", spark.range(1).selectExpr("'C1' customer_id", "'n' name", "'01/02/2024' signup_date")),
                    ("products", spark.range(1).selectExpr("'K1' sku", "'P1' product_key", "'c' category", "1.5D list_price")),
                    ("stores", spark.range(1).selectExpr("'S1' store_id", "'n' name", "'r' region")), ("transactions", lines)):
        files.stage_csv(rows.withColumn("_file", F.lit(e)), land, "_file", ".csv.gz")
    files.stage_csv(lines.withColumn("_file", F.lit("transactions_plain")), land, "_file")
    ns = Namespace("strata_t_gz")
    rep = run_layers(spark, CTX, land, gate=False, ns=ns, suffix=".csv.gz")
    assert rep.bronze["transactions"] == rep.silver_rows["transactions"] == 6
    silver = tables.read(spark, ns(TRANSACTIONS.silver_table))
    assert silver.columns[-1] == "tx_month" and {r.tx_month for r in silver.collect()} == {"unknown"}
    assert {r.channel for r in silver.collect()} == {"POS"} and {r._batch_id for r in silver.collect()} == {"b"}
    assert len(rep.results) == 50
    plain = files.match_entity(files.list_files(spark, land), "transactions").collect()
    assert plain and all(f.file_name.endswith(".csv") for f in plain)
