"""Tables keep their partitioning and their rows through every write."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.context import RunContext
from strata.operators import qc
from strata.plans.bronze import ingest_csv_to_bronze
from strata.plans.run import MissingLayer, run_layers
from strata.plans.silver import write_silver
from strata.sinks import tables
from strata.specs import ENTITIES, TRANSACTIONS, VALIDATION_RULES
from strata.streaming.ingest import any_case, run_available

HEADER = "transaction_id,transaction_line_id,transaction_ts,channel,store_id,customer_id,sku,quantity,unit_price,discount,currency\n"


def _rows(spark, *ids, part="p"):
    return spark.createDataFrame([(i, f"{part}{i % 2}", i * 10) for i in ids], "id int, part string, v int")


def test_truncate_then_merges_keep_all_rows(spark):
    name = "strata_s.trunc"
    tables.publish(_rows(spark, 1, 2, 3), name, partition_by=["part"])
    tables.truncate(spark, name)
    assert tables._partition_columns(spark, name) == ["part"] and tables.read(spark, name).count() == 0
    tables.merge_partitioned(_rows(spark, 1, 2), name, ["id"], "part")
    tables.merge_partitioned(_rows(spark, 3, 4), name, ["id"], "part")
    assert sorted(r.id for r in tables.read(spark, name).collect()) == [1, 2, 3, 4]
    tables.publish(_rows(spark, 7, 8), name)
    assert tables._partition_columns(spark, name) == ["part"]


def test_merge_moves_rows_and_drops_empty_partitions(spark):
    name = "strata_s.moves"
    tables.publish(_rows(spark, 1, 2, 3, 5), name, partition_by=["part"])
    moved = spark.createDataFrame([(2, "it's new", 99)], "id int, part string, v int")
    tables.merge_partitioned(moved, name, ["id"], "part")
    assert sorted(map(tuple, tables.read(spark, name).select("id", "part", "v").collect())) == [
        (1, "p1", 10), (2, "it's new", 99), (3, "p1", 30), (5, "p1", 50)]
    assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()} == {"part=p1", "part=it%27s new"}
    tables.append(_rows(spark, 9), name)
    assert tables.read(spark, name).count() == 5


def test_merge_by_another_column_is_refused(spark):
    name = "strata_s.flat"
    tables.publish(_rows(spark, 1, 2), name)
    with pytest.raises(ValueError):
        tables.merge_partitioned(_rows(spark, 3), name, ["id"], "part")
    assert tables.read(spark, name).count() == 2


def test_second_publish_of_a_mart_only_repoints(spark):
    name = "strata_s.mart"
    tables.publish(spark.range(3).withColumn("x", F.lit("a")), name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('kept' = 'yes')")  # lost if the table is dropped
    tables.overwrite_merge_schema(spark.createDataFrame([(1, "b"), (2, None)], "id long, x string"), name)
    assert spark.sql(f"SHOW TBLPROPERTIES {name} ('kept')").first()[1] == "yes" and tables.read(spark, name).count() == 2


def _land(folder, name, start, n):
    (folder / name).write_text(HEADER + "".join(
        f"T{i},{i},2024-0{1 + i % 3}-05 10:00:00,POS,s1,c1,k1,{1 + i % 4},10.5,5,INR\n" for i in range(start, start + n)))


def test_stream_and_job_share_one_merge(spark, tmp_path):
    land, target = tmp_path / "landing", "strata_s.shared"
    land.mkdir()
    _land(land, "Transactions_1.CSV", 0, 6)  # any case, as in batch discovery
    assert run_available(spark, str(land), "transactions", target, str(tmp_path / "c"), as_of=datetime(2024, 5, 1), gate=True,
                         audit="strata_s.stream_audit") == 1
    assert tables.read(spark, target).count() == 6 and tables._partition_columns(spark, target) == ["tx_month"]
    assert tables.read(spark, "strata_s.stream_audit").count() == 1
    staged = tables.materialize(tables.read(spark, target).limit(1).drop("tx_month").withColumn("transaction_id", F.lit("NEW")))
    write_silver(staged, TRANSACTIONS, target, RunContext(batch_id="job"))
    assert tables.read(spark, target).count() == 7
    (land / "transactions_2.csv").write_text(HEADER + "T9,9,2024-01-05 10:00:00,POS,s1,c1,k1,1000000,10.5,5,INR\n")
    with pytest.raises(Exception, match="quantity|QCFailure"):
        run_available(spark, str(land), "transactions", target, str(tmp_path / "c"), gate=True)
    assert tables.read(spark, target).count() == 7
    assert any_case("*a1.csv") == "*[aA]1.[cC][sS][vV]"


def test_empty_files_reach_the_ledger(spark, tmp_path):
    (tmp_path / "stores_a.csv").write_text("store_id,name,region\ns1,One,EAST\n")
    (tmp_path / "stores_b.csv").write_text("store_id,name,region\n")
    kw = dict(target="strata_s.b_stores", ledger="strata_s.led", audit="strata_s.led_audit")
    assert ingest_csv_to_bronze(spark, RunContext(batch_id="l1"), "stores", str(tmp_path), **kw).rows == 1
    assert sorted(r.row_count for r in tables.read(spark, "strata_s.led").collect()) == [0, 1]
    assert ingest_csv_to_bronze(spark, RunContext(batch_id="l2"), "stores", str(tmp_path), **kw) is None


def test_missing_layer_is_an_error(spark, tmp_path):
    from strata.plans.run import Namespace
    (tmp_path / "customers.csv").write_text("customer_id,name,signup_date\nc1,A,01/02/2024\n")
    with pytest.raises(MissingLayer):
        run_layers(spark, RunContext(), str(tmp_path), ns=Namespace("strata_s_missing"))


def test_rules_without_reference_or_row_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "sku string, n int")
    got = {r.check_name: r.status for r in qc.evaluate_rules(df, "t", {"foreign_keys": {"sku": "products.sku"}}).collect()}
    assert got == {"referential_integrity_sku": "FAIL"}
    assert [r.status for r in qc.evaluate_rules(df, "t", {"unique_columns": ["sku"]}).collect()] == ["FAIL"]
    assert qc.evaluate_rules(df, "t", {}).collect() == []


def test_rule_dictionary_covers_every_entity():
    assert set(VALIDATION_RULES) == set(ENTITIES)
    assert VALIDATION_RULES["transactions"]["min_values"] == {"quantity": 1, "unit_price": 0.0}
    assert VALIDATION_RULES["products"]["unique_columns"] == ["sku"]


def test_clock_is_utc_with_microseconds():
    a, b = RunContext(), RunContext()
    assert a.as_of < b.as_of and a.as_of.tzinfo is None
