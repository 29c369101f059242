"""Ingest, merges and streams that end half-way, and what the next run does;
writes that are observed instead of read again."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.context import RunContext
from strata.operators import incremental as inc
from strata.operators import qc
from strata.operators.upsert import merge_update_all
from strata.plans import bronze
from strata.plans.run import Namespace, silver_step
from strata.plans.silver import write_silver
from strata.schemas import ENTITY_SCHEMAS
from strata.sinks import tables
from strata.sources import files
from strata.specs import STORES, TABLES, TRANSACTIONS
from strata.streaming import ingest as stream

STORES_HEADER = "store_id,name,region\n"
TX_HEADER = "transaction_id,transaction_line_id,transaction_ts,channel,store_id,customer_id,sku,quantity,unit_price,discount,currency\n"


def _land(folder, name, ids):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(STORES_HEADER + "".join(f"s{i},Store {i},EAST\n" for i in ids))


def _names(p):
    return dict(target=f"strata_x.{p}_bronze", ledger=f"strata_x.{p}_ledger", audit=f"strata_x.{p}_audit")


def _ingest(spark, land, names, batch, **kw):
    day = 1 + sum(map(ord, batch)) % 20
    return bronze.ingest_csv_to_bronze(spark, RunContext(as_of=datetime(2024, 5, day, 2), batch_id=batch), "stores", str(land), **names, **kw)


def _ids(spark, table):
    return sorted(r.store_id for r in tables.read(spark, table).collect())


@pytest.mark.parametrize("step", ["commit", "show", "audit"])
def test_crash_leaves_no_copies(spark, tmp_path, monkeypatch, step):
    """Between the files and the ledger, the ledger and the catalog, the
    catalog and the audit log."""
    land, names = tmp_path / "landing", _names(f"crash_{step}")
    _land(land, "stores_1.csv", range(4))
    _ingest(spark, land, names, "a")
    _land(land, "stores_2.csv", range(4, 9))
    real = tables.append

    def lost(df, name, tag=""):
        if name == names["audit"]:
            raise RuntimeError("ended here")
        return real(df, name, tag)

    def ended(*a, **k):
        raise RuntimeError("ended here")
    with monkeypatch.context() as m:
        m.setattr(tables, "append", lost) if step == "audit" else m.setattr(bronze, step, ended)
        with pytest.raises(RuntimeError):
            _ingest(spark, land, names, "b")
    assert len(_ids(spark, names["target"])) == (9 if step == "audit" else 4)  # never a part of a batch
    again = _ingest(spark, land, names, "c")
    assert _ids(spark, names["target"]) == [f"s{i}" for i in range(9)]
    assert (again.rows if again else 0) == (5 if step == "commit" else 0)
    second = "c" if step == "commit" else "b"
    assert sorted(tuple(r) for r in tables.read(spark, names["audit"]).select("batch_id", "table_name").collect()) == \
        [("a", names["target"]), (second, names["target"])]
    assert {(r.batch_id, r.row_count) for r in tables.read(spark, names["ledger"]).collect()} == {("a", 4), (second, 5)}
    assert _ingest(spark, land, names, "d") is None


def test_bronze_is_never_read_by_its_ingest(spark, tmp_path, monkeypatch):
    """Counts, watermark and row count come from the write."""
    land, names = tmp_path / "landing", _names("scans")
    for i in range(5):
        _land(land, f"stores_{i}.csv", range(10 * i, 10 * i + i))
    read, scans = [], []
    real, real_scan = tables.read, files.read_csv
    monkeypatch.setattr(tables, "read", lambda s, n: read.append(n) or real(s, n))
    monkeypatch.setattr(files, "read_csv", lambda *a, **k: scans.append(a) or real_scan(*a, **k))
    got = _ingest(spark, land, names, "a")
    assert names["target"] not in read and len(scans) == 1
    assert got.rows == 10 and got.row_count_check[0]["message"] == "Row count 10 is valid"
    assert sorted((r.file_path[-5], r.row_count) for r in real(spark, names["ledger"]).collect()) == [(str(i), i) for i in range(5)]
    df = bronze.scan_new(spark, RunContext(), "stores", got.files)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1


def test_counts_by_file_are_exact(spark):
    """The sketch behind the per-file counts, with as many files as it is made
    for and very uneven counts."""
    n = 3000
    rows = spark.range(n).select("id", F.explode(F.sequence(F.lit(1), F.col("id") % 7 * F.col("id") % 50 + 1))) \
        .select(F.concat(F.lit("/landing/file-"), "id").alias("_source_file")).repartition(5)
    got = {r["item"]: r["count"] for r in rows.agg(bronze.observed_files(n).alias("f")).first().f}
    assert got == {r[0]: r[1] for r in rows.groupBy("_source_file").count().collect()} and len(got) == n


def test_many_files_are_several_batches(spark, tmp_path):
    land, names = tmp_path / "landing", _names("many")
    for i in range(7):
        _land(land, f"stores_{i}.csv", [i])
    assert _ingest(spark, land, names, "a", max_files=3).rows == 7
    assert _ids(spark, names["target"]) == [f"s{i}" for i in range(7)]
    assert {r[0] for r in tables.read(spark, names["ledger"]).select("batch_id").distinct().collect()} == {"a", "a.1", "a.2"}
    _land(land, "stores_8.csv", [8])
    assert _ingest(spark, land, names, "a").rows == 1  # a batch id is never used again
    assert len(_ids(spark, names["target"])) == 8


def test_archive_keeps_the_landing_folder_short(spark, tmp_path, monkeypatch):
    land, done, names = tmp_path / "landing", tmp_path / "done", _names("archive")
    _land(land, "stores_1.csv", range(3))
    with monkeypatch.context() as m:
        m.setattr(files, "archive", lambda *a: (_ for _ in ()).throw(RuntimeError("ended here")))
        with pytest.raises(RuntimeError):
            _ingest(spark, land, names, "a", archive_dir=str(done))
    _land(land, "stores_2.csv", range(3, 5))
    assert _ingest(spark, land, names, "b", archive_dir=str(done)).rows == 2
    assert files.list_files(spark, str(land)).count() == 0
    assert sorted(p.name for p in done.glob("*.csv")) == ["stores_1.csv", "stores_2.csv"]
    _land(land, "stores_1.csv", range(7, 9))  # the same path: in the ledger
    assert _ingest(spark, land, names, "c", archive_dir=str(done)) is None
    assert len(list(done.glob("*.csv"))) == 3 and _ids(spark, names["target"]) == [f"s{i}" for i in range(5)]


def test_listing_of_later_files(spark, tmp_path):
    import os
    _land(tmp_path / "l", "stores_1.csv", [1])
    _land(tmp_path / "l", "stores_2.csv", [2])
    os.utime(tmp_path / "l" / "stores_1.csv", (1_000_000_000,) * 2)
    got = files.list_files(spark, str(tmp_path / "l"), modified_after=datetime(2020, 1, 1)).collect()
    assert [r.file_name for r in got] == ["stores_2.csv"]


def test_watermark_read_prunes_days(spark, tmp_path):
    names = _names("days")
    land = tmp_path / "landing"
    for i, batch in enumerate("abc"):
        _land(land, f"stores_{batch}.csv", [i])
        bronze.ingest_csv_to_bronze(spark, RunContext(as_of=datetime(2024, 5, 1 + i, 2), batch_id=batch), "stores", str(land), **names)
    audit = tables.read(spark, names["audit"]).filter("batch_id <= 'b'")
    rows = inc.incremental_read(tables.read(spark, names["target"]), audit, names["target"], date_col=bronze.DATE_COL)
    assert [r.store_id for r in rows.collect()] == ["s2"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_ingestion_date" in plan and ">= 2024-05-02" in plan
    assert len(rows.inputFiles()) <= 2  # the watermark's own day and later ones, of three


# ----------------------------------------------------- replayed merges

def test_equal_null_key_rows_of_two_loads_stay(spark):
    t = spark.createDataFrame([(1, "a", "b1"), (None, "n", "b1")], "id int, v string, batch string")
    s = spark.createDataFrame([(1, "b", "b2"), (None, "n", "b2")], "id int, v string, batch string")
    replayed = F.col("batch") == "b2"
    once = merge_update_all(t, s, ["id"], replayed=replayed)
    twice = merge_update_all(once, s, ["id"], replayed=replayed)
    want = [(1, "b", "b2"), (None, "n", "b1"), (None, "n", "b2")]
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str) == want


def _tx(i, line, value):
    return f"{i},{line},2024-01-05 10:00:00,POS,s1,c1,k1,{value},10.5,5,INR\n"


def test_job_replays_a_failed_merge(spark, tmp_path, monkeypatch):
    """The merge is through, its audit row is not: the next run merges the
    same loads again, and rows without a key don't double."""
    from strata.plans import run
    land = tmp_path / "landing"
    land.mkdir()
    ns = Namespace("strata_x_job")
    kw = dict(target=ns(TRANSACTIONS.bronze_table), ledger=ns("l"), audit=ns(TABLES["load_audit"]), label=TRANSACTIONS.bronze_table)
    for e, header, row in (("customers", "customer_id,name,signup_date", "c1,A,01/02/2024"), ("products", "sku,product_key,category,list_price", "k1,p,x,1.0"),
                           ("stores", "store_id,name,region", "s1,S,EAST")):
        (land / f"{e}.csv").write_text(f"{header}\n{row}\n")
    for e in ("customers", "products", "stores"):
        bronze.ingest_csv_to_bronze(spark, RunContext(as_of=datetime(2024, 5, 1), batch_id="d"), e, str(land), target=ns(TABLES["bronze"][e]),
                                    ledger=ns("l"), audit=ns(TABLES["load_audit"]), label=TABLES["bronze"][e])
        silver_step(spark, RunContext(as_of=datetime(2024, 5, 1), batch_id="d"), e, ns=ns)

    def load(day, text):
        (land / f"transactions_{day}.csv").write_text(TX_HEADER + text)
        ctx = RunContext(as_of=datetime(2024, 5, day), batch_id=f"b{day}")
        bronze.ingest_csv_to_bronze(spark, ctx, "transactions", str(land), **kw)
        return ctx

    def rows():
        return sorted((r.transaction_id, r.transaction_line_id, r.quantity) for r in tables.read(spark, ns(TRANSACTIONS.silver_table)).collect())

    silver_step(spark, load(2, _tx("t1", "1", 1) + _tx("t9", "", 5)), "transactions", ns=ns)
    ctx = load(3, _tx("t1", "1", 2) + _tx("t9", "", 5))
    with monkeypatch.context() as m:
        m.setattr(run.tables, "append", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("ended here")))
        with pytest.raises(RuntimeError):
            silver_step(spark, ctx, "transactions", ns=ns)
    want = [("T1", "1", 2), ("T9", None, 5), ("T9", None, 5)]  # one of each load
    assert sorted(rows(), key=str) == want
    silver_step(spark, RunContext(as_of=datetime(2024, 5, 4), batch_id="b4"), "transactions", ns=ns)
    assert sorted(rows(), key=str) == want
    assert silver_step(spark, RunContext(as_of=datetime(2024, 5, 5), batch_id="b5"), "transactions", ns=ns) == 0


def test_replayed_epoch_writes_nothing(spark, tmp_path):
    target, ckpt = "strata_x.epochs", str(tmp_path / "ckpt")
    (tmp_path / "t.csv").write_text(TX_HEADER + _tx("t1", "1", 1) + _tx("t2", "", 1))
    batch = files.read_csv(spark, [str(tmp_path / "t.csv")], ENTITY_SCHEMAS["transactions"])
    clock = dict(as_of=datetime(2024, 5, 1))

    def files_of():
        return sorted(tables.read(spark, target).inputFiles())
    assert stream.upsert_epoch(batch, 0, ckpt, "transactions", target, **clock)
    before = files_of()
    assert not stream.upsert_epoch(batch, 0, ckpt, "transactions", target, **clock)
    assert files_of() == before and tables.read(spark, target).count() == 2
    assert stream.upsert_epoch(batch, 1, ckpt, "transactions", target, **clock)  # a later epoch with equal rows
    assert tables.read(spark, target).count() == 3
    assert stream.upsert_epoch(batch, 0, str(tmp_path / "other"), "transactions", target, **clock)  # another stream
    assert tables.read(spark, target).count() == 4


def test_epoch_that_failed_after_its_merge(spark, tmp_path, monkeypatch):
    target, ckpt = "strata_x.epoch_failed", str(tmp_path / "ckpt")
    (tmp_path / "t.csv").write_text(TX_HEADER + _tx("t1", "1", 1) + _tx("t2", "", 1))
    batch = files.read_csv(spark, [str(tmp_path / "t.csv")], ENTITY_SCHEMAS["transactions"])
    with monkeypatch.context() as m:
        m.setattr(stream.tables, "record_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("ended here")))
        with pytest.raises(RuntimeError):
            stream.upsert_epoch(batch, 0, ckpt, "transactions", target)
    assert tables.read(spark, target).count() == 2
    assert stream.upsert_epoch(batch, 0, ckpt, "transactions", target)
    assert tables.read(spark, target).count() == 2


def test_marks_outlive_a_reshaped_publish(spark):
    name = "strata_x.marks"
    tables.publish(spark.range(2), name)
    tables.record_commit(spark, name, "w", 7)
    tables.publish(spark.range(2).selectExpr("cast(id as string) as id"), name)
    assert tables.last_commit(spark, name, "w") == "7" and tables.last_commit(spark, name, "v") is None
    assert tables.last_commit(spark, "strata_x.nowhere", "w") is None


# ------------------------------------------------------ observed checks

def test_watched_write_gives_the_results_of_evaluate(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, None, -1.0), (2, "b", None), (None, "z", 99.0)], "k int, s string, v double")
    spec = {"row_count": {"min_rows": 9}, "nulls": {"columns": ["s", "nope"], "max_null_percentage": 0.1}, "duplicates": {"key_columns": ["k"]},
            "value_ranges": {"v": {"min_value": 0.0, "max_value": 50.0}}, "valid_values": {"s": ["a", "b"]}}
    for rows in (df, df.limit(0), df.filter("k > 100")):
        watch = qc.Watch("t", spec)
        written = tables.materialize(rows.repartition(3), "watched", watch)
        assert sorted(map(tuple, watch.results(written).collect())) == sorted(map(tuple, qc.evaluate(rows, "t", spec).collect()))


def test_failed_check_leaves_the_table(spark):
    name = "strata_x.gated"
    tables.publish(spark.range(3), name)
    with pytest.raises(qc.QCFailure):
        tables.publish(spark.range(0), name, watch=qc.Watch("t", {"row_count": {"min_rows": 1}}))
    assert tables.read(spark, name).count() == 3
    tables.publish(spark.range(0), name, watch=qc.Watch("t", {"row_count": {"min_rows": 1}}, gate=False))
    assert tables.read(spark, name).count() == 0


def test_captured_lines(spark, tmp_path):
    (tmp_path / "p.csv").write_text('sku,product_key,category,list_price\nk1,p1,c,1.5\nk2,p2,"a,b",free\nk3,p3,,\nk4,p4,c,n/a\n')
    schema = ENTITY_SCHEMAS["products"]
    typed = files.read_csv(spark, [str(tmp_path / "p.csv")], schema, corrupt=True)
    (got,) = qc.check_captured(typed, "t", schema, files.as_text(schema)).collect()
    assert (got.check_name, got.status, got.failed_rows, got.row_count) == ("type_conformance_list_price", "WARNING", 2, 4)
    plan = qc.check_captured(typed, "t", schema, files.as_text(schema))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1


def test_vacuum_deletes_what_nothing_points_at(spark):
    name = "strata_x.vacuumed"
    for n in (1, 2, 3):
        tables.publish(spark.range(n), name)
    assert tables.vacuum(spark, name) == []  # too young
    assert len(tables.vacuum(spark, name, keep_hours=-1)) == 2
    assert tables.read(spark, name).count() == 3
    part = "strata_x.vacuumed_parts"
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    tables.publish(rows, part, partition_by=["p"])
    tables.merge_partitioned(rows.filter("k = 1"), part, ["k"], "p")
    assert tables.vacuum(spark, part, keep_hours=-1) == []  # either snapshot holds a partition
    tables.merge_partitioned(rows, part, ["k"], "p")
    assert len(tables.vacuum(spark, part, keep_hours=-1)) == 1  # the first is the table's location
    assert tables.read(spark, part).count() == 2


def test_stores_replay_through_a_whole_job(spark, tmp_path):
    """A dimension without partitions keeps NULL keys of several loads."""
    target = "strata_x.null_stores"
    one = spark.createDataFrame([(None, "N", "EAST", datetime(2024, 5, 1))], "store_id string, name string, region string, _record_ingestion_ts timestamp_ntz")
    write_silver(tables.materialize(one), STORES, target, RunContext(batch_id="a"))
    write_silver(tables.materialize(one.withColumn("_record_ingestion_ts", F.lit("2024-05-02").cast("timestamp_ntz"))), STORES, target, RunContext(batch_id="b"))
    assert tables.read(spark, target).count() == 2
