from datetime import datetime

from pyspark.sql import functions as F

from strata.context import RunContext
from strata.functions import money
from strata.operators import incremental as inc
from strata.schemas import LOAD_AUDIT


def test_money_sum_is_exact_and_partition_independent(spark):
    # 0.1 * 3 lines, many times: a DOUBLE sum drifts, the DECIMAL one does not.
    rows = [(0.1, 3, 0.0)] * 3000 + [(19.99, 1, 12.5)] * 7
    df = spark.createDataFrame(rows, "unit_price double, quantity int, discount double")
    outs = set()
    for n in (1, 4, 16):
        r = (df.repartition(n)
               .agg(money.cents(F.sum(money.line_net_x100("unit_price", "quantity", "discount")))
                    .alias("net"),
                    money.cents(F.sum(money.line_discount_x100("unit_price", "quantity", "discount")))
                    .alias("disc"))
               .first())
        outs.add((r.net, r.disc))
    # 900.00 + 7 * 19.99 * 0.875 = 900 + 122.43875 -> 1022.44; discount 7 * 2.49875 -> 17.49
    assert outs == {(1022.44, 17.49)}


def test_mean_price_half_up(spark):
    df = spark.createDataFrame([(1.005,), (1.005,)], "p double")
    r = df.agg(money.mean_price(money.price_sum("p"), F.count("p")).alias("m")).first()
    assert r.m == 1.01  # each price is 1.01 in cents (HALF_UP on the cast), mean 1.01


def test_watermark_default_strict_and_empty_batch(spark):
    t = lambda d: datetime(2024, 1, d)
    src = spark.createDataFrame([(1, t(1)), (2, t(2)), (3, t(3)), (4, None)],
                                "id int, _record_ingestion_ts timestamp_ntz")
    empty_audit = spark.createDataFrame([], LOAD_AUDIT)
    # No audit rows: default 1900-01-01 -> every non-NULL timestamp.
    assert inc.incremental_read(src, empty_audit, "x").count() == 3
    audit = spark.createDataFrame([("b", "x", t(2), None, None), ("b", "y", t(3), None, None)],
                                  LOAD_AUDIT)
    got = sorted(r.id for r in inc.incremental_read(src, audit, "x").collect())
    assert got == [3]  # strictly after the watermark of table x only
    lazy = sorted(r.id for r in inc.incremental_read(src, audit, "x", resolve=False).collect())
    assert lazy == [3]
    ctx = RunContext(as_of=datetime(2024, 2, 1), batch_id="b9")
    assert inc.audit_row(src.limit(0), ctx, "x").count() == 0
    row = inc.audit_row(src, ctx, "x").first()
    assert row.log_ts == t(3) and row.batch_id == "b9"


def test_stream_replay_takes_only_new_files(spark, tmp_path):
    from strata.sinks import tables
    from strata.streaming.ingest import run_available
    land = tmp_path / "landing"
    land.mkdir()
    header = "store_id,name,region\n"
    (land / "stores_a.csv").write_text(header + "s1,One,EAST\ns2,Two,WEST\n")
    target, ckpt = "strata_t.stream_stores", str(tmp_path / "ckpt")
    assert run_available(spark, str(land), "stores", target, ckpt) == 1
    assert tables.read(spark, target).count() == 2
    assert run_available(spark, str(land), "stores", target, ckpt) == 0   # nothing new
    (land / "stores_b.csv").write_text(header + "s2,Two v2,WEST\ns3,Three,EAST\n")
    assert run_available(spark, str(land), "stores", target, ckpt) == 1
    rows = {r.store_id: r.name for r in tables.read(spark, target).collect()}
    assert rows == {"S1": "One", "S2": "Two v2", "S3": "Three"}


def test_stream_archives_committed_files(spark, tmp_path):
    import os
    from strata.sinks import tables
    from strata.streaming.ingest import run_available
    land, arch = tmp_path / "landing", tmp_path / "archive"
    land.mkdir()
    (land / "stores_x.csv").write_text("store_id,name,region\ns7,Seven,EAST\n")
    n = run_available(spark, str(land), "stores", "strata_t.stream_arch", str(tmp_path / "ck"),
                      archive_dir=str(arch), max_files_per_trigger=1)
    assert n == 1 and tables.read(spark, "strata_t.stream_arch").count() == 1
    # The file of the committed batch leaves the landing folder (moved by
    # the source when the next batch is planned or the query stops).
    moved = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".csv")]
    assert moved == ["stores_x.csv"] or os.path.exists(land / "stores_x.csv")


def test_money_keeps_small_negative_and_large_values(spark):
    rows = [("a", 0.333, 1000, 0.0), ("b", -1.25, 1, 50.0), ("c", 9.99, 1_000_000, 0.0), ("d", 1e30, 2, 0.0), ("e", 0.004, 1, 0.0),
            ("e", 0.004, 1, 0.0)]
    df = spark.createDataFrame(rows, "k string, unit_price double, quantity int, discount double")
    got = {r.k: (r.net, r.disc, r.mean) for r in df.groupBy("k").agg(
        money.cents(F.sum(money.line_net_x100("unit_price", "quantity", "discount"))).alias("net"),
        money.cents(F.sum(money.line_discount_x100("unit_price", "quantity", "discount"))).alias("disc"),
        money.mean_price(money.price_sum("unit_price"), F.count("unit_price")).alias("mean")).collect()}
    assert got["a"] == (333.0, 0.0, 0.33)
    assert got["b"] == (-0.63, -0.63, -1.25)  # half-up, away from zero
    assert got["c"][0] == 9_990_000.0
    assert got["d"] == (None, None, None)  # no DECIMAL holds it: no error, the range check reports it
    assert got["e"][0] == 0.01  # rounded once, after the sum
