from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.operators.dedup import dedup
from strata.operators.upsert import (MergeKeyError, merge_update_all, merge_update_columns,
                                     update_where)


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_dedup_first_last_and_null_key_group(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    df = spark.createDataFrame(
        [("a", t1, 1), ("a", t2, 2), (None, t1, 3), (None, t2, 4), ("b", t2, 5)],
        "k string, ts timestamp_ntz, v int")
    first = dedup(df, ["k"], "first", ["ts"])
    last = dedup(df, ["k"], "last", ["ts"])
    assert _rows(first, "v") == [(1,), (3,), (5,)]
    assert _rows(last, "v") == [(2,), (4,), (5,)]


def test_dedup_total_order_is_partition_independent(spark):
    # Every row ties on the order column: the remaining columns decide.
    rows = [("k", 0, i % 7, f"x{i % 5}") for i in range(200)]
    df = spark.createDataFrame(rows, "k string, ts int, a int, b string")
    picks = {tuple(dedup(df.repartition(n), ["k"], "first", ["ts"]).first()) for n in (1, 3, 8)}
    assert picks == {("k", 0, 0, "x0")}


def test_dedup_plan_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup(df, ["k"], "first", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_merge_update_all_null_keys_never_match(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    src = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    out = merge_update_all(tgt, src, ["k"])
    assert _rows(out.fillna(-1, ["k"]), "k", "v") == [(-1, "N"), (-1, "n"), (1, "a"), (2, "B"), (3, "C")]


def test_merge_rejects_duplicate_source_keys(spark):
    tgt = spark.createDataFrame([(1, "a")], "k int, v string")
    src = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    with pytest.raises(MergeKeyError):
        merge_update_all(tgt, src, ["k"])


def test_merge_update_columns_keeps_other_target_columns(spark):
    tgt = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, w int")
    src = spark.createDataFrame([(2, "B", 99), (3, "C", 30)], "k int, v string, w int")
    out = merge_update_columns(tgt, src, ["k"], ["w"])
    assert _rows(out, "k", "v", "w") == [(1, "a", 10), (2, "b", 99), (3, "C", 30)]


def test_merge_adds_new_source_columns(spark):
    tgt = spark.createDataFrame([(1, "a")], "k int, v string")
    src = spark.createDataFrame([(2, "b", 5)], "k int, v string, extra int")
    out = merge_update_all(tgt, src, ["k"])
    assert _rows(out.fillna(-1), "k", "extra") == [(1, -1), (2, 5)]


def test_update_where_null_predicate_keeps_row(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "k int, s string")
    out = update_where(df, F.col("s") == "x", {"s": "y"})
    assert _rows(out.fillna("-"), "k", "s") == [(1, "-"), (2, "y")]


def test_table_create_truncate_append_align(spark):
    from strata.schemas import LOAD_AUDIT
    from strata.sinks import tables
    name = "strata_t.audit_probe"
    tables.create_empty(spark, name, LOAD_AUDIT)
    assert tables.read(spark, name).count() == 0
    assert tables.read(spark, name).schema == LOAD_AUDIT
    row = spark.createDataFrame([("b1", "t", None, None, None)], LOAD_AUDIT)
    tables.append(row, name)
    tables.append(row.withColumn("extra", F.lit(1)), name)
    got = tables.read(spark, name)
    assert got.count() == 2 and "extra" in got.columns
    assert sorted(r.extra for r in got.collect() if r.extra is not None) == [1]
    tables.truncate(spark, name)
    assert tables.read(spark, name).count() == 0


def test_merge_partitioned_rewrites_only_touched(spark):
    from strata.sinks import tables
    name = "strata_t.part_probe"
    t0 = spark.createDataFrame([(1, "x", "A"), (2, "y", "A"), (3, "z", "B"), (4, "w", "C")],
                               "k int, v string, p string")
    tables.merge_partitioned(t0, name, ["k"], "p")
    files_c = {r[0] for r in spark.table(name).filter("p = 'C'").select(F.input_file_name()).collect()}
    src = spark.createDataFrame([(3, "moved", "A"), (5, "new", "D")], "k int, v string, p string")
    touched = tables.merge_partitioned(src, name, ["k"], "p")
    assert sorted(touched) == ["A", "B", "D"]
    got = _rows(spark.table(name), "k", "v", "p")
    assert got == [(1, "x", "A"), (2, "y", "A"), (3, "moved", "A"), (4, "w", "C"), (5, "new", "D")]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["p=A", "p=C", "p=D"]
    files_c2 = {r[0] for r in spark.table(name).filter("p = 'C'").select(F.input_file_name()).collect()}
    assert files_c == files_c2


def test_publish_same_schema_repoints(spark):
    from strata.sinks import tables
    name = "strata_t.pub_probe"
    p1 = tables.publish(spark.range(3), name)
    p2 = tables.publish(spark.range(5), name)
    assert p1 != p2
    assert tables.location(spark, name).endswith(p2.rsplit("/", 1)[-1])
    assert tables.read(spark, name).count() == 5
    tables.publish(spark.range(2).selectExpr("id", "'x' AS s"), name)   # new shape: recreated
    assert tables.read(spark, name).columns == ["id", "s"]


def test_append_to_partitioned_table(spark):
    from strata.sinks import tables
    name = "strata_t.part_append_probe"
    tables.publish(spark.createDataFrame([(1, "A")], "k int, p string"), name, partition_by=["p"])
    tables.append(spark.createDataFrame([(2, "B"), (3, "A")], "k int, p string"), name)
    assert _rows(tables.read(spark, name), "k", "p") == [(1, "A"), (2, "B"), (3, "A")]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["p=A", "p=B"]
