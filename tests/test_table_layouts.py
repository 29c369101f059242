"""Partition-scoped updates, bucketed merges, clustered marts, sketches."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators import gold, sketches
from strata.operators.upsert import merge_update_all, merge_update_columns, update_where
from strata.queries import layers as L
from strata.sinks import bucketed, tables

SF = "/root/testdata/sf0.001"
COLUMNS = "id int, part string, v int, w string"


def _rows(df, *cols):
    return sorted(map(tuple, df.select(*(cols or ("id", "part", "v", "w"))).collect()), key=str)


def _frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def _files(spark, name, part):
    return {r[0] for r in tables.read(spark, name).filter(F.col("part") == part).select("_metadata.file_path").distinct().collect()}


BASE = [(1, "a", 1, "x"), (2, "a", 2, "x"), (3, "b", 3, "x"), (4, "c", 4, "x"), (None, "d", 5, "x"), (6, "e", 6, "x")]


def test_update_list_touches_its_partitions_only(spark):
    name = "strata_l.update_list"
    tables.publish(_frame(spark, BASE), name, partition_by=["part"])
    # 3 is matched (its source partition doesn't count), 9 is new in b, a NULL key in f
    source = _frame(spark, [(3, "c", 30, "y"), (9, "b", 90, "y"), (None, "f", 50, "y")])
    kept = {p: _files(spark, name, p) for p in "acde"}
    want = _rows(merge_update_columns(_frame(spark, BASE), source, ["id"], ["v"]))
    assert sorted(tables.merge_columns_partitioned(source, name, ["id"], "part", ["v"])) == ["b", "f"]
    assert _rows(tables.read(spark, name)) == want and (3, "b", 30, "x") in want
    assert {p: _files(spark, name, p) for p in "acde"} == kept
    # an update list with the partition column moves rows
    moved = _frame(spark, [(1, "z", 0, "y"), (2, "z", 0, "y")])
    want = _rows(merge_update_columns(tables.read(spark, name), moved, ["id"], ["part"]))
    assert sorted(tables.merge_columns_partitioned(moved, name, ["id"], "part", ["part"])) == ["a", "z"]
    assert _rows(tables.read(spark, name)) == want
    assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()} == {f"part={p}" for p in "bcdefz"}


def test_predicate_update_touches_its_partitions_only(spark):
    name = "strata_l.update"
    tables.publish(_frame(spark, BASE), name, partition_by=["part"])
    kept = {p: _files(spark, name, p) for p in "abde"}
    pred = F.col("v") >= 4
    assert tables.update_partitioned(spark, name, pred & (F.col("part") < "d"), {"w": "new"}) == ["c"]
    assert {p: _files(spark, name, p) for p in "abde"} == kept
    assert _rows(tables.read(spark, name)) == _rows(update_where(_frame(spark, BASE), pred & (F.col("part") < "d"), {"w": "new"}))
    assert tables.update_partitioned(spark, name, F.col("v") > 100, {"w": "never"}) == []
    # rows that move to a partition that is there, and to a new one
    assert sorted(tables.update_partitioned(spark, name, F.col("part") == "e", {"part": "a"})) == ["a", "e"]
    assert sorted(tables.update_partitioned(spark, name, F.col("part") == "b", {"part": F.lit("new")})) == ["b", "new"]
    assert _rows(tables.read(spark, name), "id", "part") == sorted(
        [(1, "a"), (2, "a"), (3, "new"), (4, "c"), (None, "d"), (6, "a")], key=str)


def test_partition_search_is_pruned(spark):
    name = "strata_l.pruned"
    tables.publish(_frame(spark, BASE), name, partition_by=["part"])
    hit = tables.read(spark, name).filter((F.col("v") >= 4) & (F.col("part") < "d")).select("part")
    assert "PartitionFilters: [isnotnull(part" in hit._jdf.queryExecution().executedPlan().toString()


def test_many_partitions_in_one_table(spark):
    """Values that need escapes, and partitions that stay, go and come."""
    name = "strata_l.many"
    parts = ["a b", "c/d", "e=f", "g%h", "it's", "ä+ö"]
    tables.publish(_frame(spark, [(i, p, i, "x") for i, p in enumerate(parts)]), name, partition_by=["part"])
    source = _frame(spark, [(0, "a b", 10, "y"), (1, "new+1", 11, "y"), (7, "new 2", 17, "y"), (5, "ä+ö", 15, "y")])
    want = _rows(merge_update_all(tables.read(spark, name), source, ["id"]))
    tables.merge_partitioned(source, name, ["id"], "part")
    assert _rows(tables.read(spark, name)) == want
    assert sorted(r.part for r in tables.partitions(spark, name).collect()) == sorted(["a b", "e=f", "g%h", "it's", "ä+ö", "new+1", "new 2"])
    tables.publish(_frame(spark, [(1, "it's", 1, "z")]), name)  # repoints, and drops the others
    assert _rows(tables.read(spark, name)) == [(1, "it's", 1, "z")]


# ------------------------------------------------------------- buckets

def test_bucketed_merges(spark):
    r = random.Random(3)
    name = "strata_l.bucketed"
    base = [(i, "p", r.randint(0, 9), "x") for i in range(200)] + [(None, "p", 1, "x"), (None, "p", 1, "x")]
    bucketed.create(_frame(spark, base), name, ["id"], 4)
    want = _frame(spark, base)
    for n in (1, 2):
        source = _frame(spark, [(i, "q", n, None) for i in r.sample(range(300), 60)] + [(None, "q", n, "y")])
        want = merge_update_all(want, source, ["id"])
        bucketed.merge(source, name, f"b{n}")
    got = _rows(bucketed.read(spark, name))
    assert got == _rows(want)
    bucketed.merge(source, name, "b2")  # replayed
    assert _rows(bucketed.read(spark, name)) == got
    # fewer columns, others in no order
    less = source.select("v", "id").filter("id is not null")
    assert _rows(bucketed.merged(less, name)) == _rows(merge_update_all(tables.read(spark, name), less, ["id"]))
    with pytest.raises(ValueError):
        bucketed.merge(source.withColumn("extra", F.lit(1)), name, "b3")


def test_bucketed_merge_shuffles_the_batch_alone(spark):
    name = "strata_l.bucketed_plan"
    bucketed.create(spark.range(5000).selectExpr("cast(id as int) as id", "'p' as part", "1 as v", "'x' as w"), name, ["id"], 4)
    batch = tables.materialize(spark.range(100).selectExpr("cast(id * 7 as int) as id", "'q' as part", "2 as v", "'y' as w"))
    out = bucketed.merged(batch, name)
    assert out.count() == 5000
    lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    (scan,) = [i for i, s in enumerate(lines) if "SelectedBucketsCount: 4 out of 4" in s or "Bucketed: true" in s]
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-*|"))
    # the nodes above the table's scan, up to the join
    above = [s for s in lines[:scan] if "Exchange" in s and len(s) - len(s.lstrip(" :+-*|")) < depth]
    joins = [i for i, s in enumerate(lines) if "SortMergeJoin" in s]
    assert joins and not [s for s in lines[joins[0]:scan] if "Exchange" in s], above
    assert sum("Exchange hashpartitioning" in s for s in lines) == 1
    bucketed.merge(batch, name, "b1")
    assert len(tables.read(spark, name).inputFiles()) == 4  # a file a bucket, as before


# ------------------------------------------------------- clustered marts

def test_clustered_files_hold_ascending_ranges(spark):
    name = "strata_l.clustered"
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("s"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.publish(rows, name, cluster_by=["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    t = tables.read(spark, name).select("k", "_metadata.file_path", "_metadata.row_index")
    by_file = {}
    for r in t.collect():
        by_file.setdefault(r.file_path, []).append((r.row_index, r.k))
    ranges = sorted((min(k for _, k in v), max(k for _, k in v)) for v in by_file.values())
    assert len(ranges) > 2 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert all([k for _, k in sorted(v)] == sorted(k for _, k in v) for v in by_file.values())


# -------------------------------------------------------------- sketches

def _close(approx, exact):
    return abs(approx - exact) <= max(1, 4 * sketches.ERROR * exact)


def test_sketched_marts_are_near_the_exact_ones(spark):
    tx = tables.materialize(L.silver(spark, SF, "transactions"))
    stores = L.silver(spark, SF, "stores")
    for exact, approx, key in ((gold.daily_sales(tx), gold.daily_sales(tx, sketches.approx_distinct), ("sale_date", "_record_ingestion_ts")),
                               (gold.store_performance(stores, tx), gold.store_performance(stores, tx, sketches.approx_distinct), ("store_id",))):
        a, b = ({tuple(r[k] for k in key): r.asDict() for r in df.collect()} for df in (exact, approx))
        assert a.keys() == b.keys()
        for k in a:
            for c, v in a[k].items():
                assert _close(b[k][c], v) if c.startswith("unique_") else b[k][c] == v
    # no row for each group and value
    assert "Expand" in gold.daily_sales(tx)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in gold.daily_sales(tx, sketches.approx_distinct)._jdf.queryExecution().optimizedPlan().toString()


def test_states_of_loads_unite(spark):
    rows = spark.range(60_000).select(
        (F.col("id") * 31 % 20_000).cast("string").alias("customer_id"), F.when(F.col("id") % 3 > 0, F.col("id") % 50).cast("string").alias("store_id"),
        F.timestamp_add("DAY", (F.col("id") % 9).cast("int"), F.lit("2024-01-01").cast("timestamp")).cast("timestamp_ntz").alias("transaction_ts"),
        F.when(F.col("id") < 30_000, F.lit("2024-02-01")).otherwise(F.lit("2024-02-02")).cast("timestamp_ntz").alias("_record_ingestion_ts"))
    columns = ["customer_id", "store_id"]
    loads = [sketches.distinct_states(rows.filter(F.col("_record_ingestion_ts") == F.lit(d).cast("timestamp_ntz")), columns) for d in ("2024-02-01", "2024-02-02")]
    stored = tables.materialize(loads[0]).unionByName(tables.materialize(loads[1]))
    names = {"customer_id": "customers", "store_id": "stores"}
    for by in ([], ["sale_date"], ["_record_ingestion_ts"]):
        got = {tuple(r[b] for b in by): (r.customers, r.stores) for r in sketches.estimates(stored, names, by).collect()}
        t = rows.withColumn("sale_date", F.to_date("transaction_ts"))
        for r in t.groupBy(*by).agg(F.count_distinct("customer_id").alias("c"), F.count_distinct("store_id").alias("s")).collect():
            c, s = got[tuple(r[b] for b in by)]
            assert _close(c, r.c) and _close(s, r.s)
    empty = sketches.distinct_states(rows.limit(0), columns)
    assert sketches.estimates(empty, names, ["sale_date"]).collect() == []
