import pytest
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from strata.operators import qc


def _by_check(df):
    return {r.check_name: r.asDict() for r in df.collect()}


def test_row_count_fail_warning_pass(spark):
    df = spark.range(5)
    assert _by_check(qc.check_row_count(df, "t", 10))["row_count"]["status"] == "FAIL"
    w = _by_check(qc.check_row_count(df, "t", 1, 7))["row_count"]
    assert w["status"] == "WARNING" and w["threshold"] == 7.0
    p = _by_check(qc.check_row_count(df, "t", 1, 0))["row_count"]  # 0 expected is ignored
    assert p["status"] == "PASS" and p["threshold"] is None and p["message"] == "Row count 5 is valid"


def test_empty_frame(spark):
    df = spark.createDataFrame([], "a string")
    r = _by_check(qc.evaluate(df, "t", {"row_count": {}, "nulls": {"columns": ["a"]},
                                        "duplicates": {"key_columns": ["a"]}}))
    assert r["row_count"]["status"] == "FAIL"
    assert r["null_check_a"]["actual_value"] == 0.0 and r["null_check_a"]["status"] == "PASS"
    assert r["duplicate_check"]["status"] == "PASS"


def test_nulls_and_missing_column(spark):
    df = spark.createDataFrame([(None,), ("x",), ("y",), ("z",)], "a string")
    r = _by_check(qc.check_nulls(df, "t", ["a", "b"], 0.2))
    assert r["null_check_a"]["status"] == "FAIL" and r["null_check_a"]["failed_rows"] == 1
    assert r["null_check_a"]["message"] == "Null percentage 25.00% exceeds threshold 20.00%"
    assert r["null_check_b"]["status"] == "FAIL" and r["null_check_b"]["row_count"] is None


def test_duplicates_counts_all_rows_of_duplicated_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)] + [(i,) for i in range(3, 13)],
                               "k int")
    fail = _by_check(qc.check_duplicates(df, "t", ["k"], 0.05))["duplicate_check"]
    assert fail["status"] == "FAIL" and fail["failed_rows"] == 5 and fail["row_count"] == 16
    warn = _by_check(qc.check_duplicates(df, "t", ["k"], 0.5))["duplicate_check"]
    assert warn["status"] == "WARNING" and warn["message"] == "Found 2 duplicate key combinations"
    glob = _by_check(qc.check_duplicates(df, "t", [], 0.5))["duplicate_check"]
    assert glob["failed_rows"] == 16


def test_value_range_nan_null_bounds(spark):
    schema = StructType([StructField("v", DoubleType())])
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (20000.0,), (-1.0,)], schema)
    r = _by_check(qc.check_value_range(df, "t", "v", 0.0, 10000.0))["value_range_v"]
    assert r["status"] == "FAIL" and r["failed_rows"] == 3  # NaN, 20000, -1; NULL passes
    assert "[0.0, 10000.0]" in r["message"]
    lo = _by_check(qc.check_value_range(df, "t", "v", 0.0))["value_range_v"]
    assert lo["failed_rows"] == 1  # NaN never violates a minimum
    none = _by_check(qc.check_value_range(df, "t", "v"))["value_range_v"]
    assert none["status"] == "PASS" and none["message"] == "No range constraints specified"
    miss = _by_check(qc.check_value_range(df, "t", "w", 0.0))["value_range_w"]
    assert miss["status"] == "FAIL"


def test_valid_values_null_passes_case_sensitive(spark):
    df = spark.createDataFrame([("POS",), ("pos",), (None,)], "c string")
    r = _by_check(qc.check_valid_values(df, "t", "c", ["ECOM", "POS"]))["valid_values_c"]
    assert r["status"] == "FAIL" and r["failed_rows"] == 1


def test_referential_integrity(spark):
    fact = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "fk string")
    dim = spark.createDataFrame([("a",), ("b",)], "k string")
    r = _by_check(qc.check_referential_integrity(fact, "t", "fk", dim, "k"))["referential_integrity_fk"]
    assert r["status"] == "FAIL" and r["failed_rows"] == 1 and r["row_count"] == 4
    ok = _by_check(qc.check_referential_integrity(fact.filter("fk = 'a'"), "t", "fk", dim, "k"))
    assert ok["referential_integrity_fk"]["status"] == "PASS"


def test_schema_check(spark):
    exp = StructType([StructField("a", StringType()), StructField("b", DoubleType())])
    ok = spark.createDataFrame([], exp)
    assert _by_check(qc.check_schema(ok, "t", exp))["schema_check"]["status"] == "PASS"
    typed = spark.createDataFrame([], "a string, b string")
    assert _by_check(qc.check_schema(typed, "t", exp))["schema_check"]["status"] == "WARNING"
    names = spark.createDataFrame([], "a string, c string")
    assert _by_check(qc.check_schema(names, "t", exp))["schema_check"]["status"] == "FAIL"


def test_gate_raises_with_all_failures(spark):
    df = spark.createDataFrame([(None,)], "a string")
    res = qc.evaluate(df, "t", {"row_count": {"min_rows": 5}, "nulls": {"columns": ["a"]}})
    with pytest.raises(qc.QCFailure) as e:
        qc.gate(res)
    assert len(e.value.failures) == 2


def test_fused_checks_scan_source_once(spark, tmp_path):
    path = str(tmp_path / "src")
    spark.range(100).selectExpr("id", "cast(id % 7 as string) as s").write.parquet(path)
    df = spark.read.parquet(path)
    spec = {"row_count": {}, "nulls": {"columns": ["id", "s"]},
            "value_ranges": {"id": {"min_value": 0, "max_value": 50}},
            "valid_values": {"s": ["1", "2"]}}
    plan = qc.evaluate(df, "t", spec)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_results_schema(spark):
    res = qc.check_row_count(spark.range(1), "t")
    assert [f.name for f in res.schema.fields] == ["seq", "table_name", "check_name", "status",
                                                  "message", "row_count", "failed_rows",
                                                  "threshold", "actual_value"]


def _exchanges_fed_by_partial_agg(df):
    """For every hash exchange, the next operator below it (skipping
    codegen/adapter wrappers) must be a partial aggregate."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    ops = [ln.strip().lstrip(":+- ").lstrip("*0123456789() ") for ln in lines]
    ops = [o for o in ops if o and not o.startswith(("WholeStageCodegen", "ColumnarToRow", "InputAdapter",
                                                     "AdaptiveSparkPlan"))]
    checked = 0
    for i, o in enumerate(ops):
        if o.startswith("Exchange hashpartitioning"):
            checked += 1
            below = ops[i + 1]
            # partial_* functions, or a key-only partial aggregate (distinct)
            assert below.startswith("HashAggregate") and (
                "partial_" in below or "functions=[]" in below), below
    return checked


def test_hot_keys_are_reduced_before_shuffles(spark):
    # One key holds a third of the rows.
    rows = [("hot",)] * 300 + [(f"k{i}",) for i in range(600)] + [(None,)] * 50
    fact = spark.createDataFrame(rows, "fk string").repartition(4)
    dim = spark.createDataFrame([("hot",)] + [(f"k{i}",) for i in range(0, 600, 2)], "k string")
    assert _exchanges_fed_by_partial_agg(qc.check_duplicates(fact, "t", ["fk"])) >= 1
    assert _exchanges_fed_by_partial_agg(
        qc.check_referential_integrity(fact, "t", "fk", dim, "k")) >= 1
    r = _by_check(qc.check_referential_integrity(fact, "t", "fk", dim, "k"))["referential_integrity_fk"]
    assert r["failed_rows"] == 300 and r["row_count"] == 950
