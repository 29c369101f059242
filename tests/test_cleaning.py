import pytest

from strata.operators import cleaning


def test_trim_skips_missing_columns(spark):
    df = spark.createDataFrame([(" a ", " b ")], "x string, y string")
    out = cleaning.trim_columns(df, ["x", "nope"]).collect()[0]
    assert out.x == "a" and out.y == " b "


def test_case_upper_lower_and_unknown(spark):
    df = spark.createDataFrame([("aB",)], "x string")
    assert cleaning.standardize_case(df, ["x"], "upper").first().x == "AB"
    assert cleaning.standardize_case(df, ["x"], "lower").first().x == "ab"
    with pytest.raises(ValueError):
        cleaning.standardize_case(df, ["x"], "title")


def test_fill_nulls_none_default_passes_through(spark):
    df = spark.createDataFrame([(None, None, None)], "a string, q int, p double")
    out = cleaning.fill_nulls(df, {"a": None, "q": 1, "p": 0.0})
    r = out.first()
    assert r.a is None and r.q == 1 and r.p == 0.0
    assert dict(out.dtypes)["q"] == "int"


def test_convert_types_bad_value_is_null(spark):
    df = spark.createDataFrame([("12",), ("n/a",), (None,)], "q string")
    got = [r.q for r in cleaning.convert_types(df, {"q": "int"}).collect()]
    assert got == [12, None, None]


def test_drop_all_null_rows(spark):
    df = spark.createDataFrame([(None, None), ("a", None), (None, 1)], "a string, b int")
    assert cleaning.drop_all_null(df).count() == 2


def test_two_format_dates_only_day_first_padded_parse(spark):
    vals = ["05/03/2024", "05/03/24", "5/3/24", "2024-03-05", "31/02/2024", "bad", None]
    df = spark.createDataFrame([(v,) for v in vals], "signup_date string")
    got = [r.signup_date for r in cleaning.normalize_dates(df).collect()]
    assert got == ["2024-03-05", "2024-03-05", None, None, None, None, None]


def test_normalize_dates_noop_without_column(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert cleaning.normalize_dates(df).columns == ["x"]
