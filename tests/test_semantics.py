"""One test per comparison rule of the source system (S1-S27 in the survey)."""

import datetime as dt

from pyspark.sql import functions as F

from wellmart.functions.semantics import (
    add_months_ts,
    any_not_null,
    eq_ci,
    first_non_empty,
    guarded_ratio,
    in_ci,
    isnull,
    label_if_total,
    like_ci,
    month_boundaries,
    ne_ci,
    not_in_ci,
    null_if_ci,
    null_outside,
    varchar,
)


def ts(*a):
    return dt.datetime(*a)


def col_values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_case_and_trailing_blank_insensitive_equality(spark):  # S1, S2
    df = spark.createDataFrame([("Louisiana",), ("LOUISIANA",), ("TEXAS ",), ("Texas",), (None,)], "s string")
    assert col_values(df, eq_ci("s", "louisiana")) == [True, True, False, False, None]
    assert col_values(df, eq_ci("s", "Texas")) == [False, False, True, True, None]
    assert col_values(df, in_ci("s", ["TEXAS", "Oklahoma"])) == [False, False, True, True, None]
    # NOT IN / <> drop NULL under three-valued logic (S5)
    assert col_values(df, not_in_ci("s", ["texas"])) == [True, True, False, False, None]
    assert col_values(df, ne_ci("s", "texas")) == [True, True, False, False, None]


def test_like_is_case_insensitive(spark):
    df = spark.createDataFrame([("Fresh Water",), ("brine",), (None,)], "s string")
    assert col_values(df, like_ci("s", "%WATER%")) == [True, False, None]


def test_isnull_keeps_type_of_first_argument(spark):  # S4
    df = spark.createDataFrame([(None, 7.9), ("a", 1.0)], "s string, d double")
    out = df.select(isnull("s", F.lit(0), "string").alias("x"), isnull(F.lit(None), "d", "bigint").alias("y"))
    assert out.schema["x"].dataType.simpleString() == "string"
    assert [tuple(r) for r in out.collect()] == [("0", 7), ("a", 1)]


def test_month_boundaries_count_calendar_boundaries(spark):  # S6
    rows = [(ts(2015, 1, 31), ts(2015, 2, 1)), (ts(2015, 2, 1), ts(2015, 1, 31)),
            (ts(2015, 5, 1), ts(2015, 2, 28)), (ts(2015, 5, 1), ts(2015, 1, 1)), (ts(2014, 12, 31), ts(2015, 1, 1))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert col_values(df, month_boundaries("a", "b")) == [1, -1, -3, -4, 1]


def test_add_months_clamps_and_keeps_time(spark):  # S7
    df = spark.createDataFrame([(ts(2015, 1, 31, 10, 30),), (ts(2015, 3, 31, 23, 59),)], "d timestamp_ntz")
    assert col_values(df, add_months_ts("d", 1)) == [ts(2015, 2, 28, 10, 30), ts(2015, 4, 30, 23, 59)]
    assert col_values(df, add_months_ts("d", -1)) == [ts(2014, 12, 31, 10, 30), ts(2015, 2, 28, 23, 59)]


def test_string_key_range(spark):  # S20
    df = spark.createDataFrame([("0",), ("00",), ("4250536539",), (None,), ("",)], "api string")
    assert [r.api for r in df.where(F.col("api") > F.lit("0")).collect()] == ["00", "4250536539"]


def test_null_if_ci_and_null_outside(spark):  # RUL-2, RUL-18
    df = spark.createDataFrame([("unknown", 0.99), ("NULL", 1.0), ("", 99.9), (" ", 100.0), ("x", None)],
                               "s string, v double")
    assert col_values(df, null_if_ci("s", ["NULL", "UNKNOWN", ""])) == [None, None, None, None, "x"]
    assert col_values(df, null_outside("v", 0.99, 100)) == [None, 1.0, 99.9, None, None]
    assert col_values(df, null_outside("v", 0, 99.9, high_inclusive=False)) == [0.99, 1.0, 99.9, None, None]


def test_any_not_null_and_first_non_empty(spark):  # FLT-4, RUL-4
    df = spark.createDataFrame([(None, None), ("", "b"), ("  ", None), ("a", "b")], "a string, b string")
    assert col_values(df, any_not_null("a", "b")) == [False, True, True, True]
    assert col_values(df, first_non_empty("a", "b", default=F.lit("UNKNOWN"))) == ["UNKNOWN", "b", "UNKNOWN", "a"]


def test_varchar_truncates(spark):  # FN-7
    df = spark.createDataFrame([("42123456789012345",), (None,)], "s string")
    assert col_values(df, varchar("s", 14)) == ["42123456789012", None]


def test_guarded_ratio_and_label(spark):  # RUL-24, RUL-26
    df = spark.createDataFrame([(10.0, 2.0, "A", 1.0), (0.0, 2.0, None, 1.0), (5.0, None, None, None)],
                               "n double, d double, lst string, tot double")
    assert col_values(df, guarded_ratio("n", "d")) == [5.0, None, None]
    assert col_values(df, label_if_total("lst", "tot")) == ["A", "UNKNOWN", None]


def test_bigint_cast_truncates_toward_zero(spark):  # S27
    df = spark.createDataFrame([(12.7,), (-12.7,)], "d double")
    assert col_values(df, F.col("d").cast("bigint")) == [12, -12]


def test_like_ignores_trailing_blanks_of_the_value(spark):  # S2 for LIKE
    df = spark.createDataFrame([("OTTAWA SAN  ",), ("SD ",), ("40/7 ",), ("40/7",)], "s string")
    assert col_values(df, like_ci("s", "% SAN")) == [True, False, False, False]
    assert col_values(df, like_ci("s", "SD")) == [False, True, False, False]
    assert col_values(df, like_ci("s", "%40/7 %")) == [False, False, True, False]
