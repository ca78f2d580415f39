"""Column functions on edge values."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from projectmart.functions import dates as D
from projectmart.functions import fixed_values as V
from projectmart.functions import values as N
from projectmart.operators import aggregates as A


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")


def applied(df, column):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_dates_in_five_formats(spark):
    df = texts(
        spark,
        ["2025-03-05", "05/03/2025", "20250305", "05-Mar-2025", "03-05-2025", "2025-3-5",
         "2025-13-40", "2025-03-05 ", "2025-03-05T00:00:00", "", None, "N/A"],
    )
    found = applied(df, D.parse_date(F.col("x")))
    assert found == [date(2025, 3, 5)] * 5 + [None] * 7


def test_fifth_format_is_month_first(spark):
    assert applied(texts(spark, ["05-03-2025"]), D.parse_date(F.col("x"))) == [date(2025, 5, 3)]


def test_three_formats_leave_the_other_two(spark):
    df = texts(spark, ["2025-03-05", "05/03/2025", "20250305", "05-Mar-2025", "03-05-2025"])
    found = applied(df, D.parse_date(F.col("x"), V.THREE_FORMATS))
    assert found == [date(2025, 3, 5)] * 3 + [None, None]


@pytest.mark.parametrize(
    ("formats", "last"), [(V.MONTH_FORMATS, date(2025, 3, 1)), (V.MONTH_FORMATS_SHORT, None)]
)
def test_months(spark, formats, last):
    df = texts(spark, ["2025-03-01", "2025-03", "01/03/2025", "March 2025", "misc", None])
    found = applied(df, D.parse_month(F.col("x"), formats))
    assert found == [date(2025, 3, 1)] * 3 + [last, None, None]


def test_names_of_parsed_columns(spark):
    df = spark.createDataFrame([("2025-03-05", "20250305")], "start_date string, end_dt string")
    assert D.parse_dates(df, "start_date").columns[-1] == "start_date_dt"
    assert D.parse_dates(df, "start_date", rename=D.strip_date_suffix).columns[-1] == "start_dt"
    assert D.strip_date_suffix("end_dt") == "end_dt"
    assert D.strip_date_suffix("due_date_str") == "due_dt"


def test_fold_keeps_tabs(spark):
    assert applied(texts(spark, ["  A b ", "\tA", None]), N.fold(F.col("x"))) == ["a b", "\ta", None]


def test_enum_map(spark):
    df = texts(spark, ["Site_Manager", "site  manager", "site manager", "mgr", "PROJECT MANAGER",
                       "unknown", "", None])
    found = applied(df, N.map_enum(F.col("x"), V.ROLES, V.ROLE_VARIANTS))
    assert found == ["site_manager", "site_manager", None, "site_manager", "project_manager",
                     None, None, None]


def test_department_without_value_is_unassigned(spark):
    df = texts(spark, ["N/A", "", " unknown", "sfaety", "other", None])
    valid = (*V.DEPARTMENTS, V.UNASSIGNED)
    found = applied(df, N.map_enum(F.col("x"), valid, V.DEPARTMENT_VARIANTS))
    assert found == ["unassigned"] * 3 + ["safety", None, None]


def test_unmapped_municipality_stays_folded(spark):
    df = texts(spark, ["Helsinki", "HYVINKÄÄ", "Unknown", "", None])
    column = N.map_enum(F.col("x"), (), V.MUNICIPALITY_VARIANTS, keep_unmapped=True)
    assert applied(df, column) == ["HKI", "HYV", "unknown", "", None]


def test_booleans(spark):
    df = texts(spark, ["True", " Y", "1", "no", "0", "maybe", "t", "", None])
    found = applied(df, N.parse_bool(F.col("x")))
    assert found == [True, True, True, False, False, None, None, None, None]


def test_key_shapes(spark):
    df = texts(spark, ["0000000-0", "12345", None])
    assert applied(df, N.matches_flag(F.col("x"), V.BUSINESS_ID)) == [True, False, False]
    df = texts(spark, ["EMP-9999", "EMP-12345", "NULL", "", None])
    narrow = applied(df, N.null_unless_matches(F.col("x"), V.NARROW_KEYS["employee_id"]))
    wide = applied(df, N.null_unless_matches(F.col("x"), V.WIDE_KEYS["employee_id"]))
    assert narrow == ["EMP-9999", None, None, None, None]
    assert wide == ["EMP-9999", "EMP-12345", None, None, None]


def test_score_range(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([0, 1, 10, 11, None])], "i int, x int")
    assert applied(df, N.null_outside(F.col("x"))) == [None, 1, 10, None, None]


def test_weighted_score(spark):
    df = spark.createDataFrame(
        [(0, 10, 10, 10, 10), (1, 7, 9, 3, 5), (2, 7, None, 3, 5)],
        "i int, quality_score int, schedule_score int, safety_score int, communication_score int",
    )
    scores = {c: F.col(c) for c in V.SCORE_WEIGHTS}
    assert applied(df, N.weighted_score(scores)) == [10.0, 6.6, None]


def test_variance_and_flag(spark):
    df = spark.createDataFrame(
        [(0, -100.10, 100.0), (1, 50.0, -80.255), (2, None, 1.0)], "i int, a double, b double"
    )
    assert applied(df, N.variance(F.col("a"), F.col("b"))) == [0.1, -30.26, None]
    assert applied(df, N.over_invoiced(F.col("b"), F.col("a"))) == [False, True, False]


def test_overdue_days_and_buckets(spark):
    days = [0, 1, 30, 31, 60, 61, 90, 91]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d int")
    due = F.date_sub(F.lit("2025-06-30").cast("date"), F.col("d"))
    late = N.days_overdue(F.lit("pending"), due, F.lit("2025-06-30").cast("date"))
    assert applied(df, late) == days
    assert applied(df, N.aging_bucket(F.col("d"))) == [
        "current", "1-30 days", "1-30 days", "31-60 days", "31-60 days", "61-90 days",
        "61-90 days", "90+ days",
    ]
    one = df.filter("i = 7")
    as_of = F.lit("2025-06-30").cast("date")
    for status in (F.lit("paid"), F.lit(None).cast("string")):
        assert applied(one, N.days_overdue(status, due, as_of)) == [0]
    unknown = F.lit(None).cast("date")
    assert applied(one, N.days_overdue(F.lit("pending"), unknown, as_of)) == [0]
    assert applied(one, N.aging_bucket(F.lit(None).cast("int"))) == ["90+ days"]


def test_date_not_before(spark):
    rows = [(0, date(2025, 1, 1), date(2025, 1, 1)), (1, date(2025, 1, 1), date(2025, 1, 2)),
            (2, date(2025, 1, 1), None)]
    df = spark.createDataFrame(rows, "i int, ended date, started date")
    found = applied(df, N.null_if_before(F.col("ended"), F.col("started")))
    assert found == [date(2025, 1, 1), None, date(2025, 1, 1)]


def test_risk_bucket_is_open_on_the_left(spark):
    values = [0.0, 0.0001, 0.3, 0.3001, 0.7, 0.71, 1.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, p double")
    assert applied(df, N.risk_bucket(F.col("p"))) == [
        None, "low", "low", "medium", "medium", "high", "high",
    ]


def test_rounding_follows_decimal_digits(spark):
    df = spark.createDataFrame([(0, 1.005), (1, -1.005), (2, 2.675)], "i int, x double")
    assert applied(df, N.round_half_up(F.col("x"), 2)) == [1.01, -1.01, 2.68]


def test_values_are_rounded_once(spark):
    df = spark.createDataFrame([(0, 0.12499999996), (1, 33.33499999997), (2, 2e14)], "i int, x double")
    assert applied(df, N.round_half_up(F.col("x"), 2)) == [0.12, 33.33, 2e14]


def test_percentages_of_both_paths(spark):
    df = spark.createDataFrame([(0, 23, 160), (1, 29, 800), (2, 41, 160)], "i int, n int, d int")
    n, d = F.col("n"), F.col("d")
    # One divides first, the other multiplies first: 23 / 160 * 100 is a little below 14.375, and so on.
    assert applied(df, A.pct(n, d)) == [14.37, 3.62, 25.62]
    assert applied(df, A.hundredths(n, d)) == [14.38, 3.63, 25.63]


def test_large_amounts_are_summed_exactly(spark):
    df = spark.createDataFrame([(2e14,), (0.01,), (0.02,)], "x double")
    assert df.agg(A.money_total(F.col("x")).cast("string")).collect()[0][0] == "200000000000000.0300"


def test_ratio_of_zero_and_unknown(spark):
    df = spark.createDataFrame([(0, 1, 8), (1, 1, 0), (2, 1, None)], "i int, n int, d int")
    assert applied(df, A.pct(F.col("n"), F.col("d"))) == [12.5, None, None]
    assert applied(df, A.ratio(F.col("n"), F.col("d"))) == [0.125, None, None]


def test_fill_numeric_leaves_text_and_excluded(spark):
    df = spark.createDataFrame(
        [(None, None, None, None)], "a int, b double, label bigint, name string"
    )
    assert N.fill_numeric(df, exclude=["label"]).collect()[0] == (0, 0.0, None, None)
