from helpers import day, frame, one, rows
from pyspark.sql import functions as F

from riskspark.functions import dates, scalars


def test_month_end_and_rolling(spark):
    df = frame(spark, "d date", [("2024-02-28",), ("2024-02-29",), ("2023-02-28",), ("2024-04-30",), ("2024-08-31",), ("2024-08-15",)])
    ends = {r[0] for r in dates.month_end_rows(df, "d").collect()}
    assert ends == {day("2024-02-29"), day("2023-02-28"), day("2024-04-30"), day("2024-08-31")}
    rolled = dict(rows(df.select("d", dates.roll_to_month_end(F.col("d")).alias("r")), "d", "r"))
    assert rolled[day("2024-02-28")] == day("2024-02-29")
    assert rolled[day("2024-02-29")] == day("2024-03-31")
    assert rolled[day("2024-08-31")] == day("2024-09-30")


def test_calendar_months_count_boundaries(spark):
    df = frame(spark, "a date, b date", [("2024-01-31", "2024-02-01"), ("2023-12-01", "2024-02-29"), ("2024-03-01", "2024-02-29")])
    assert rows(df.select(dates.calendar_months_between(F.col("a"), F.col("b")).alias("m")), "m") == [(-1,), (1,), (2,)]


def test_full_years_around_birthday(spark):
    df = frame(spark, "b date", [("1990-06-14",), ("1990-06-15",), ("1990-06-16",)])
    assert rows(df.select("b", dates.full_years(F.col("b"), "2020-06-15").alias("age")), "b", "age") == [
        (day("1990-06-14"), 30), (day("1990-06-15"), 30), (day("1990-06-16"), 29)]


def test_report_dates(spark):
    df = frame(spark, "SnapshotDate date", [("2024-03-31",), ("2024-04-15",), ("2024-02-29",)])
    assert tuple(one(dates.report_dates(df))) == (day("2024-03-31"), day("2024-02-29"))
    assert tuple(one(dates.report_dates(df, "2024-01-31"))) == (day("2024-01-31"), day("2023-12-31"))


def test_half_even_and_bins(spark):
    df = frame(spark, "x double", [(0.125,), (0.375,), (0.0,), (0.28,), (0.2800001,), (1.0,), (1.1,)])
    got = {r.x: (r.h, r.b) for r in df.select(
        "x", scalars.round_half_even(F.col("x")).alias("h"), scalars.right_closed_bin(F.col("x"), (0, 0.28, 0.36, 0.46, 0.58, 0.71, 1)).alias("b")).collect()}
    assert got[0.125][0] == 0.12 and got[0.375][0] == 0.38
    assert got[0.0][1] is None and got[1.1][1] is None
    assert got[0.28][1] == 0 and got[0.2800001][1] == 1 and got[1.0][1] == 5


def test_numbers_and_missing(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), (None,)], "t string")
    assert sorted((r[0] is None, r[0]) for r in df.select(scalars.to_number(F.col("t"))).collect())[0] == (False, 1.5)
    assert df.select(scalars.to_number(F.col("t")).alias("n")).filter("n is null").count() == 3
    wide = spark.createDataFrame([(float("nan"),), (2.0,)], "v double")
    assert scalars.nan_to_null(wide).filter("v is null").count() == 1


def test_rolling_mean_needs_full_window(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None), (4, 4.0), (5, 5.0), (6, 6.0)], "i int, v double")
    got = dict(rows(df.select("i", scalars.rolling_mean(F.col("v"), 3, F.col("i")).alias("m")).fillna(-1.0), "i", "m"))
    assert got == {1: -1, 2: -1, 3: -1, 4: -1, 5: -1, 6: 5}


def test_min_max_scale_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert rows(scalars.min_max_scale(df, ["a", "b"]), "a", "b") == [(0.0, 0.0), (1.0, 0.0)]
