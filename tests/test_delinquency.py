from helpers import day, frame, rows
from pyspark.sql import functions as F

from riskspark.operators import delinquency as d

PORTFOLIO = "AccountNumber long, SnapshotDate date, DelinquencyStatusCode int, NumberOfLateStatements int, CurrentAmount double"
ENDS = ["2023-01-31", "2023-02-28", "2023-03-31", "2023-04-30", "2023-05-31", "2023-06-30"]


def history(spark):
    data = [(1, e, c, 0, 100.0 * (i + 1)) for i, (e, c) in enumerate(zip(ENDS, [0, 1, 2, 3, 4, 9]))]
    data += [(2, e, 0, 0, 50.0) for e in ENDS]
    data += [(3, e, c, 0, 10.0 + c) for e, c in zip(ENDS[:2] + ENDS[4:], [2, 0, 0, 3])]
    return frame(spark, PORTFOLIO, data)


def test_severity_rules(spark):
    df = frame(spark, PORTFOLIO, [
        (1, "2023-01-31", 3, 4, 1.0), (2, "2023-01-31", 3, 5, 1.0), (3, "2023-01-31", 9, 5, 1.0),
        (4, "2023-01-31", 1, 0, 1.0), (4, "2023-01-31", 2, 0, 2.0), (5, "2023-01-30", 2, 0, 1.0)])
    assert rows(d.delinquency_info(df), "AccountNumber", "Delinquency", "Balance") == [(1, 3, 1.0), (2, 5, 1.0), (3, 9, 1.0), (4, 2, 3.0)]


def test_payment_free_months_neither_inflate_nor_add_rows(spark):
    df = frame(spark, PORTFOLIO, [(1, "2024-02-29", 0, 0, 7.0), (2, "2024-02-29", 0, 0, 5.0)])
    free = spark.createDataFrame([(1, 202402), (1, 202402), (1, 202403), (9, 202402)], "AccountNumber long, YearMonth int")
    assert rows(d.delinquency_info(df, free), "AccountNumber", "FBE", "Balance") == [(1, 1, 7.0), (2, 0, 5.0)]


def test_next_events_and_exposure(spark):
    got = {(r.AccountNumber, str(r.SnapshotDate)): r for r in d.account_history(history(spark)).collect()}
    first = got[1, ENDS[0]]
    assert (str(first.Next30Date), first.ExposureAtFirst30) == (ENDS[2], 300.0)
    assert (str(first.NextFrozenDate), first.ExposureAtFirstFrozen) == (ENDS[5], 600.0)
    assert first.Ever30After12Months == 1 and first.WorstDelinquency == 0
    last = got[1, ENDS[5]]
    assert last.Next30Date is None and last.Ever120 == 1 and last.WorstDelinquency6M == 5
    assert got[2, ENDS[3]].WorstDelinquency == 0 and got[2, ENDS[3]].Ever30In6Months == 0
    gap = got[3, ENDS[4]]
    assert (str(gap.Last30Date), gap.Ever30, str(gap.Next60Date)) == (ENDS[0], 1, ENDS[5])
    assert gap.TimeSince30 == 120


def test_lookback_boundary_is_inclusive(spark):
    df = frame(spark, PORTFOLIO, [(1, "2023-01-31", 2, 0, 1.0), (1, "2023-07-31", 0, 0, 1.0), (1, "2023-08-31", 0, 0, 1.0), (1, "2024-01-31", 0, 0, 1.0), (1, "2024-02-29", 0, 0, 1.0)])
    got = rows(d.account_history(df), "SnapshotDate", "Ever30In6Months", "Ever30In12Months", "WorstDelinquency12M")
    assert [(str(a), b, c, w) for a, b, c, w in got] == [
        ("2023-01-31", 1, 1, 2), ("2023-07-31", 1, 1, 2), ("2023-08-31", 0, 1, 2), ("2024-01-31", 0, 1, 2), ("2024-02-29", 0, 0, 0)]


def test_history_start_limits_lookback(spark):
    full = d.account_history(history(spark)).filter("SnapshotDate = '2023-06-30'")
    cut = d.account_history(history(spark), history_start="2023-05-31")
    assert rows(full, "AccountNumber", "Ever60") == [(1, 1), (2, 0), (3, 1)]
    assert cut.count() == 3 and rows(cut.filter("AccountNumber = 3"), "Ever30In6Months") == [(1,)]


FORB = "AccountNumber long, ForbearanceName string, StartDate date, EndDate date"


def test_forbearance_ties_and_windows(spark):
    panel = frame(spark, "AccountNumber long, SnapshotDate date, WorstDelinquency int", [
        (1, "2023-03-31", 0), (1, "2023-12-31", 0), (2, "2023-03-31", 4), (3, "2023-04-30", 1), (4, "2023-04-30", 1)])
    forb = frame(spark, FORB, [
        (1, "Capitalization", "2023-03-31", "2023-06-30"), (1, "Extension of maturity", "2023-03-31", "2023-12-31"),
        (1, "Capitalization", "2022-01-01", "2029-01-01"), (2, "Capitalization", "2023-01-01", "2023-12-31"),
        (3, "Skip a pay", "2023-01-01", "2023-12-31"), (4, "Capitalization", "2023-01-30", None)])
    got = rows(d.forbearance_flags(panel, forb), "AccountNumber", "SnapshotDate", "FBE_eftergift", "ForberanceIn3Months", "ForberanceIn9Months")
    assert got == [
        (1, day("2023-03-31"), 1, 1, 1), (1, day("2023-12-31"), 0, 0, 0), (1, day("2023-12-31"), 1, 0, 0),
        (2, day("2023-03-31"), 0, 1, 1), (3, day("2023-04-30"), 0, 0, 0), (4, day("2023-04-30"), 0, 0, 1)]


def test_latest_forbearance_keeps_ties(spark):
    forb = frame(spark, FORB, [(1, "Capitalization", "2023-03-31", "2023-06-30"), (1, "Extension of maturity", "2023-03-31", "2023-12-31"), (1, "Skip a pay", "2024-01-01", "2024-02-01")])
    assert d.latest_forbearance(forb).count() == 2
    assert rows(d.latest_forbearance(forb, include=None), "ForbearanceName") == [("Skip a pay",)]


def test_status(spark):
    df = spark.createDataFrame([(1, "Frozen"), (1, "Late"), (0, "Late"), (1, None)], "o int, s string")
    assert rows(df.select(d.account_status(F.col("o"), F.col("s")).alias("x")), "x") == [("CLOSED",), ("CLOSED",), ("FROZEN",), ("OPEN",)]


def test_plan_has_no_self_join_and_one_account_shuffle(spark):
    plan = d.account_history(history(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2


def test_hot_account_is_reduced_before_the_shuffle(spark):
    """A third of all rows on one (account, month): the aggregate combines them where they are read."""
    hot = spark.range(20_000).selectExpr("1L as AccountNumber", "date'2023-01-31' as SnapshotDate", "cast(id % 5 as int) as DelinquencyStatusCode", "0 as NumberOfLateStatements", "1.0D as CurrentAmount")
    cold = spark.range(40_000).selectExpr("id + 2 as AccountNumber", "date'2023-01-31' as SnapshotDate", "0 as DelinquencyStatusCode", "0 as NumberOfLateStatements", "1.0D as CurrentAmount")
    info = d.delinquency_info(hot.unionByName(cold))
    assert "partial_max" in info._jdf.queryExecution().executedPlan().toString()
    assert rows(info.filter("AccountNumber = 1"), "Delinquency", "Balance") == [(4, 20000.0)]
    assert info.count() == 40_001
