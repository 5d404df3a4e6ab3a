"""Delinquency history: look-back flags, look-ahead outcomes and forbearance, per account and month-end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.dates import (DateLike, as_date, calendar_months_between, days_between, is_month_end,
                                       month_end_rows)
from riskspark.operators.keyed import latest_with_ties

FROZEN = 9
# Bucket name -> severity a row must exceed to count as "past the bucket".
PAST = {"30": 1, "60": 2, "90": 3, "120": 4}
# Bucket name -> the severity code of exactly that bucket.
EXACT = {"1": 1, "30": 2, "60": 3, "90": 4, "120": 5}
RELIEF_MEASURES = ("Permanent interest cut", "Extension of maturity", "Temporary interest cut", "Capitalization")


def account_status(is_open: Column, delinquency_status: Column) -> Column:
    return (F.when((is_open == 1) & (delinquency_status == "Frozen"), "FROZEN")
             .when((is_open == 1) & (delinquency_status != "Frozen"), "OPEN")
             .otherwise("CLOSED"))


def severity(code: Column, late_statements: Column) -> Column:
    """9 frozen; five or more late statements count as 5; else the status code."""
    return F.when(code == FROZEN, FROZEN).when(late_statements >= 5, 5).otherwise(code)


def delinquency_info(portfolio: DataFrame, payment_free_months: DataFrame | None = None,
                     history_start: DateLike | None = None) -> DataFrame:
    """Severity, payment-free flag and balance per (account, month-end).

    Payment-free months enter the same aggregate as rows without a balance: one shuffle, combined on
    the map side, and neither a second application nor a repeated payment-free row inflates the balance.
    After this step an account has at most one row per month, which bounds every per-account window below.
    """
    rows = month_end_rows(portfolio)
    if history_start is not None:
        rows = rows.filter(F.col("SnapshotDate") > as_date(history_start))
    rows = rows.select(
        "AccountNumber", "SnapshotDate", "CurrentAmount",
        severity(F.col("DelinquencyStatusCode"), F.col("NumberOfLateStatements")).alias("severity"),
        F.lit(0).alias("free"), F.lit(1).alias("held"))
    if payment_free_months is not None:
        ym = F.col("YearMonth")
        end = F.last_day(F.make_date(F.floor(ym / 100).cast("int"), ym % 100, F.lit(1)))
        rows = rows.unionByName(payment_free_months.select(
            "AccountNumber", end.alias("SnapshotDate"), F.lit(1).alias("free"), F.lit(0).alias("held")), allowMissingColumns=True)
    grouped = rows.groupBy("AccountNumber", "SnapshotDate").agg(
        F.max("severity").alias("Delinquency"), F.max("free").alias("FBE"), F.sum("CurrentAmount").alias("Balance"),
        F.max("held").alias("held"))
    return grouped.filter("held = 1").drop("held")


def with_event_dates(info: DataFrame) -> DataFrame:
    """Last and next event dates per row, with the balance at each next event.

    Both directions are running aggregates: the look-ahead reads the account backwards, where the
    nearest future event is the last one seen. That keeps the frames linear and needs no self join.
    """
    d, day = F.col("Delinquency"), F.col("SnapshotDate")
    past = Window.partitionBy("AccountNumber").orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    future = Window.partitionBy("AccountNumber").orderBy(day.desc()).rowsBetween(Window.unboundedPreceding, -1)

    def last(event: Column) -> Column:
        return F.max(F.when(event, day)).over(past)

    def upcoming(event: Column) -> Column:
        return F.last(F.when(event, F.struct(day.alias("day"), F.col("Balance").alias("balance"))), True).over(future)

    back = {f"Last{b}DateE": last(d == k) for b, k in EXACT.items()}
    back |= {f"Last{b}Date": last(d > k) for b, k in PAST.items()}
    back["LastFBEDate"] = last(F.col("FBE") == 1)
    events = {b: d > k for b, k in PAST.items()} | {"Frozen": d == FROZEN, "FBE": F.col("FBE") == 1}
    ahead = {f"__next{b}": upcoming(e) for b, e in events.items()}
    df = info.withColumns(back).withColumns(ahead)
    dates = {f"Next{b}Date": F.col(f"__next{b}.day") for b in events}
    exposures = {f"ExposureAtFirst{b}": F.col(f"__next{b}.balance") for b in events if b != "FBE"}
    return df.withColumns(dates | exposures).drop(*ahead)


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _within(last: str, months: int) -> Column:
    return F.add_months(F.col(last), months) >= F.col("SnapshotDate")


def _worst(test) -> Column:
    expr = F.when(test("Last120Date"), 5).when(test("Last90Date"), 4).when(test("Last60Date"), 3)
    return expr.when(test("Last30Date"), 2).when(test("Last1DateE"), 1).otherwise(0)


def lookback_features(df: DataFrame) -> DataFrame:
    """Days since, ever, and worst-delinquency flags from the last event dates."""
    day = F.col("SnapshotDate")
    cols = {f"TimeSince{b}": days_between(F.col(f"Last{b}DateE"), day) for b in PAST}
    for b in PAST:
        cols[f"Ever{b}In6Months"] = _flag(_within(f"Last{b}Date", 6))
        cols[f"Ever{b}In12Months"] = _flag(_within(f"Last{b}Date", 12))
        cols[f"Ever{b}"] = _flag(F.col(f"Last{b}Date").isNotNull())
    cols["WorstDelinquency6M"] = _worst(lambda c: _within(c, 6))
    cols["WorstDelinquency12M"] = _worst(lambda c: _within(c, 12))
    cols["WorstDelinquency"] = _worst(lambda c: F.col(c).isNotNull())
    return df.withColumns(cols)


def payment_free_features(df: DataFrame) -> DataFrame:
    cols = {"TimeSinceFBE": days_between(F.col("LastFBEDate"), F.col("SnapshotDate"))}
    cols |= {f"EverFBEIn{m}Months": _flag(_within("LastFBEDate", m)) for m in (6, 12, 24, 36, 48)}
    cols["EverFBE"] = _flag(F.col("LastFBEDate").isNotNull())
    return df.withColumns(cols)


def forward_outcomes(df: DataFrame) -> DataFrame:
    """Whether the next event comes within 12, 24, 36 and 48 months."""
    cols = {}
    for months in (12, 24, 36, 48):
        limit = F.add_months(F.col("SnapshotDate"), months)
        for b in PAST:
            cols[f"Ever{b}After{months}Months"] = _flag(F.col(f"Next{b}Date") <= limit)
        cols[f"FrozenAfter{months}Months"] = _flag(F.col("NextFrozenDate") <= limit)
    return df.withColumns(cols)


def time_to_first(df: DataFrame) -> DataFrame:
    """Calendar months from disbursal to the next event; needs DisbursedDate."""
    return df.withColumns({
        f"TimeToFirst{b}": calendar_months_between(F.col("DisbursedDate"), F.col(f"Next{b}Date"))
        for b in (*PAST, "Frozen")
    })


def latest_forbearance(forbearance: DataFrame, include: tuple[str, ...] | None = RELIEF_MEASURES,
                       exclude: tuple[str, ...] = ()) -> DataFrame:
    """Forbearance rows with the latest start date per account; ties are kept.

    Choose measures by `include`, or pass `include=None` and name what to leave out in `exclude`.
    """
    name = F.col("ForbearanceName")
    chosen = forbearance.filter(name.isin(*include)) if include else forbearance.filter(name.isNotNull())
    if exclude:
        chosen = chosen.filter(~name.isin(*exclude))
    return latest_with_ties(chosen, "AccountNumber", "StartDate")


def forbearance_summary(forbearance: DataFrame) -> DataFrame:
    """One row per account: latest start, and the earliest and latest end among relief starting then.

    A missing end never covers a snapshot, so it makes the earliest end missing too.
    """
    end = F.col("EndDate")
    return latest_forbearance(forbearance).groupBy("AccountNumber").agg(
        F.max("StartDate").alias("forberanceDate"), F.max(end).alias("__end_hi"),
        F.when(F.count_if(end.isNull()) == 0, F.min(end)).alias("__end_lo"))


def with_forbearance_flags(df: DataFrame) -> DataFrame:
    """Flags from the columns of `forbearance_summary`.

    Several measures may start on one day. Where they disagree on covering the snapshot the row comes
    twice, once with each answer; the relief row is preferred later.
    """
    day, start = F.col("SnapshotDate"), F.col("forberanceDate")

    def covered(end: str) -> Column:
        return _flag(day.between(start, F.col(end)) & (F.col("WorstDelinquency") < 4))

    cols = {f"ForberanceIn{m}Months": _flag((F.add_months(start, m) > day) & (day >= start)) for m in (3, 6, 9, 12)}
    answers = F.array_distinct(F.array(covered("__end_hi"), covered("__end_lo")))
    # The array is never empty; the outer form keeps Spark from testing that inside the join before it.
    return df.withColumns(cols | {"__answers": answers}).withColumn("FBE_eftergift", F.explode_outer("__answers")).drop(
        "__answers", "__end_hi", "__end_lo")


def forbearance_flags(df: DataFrame, forbearance: DataFrame) -> DataFrame:
    """Relief in force at the snapshot, and relief started within 3, 6, 9 and 12 months."""
    return with_forbearance_flags(df.join(forbearance_summary(forbearance), "AccountNumber", "left"))


def derived_features(df: DataFrame) -> DataFrame:
    return forward_outcomes(payment_free_features(lookback_features(df)))


def account_history(portfolio: DataFrame, payment_free_months: DataFrame | None = None,
                    history_start: DateLike | None = None) -> DataFrame:
    """All look-back and look-ahead columns per (account, month-end)."""
    return derived_features(with_event_dates(delinquency_info(portfolio, payment_free_months, history_start)))


def delinquency_features(portfolio: DataFrame, applications: DataFrame, payment_free_months: DataFrame,
                         forbearance: DataFrame, history_start: DateLike | None = None,
                         output_after: DateLike | None = None) -> DataFrame:
    """The scored panel: portfolio rows with applicant flags, delinquency history and forbearance, distinct.

    The history uses every month after `history_start`; `output_after` only limits the months returned.

    Forbearance joins the event dates while they are still partitioned by account. The join with the
    portfolio moves dates only, and the seventy flags are computed after it. Rows are made distinct
    before they are widened: after the applicants' join its partitioning serves the distinct as well,
    and the other two sides have one row per key.
    """
    dates = with_event_dates(delinquency_info(portfolio, payment_free_months, history_start)).drop("Delinquency", "Balance")
    dates = dates.join(forbearance_summary(forbearance), "AccountNumber", "left")
    rows = portfolio.filter(F.col("SnapshotDate") > as_date(output_after)) if output_after is not None else portfolio
    return scored_panel(rows, applications, dates)


def scored_panel(portfolio: DataFrame, applications: DataFrame, dates: DataFrame) -> DataFrame:
    """The panel of these portfolio rows with the event dates and forbearance of their month in `dates`."""
    rows = portfolio.filter(is_month_end(F.col("SnapshotDate")))
    status = account_status(F.col("IsOpen"), F.col("DelinquencyStatus")).alias("AccountStatus")
    rows = rows.select("AccountNumber", "SnapshotDate", "IsOpen", status, "CurrentAmount", "MOB", "DisbursedDate",
                       "RemainingTenor", F.col("DelinquencyStatusCode").alias("CurrentDelinquencyStatus"))
    applicants = applications.select(
        "AccountNumber", "DisbursedDate", (1 - F.col("IsMainApplicant")).alias("CoappFlag"),
        _flag(F.col("Kronofogden") == 1).alias("Kronofogden"),
        _flag(F.coalesce("Kronofogden", F.lit(0)) == 0).alias("NoKronofogden"))
    rows = rows.join(applicants, ["AccountNumber", "DisbursedDate"], "left").withColumns(
        {"Kronofogden": F.coalesce("Kronofogden", F.lit(0)), "NoKronofogden": F.coalesce("NoKronofogden", F.lit(1))}).distinct()
    panel = rows.join(dates, ["AccountNumber", "SnapshotDate"])
    panel = with_forbearance_flags(derived_features(time_to_first(panel)))
    return panel.drop(*[c for c in panel.columns if c.endswith(("Date", "DateE")) and c.startswith(("Last", "Next"))])


#: The dates of a state: the last month of each event so far.
STATE_DATES = (*[f"Last{b}DateE" for b in EXACT], *[f"Last{b}Date" for b in PAST], "LastFBEDate")


def account_state(info: DataFrame) -> DataFrame:
    """AccountNumber and the last month of each event, from severities per (account, month).

    The state of two spans of months together is the later of their dates, so states merge in any order.
    """
    d, day = F.col("Delinquency"), F.col("SnapshotDate")
    events = {f"Last{b}DateE": d == k for b, k in EXACT.items()} | {f"Last{b}Date": d > k for b, k in PAST.items()} | {"LastFBEDate": F.col("FBE") == 1}
    return info.groupBy("AccountNumber").agg(*[F.max(F.when(e, day)).alias(name) for name, e in events.items()])


def merged_state(*states: DataFrame) -> DataFrame:
    """The state after all the spans of months that the states stand for."""
    every = states[0]
    for state in states[1:]:
        every = every.unionByName(state)
    return every.groupBy("AccountNumber").agg(*[F.max(c).alias(c) for c in STATE_DATES])


def month_features(portfolio_month: DataFrame, applications: DataFrame, payment_free_months: DataFrame, forbearance: DataFrame, state: DataFrame) -> DataFrame:
    """`delinquency_features` of one month from that month and the state before it, instead of all history.

    No later month is known, as in a run on the day: what looks ahead is empty.
    """
    info = delinquency_info(portfolio_month, payment_free_months)
    now = account_state(info)
    before = state.select("AccountNumber", *[F.col(c).alias(f"__{c}") for c in STATE_DATES])
    dates = info.join(now, "AccountNumber").join(before, "AccountNumber", "left")
    dates = dates.withColumns({c: F.greatest(c, f"__{c}") for c in STATE_DATES}).drop(*[f"__{c}" for c in STATE_DATES])
    ahead = {f"Next{b}Date": F.lit(None).cast("date") for b in (*PAST, "Frozen", "FBE")}
    ahead |= {f"ExposureAtFirst{b}": F.when(F.lit(False), F.col("Balance")) for b in (*PAST, "Frozen")}
    dates = dates.withColumns(ahead).drop("Delinquency", "Balance")
    return scored_panel(portfolio_month, applications, dates.join(forbearance_summary(forbearance), "AccountNumber", "left"))
