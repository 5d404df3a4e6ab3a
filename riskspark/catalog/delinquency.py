"""Delinquency history and forbearance."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog.registry import query
from riskspark.operators import delinquency as d

HISTORY_START = "1997-05-31"

INFO = """
 info as (
  select AccountNumber, SnapshotDate,
    max(case when DelinquencyStatusCode = 9 then 9 when NumberOfLateStatements >= 5 then 5 else DelinquencyStatusCode end) as Delinquency,
    max(case when exists (select 1 from payment_free_months p where p.AccountNumber = s.AccountNumber
          and p.YearMonth = year(s.SnapshotDate) * 100 + month(s.SnapshotDate)) then 1 else 0 end) as FBE,
    cast(sum(CurrentAmount) as decimal(28,2)) as Balance
  from {source} s where SnapshotDate = last_day(SnapshotDate) group by AccountNumber, SnapshotDate)"""

# Stated here on their own: the codes of each bucket, and what a code must exceed to be past it.
EXACT = {"1": 1, "30": 2, "60": 3, "90": 4, "120": 5}
PAST = {"30": 1, "60": 2, "90": 3, "120": 4}


def _nearest(name: str, event: str, ahead: bool = False) -> str:
    """The nearest month of an event among the account's other months, before (or at) a month or after it."""
    return f" {'min' if ahead else 'max'}(o.SnapshotDate) filter ({event} and o.SnapshotDate {'>' if ahead else '<='} m.SnapshotDate) as {name}"


EVENTS = INFO.replace("{source}", "loan_portfolio") + ",\n events as (select m.AccountNumber, m.SnapshotDate, m.Delinquency, m.FBE, m.Balance,\n" + ",\n".join(
    [_nearest(f"Last{b}DateE", f"o.Delinquency = {k}") for b, k in EXACT.items()]
    + [_nearest(f"Last{b}Date", f"o.Delinquency > {k}") for b, k in PAST.items()] + [_nearest("LastFBEDate", "o.FBE = 1")]
    + [_nearest(f"Next{b}Date", f"o.Delinquency > {k}", True) for b, k in PAST.items()]
    + [_nearest("NextFrozenDate", "o.Delinquency = 9", True), _nearest("NextFBEDate", "o.FBE = 1", True)]
) + "\n from info m join info o on o.AccountNumber = m.AccountNumber group by all)"


def _flag(cond: str) -> str:
    return f"case when {cond} then 1 else 0 end"


def _worst(test: str) -> str:
    steps = [("Last120Date", 5), ("Last90Date", 4), ("Last60Date", 3), ("Last30Date", 2), ("Last1DateE", 1)]
    return "case " + " ".join(f"when {test.format(c)} then {n}" for c, n in steps) + " else 0 end"


LOOKBACK = ", ".join(
    [f"cast(SnapshotDate - Last{b}DateE as int) as TimeSince{b}" for b in PAST]
    + [f"{_flag(f'Last{b}Date + interval {m} month >= SnapshotDate')} as Ever{b}In{m}Months" for b in PAST for m in (6, 12)]
    + [f"{_flag(f'Last{b}Date is not null')} as Ever{b}" for b in PAST]
    + [f"{_worst('{} + interval ' + str(m) + ' month >= SnapshotDate')} as WorstDelinquency{m}M" for m in (6, 12)]
    + [f"{_worst('{} is not null')} as WorstDelinquency"])
PAYMENT_FREE = ", ".join(
    ["cast(SnapshotDate - LastFBEDate as int) as TimeSinceFBE"]
    + [f"{_flag(f'LastFBEDate + interval {m} month >= SnapshotDate')} as EverFBEIn{m}Months" for m in (6, 12, 24, 36, 48)]
    + [f"{_flag('LastFBEDate is not null')} as EverFBE"])
FORWARD = ", ".join(
    [f"{_flag(f'Next{b}Date <= SnapshotDate + interval {y} year')} as Ever{b}After{12 * y}Months" for b in PAST for y in (1, 2, 3, 4)]
    + [f"{_flag(f'NextFrozenDate <= SnapshotDate + interval {y} year')} as FrozenAfter{12 * y}Months" for y in (1, 2, 3, 4)])
NAMES = [*PAST, "Frozen"]
EXPOSURE = ", ".join(
    f"(select x.Balance from info x where x.AccountNumber = e.AccountNumber and x.SnapshotDate = e.Next{b}Date) as ExposureAtFirst{b}"
    for b in NAMES)
LATEST = """
 relief as (select f.AccountNumber, f.ForbearanceName, f.StartDate, f.EndDate from forbearance f
   where ForbearanceName in ('Permanent interest cut', 'Extension of maturity', 'Temporary interest cut', 'Capitalization')),
 latest as (select r.* from relief r join (select AccountNumber, max(StartDate) as m from relief group by 1) x
   on r.AccountNumber = x.AccountNumber and r.StartDate = x.m)"""
RELIEF_FLAGS = ", ".join(
    [f"{_flag('p.SnapshotDate between l.StartDate and l.EndDate and p.WorstDelinquency < 4')} as FBE_eftergift"]
    + [f"{_flag(f'l.StartDate + interval {m} month > p.SnapshotDate and p.SnapshotDate >= l.StartDate')} as ForberanceIn{m}Months"
       for m in (3, 6, 9, 12)])
TIME_TO_FIRST = ", ".join(
    f"cast((year(Next{b}Date) - year(lp.DisbursedDate)) * 12 + month(Next{b}Date) - month(lp.DisbursedDate) as int) as TimeToFirst{b}"
    for b in NAMES)

# Reused by the staging query.
FEATURES = EVENTS + f""",
 history as (select e.AccountNumber, e.SnapshotDate, FBE, {LOOKBACK}, {PAYMENT_FREE}, {FORWARD}, {EXPOSURE},
   Next30Date, Next60Date, Next90Date, Next120Date, NextFrozenDate from events e),{LATEST},
 panel as (select lp.IsOpen,
   case when lp.IsOpen = 1 and lp.DelinquencyStatus = 'Frozen' then 'FROZEN' when lp.IsOpen = 1 and lp.DelinquencyStatus <> 'Frozen' then 'OPEN' else 'CLOSED' end as AccountStatus,
   lp.CurrentAmount, lp.MOB, lp.DisbursedDate, lp.RemainingTenor, cast(1 - a.IsMainApplicant as int) as CoappFlag,
   {_flag('a.Kronofogden = 1')} as Kronofogden, {_flag('coalesce(a.Kronofogden, 0) = 0')} as NoKronofogden,
   lp.DelinquencyStatusCode as CurrentDelinquencyStatus, h.* exclude (Next30Date, Next60Date, Next90Date, Next120Date, NextFrozenDate), {TIME_TO_FIRST}
   from history h join loan_portfolio lp on lp.AccountNumber = h.AccountNumber and lp.SnapshotDate = h.SnapshotDate
   left join applications a on a.AccountNumber = lp.AccountNumber and a.DisbursedDate = lp.DisbursedDate),
 features as (select distinct p.*, l.StartDate as forberanceDate, {RELIEF_FLAGS}
   from panel p left join latest l on l.AccountNumber = p.AccountNumber)"""


@query("delinquency_info", "with " + INFO.replace("{source}", "statements") + " select * from info",
       "statements payment_free_months")
def delinquency_info(t):
    return d.delinquency_info(t.statements, t.payment_free_months)


@query("delinquency_info_recent", f"""
  select AccountNumber, SnapshotDate,
    max(case when DelinquencyStatusCode = 9 then 9 when NumberOfLateStatements >= 5 then 5 else DelinquencyStatusCode end) as Delinquency,
    0 as FBE, cast(sum(CurrentAmount) as decimal(28,2)) as Balance
  from statements where SnapshotDate = last_day(SnapshotDate) and SnapshotDate > date '{HISTORY_START}' group by 1, 2""", "statements")
def delinquency_info_recent(t):
    return d.delinquency_info(t.statements, history_start=HISTORY_START)


@query("event_dates", "with " + EVENTS + " select * from events", "loan_portfolio payment_free_months")
def event_dates(t):
    df = d.with_event_dates(d.delinquency_info(t.loan_portfolio, t.payment_free_months))
    return df.drop(*[c for c in df.columns if c.startswith("Exposure")])


@query("lookback_features", "with " + EVENTS + f" select AccountNumber, SnapshotDate, {LOOKBACK} from events",
       "loan_portfolio payment_free_months")
def lookback_features(t):
    df = d.lookback_features(d.with_event_dates(d.delinquency_info(t.loan_portfolio, t.payment_free_months)))
    return df.select("AccountNumber", "SnapshotDate", *[c for c in df.columns if c.startswith(("TimeSince", "Ever", "Worst"))])


@query("payment_free_features", "with " + EVENTS + f" select AccountNumber, SnapshotDate, {PAYMENT_FREE} from events",
       "loan_portfolio payment_free_months")
def payment_free_features(t):
    df = d.payment_free_features(d.with_event_dates(d.delinquency_info(t.loan_portfolio, t.payment_free_months)))
    return df.select("AccountNumber", "SnapshotDate", *[c for c in df.columns if c.startswith(("TimeSince", "Ever"))])


@query("forward_outcomes", "with " + EVENTS + f" select AccountNumber, SnapshotDate, {FORWARD} from events",
       "loan_portfolio payment_free_months")
def forward_outcomes(t):
    df = d.forward_outcomes(d.with_event_dates(d.delinquency_info(t.loan_portfolio, t.payment_free_months)))
    return df.select("AccountNumber", "SnapshotDate", *[c for c in df.columns if "After" in c])


@query("exposure_at_first_event", "with " + EVENTS + f" select AccountNumber, SnapshotDate, {EXPOSURE} from events e",
       "loan_portfolio payment_free_months")
def exposure_at_first_event(t):
    df = d.with_event_dates(d.delinquency_info(t.loan_portfolio, t.payment_free_months))
    return df.select("AccountNumber", "SnapshotDate", *[c for c in df.columns if c.startswith("Exposure")])


@query("time_to_first_event", "with " + EVENTS + f"""
  select lp.AccountNumber, lp.SnapshotDate, {TIME_TO_FIRST}
  from events e join loan_portfolio lp on lp.AccountNumber = e.AccountNumber and lp.SnapshotDate = e.SnapshotDate""",
       "loan_portfolio payment_free_months")
def time_to_first_event(t):
    ev = d.with_event_dates(d.delinquency_info(t.loan_portfolio, t.payment_free_months))
    lp = t.loan_portfolio.select("AccountNumber", "SnapshotDate", "DisbursedDate")
    df = d.time_to_first(ev.join(lp, ["AccountNumber", "SnapshotDate"]))
    return df.select("AccountNumber", "SnapshotDate", *[c for c in df.columns if c.startswith("TimeToFirst")])


@query("latest_forbearance", "with " + LATEST + " select * from latest", "forbearance")
def latest_forbearance(t):
    return d.latest_forbearance(t.forbearance)


@query("latest_forbearance_excluding", """
  with chosen as (select * from forbearance where ForbearanceName not in ('Skip a pay', ''))
  select f.AccountNumber, f.StartDate from chosen f
  join (select AccountNumber, max(StartDate) as m from chosen group by 1) x on f.AccountNumber = x.AccountNumber and f.StartDate = x.m""",
       "forbearance")
def latest_forbearance_excluding(t):
    return d.latest_forbearance(t.forbearance, include=None, exclude=("Skip a pay", "")).select("AccountNumber", "StartDate")


@query("forbearance_flags", "with " + EVENTS + f""", p as (select AccountNumber, SnapshotDate, {_worst('{} is not null')} as WorstDelinquency from events),{LATEST}
  select distinct p.*, l.StartDate as forberanceDate, {RELIEF_FLAGS} from p left join latest l on l.AccountNumber = p.AccountNumber""",
       "loan_portfolio payment_free_months forbearance")
def forbearance_flags(t):
    df = d.lookback_features(d.with_event_dates(d.delinquency_info(t.loan_portfolio, t.payment_free_months)))
    return d.forbearance_flags(df.select("AccountNumber", "SnapshotDate", "WorstDelinquency"), t.forbearance)


@query("delinquency_features", "with " + FEATURES + " select * from features",
       "loan_portfolio payment_free_months forbearance applications")
def delinquency_features(t):
    return d.delinquency_features(t.loan_portfolio, t.applications, t.payment_free_months, t.forbearance)


@query("account_status", """
  select AccountNumber, SnapshotDate, case when IsOpen = 1 and DelinquencyStatus = 'Frozen' then 'FROZEN'
    when IsOpen = 1 and DelinquencyStatus <> 'Frozen' then 'OPEN' else 'CLOSED' end as Status from loan_portfolio""", "loan_portfolio")
def account_status(t):
    return t.loan_portfolio.select("AccountNumber", "SnapshotDate",
                                   d.account_status(F.col("IsOpen"), F.col("DelinquencyStatus")).alias("Status"))
