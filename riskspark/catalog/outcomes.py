"""Twelve-month outcomes, default rates, cures, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog.delinquency import FEATURES
from riskspark.catalog.registry import query
from riskspark.functions.dates import year_month
from riskspark.operators import outcomes as o
from riskspark.operators import sampling as s
from riskspark.operators.delinquency import delinquency_features
from riskspark.plans import development
from riskspark.plans.development import TAPE
from riskspark.session import materialise

OUTCOME = """
 later as (select panel.AccountNumber, panel.SnapshotDate, panel.CurrentAmount, panel.Ever90, panel.IsOpen, panel.AccountStatus, panel.Stage,
    year_on.Ever90 as Ever90_12, year_on.CurrentAmount as CurrentAmount_12
  from model_tape panel, model_tape year_on
  where year_on.AccountNumber = panel.AccountNumber and cast(year_on.SnapshotDate - interval 12 month as date) = panel.SnapshotDate)"""
CARRY = ("IsOpen", "AccountStatus", "Stage")


def _rates(source: str, outcome: str, n: int = 3) -> str:
    return f"""
 counts as (select last_day(SnapshotDate) as Month, count(*) filter ({outcome} = 1) as bad, count(*) filter ({outcome} = 0) as good
   from (select distinct * from {source}) d group by 1),
 span as (select min(case when bad > 0 then Month end) as blo, max(case when bad > 0 then Month end) as bhi,
   min(case when good > 0 then Month end) as glo, max(case when good > 0 then Month end) as ghi from counts),
 months as (select distinct last_day(cast(m as date)) as Month from (
   select unnest(generate_series(date_trunc('month', blo), date_trunc('month', bhi), interval 1 month)) as m from span
   union all select unnest(generate_series(date_trunc('month', glo), date_trunc('month', ghi), interval 1 month)) from span) x),
 filled as (select m.Month, case when m.Month between blo and bhi then coalesce(bad, 0) end as bad,
   case when m.Month between glo and ghi then coalesce(good, 0) end as good from months m left join counts c on c.Month = m.Month, span),
 rates as (select *, case when bad + good > 0 then bad::double / (bad + good) end as rate from filled)
 select Month, bad, good, round(rate, 9) as rate, round(case when count(rate) over w = {n} then avg(rate) over w end, 9) as rolling
 from rates window w as (order by Month rows between {n - 1} preceding and current row)"""


def _rounded(df):
    return df.withColumns({c: F.round(c, 9) for c in ("rate", "rolling")})


@query("outcome_12m", "with " + OUTCOME + " select * from later", "model_tape")
def outcome_12m(t):
    return o.outcome_12m(t.model_tape, CARRY)


@query("outcome_12m_month_end", """select a.AccountNumber, a.SnapshotDate, a.CurrentAmount, a.Ever90, b.Ever90 as Ever90_12, b.CurrentAmount as CurrentAmount_12
  from model_tape a join model_tape b on a.AccountNumber = b.AccountNumber and a.SnapshotDate = last_day(cast(b.SnapshotDate - interval 12 month as date))""", "model_tape")
def outcome_12m_month_end(t):
    return o.outcome_12m(t.model_tape, month_end=True)


@query("default_rate_by_month", "with " + OUTCOME + ", live as (select * from later where IsOpen = 1 and Stage <> 3 and AccountStatus <> 'FROZEN')," + _rates("live", "Ever90_12"), "model_tape")
def default_rate_by_month(t):
    rows = o.outcome_12m(t.model_tape, CARRY).filter((F.col("IsOpen") == 1) & (F.col("Stage") != 3) & (F.col("AccountStatus") != "FROZEN"))
    return _rounded(o.default_rate_by_month(rows))


@query("default_rate_collapsed", "with " + OUTCOME + """, open_rows as (select * from later where IsOpen = 1 and Stage <> 3 and AccountStatus <> 'FROZEN' and Ever90_12 in (0, 1)),
 live as (select AccountNumber, CurrentAmount, Ever90, IsOpen, AccountStatus, Stage, Ever90_12, CurrentAmount_12, min(SnapshotDate) as SnapshotDate from open_rows group by 1, 2, 3, 4, 5, 6, 7, 8),""" + _rates("live", "Ever90_12"), "model_tape")
def default_rate_collapsed(t):
    rows = o.outcome_12m(t.model_tape, CARRY).filter((F.col("IsOpen") == 1) & (F.col("Stage") != 3) & (F.col("AccountStatus") != "FROZEN"))
    return _rounded(o.default_rate_by_month(rows, collapse_months=True))


@query("default_rate_stage_1", "with " + OUTCOME + ", live as (select * from later where IsOpen = 1 and Stage = 1)," + _rates("live", "Ever90_12"), "model_tape")
def default_rate_stage_1(t):
    rows = o.outcome_12m(t.model_tape, CARRY).filter(F.col("IsOpen") == 1)
    return _rounded(o.default_rate_by_month(rows, stages=[1]))


@query("default_rate_stage_2", "with " + OUTCOME + ", live as (select * from later where IsOpen = 1 and Stage = 2)," + _rates("live", "Ever90_12"), "model_tape")
def default_rate_stage_2(t):
    rows = o.outcome_12m(t.model_tape, CARRY).filter(F.col("IsOpen") == 1)
    return _rounded(o.default_rate_by_month(rows, stages=[2]))


@query("default_rate_stage_1_2", "with " + OUTCOME + ", live as (select * from later where IsOpen = 1 and Stage in (1, 2))," + _rates("live", "Ever90_12"), "model_tape")
def default_rate_stage_1_2(t):
    rows = o.outcome_12m(t.model_tape, CARRY).filter(F.col("IsOpen") == 1)
    return _rounded(o.default_rate_by_month(rows, stages=[1, 2]))


@query("default_rate_without_earlier_default", "with " + OUTCOME + ", live as (select * from later where IsOpen = 1 and Ever90 = 0)," + _rates("live", "Ever90_12", 6), "model_tape")
def default_rate_without_earlier_default(t):
    rows = o.outcome_12m(t.model_tape, CARRY).filter((F.col("IsOpen") == 1) & (F.col("Ever90") == 0))
    return _rounded(o.default_rate_by_month(rows, window=6))


@query("monthly_counts", """
  with c as (select last_day(DisbursedDate) as Month, count(*) as n from model_tape where Ever90_12M = 1 group by 1),
  m as (select last_day(cast(unnest(generate_series(date_trunc('month', min(Month)), date_trunc('month', max(Month)), interval 1 month)) as date)) as Month from c),
  f as (select m.Month, coalesce(n, 0) as n from m left join c on c.Month = m.Month)
  select Month, n, round(n / 6444.0, 9) as share, round(case when count(*) over w = 4 then avg(n / 6444.0) over w end, 9) as rolling
  from f window w as (order by Month rows between 3 preceding and current row)""", "model_tape")
def monthly_counts(t):
    df = o.monthly_counts(t.model_tape.filter("Ever90_12M = 1"), "DisbursedDate", share_of=6444, window=4)
    return df.withColumns({c: F.round(c, 9) for c in ("share", "rolling")})


@query("cure_cohort", """select a.AccountNumber, a.CurrentAmount, a.AccountStatus, b.CurrentAmount as CurrentAmount_n, b.DelinquencyStatusCode as DelinquencyStatusCode_n
  from loan_portfolio_monthly a join loan_portfolio_monthly b on a.AccountNumber = b.AccountNumber
  where a.DelinquencyStatusCode = 4 and a.SnapshotDate = date '1998-01-31' and b.SnapshotDate = date '2001-08-31'""", "loan_portfolio_monthly")
def cure_cohort(t):
    return o.cure_cohort(t.loan_portfolio_monthly, "1998-01-31", "2001-08-31")


def _hash(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::bigint"


PLAIN_ROWS = "with tape as (select AccountNumber, SnapshotDate, MOB, AccountStatus, Ever90, Score from model_tape)"


def _sample(healthy: str, draw: str, draw_hash: str, rows: str = PLAIN_ROWS) -> str:
    return f"""
  {rows},
  healthy as (select * from tape where {healthy}),
  later as (select AccountNumber, MOB - 12 as MOB, max(Ever90) as Ever90_12M from tape group by AccountNumber, MOB having count(*) = 1),
  ranked as (select e.*, Ever90_12M, row_number() over (partition by e.AccountNumber order by e.MOB) as r, count(*) over (partition by e.AccountNumber) as c
    from (select distinct AccountNumber, MOB from healthy) e join later l on l.AccountNumber = e.AccountNumber and l.MOB = e.MOB),
  draws as (select distinct p.AccountNumber, {draw_hash} % c + 1 as r from (select distinct {draw} from tape) p
    join (select distinct AccountNumber, c from ranked) z on z.AccountNumber = p.AccountNumber)
  select distinct h.* exclude (Ever90), k.Ever90_12M from draws d join ranked k on k.AccountNumber = d.AccountNumber and k.r = d.r
  join healthy h on h.AccountNumber = k.AccountNumber and h.MOB = k.MOB"""


PANEL = ("AccountNumber", "SnapshotDate", "MOB", "AccountStatus", "Ever90", "Score")


def _panel(t):
    """Drawing reads the panel several times, so it is a written tape."""
    return materialise(t.model_tape.select(*PANEL), "tape")


@query("sample_account_month", _sample("Ever90 = 0 and AccountStatus = 'OPEN'", "AccountNumber, SnapshotDate", _hash("p.AccountNumber", "p.SnapshotDate", "42")), "model_tape")
def sample_account_month(t):
    return o.sample_account_month(_panel(t))


@query("sample_account_once", _sample("Ever90 = 0", "AccountNumber", _hash("p.AccountNumber", "42")), "model_tape")
def sample_account_once(t):
    return o.sample_account_month(_panel(t), open_only=False, per_snapshot=False)


@query("sample_accounts", f"""
  with a as (select AccountNumber, row_number() over (order by {_hash('AccountNumber', '42')}, AccountNumber) as r from (select distinct AccountNumber from model_tape) x)
  select m.AccountNumber, m.SnapshotDate, m.MOB from model_tape m join a on a.AccountNumber = m.AccountNumber
  where r <= (select floor(count(*) * 0.05) from a)""", "model_tape")
def sample_accounts(t):
    return o.sample_accounts(t.model_tape).select("AccountNumber", "SnapshotDate", "MOB")


@query("split_by_positive_share", """
  with n as (select AccountNumber, MOB, SnapshotDate, Ever90_12M, row_number() over w as rn, sum(Ever90_12M) over (order by AccountNumber, MOB, SnapshotDate rows unbounded preceding) as c,
      sum(Ever90_12M) over () as total from model_tape window w as (order by AccountNumber, MOB, SnapshotDate)),
  cuts as (select min(rn) filter (c >= round_even(total * 0.7, 0)) as c1, min(rn) filter (c >= round_even(total * 0.85, 0)) as c2 from n)
  select AccountNumber, MOB, SnapshotDate, Ever90_12M, case when rn < c1 then 'train' when rn < c2 then 'test' else 'validation' end as Split from n, cuts""", "model_tape")
def split_by_positive_share(t):
    return s.split_by_positive_share(t.model_tape.select("AccountNumber", "MOB", "SnapshotDate", "Ever90_12M"))


@query("replicate_to_length", """
  with b as (select AccountNumber, MOB, SnapshotDate, cast(year(DisbursedDate) * 100 + month(DisbursedDate) as int) as YearMonth from model_tape where Ever90_12M = 1),
  i as (select *, row_number() over (partition by YearMonth order by AccountNumber, MOB, SnapshotDate) as i, count(*) over (partition by YearMonth) as m from b)
  select AccountNumber, MOB, SnapshotDate, YearMonth, cast(unnest(generate_series(1, case when m >= 170 then 1 else 170 // m + case when i <= 170 % m then 1 else 0 end end)) as int) as Copy from i""", "model_tape")
def replicate_to_length(t):
    rows = t.model_tape.filter("Ever90_12M = 1")
    df = s.replicate_to_length(rows.select("AccountNumber", "MOB", "SnapshotDate", "DisbursedDate"), year_month(F.col("DisbursedDate")))
    return df.drop("DisbursedDate")


@query("upsample_minority", f"""
  with h as (select AccountNumber, MOB, SnapshotDate, Ever90_12M, {_hash('AccountNumber', 'MOB', 'SnapshotDate', '42')} as h from model_tape),
  rare as (select Ever90_12M as v, count(*) as have from h group by 1 order by 2, 1 limit 1),
  ids as (select *, row_number() over (order by h, AccountNumber, MOB, SnapshotDate) as r from h where Ever90_12M = (select v from rare)),
  draws as (select {_hash('id', '42')} % (select have from rare) + 1 as r from range((select count(*) from h where Ever90_12M <> (select v from rare))) g(id))
  select AccountNumber, MOB, SnapshotDate, Ever90_12M from h where Ever90_12M <> (select v from rare)
  union all select AccountNumber, MOB, SnapshotDate, Ever90_12M from ids join draws on ids.r = draws.r""", "model_tape")
def upsample_minority(t):
    return s.upsample_minority(t.model_tape.select("AccountNumber", "MOB", "SnapshotDate", "Ever90_12M"))


@query("group_index", """select AccountNumber, SnapshotDate, MOB, cast(row_number() over (partition by AccountNumber order by AccountNumber, MOB, SnapshotDate) - 1 as int) as index
  from model_tape""", "model_tape")
def group_index(t):
    return s.group_index(t.model_tape.select("AccountNumber", "SnapshotDate", "MOB"), "AccountNumber")


KEPT = [c for c in TAPE if c != "Score"]
CLEAN = "with " + FEATURES + """,
  one_side as (select f.* from features f where CoappFlag = 1 or AccountNumber not in (select AccountNumber from features where CoappFlag = 1)),
  relieved as (select l.* from one_side l where FBE_eftergift = 1 or not exists (select 1 from one_side k
    where k.FBE_eftergift = 1 and k.SnapshotDate = l.SnapshotDate and k.AccountNumber = l.AccountNumber)),
  kept as (select distinct """ + ", ".join([*KEPT, "FBE_eftergift"]) + """ from relieved where MOB > 2),
  tape as (select * replace (coalesce(TimeSince30, 0) as TimeSince30, coalesce(TimeSince60, 0) as TimeSince60)
    from (select """ + ", ".join(KEPT) + """ from kept) k)"""
FEATURE_USES = "loan_portfolio payment_free_months forbearance applications"


def _features(t):
    return delinquency_features(t.loan_portfolio, t.applications, t.payment_free_months, t.forbearance)


@query("model_tape", CLEAN + " select * from tape", FEATURE_USES)
def model_tape(t):
    return development.model_tape(_features(t))


@query("sampled_tape", _sample("Ever90 = 0 and AccountStatus = 'OPEN'", "AccountNumber, SnapshotDate", _hash("p.AccountNumber", "p.SnapshotDate", "42"), CLEAN), FEATURE_USES)
def sampled_tape(t):
    return development.sampled_tape(_features(t))


@query("training_set", """
  with n as (select AccountNumber, MOB, SnapshotDate, DisbursedDate, Ever90_12M, row_number() over w as rn,
      sum(Ever90_12M) over (order by AccountNumber, MOB, SnapshotDate rows unbounded preceding) as c, sum(Ever90_12M) over () as total
    from model_tape window w as (order by AccountNumber, MOB, SnapshotDate)),
  train as (select * from n where rn < (select min(rn) filter (c >= round_even(total * 0.7, 0)) from n)),
  b as (select *, cast(year(DisbursedDate) * 100 + month(DisbursedDate) as int) as YearMonth from train where Ever90_12M = 1),
  i as (select *, row_number() over (partition by YearMonth order by AccountNumber, MOB, SnapshotDate) as i, count(*) over (partition by YearMonth) as m from b),
  copies as (select AccountNumber, MOB, SnapshotDate, Ever90_12M, YearMonth, unnest(generate_series(1, case when m >= 170 then 1 else 170 // m + case when i <= 170 % m then 1 else 0 end end)) as k from i)
  select AccountNumber, MOB, SnapshotDate, Ever90_12M, YearMonth from copies
  union all select AccountNumber, MOB, SnapshotDate, Ever90_12M, null from train where Ever90_12M = 0""", "model_tape")
def training_set(t):
    tape = t.model_tape.select("AccountNumber", "MOB", "SnapshotDate", "DisbursedDate", "Ever90_12M")
    return development.training_set(tape)[0].select("AccountNumber", "MOB", "SnapshotDate", "Ever90_12M", "YearMonth")
