"""Monthly reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog.registry import query
from riskspark.operators import reporting as r

THIS, LAST, AS_OF = "1999-06-30", "1999-05-31", "1999-07-10"
TWO = f"(date '{THIS}', date '{LAST}')"
SUMS = "cast(sum(Base) as decimal(38,2)) as Balance, cast(sum(ECL_SUM) as decimal(38,2)) as ECL_SUM, cast(sum(ECLNPV_SUM) as decimal(38,2)) as ECLNPV_SUM"
CURRENT = "select * from ecl_result where Ord = 0 and ReportDate = date"
NEW = f"""entries as ({CURRENT} '{THIS}' and RiskStage = 'Stage3' and exists (select 1 from ecl_result b
    where b.Ord = 0 and b.ReportDate = date '{LAST}' and b.RiskStage in ('Stage1', 'Stage2') and b.AccountNumber = ecl_result.AccountNumber))"""
GONE = f"""entries as ({CURRENT} '{LAST}' and RiskStage = 'Stage3' and ECL_SUM > 0 and not exists (select 1 from ecl_result b
    where b.Ord = 0 and b.ReportDate = date '{THIS}' and b.AccountNumber = ecl_result.AccountNumber))"""
LATEST = "(select max(SnapshotDate) from loan_portfolio)"


@query("stage_totals", f"""
  select ReportDate, RiskStage, {SUMS} from ecl_result where Ord = 0 and ReportDate in {TWO} group by 1, 2
  union all select ReportDate, 'Total', {SUMS} from ecl_result where Ord = 0 and ReportDate in {TWO} group by 1""", "ecl_result")
def stage_totals(t):
    return r.stage_totals(t.ecl_result, [THIS, LAST])


# One grouped scan: each account's values in the earlier and in the later month, then a list of labelled moves.
WALK = f"""
  pairs as (select AccountNumber, count(*) filter (ReportDate = date '{LAST}') as known_before,
      max(Base) filter (ReportDate = date '{LAST}') as base_0, max(Base) filter (ReportDate = date '{THIS}') as base_1,
      max(ECLNPV_SUM) filter (ReportDate = date '{LAST}') as npv_0, max(ECLNPV_SUM) filter (ReportDate = date '{THIS}') as npv_1,
      max(RiskStage) filter (ReportDate = date '{LAST}') as stage_0, max(RiskStage) filter (ReportDate = date '{THIS}') as stage_1,
      max(SpecialCase) filter (ReportDate = date '{LAST}') as special_0, max(SpecialCase) filter (ReportDate = date '{THIS}') as special_1,
      max(FBE) filter (ReportDate = date '{THIS}') as reason_1
    from ecl_result where Ord = 0 and ReportDate in {TWO} group by AccountNumber),
  moves(stage_0, stage_1, label) as (values ('Stage3', 'gone', 'WO_Out'), ('Stage2', 'Stage3', 'New_Entries_S3'),
    ('Stage2', 'Stage1', 'Cure_S1'), ('Stage1', 'Stage2', 'New_Entries_S2_SICR'))"""


@query("stage_walk", f"""with {WALK}
  select case when known_before > 0 then AccountNumber end as AccountNumber, base_0 as Last_Base, base_1 as This_Base, npv_0 as ECLNPV_SUM,
    npv_1 as This_ECLNPV_SUM, p.stage_0 as RiskStage, p.stage_1 as This_RiskStage, special_0 as SpecialCase, special_1 as This_SpecialCase,
    coalesce(label, case when p.stage_1 = 'Stage2' then
      case when reason_1 in ('monitoring_paymentrelief', 'monitoring_previous_S3') then reason_1 else 'SICR' end end) as Walk
  from pairs p left join moves m on m.stage_0 = p.stage_0 and m.stage_1 = coalesce(p.stage_1, 'gone')""", "ecl_result")
def stage_walk(t):
    return r.stage_walk(t.ecl_result, THIS)


@query("new_stage3_entries", f"with {NEW} select * from entries", "ecl_result")
def new_stage3_entries(t):
    return r.new_stage3_entries(t.ecl_result, THIS)


@query("new_entries_summary", f"with {NEW} select count(*) as TotalEntries, {SUMS} from entries", "ecl_result")
def new_entries_summary(t):
    return r.entries_summary(r.new_stage3_entries(t.ecl_result, THIS))


@query("write_off_summary", f"with {GONE} select FBE, count(*) as TotalEntries, {SUMS} from entries group by FBE", "ecl_result")
def write_off_summary(t):
    return r.entries_summary(r.write_offs(t.ecl_result, THIS), "FBE")


MEANS = "round(avg(AdjustedBehaviourScore), 9) as AdjustedBehaviourScore, round(avg(Score), 9) as Score"


def _means(df, *by):
    out = r.score_means(df, ["AdjustedBehaviourScore", "Score"], *by)
    return out.withColumns({c: F.round(c, 9) for c in ("AdjustedBehaviourScore", "Score")})


@query("score_means_by_stage", f"select Stageing, {MEANS} from scored_accounts group by 1", "scored_accounts")
def score_means_by_stage(t):
    return _means(t.scored_accounts, "Stageing")


@query("score_means_open_by_date", f"select Stageing, SnapshotDate, {MEANS} from scored_accounts where AccountStatus = 'OPEN' group by 1, 2", "scored_accounts")
def score_means_open_by_date(t):
    return _means(t.scored_accounts.filter(F.col("AccountStatus") == "OPEN"), "Stageing", "SnapshotDate")


@query("score_means_without_stage3", f"select {MEANS} from scored_accounts where Stageing <> 3", "scored_accounts")
def score_means_without_stage3(t):
    return _means(t.scored_accounts.filter(F.col("Stageing") != 3))


@query("balance_by_stage", f"""
  with b as (select distinct SnapshotDate, AccountNumber, CurrentAmount from loan_portfolio where SnapshotDate > date '{AS_OF}' - interval 3 month
    and SnapshotDate = last_day(SnapshotDate) and CurrentAmount > 0 and IsOpen = 1)
  select s.SnapshotDate, Stageing, cast(sum(CurrentAmount) as decimal(38,2)) as Balance from scored_accounts s
  left join b on b.AccountNumber = s.AccountNumber and b.SnapshotDate = s.SnapshotDate group by 1, 2""", "scored_accounts loan_portfolio")
def balance_by_stage(t):
    return r.balance_by_stage(t.scored_accounts, t.loan_portfolio, AS_OF)


@query("open_count_by_snapshot", """select SnapshotDate, count(AccountNumber) as count from loan_portfolio
  where IsOpen = 1 and AccountStatus = 'OPEN' and SnapshotDate = last_day(SnapshotDate) group by 1""", "loan_portfolio")
def open_count_by_snapshot(t):
    return r.open_count_by_snapshot(t.loan_portfolio)


@query("open_count_stage_1_2", """select l.SnapshotDate, count(l.AccountNumber) as count from loan_portfolio l
  join scored_accounts s on s.AccountNumber = l.AccountNumber and s.SnapshotDate = l.SnapshotDate
  where IsOpen = 1 and l.AccountStatus = 'OPEN' and l.SnapshotDate = last_day(l.SnapshotDate) and Stageing in (1, 2) group by 1""", "loan_portfolio scored_accounts")
def open_count_stage_1_2(t):
    return r.open_count_by_snapshot(t.loan_portfolio, t.scored_accounts, [1, 2])


@query("value_counts", "select FBE, count(*) as count from scored_accounts group by 1", "scored_accounts")
def value_counts(t):
    return r.value_counts(t.scored_accounts, "FBE")


@query("distinct_accounts", "select SnapshotDate, count(distinct AccountNumber) as accounts from loan_portfolio group by 1", "loan_portfolio")
def distinct_accounts(t):
    return r.distinct_accounts(t.loan_portfolio, "SnapshotDate")


@query("open_accounts", "select * from loan_portfolio where AccountStatus in ('COLLECTION', 'FROZEN', 'OPEN')", "loan_portfolio")
def open_accounts(t):
    return r.open_rows(t.loan_portfolio)


@query("unpaid_invoices", f"""
  select distinct AccountNumber, SnapshotDate, InvoicedInterest, PaidInterest, InvoicedFee, PaidFee,
    cast(InvoicedInterest - PaidInterest + InvoicedFee - PaidFee as decimal(21,2)) as unpaid from loan_portfolio
  where SnapshotDate > date '{AS_OF}' - interval 1 month and SnapshotDate = last_day(SnapshotDate)
    and AccountStatus not in ('CANCELLED', 'CLOSED', 'DECEASED', 'PRE_SETTLED', 'WRITTEN_OFF')
    and InvoicedInterest - PaidInterest + InvoicedFee - PaidFee > 0""", "loan_portfolio")
def unpaid_invoices(t):
    return r.unpaid_invoices(t.loan_portfolio, AS_OF)


@query("invoice_not_paid", f"""select date '{THIS}' as SnapshotDate, cast(AccountNumber as varchar) as AccountNumber, CurrentAmount as amount from loan_portfolio""", "loan_portfolio")
def invoice_not_paid(t):
    sheet = t.loan_portfolio.select(F.col("AccountNumber").alias("Account"), F.col("CurrentAmount").alias("InvNotPaid"))
    return r.invoice_not_paid(sheet, AS_OF)


@query("repurchase_load", """select cast(AccountNumber as varchar) as AccountNumber, SnapshotDate as SaleDate, MOB as BoughtCapital, IsOpen
  from loan_portfolio where MOB > 0""", "loan_portfolio")
def repurchase_load(t):
    sheet = t.loan_portfolio.select(F.col("AccountNumber").cast("double").alias("AccountNumber"), F.col("SnapshotDate").cast("string").alias("SaleDate"),
                                    F.col("MOB").alias("BoughtCapital"), "IsOpen", "DelinquencyStatus")
    return r.repurchase_load(sheet)


@query("accounts_lookup", """select AccountNumber, SnapshotDate, DisbursedDate, CurrentAmount, MOB, DelinquencyStatusCode, Ever90, AccountStatus, IsOpen
  from loan_portfolio_monthly where AccountNumber in (3, 7, 11)""", "loan_portfolio_monthly")
def accounts_lookup(t):
    return r.accounts_lookup(t.loan_portfolio_monthly, [3, 7, 11]).select(
        "AccountNumber", "SnapshotDate", "DisbursedDate", "CurrentAmount", "MOB", "DelinquencyStatusCode", "Ever90", "AccountStatus", "IsOpen")


@query("first_thousand_by_score", "select AccountNumber, SnapshotDate, Score from scored_accounts order by Score desc, AccountNumber, SnapshotDate limit 1000", "scored_accounts")
def first_thousand(t):
    return t.scored_accounts.select("AccountNumber", "SnapshotDate", "Score").orderBy(F.col("Score").desc(), "AccountNumber", "SnapshotDate").limit(1000)


STATUS = f"(select AccountNumber, AccountStatus from loan_portfolio where SnapshotDate = {LATEST})"
APPS = "select IsMainApplicant, ApplicantNo, HasCoapp, ReceivedDate, a.AccountNumber, DisbursedDate, Amount, SSN, s.AccountStatus from applications a join " + STATUS + " s on s.AccountNumber = a.AccountNumber where Status = 'DISBURSED'"
EVENTS = """
  decided as (select ApplicationID, IsMainApplicant, ApplicantNo, HasCoapp, ReceivedDate, AccountNumber, DisbursedDate, Amount,
      EventTypeDesc, DecisionDate, InsertDate, ssn_hash
    from applications, id_map, credit_events
    where applications.SSN = id_map.ssn_hash and id_map.SSN = credit_events.SSN and Status = 'DISBURSED'
      and EventTypeDesc in ('Skuldsanering bevilj', 'Personen har utvandr', 'Personen har avlidit')),
  counted as (select *, cast(sum(HasCoapp) over (partition by ApplicationID) as bigint) as HitWithCoapp from decided)"""
EVENT_USES = "credit_events id_map applications loan_portfolio"


@query("applications_with_status", APPS, "applications loan_portfolio")
def applications_with_status(t):
    return r.applications_with_status(t.applications, t.loan_portfolio)


@query("both_applicants_hit", "with " + EVENTS + " select * from counted where HitWithCoapp <> 1", EVENT_USES)
def both_applicants_hit(t):
    chosen = t.credit_events.filter(F.col("EventTypeDesc").isin(*r.SPECIAL_EVENTS)).join(t.id_map, "SSN", "left").drop("SSN")
    apps = t.applications.filter(F.col("Status") == "DISBURSED").select(
        "ApplicationID", "IsMainApplicant", "ApplicantNo", "HasCoapp", "ReceivedDate", "AccountNumber", "DisbursedDate", "Amount", F.col("SSN").alias("ssn_hash"))
    return r.both_applicants_hit(apps.join(chosen, "ssn_hash"))


SPECIAL = EVENTS + f""",
  status as (select AccountNumber, AccountStatus from loan_portfolio where SnapshotDate = {LATEST}),
  event_rows as (select distinct counted.*, AccountStatus from counted join status using (AccountNumber) where HitWithCoapp <> 1)"""


def _special(cut: str) -> str:
    return "with " + SPECIAL + f""",
  live as (select AccountNumber, AccountStatus from status where AccountStatus in ('COLLECTION', 'FROZEN', 'OPEN')),
  named as (select distinct AccountNumber, DisbursedDate, AccountStatus, EventTypeDesc, HasCoapp from event_rows
    where AccountStatus in ('COLLECTION', 'FROZEN', 'OPEN') {cut}),
  listed as (select distinct AccountNumber, DisbursedDate, AccountStatus, 'Skuldsanering bevilj' as EventTypeDesc, HasCoapp
    from applications join live using (AccountNumber)
    where Status = 'DISBURSED' and AccountNumber in (select AccountNumber from old_special_accounts)
      and AccountNumber not in (select AccountNumber from named) {cut}),
  every_case as (select * from named union all select * from listed)
  select AccountNumber, AccountStatus, EventTypeDesc, cast(case when EventTypeDesc = 'Skuldsanering bevilj' then 0.5 else 1 end as double) as LGD,
    date '{THIS}' as ReportingDate from every_case"""


SPECIAL_USES = EVENT_USES + " old_special_accounts"


def _special_df(t, until=None):
    rows = r.special_events(t.credit_events, t.id_map, t.applications, t.loan_portfolio)
    return r.special_cases(rows, t.old_special_accounts, r.applications_with_status(t.applications, t.loan_portfolio), THIS, until)


@query("special_events", "with " + SPECIAL + " select * from event_rows", EVENT_USES)
def special_events(t):
    return r.special_events(t.credit_events, t.id_map, t.applications, t.loan_portfolio)


@query("special_cases", _special(""), SPECIAL_USES)
def special_cases(t):
    return _special_df(t)


@query("special_cases_back_dated", _special("and DisbursedDate < date '1995-06-01'"), SPECIAL_USES)
def special_cases_back_dated(t):
    return _special_df(t, "1995-06-01")
