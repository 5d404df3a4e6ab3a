"""Applicants, credit reports and admission data."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog.registry import query
from riskspark.operators import applicants as a
from riskspark.operators.keyed import first_per_key
from riskspark.plans.admission import admission_data, admission_scores

AS_OF = "2001-06-15"

DEL90 = """
 ends as (select * from loan_portfolio_monthly where IsMonthEnd = 1),
 maxmob as (select AccountNumber, max(MOB) as MOB from ends where MOB <= 12 group by 1),
 outcome_any as (select distinct l.AccountNumber, l.Ever90, l.DisbursedDate, l.MOB from ends l join maxmob m
   on l.AccountNumber = m.AccountNumber and l.MOB = m.MOB),
 outcome as (select o.*, e.Ever30 from outcome_any o join (select distinct AccountNumber, Ever30 from ends where MOB = 3) e
   on o.AccountNumber = e.AccountNumber)"""

IN_WINDOW = "r.SSN = a.SSN and r.Date - a.ReceivedDate between -30 and coalesce(a.DisbursedDate - a.ReceivedDate, 60)"

MAIN = f"""
 main_apps as (select a.*, o.Ever30, o.Ever90 from applications a left join outcome o
   on o.AccountNumber = a.AccountNumber and o.DisbursedDate = a.DisbursedDate
   where IsMainApplicant = 1 and HasCoapp = 0 and Status = 'DISBURSED'),
 main as (select * exclude (n) from (
   select a.*, r.* exclude (SSN), row_number() over (partition by a.AccountNumber, a.SSN
     order by r.Date desc nulls last, a.ApplicationID, r.jsonID desc) as n
   from main_apps a left join credit_reports r on {IN_WINDOW}) x where n = 1)"""

CO = f"""
 co_hits as (select a.*, r.* exclude (SSN) from applications a join credit_reports r on {IN_WINDOW}
   where HasCoapp = 1 and Status = 'DISBURSED'),
 co_best as (select * exclude (n) from (select h.*, row_number() over (partition by h.AccountNumber
     order by h.Date desc, h.ApplicationID, h.jsonID desc) as n
   from co_hits h join (select AccountNumber, min(UCScore) as m from co_hits group by 1) x
     on h.AccountNumber = x.AccountNumber and h.UCScore = x.m) y where n = 1),
 co as (select c.*, o.Ever90 from co_best c join outcome_any o on o.AccountNumber = c.AccountNumber)"""

ZERO = ("PaymentRemarksNo", "MortgageLoansHouseVolume", "MortgageLoansApartmentVolume", "AvgUtilizationRatio12M")
MINUS_ONE = ("IndebtednessRatio", "CapitalDeficit", "Inquiries12M")
TEXTS = ("Status", "MaritalStatus", "Product", "BrokerName")
FILLED = ", ".join(
    [f"coalesce({c}, 0.0) as {c}" for c in ZERO] + [f"coalesce({c}, -1.0) as {c}" for c in MINUS_ONE]
    + ["coalesce(UtilizationRatio, -100.0) as UtilizationRatio"]
    + [f"case when {c} is null or {c} = 'None' then 'Unknown' else {c} end as {c}" for c in TEXTS])

# Reused by the staging query.
ADMISSION = f"""{DEL90},{MAIN},{CO},
 stacked as (select *, 0 as Applicationtype from main where UCScore is not null
   union all by name
   select *, case when HasCoapp = 1 and CoappSameAddress = 1 then 1 when HasCoapp = 1 and CoappSameAddress = 0 then 2 end as Applicationtype from co),
 admission as (select *, case when MortgageLoansHouseVolume > 0 then MortgageLoansHouseVolume
     when MortgageLoansApartmentVolume > 0 then MortgageLoansApartmentVolume else 0.0 end as PropertyVolume from (
   select * replace ({FILLED}), cast(date_diff('year', BirthDate, date '{AS_OF}')
     - case when strftime(BirthDate, '%m%d') > strftime(date '{AS_OF}', '%m%d') then 1 else 0 end as int) as age from stacked) x)"""
USES = "loan_portfolio_monthly applications credit_reports"


@query("early_outcome", "with " + DEL90 + " select * from outcome", "loan_portfolio_monthly")
def early_outcome(t):
    return a.early_outcome(t.loan_portfolio_monthly)


@query("max_month_on_book", "with " + DEL90 + " select * from maxmob", "loan_portfolio_monthly")
def max_month_on_book(t):
    return a.max_mob(t.loan_portfolio_monthly)


@query("outcome_at_month_12", "select distinct AccountNumber, Ever90, DisbursedDate from loan_portfolio_monthly where IsMonthEnd = 1 and MOB = 12",
       "loan_portfolio_monthly")
def outcome_at_month_12(t):
    return a.outcome_at_mob(t.loan_portfolio_monthly)


@query("outcome_history", """select distinct AccountNumber, Ever90, DisbursedDate, SnapshotDate, MOB, CurrentAmount
  from loan_portfolio_monthly where IsMonthEnd = 1""", "loan_portfolio_monthly")
def outcome_history(t):
    return a.outcome_history(t.loan_portfolio_monthly)


@query("credit_report_asof", f"""
  select * exclude (n) from (select a.*, r.* exclude (SSN), row_number() over (partition by a.AccountNumber, a.SSN
    order by r.Date desc nulls last, a.ApplicationID, r.jsonID desc) as n
  from applications a left join credit_reports r on {IN_WINDOW}) x where n = 1""", "applications credit_reports")
def credit_report_asof(t):
    return a.credit_report_asof(t.applications, t.credit_reports)


@query("credit_report_min_score", f"""
  with hits as (select a.*, r.* exclude (SSN) from applications a join credit_reports r on {IN_WINDOW})
  select * exclude (n) from (select h.*, row_number() over (partition by h.AccountNumber
      order by h.Date desc, h.ApplicationID, h.jsonID desc) as n
    from hits h join (select AccountNumber, min(UCScore) as m from hits group by 1) x
      on h.AccountNumber = x.AccountNumber and h.UCScore = x.m) y where n = 1""", "applications credit_reports")
def credit_report_min_score(t):
    return a.credit_report_min_score(t.applications, t.credit_reports)


@query("main_applicants", "with " + DEL90 + "," + MAIN + " select * from main", USES)
def main_applicants(t):
    return a.main_applicants(t.applications, t.credit_reports, a.early_outcome(t.loan_portfolio_monthly))


@query("co_applicants", "with " + DEL90 + "," + CO + " select * from co", USES)
def co_applicants(t):
    return a.co_applicants(t.applications, t.credit_reports, a.early_outcome(t.loan_portfolio_monthly, early_mob=None))


@query("co_applicants_month_12", "with " + DEL90 + "," + CO + """
  select c.*, o.Ever90 from co_best c join (select distinct AccountNumber, Ever90, DisbursedDate from ends where MOB = 12) o
    on o.AccountNumber = c.AccountNumber""", USES)
def co_applicants_month_12(t):
    return a.co_applicants(t.applications, t.credit_reports, a.outcome_at_mob(t.loan_portfolio_monthly))


@query("impute_admission", f"select * replace ({FILLED.split(', case')[0]}) from credit_reports", "credit_reports")
def impute_admission(t):
    return a.impute_admission(t.credit_reports)


@query("admission_data", "with " + ADMISSION + " select * from admission", USES)
def admission(t):
    return admission_data(t.applications, t.credit_reports, t.loan_portfolio_monthly, AS_OF)


@query("admission_scores", "with " + ADMISSION + f""",
  scored as (select *, 1 / (1 + exp(-(-0.13407141 + 2.03675292 * UCScore - 0.0218071234 * age + 0.0339715771 * Inquiries12M - 2.12322589e-07 * PropertyVolume))) as P
    from admission where DisbursedDate < date_trunc('month', date '{AS_OF}'))
  select AccountNumber, PDScoreNew, UCScore, age, Inquiries12M, PropertyVolume, ApplicationScore,
    round(1 / (1 + exp(-(P * 3.7812065422080856 - 4.336067082588543))), 9) as AdmissionModel from scored""", USES)
def admission_score(t):
    df = admission_scores(t.applications, t.credit_reports, t.loan_portfolio_monthly, AS_OF)
    return df.withColumn("AdmissionModel", F.round("AdmissionModel", 9))


@query("property_volume", """select jsonID, case when MortgageLoansHouseVolume > 0 then MortgageLoansHouseVolume
  when MortgageLoansApartmentVolume > 0 then MortgageLoansApartmentVolume else 0.0 end as PropertyVolume from credit_reports""", "credit_reports")
def property_volume(t):
    return a.property_volume(t.credit_reports).select("jsonID", "PropertyVolume")


@query("application_type", """select ApplicationID, case when HasCoapp = 0 and PaymentRemarks > 0 then 0 when HasCoapp = 1 and CoappSameAddress = 1 then 1 else 2 end as Applicationtype
  from applications where (HasCoapp = 0 and PaymentRemarks > 0) or HasCoapp = 1""", "applications")
def application_type(t):
    apps = t.applications.withColumn("UCScore", F.when(F.col("PaymentRemarks") > 0, F.col("PaymentRemarks")))
    df = a.application_type(apps.filter("HasCoapp = 0"), apps.filter("HasCoapp = 1"))
    return df.select("ApplicationID", "Applicationtype")


@query("prefer_coapplicant", """select a.* from applications a where IsMainApplicant = 0
  or AccountNumber not in (select AccountNumber from applications where IsMainApplicant = 0)""", "applications")
def prefer_coapplicant(t):
    apps = t.applications.withColumn("CoappFlag", 1 - F.col("IsMainApplicant"))
    return a.prefer_coapplicant(apps).drop("CoappFlag")


@query("normalise_coapp_flag", "select c_custkey as AccountNumber, case when c_custkey % 5 in (0, 1) then cast(c_custkey % 5 as bigint) else 0 end as CoappFlag from customer")
def normalise_coapp_flag(t):
    df = t.given("customer").select(F.col("c_custkey").alias("AccountNumber"), (F.col("c_custkey") % 5).alias("CoappFlag"))
    return a.normalise_coapp_flag(df)


@query("prefer_relief_row", """
  with s as (select *, case when DelinquencyStatusCode in (1, 2) then 1 else 0 end as FBE_eftergift from statements)
  select s.* from s left join (select distinct SnapshotDate, AccountNumber from s where FBE_eftergift = 1) k
    on s.SnapshotDate = k.SnapshotDate and s.AccountNumber = k.AccountNumber
  where s.FBE_eftergift = 1 or k.AccountNumber is null""", "statements")
def prefer_relief_row(t):
    df = t.statements.withColumn("FBE_eftergift", F.when(F.col("DelinquencyStatusCode").isin(1, 2), 1).otherwise(0))
    return a.prefer_relief_row(df)


@query("latest_report_per_person", """select * exclude (n) from (select *, row_number() over (partition by SSN order by Date desc, jsonID desc) as n
  from credit_reports) x where n = 1""", "credit_reports")
def latest_report_per_person(t):
    return first_per_key(t.credit_reports, ["SSN"], [F.col("Date").desc(), F.col("jsonID").desc()])


@query("lowest_score_per_person", """select * exclude (n) from (select *, row_number() over (partition by SSN order by UCScore, Date desc, jsonID desc) as n
  from credit_reports where UCScore is not null) x where n = 1""", "credit_reports")
def lowest_score_per_person(t):
    scored = t.credit_reports.filter(F.col("UCScore").isNotNull())
    return first_per_key(scored, ["SSN"], [F.col("UCScore"), F.col("Date").desc(), F.col("jsonID").desc()])
