"""Scores, increased risk, stage, macro instrument."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.catalog import admission as adm
from riskspark.catalog.delinquency import FEATURES
from riskspark.catalog.registry import query
from riskspark.operators import macro, scoring
from riskspark.operators.delinquency import delinquency_features
from riskspark.plans.admission import admission_scores
from riskspark.plans.staging import BEHAVIOUR_COLUMNS, behaviour_scores, customer_scores, latest_month

FEATURE_USES = "loan_portfolio payment_free_months forbearance applications"
START, END = "1995-01-01", "2001-12-31"

BEHAVIOUR = """
 flagged as (select * replace (case when CoappFlag in (0, 1) then CoappFlag else 0 end as CoappFlag) from features),
 one_side as (select f.* from flagged f where CoappFlag = 1 or AccountNumber not in (select AccountNumber from flagged where CoappFlag = 1)),
 live as (select * from one_side where AccountStatus in ('OPEN', 'FROZEN', 'COLLECTION')),
 relieved as (select l.* from live l where FBE_eftergift = 1 or not exists (select 1 from live k
   where k.FBE_eftergift = 1 and k.SnapshotDate = l.SnapshotDate and k.AccountNumber = l.AccountNumber)),
 raw as (select *, 1 / (1 + exp(-(-0.44414603 * CoappFlag + 0.18778622 * Ever30In6Months + 0.3539554 * WorstDelinquency6M
   + 0.70178643 * CurrentDelinquencyStatus))) as P from relieved),
 behaviour as (select *, 1 / (1 + exp(-(P * 10.11569562 - 8.18226514))) as BehaviourModel from raw)"""

ADM_SCORES = adm.ADMISSION + f""",
 adm_raw as (select *, 1 / (1 + exp(-(-0.13407141 + 2.03675292 * UCScore - 0.0218071234 * age + 0.0339715771 * Inquiries12M - 2.12322589e-07 * PropertyVolume))) as P
   from admission where DisbursedDate < date_trunc('month', date '{adm.AS_OF}')),
 adm_scores as (select AccountNumber, PDScoreNew, ApplicationScore, 1 / (1 + exp(-(P * 3.7812065422080856 - 4.336067082588543))) as AdmissionModel from adm_raw)"""


def _rules(source: str) -> str:
    return f"""
 applied as (select *, coalesce(case
     when DisbursedDate > date '2023-12-20' and PDScoreNew is not null and round_even(PDScoreNew, 2) <= round_even(AdmissionModel, 2) then PDScoreNew
     when DisbursedDate > date '2023-12-20' and PDScoreNew is null then AdmissionModel
     when DisbursedDate <= date '2023-12-20' then ApplicationScore / 100
     else AdmissionModel end, 0) as AppliedApplicationScore,
   case when CurrentDelinquencyStatus in (4, 9) then 1.0 else BehaviourModel end as Adjusted from {source}),
 deltas as (select *, coalesce(Adjusted - AppliedApplicationScore, 0) as PD_Delta,
   case when ForberanceIn12Months = 1 and CurrentDelinquencyStatus > 1 and CurrentDelinquencyStatus < 4 then 'monitoring_previous_S3'
     when FBE_eftergift = 1 then 'monitoring_paymentrelief' else '' end as Reason from applied where MOB is not null),
 sicrs as (select *, case when PD_Delta > 0.09 or Reason <> '' then 1 else 0 end as SICR from deltas),
 lifetime as (select *, least(case when SICR = 1 and Adjusted < 0.5 then Adjusted * 1.2 when SICR = 1 then Adjusted * 1.1 else Adjusted end, 1.0) as Life from sicrs),
 staged as (select *, case when SICR = 0 then 1 when Life = 1.0 then 3 else 2 end as Stageing from lifetime)"""


INSTRUMENT = f"""
 rolled as (select case when Date = last_day(Date) then last_day(Date + 1) else last_day(Date) end as Date, Inflation, Forecast from macro_series),
 merged as (select Date, case when Inflation > -11 then Inflation + 1 else Forecast + 1 end as x from rolled where Date between date '{START}' and date '{END}'),
 six as (select Date, case when count(x) over w = 6 then avg(x) over w end as m from merged window w as (order by Date rows between 5 preceding and current row)),
 lagged as (select Date, lead(m, 3) over (order by Date) as m from six),
 root as (select Date, case when m >= 0 then pow(m, 1.0 / 3) end as i from lagged),
 normed as (select Date, i / avg(i) over () as i from root),
 smooth as (select Date, case when count(i) over w = 3 then avg(i) over w end as i from normed window w as (order by Date rows between 2 preceding and current row)),
 instrument as (select Date, pow(i, 0.1) as InstrumentRollingMean from smooth)"""

# A frame with every input of the staging rules, for the rules on their own.
RULE_INPUT = """
  select AccountNumber, SnapshotDate, MOB, date '2023-12-01' + cast(AccountNumber % 40 as int) as DisbursedDate,
    DelinquencyStatusCode as CurrentDelinquencyStatus, (AccountNumber % 97) / 97.0E0 as BehaviourModel,
    case when AccountNumber % 5 = 0 then null else (AccountNumber % 89) / 89.0E0 end as PDScoreNew, (AccountNumber % 83) / 83.0E0 as AdmissionModel,
    case when AccountNumber % 7 = 0 then null else cast(AccountNumber % 100 as double) end as ApplicationScore,
    case when AccountNumber % 11 = 0 then 1 else 0 end as FBE_eftergift, case when AccountNumber % 3 = 0 then 1 else 0 end as ForberanceIn12Months
  from loan_portfolio"""


def _features(t):
    return delinquency_features(t.loan_portfolio, t.applications, t.payment_free_months, t.forbearance)


def _instrument(t):
    return macro.macro_instrument(macro.macro_series(t.macro_series, START, END))


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 9) for c in columns})


@query("behaviour_score", "with " + FEATURES + "," + BEHAVIOUR + """
  select AccountNumber, SnapshotDate, CoappFlag, FBE_eftergift, round(P, 9) as P, round(BehaviourModel, 9) as BehaviourModel from behaviour""", FEATURE_USES)
def behaviour_score(t):
    df = behaviour_scores(_features(t)).select("AccountNumber", "SnapshotDate", "CoappFlag", "FBE_eftergift", "P", "BehaviourModel")
    return _rounded(df, "P", "BehaviourModel")


@query("staging_rules", "with rule_input as (" + RULE_INPUT + ")," + _rules("rule_input") + """
  select AccountNumber, SnapshotDate, round(AppliedApplicationScore, 9) as AppliedApplicationScore, round(PD_Delta, 9) as PD_Delta, Reason as FBE, SICR,
    round(Life, 9) as LifetimeScore, Stageing from staged""", "loan_portfolio")
def staging_rules(t):
    staged = scoring.stage_accounts(t.spark.sql(RULE_INPUT.replace("from loan_portfolio", "from {lp}"), lp=t.loan_portfolio))
    cols = staged.select("AccountNumber", "SnapshotDate", "AppliedApplicationScore", "PD_Delta", "FBE", "SICR", "LifetimeScore", "Stageing")
    return _rounded(cols, "AppliedApplicationScore", "PD_Delta", "LifetimeScore")


TOGETHER = ("with " + FEATURES + "," + BEHAVIOUR + "," + ADM_SCORES + ", together as (select " + ", ".join(f"b.{c}" for c in BEHAVIOUR_COLUMNS)
            + ", s.* exclude (AccountNumber) from behaviour b left join adm_scores s on s.AccountNumber = b.AccountNumber)," + _rules("together"))
SCORE_USES = FEATURE_USES + " loan_portfolio_monthly credit_reports"
RUN_DATE = "2001-09-15"


#: Tables that the features and the admission scores read in many branches.
SHARED = ("loan_portfolio", "applications")


def _scores(features, t, **options):
    adm_scores = admission_scores(t.applications, t.credit_reports, t.loan_portfolio_monthly, adm.AS_OF)
    df = customer_scores(features, adm_scores, _instrument(t), **options)
    return _rounded(df, "AppliedApplicationScore", "AdjustedBehaviourScore", "PD_Delta")


@query("customer_scores", TOGETHER + """
  select AccountNumber, SnapshotDate, MOB, round(AppliedApplicationScore, 9) as AppliedApplicationScore, round(Adjusted, 9) as AdjustedBehaviourScore,
    round(PD_Delta, 9) as PD_Delta, Reason as FBE, SICR, Stageing from (select distinct * from staged) d""", SCORE_USES)
def scores(t):
    t.write(*SHARED)
    return _scores(_features(t), t)


def _monthly(t):
    """The month before the run date, with its whole history."""
    cut = F.add_months(F.lit(RUN_DATE).cast("date"), -1)
    return delinquency_features(t.loan_portfolio, t.applications, t.payment_free_months, t.forbearance, output_after=cut)


@query("monthly_scores_with_macro", TOGETHER + "," + INSTRUMENT + f"""
  select AccountNumber, SnapshotDate, MOB, round(AppliedApplicationScore, 9) as AppliedApplicationScore,
    round(case when CurrentDelinquencyStatus in (4, 9) then 1.0 else BehaviourModel * coalesce(InstrumentRollingMean, 1) end, 9) as AdjustedBehaviourScore,
    round(PD_Delta, 9) as PD_Delta, Reason as FBE, SICR, Stageing
  from (select distinct * from staged where SnapshotDate > date '{RUN_DATE}' - interval 1 month) d left join instrument i on i.Date = d.SnapshotDate""",
       SCORE_USES + " macro_series")
def monthly_scores_with_macro(t):
    t.write(*SHARED)
    return _scores(_monthly(t), t, apply_macro=True)


@query("monthly_scores_with_labels", TOGETHER + f"""
  select AccountNumber, SnapshotDate, MOB, round(AppliedApplicationScore, 9) as AppliedApplicationScore, round(Adjusted, 9) as AdjustedBehaviourScore,
    round(PD_Delta, 9) as PD_Delta, Reason as FBE, SICR, concat('Stage', Stageing) as Stageing
  from (select distinct * from staged where SnapshotDate > date '{RUN_DATE}' - interval 1 month) d""", SCORE_USES)
def monthly_scores_with_labels(t):
    t.write(*SHARED)
    return _scores(latest_month(_features(t), RUN_DATE), t, labels=True)


@query("macro_overlay", "with rule_input as (" + RULE_INPUT + ")," + INSTRUMENT + """
  select AccountNumber, SnapshotDate, round(coalesce(InstrumentRollingMean, 1), 9) as MacroFactor,
    round(case when CurrentDelinquencyStatus in (4, 9) then 1.0 else BehaviourModel * coalesce(InstrumentRollingMean, 1) end, 9) as AdjustedBehaviourScore
  from rule_input r left join instrument i on i.Date = r.SnapshotDate""", "loan_portfolio macro_series")
def macro_overlay(t):
    rows = t.spark.sql(RULE_INPUT.replace("from loan_portfolio", "from {lp}"), lp=t.loan_portfolio)
    df = scoring.macro_overlay(rows, _instrument(t)).select("AccountNumber", "SnapshotDate", "MacroFactor", "AdjustedBehaviourScore")
    return _rounded(df, "MacroFactor", "AdjustedBehaviourScore")


@query("macro_instrument", "with " + INSTRUMENT + " select Date, round(InstrumentRollingMean, 9) as InstrumentRollingMean from instrument", "macro_series")
def macro_instrument(t):
    return _rounded(_instrument(t).select("Date", "InstrumentRollingMean"), "InstrumentRollingMean")


@query("macro_rolling_means", """select Date, round(case when count(RepoRate) over w = 6 then avg(RepoRate) over w end, 9) as RepoRateMean,
    round(case when count(Inflation) over w = 6 then avg(Inflation) over w end, 9) as InflationMean
  from macro_series window w as (order by Date rows between 5 preceding and current row)""", "macro_series")
def macro_rolling_means(t):
    df = macro.rolling_means(t.macro_series, ["RepoRate", "Inflation"], 6).select("Date", "RepoRateMean", "InflationMean")
    return _rounded(df, "RepoRateMean", "InflationMean")


@query("macro_correlations", """
  select 'Inflation' as Feature, round(corr(Inflation, Forecast), 6) as Correlation from macro_series
  union all select 'RepoRate', round(corr(RepoRate, Forecast), 6) from macro_series
  union all select 'Consumption', round(corr(Consumption, Forecast), 6) from macro_series""", "macro_series")
def macro_correlations(t):
    df = macro.correlation_ranking(t.macro_series, ["Inflation", "RepoRate", "Consumption"], "Forecast")
    return df.withColumn("Correlation", F.round("Correlation", 6))


@query("score_snapshot", """
  with tape as (select distinct AccountNumber, (AccountNumber % 100) / 100.0E0 as P_calibrated from applications),
  raw as (select m.*, P_calibrated, 1 / (1 + exp(-(-0.44414603 * CoappFlag + 0.18778622 * Ever30In6Months + 0.3539554 * WorstDelinquency6M
    + 0.70178643 * CurrentDelinquencyStatus))) as P from model_tape m join tape t on t.AccountNumber = m.AccountNumber where SnapshotDate = date '1999-06-30')
  select AccountNumber, P_calibrated, round(P, 9) as Probability_model, round(1 / (1 + exp(-(P * 10.11569562 - 8.18226514))), 9) as Recalibrated_Probability_model from raw""",
       "model_tape applications")
def score_snapshot(t):
    tape = t.applications.select("AccountNumber", ((F.col("AccountNumber") % 100) / 100.0).alias("P_calibrated"))
    df = scoring.score_snapshot(t.model_tape.drop("Probability_model"), "1999-06-30", tape)
    cols = df.select("AccountNumber", "P_calibrated", "Probability_model", "Recalibrated_Probability_model")
    return _rounded(cols, "Probability_model", "Recalibrated_Probability_model")
