"""The loan tables, derived from the given parquet tables by one SQL text that any engine reads alike.

A customer stands for an account, an order for its snapshot of the month. Each text names the given
tables in braces and earlier loan tables by their plain name.
"""

from __future__ import annotations

import re
from collections.abc import Collection
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from riskspark.session import materialise

GIVEN = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
         "conversations").split()

TABLES = {
    # One row per order: an account may have several rows for one month-end. Its last order also stands at the last
    # month-end of all, so that the latest snapshot holds every account.
    "statements": """
        select o_custkey as AccountNumber,
          case when o_orderkey % 16 = 3 then cast(o_orderdate as date) else last_day(cast(o_orderdate as date)) end as SnapshotDate,
          case o_orderkey % 10 when 5 then 1 when 6 then 2 when 7 then 3 when 8 then 4 when 9 then 9 else 0 end as DelinquencyStatusCode,
          cast(o_orderkey % 7 as int) as NumberOfLateStatements,
          cast(o_totalprice as decimal(18,2)) as CurrentAmount,
          case when o_orderstatus = 'F' then 0 else 1 end as IsOpen,
          cast(o_orderdate as date) as OrderDate
        from {orders}
        union all
        select o_custkey, (select last_day(cast(max(o_orderdate) as date)) from {orders}),
          case o_orderkey % 10 when 5 then 1 when 6 then 2 when 7 then 3 when 8 then 4 when 9 then 9 else 0 end,
          cast(o_orderkey % 7 as int), cast(o_totalprice as decimal(18,2)), case when o_orderstatus = 'F' then 0 else 1 end,
          cast(o_orderdate as date)
        from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as latest from {orders}) o
        where latest = 1 and cast(o_orderdate as date) < (select last_day(cast(max(o_orderdate) as date)) from {orders})""",
    # One row per account and snapshot; one in sixteen snapshots is not a month-end.
    "loan_portfolio": """
        select AccountNumber, SnapshotDate, DisbursedDate, CurrentAmount,
          cast((year(SnapshotDate) - year(DisbursedDate)) * 12 + month(SnapshotDate) - month(DisbursedDate) as int) as MOB,
          cast(120 - (year(SnapshotDate) - year(DisbursedDate)) * 12 - month(SnapshotDate) + month(DisbursedDate) as int) as RemainingTenor,
          IsOpen,
          case when IsOpen = 0 and DelinquencyStatusCode >= 4 then 'WRITTEN_OFF' when IsOpen = 0 then 'CLOSED'
            when DelinquencyStatusCode = 9 then 'FROZEN' else 'OPEN' end as AccountStatus,
          case when DelinquencyStatusCode = 9 then 'Frozen' when DelinquencyStatusCode = 0 then 'Current' else 'Late' end as DelinquencyStatus,
          DelinquencyStatusCode, NumberOfLateStatements,
          cast(100 + 10 * NumberOfLateStatements as decimal(18,2)) as InvoicedInterest,
          cast(case when DelinquencyStatusCode = 0 then 100 + 10 * NumberOfLateStatements else 100 end as decimal(18,2)) as PaidInterest,
          cast(20 as decimal(18,2)) as InvoicedFee,
          cast(case when NumberOfLateStatements = 6 then 45 else 20 end as decimal(18,2)) as PaidFee
        from (
          select AccountNumber, SnapshotDate, min(min(OrderDate)) over (partition by AccountNumber) as DisbursedDate,
            cast(sum(CurrentAmount) as decimal(18,2)) as CurrentAmount, max(IsOpen) as IsOpen,
            max(DelinquencyStatusCode) as DelinquencyStatusCode, max(NumberOfLateStatements) as NumberOfLateStatements
          from statements group by AccountNumber, SnapshotDate) s""",
    "loan_portfolio_monthly": """
        select AccountNumber, SnapshotDate, DisbursedDate, MOB,
          max(case when DelinquencyStatusCode > 1 then 1 else 0 end) over (partition by AccountNumber order by SnapshotDate) as Ever30,
          max(case when DelinquencyStatusCode > 3 then 1 else 0 end) over (partition by AccountNumber order by SnapshotDate) as Ever90,
          CurrentAmount, DelinquencyStatusCode, AccountStatus, IsOpen,
          case when SnapshotDate = last_day(SnapshotDate) then 1 else 0 end as IsMonthEnd
        from loan_portfolio""",
    "payment_free_months": """
        select o_custkey as AccountNumber,
          cast(year(cast(o_orderdate as date)) * 100 + month(cast(o_orderdate as date)) as int) as YearMonth
        from {orders} where o_orderpriority = '5-LOW'""",
    "forbearance": """
        select o.o_custkey as AccountNumber,
          case l_linenumber when 1 then 'Permanent interest cut' when 2 then 'Extension of maturity'
            when 3 then 'Temporary interest cut' when 4 then 'Capitalization' else 'Skip a pay' end as ForbearanceName,
          cast(l_shipdate as date) as StartDate,
          cast(cast(l_shipdate as date) + interval 180 day as date) as EndDate
        from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey
        where l_returnflag = 'R' and l_partkey % 10 = 0""",
    # One applicant per account, and a second one - the next customer - for every fourth account.
    "applicant_base": """
        select c_custkey, c_acctbal, c_nationkey, c_mktsegment, FirstDate
        from {customer} c join (select o_custkey, cast(min(o_orderdate) as date) as FirstDate from {orders} group by 1) o
          on c.c_custkey = o.o_custkey""",
    "applications": """
        select cast(c_custkey * 10 + ApplicantNo as bigint) as ApplicationID, c_custkey as AccountNumber,
          cast(c_custkey + ApplicantNo - 1 as bigint) as SSN, 2 - ApplicantNo as IsMainApplicant, ApplicantNo,
          case when c_custkey % 4 = 0 then 1 else 0 end as HasCoapp,
          case when c_custkey % 8 = 0 then 1 else 0 end as CoappSameAddress,
          FirstDate - cast(c_custkey % 20 as int) as ReceivedDate,
          case when c_custkey % 17 = 5 then null else FirstDate end as DisbursedDate,
          date '1950-01-01' + cast(c_custkey * 37 % 16000 as int) as BirthDate,
          cast(c_acctbal as decimal(18,2)) as Amount, cast(c_custkey % 5 * 100 as decimal(18,2)) as StartupFee,
          case when c_custkey % 11 = 0 then 'REJECTED' else 'DISBURSED' end as Status,
          case when c_custkey % 5 = 0 then null else (c_custkey % 100) / 100.0E0 end as PDScoreNew,
          case when c_custkey % 19 = 0 then null else cast(c_custkey % 100 as double) end as ApplicationScore,
          cast(c_custkey % 3 as int) as PaymentRemarks,
          case c_custkey % 4 when 0 then 'Married' when 1 then 'None' when 2 then null else 'Single' end as MaritalStatus,
          case when c_custkey % 6 = 0 then null when c_custkey % 9 = 0 then 1 else 0 end as Kronofogden,
          c_mktsegment as Product, concat('Broker ', cast(c_nationkey as varchar(10))) as BrokerName
        from (select *, 1 as ApplicantNo from applicant_base
              union all select *, 2 as ApplicantNo from applicant_base where c_custkey % 4 = 0) a""",
    "credit_reports": """
        select o_custkey as SSN, cast(o_orderdate as date) as Date, o_orderkey as jsonID,
          case when o_orderkey % 13 = 0 then null else (o_orderkey % 1000) / 1000.0E0 end as UCScore,
          case when o_orderkey % 9 = 0 then null else cast(o_orderkey % 12 as double) end as Inquiries12M,
          case o_orderkey % 3 when 0 then null when 1 then 0.0E0 else o_totalprice end as MortgageLoansHouseVolume,
          case o_orderkey % 5 when 0 then null when 1 then 0.0E0 else o_totalprice / 2 end as MortgageLoansApartmentVolume,
          case when o_orderkey % 7 = 0 then null else (o_orderkey % 100) / 100.0E0 end as UtilizationRatio,
          case when o_orderkey % 4 = 0 then null else cast(o_orderkey % 500 as double) end as CapitalDeficit,
          case when o_orderkey % 6 = 0 then null else (o_orderkey % 50) / 10.0E0 end as IndebtednessRatio,
          case when o_orderkey % 8 = 0 then null else cast(o_orderkey % 4 as double) end as PaymentRemarksNo,
          case when o_orderkey % 10 = 0 then null else (o_orderkey % 80) / 80.0E0 end as AvgUtilizationRatio12M
        from {orders}""",
    "ecl_result": """
        select SnapshotDate as ReportDate, AccountNumber, case when AccountNumber % 10 = 7 then 1 else 0 end as Ord,
          case when DelinquencyStatusCode >= 4 then 'Stage3' when DelinquencyStatusCode >= 1 or AccountNumber % 6 = 0 then 'Stage2' else 'Stage1' end as RiskStage,
          case AccountNumber % 4 when 0 then 'monitoring_paymentrelief' when 1 then 'monitoring_previous_S3' else '' end as FBE,
          case when AccountNumber % 9 = 0 then 'DebtRelief' else null end as SpecialCase,
          CurrentAmount as Base,
          cast(DelinquencyStatusCode * 100 + AccountNumber % 50 as decimal(18,2)) as ECL_SUM,
          cast(DelinquencyStatusCode * 90 + AccountNumber % 50 as decimal(18,2)) as ECLNPV_SUM
        from loan_portfolio where SnapshotDate = last_day(SnapshotDate)""",
    "scored_accounts": """
        select AccountNumber, SnapshotDate, MOB, AccountStatus, (AccountNumber % 50) / 100.0E0 as AppliedApplicationScore,
          case when DelinquencyStatusCode in (4, 9) then 1.0E0 else (DelinquencyStatusCode * 15 + AccountNumber % 10) / 100.0E0 end as AdjustedBehaviourScore,
          (AccountNumber % 70) / 100.0E0 as Score,
          case AccountNumber % 4 when 0 then 'monitoring_paymentrelief' when 1 then 'monitoring_previous_S3' else '' end as FBE,
          case when DelinquencyStatusCode >= 4 then 3 when DelinquencyStatusCode >= 1 then 2 else 1 end as Stageing
        from loan_portfolio where SnapshotDate = last_day(SnapshotDate) and AccountNumber % 8 <> 5""",
    "credit_events": """
        select concat('P', cast(o_custkey as varchar(20))) as SSN,
          case o_orderkey % 4 when 0 then 'Skuldsanering bevilj' when 1 then 'Personen har utvandr' when 2 then 'Personen har avlidit'
            else 'Skuldsanering inledd' end as EventTypeDesc,
          cast(o_orderdate as date) as DecisionDate, last_day(cast(o_orderdate as date)) as InsertDate
        from {orders} where o_orderpriority = '1-URGENT'""",
    "id_map": """
        select concat('P', cast(c_custkey as varchar(20))) as SSN, c_custkey as ssn_hash from {customer} where c_custkey % 23 <> 0""",
    "old_special_accounts": "select o_custkey as AccountNumber from {orders} where o_orderkey % 50 = 0",
    "broker_commission": """
        select concat('Broker ', cast(s_nationkey as varchar(10))) as BrokerName, cast(s_suppkey % 30 as int) as Days,
          cast(s_suppkey % 12 as int) as Months, (s_suppkey % 5) / 100.0E0 as CommissionPct,
          date '1995-01-01' + cast(s_suppkey % 1500 as int) as validFrom, date '1998-01-01' + cast(s_suppkey % 1500 as int) as validTo,
          cast(s_acctbal as decimal(18,2)) as FixAmount, 'Old product' as Product
        from {supplier}""",
    # One row per month.
    "macro_series": """
        select *, case when month(Date) = 7 then null else Discount end as Inflation, Discount + 0.5E0 as Forecast
        from (select cast(date_trunc('month', l_shipdate) as date) as Date,
                cast(sum(cast(round(l_discount * 100) as int)) as double) / count(*) as Discount,
                cast(sum(cast(round(l_tax * 100) as int)) as double) / count(*) as RepoRate,
                cast(sum(cast(round(l_quantity) as int)) as double) / count(*) as Consumption
              from {lineitem} group by 1) m""",
    # Month-end rows with the columns a score is built from and a later outcome.
    "model_tape": """
        select AccountNumber, SnapshotDate, DisbursedDate, MOB, AccountStatus, CurrentAmount, IsOpen, Ever30, Ever90,
          case when AccountNumber % 4 = 0 then 1 else 0 end as CoappFlag, Ever30 as Ever30In6Months,
          case when DelinquencyStatusCode = 9 then 5 else DelinquencyStatusCode end as WorstDelinquency6M,
          DelinquencyStatusCode as CurrentDelinquencyStatus,
          case when DelinquencyStatusCode >= 4 then 3 when DelinquencyStatusCode >= 1 then 2 else 1 end as Stage,
          ((AccountNumber * 37 + MOB * 11) % 1000) / 1000.0E0 as Score,
          (DelinquencyStatusCode * 60 + (AccountNumber * 53 + MOB * 17) % 461) / 1001.0E0 as Probability_model,
          case when (AccountNumber * 7 + MOB * 13) % 17 < DelinquencyStatusCode + 2 then 1 else 0 end as Ever90_12M
        from loan_portfolio_monthly where IsMonthEnd = 1""",
}

_WORD = re.compile(r"\w+")


def needed(names: list[str], ready: Collection[str] = ()) -> list[str]:
    """The loan tables behind `names`, each after those it is built on; nothing behind those that are `ready`."""
    found: set[str] = set()

    def visit(name: str) -> None:
        if name not in found:
            found.add(name)
            for word in () if name in ready else set(_WORD.findall(TABLES[name])) & set(TABLES):
                if word != name:
                    visit(word)

    for n in names:
        visit(n)
    return [n for n in TABLES if n in found]


def _text(name: str) -> str:
    return TABLES[name].format(**{g: g for g in GIVEN})


def sql_with_inputs(body: str, names: list[str]) -> str:
    """`body` with the loan tables it names in front, over the given tables."""
    parts = [f"{n} as ({_text(n)})" for n in needed(names)]
    body = body.strip()
    if not parts:
        return body
    if body.lower().startswith("with "):
        return "with " + ",\n".join(parts) + ",\n" + body[5:]
    return "with " + ",\n".join(parts) + "\n" + body


# Footers are read once per folder and table.
_SCHEMAS: dict[tuple[str, str], StructType] = {}


class Inputs:
    """Loan tables of one data folder as lazy DataFrames: `inputs.loan_portfolio` and so on."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._written: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if (self.folder, name) not in _SCHEMAS:
            _SCHEMAS[self.folder, name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[self.folder, name]).parquet(path)

    @cached_property
    def orders(self) -> DataFrame:
        return self.given("orders")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        order = needed([name], self._written)
        texts = [f"{n} as ({TABLES[n]})" if n not in self._written else f"{n} as (select * from {{{n}}})" for n in order]
        body = "with " + ",\n".join(texts) + f"\nselect * from {name}"
        tables = {g: self.given(g) for g in GIVEN if "{" + g + "}" in body}
        df = self.spark.sql(body, **tables, **{n: t for n, t in self._written.items() if n in order})
        setattr(self, name, df)
        return df

    def write(self, *names: str) -> None:
        """Write loan tables that many branches of a query read; they and the tables built on them are then read back.

        Rows are the same; the aggregates and windows behind a table run once instead of once for each branch.
        """
        for name in names:
            self._written[name] = materialise(getattr(self, name), name)
            setattr(self, name, self._written[name])
