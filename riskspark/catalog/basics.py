"""Sources, sinks, dates and scalar expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskspark.catalog.registry import query
from riskspark.functions import dates, scalars
from riskspark.session import shared_folder
from riskspark.sources import tables

AS_OF = "1999-07-10"
LP_COLUMNS = ("AccountNumber", "SnapshotDate", "DisbursedDate", "CurrentAmount", "MOB", "AccountStatus")


def _folder(t, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


@query("read_table", "select * from customer")
def read_table(t):
    return tables.read_table(t.spark, "customer", root=t.folder, require_non_empty=True)


@query("read_table_as_of", "select * from orders where o_orderdate = timestamp '1998-03-14 00:00:00'")
def read_table_as_of(t):
    return tables.read_table(t.spark, "orders", root=t.folder, as_of=F.lit("1998-03-14").cast("timestamp_ntz"), date="o_orderdate")


@query("csv_tape_round_trip", "select AccountNumber, SnapshotDate, DisbursedDate, CurrentAmount, MOB, AccountStatus from loan_portfolio", "loan_portfolio")
def csv_tape(t):
    path = _folder(t, "tape")
    tables.write_tape(t.loan_portfolio.select(*LP_COLUMNS), path, "csv")
    return tables.read_csv(t.spark, path, "AccountNumber long, SnapshotDate date, DisbursedDate date, CurrentAmount decimal(18,2), MOB int, AccountStatus string")


@query("read_manual_input", "select AccountNumber, cast(CurrentAmount as double) as amount, SnapshotDate as SaleDate from loan_portfolio", "loan_portfolio")
def read_manual_input(t):
    path = _folder(t, "sheet")
    sheet = t.loan_portfolio.select(F.col("AccountNumber").alias("Loan account"), F.col("CurrentAmount").alias("Not paid"),
                                    F.col("SnapshotDate").alias("Sold on"), F.col("MOB").alias("unused"))
    tables.write_tape(sheet, path, "csv")
    return tables.read_manual_input(t.spark, path, "`Loan account` string, `Not paid` string, `Sold on` string, unused string", {
        "Loan account": ("AccountNumber", "long"), "Not paid": ("amount", "double"), "Sold on": ("SaleDate", "date")})


@query("append_month", """select AccountNumber, case when SnapshotDate = date '2001-08-31' then 1 else 0 end as revised, SnapshotDate
  from loan_portfolio where SnapshotDate = last_day(SnapshotDate)""", "loan_portfolio")
def append_month(t):
    """All month-ends are written, then the last again: the rerun replaces it."""
    path = _folder(t, "scores")
    rows = dates.month_end_rows(t.loan_portfolio).select("AccountNumber", F.lit(0).alias("revised"), "SnapshotDate")
    tables.append_month(rows, path, "SnapshotDate")
    tables.append_month(rows.filter(F.col("SnapshotDate") == dates.as_date("2001-08-31")).withColumn("revised", F.lit(1)), path, "SnapshotDate")
    return t.spark.read.parquet(path)


@query("copy_commission_setup", f"""
  select b.BrokerName, Days, Months, CommissionPct, validFrom, validTo, FixAmount, 'BUILDING' as Product from broker_commission b
  where BrokerName in (select distinct BrokerName from applications where Product = 'BUILDING' and BrokerName not in ('Broker 3', 'Broker 7'))
    and (BrokerName <> 'Broker 5' or CommissionPct = 0.03) and date '1997-01-10' between validFrom and validTo""", "broker_commission applications")
def copy_commission_setup(t):
    return tables.copy_commission_setup(t.broker_commission, t.applications, "BUILDING", "1997-01-10", ("Broker 3", "Broker 7"), {"Broker 5": 0.03})


@query("month_end_rows", "select * from loan_portfolio where SnapshotDate = last_day(SnapshotDate)", "loan_portfolio")
def month_end_rows(t):
    return dates.month_end_rows(t.loan_portfolio)


@query("recent_months", f"select * from loan_portfolio where SnapshotDate > date '{AS_OF}' - interval 3 month", "loan_portfolio")
def recent_months(t):
    return dates.recent_months(t.loan_portfolio, 3, AS_OF)


@query("report_dates", """select max(SnapshotDate) as ReportDate, cast(date_trunc('month', max(SnapshotDate)) - interval 1 day as date) as PreviousMonthEnd
  from loan_portfolio where SnapshotDate = last_day(SnapshotDate)""", "loan_portfolio")
def report_dates(t):
    return dates.report_dates(t.loan_portfolio)


@query("latest_month_end_rows", """select * from loan_portfolio where SnapshotDate =
  (select max(SnapshotDate) from loan_portfolio where SnapshotDate = last_day(SnapshotDate))""", "loan_portfolio")
def latest_month_end_rows(t):
    return t.loan_portfolio.filter(F.col("SnapshotDate") == dates.latest_month_end(t.loan_portfolio))


@query("date_functions", f"""
  select ApplicationID, cast(ReceivedDate + interval 6 month as date) as plus_six, cast(BirthDate + interval 2 year as date) as plus_two_years,
    cast(date '{AS_OF}' - ReceivedDate as int) as days,
    cast((year(date '{AS_OF}') - year(ReceivedDate)) * 12 + month(date '{AS_OF}') - month(ReceivedDate) as int) as months,
    cast(year(ReceivedDate) * 100 + month(ReceivedDate) as int) as year_month,
    case when ReceivedDate = last_day(ReceivedDate) then last_day(ReceivedDate + 1) else last_day(ReceivedDate) end as rolled,
    cast(date_trunc('month', ReceivedDate) as date) as first_day, last_day(ReceivedDate) as last_day,
    cast(date_trunc('month', ReceivedDate) - interval 1 day as date) as previous_month_end,
    cast(date_part('year', age(date '{AS_OF}', BirthDate)) as int) as age, strftime(ReceivedDate, '%Y-%m-%d') as text,
    strptime(strftime(ReceivedDate, '%Y-%m-%d'), '%Y-%m-%d')::date as parsed
  from applications""", "applications")
def date_functions(t):
    received, birth, as_of = F.col("ReceivedDate"), F.col("BirthDate"), dates.as_date(AS_OF)
    text = F.date_format(received, "yyyy-MM-dd")
    return t.applications.select(
        "ApplicationID", F.add_months(received, 6).alias("plus_six"), F.add_months(birth, 24).alias("plus_two_years"),
        dates.days_between(received, as_of).alias("days"), dates.calendar_months_between(received, as_of).alias("months"),
        dates.year_month(received).alias("year_month"), dates.roll_to_month_end(received).alias("rolled"),
        dates.first_of_month(received).alias("first_day"), F.last_day(received).alias("last_day"),
        dates.previous_month_end(received).alias("previous_month_end"), dates.full_years(birth, AS_OF).alias("age"),
        text.alias("text"), F.to_date(text, "yyyy-MM-dd").alias("parsed"))


@query("scalar_functions", """
  select l_orderkey, l_linenumber, round(1 / (1 + exp(-l_discount * 10)), 9) as logistic,
    round_even(l_quantity / 8, 2) as half_even, round(pow(l_quantity, 1.0 / 3), 9) as cube_root,
    case when l_quantity / 40 > 1 then 1.0 else l_quantity / 40 end as capped, try_cast(concat(l_returnflag, cast(l_linenumber as varchar)) as double) as not_number,
    try_cast(cast(l_linenumber as varchar) as double) as number, case when l_discount > 0 then least(floor((l_discount - 1e-9) / 0.02), 4)::int end as bin,
    case when l_returnflag = 'N' then 'Unknown' else l_returnflag end as filled, round(sqrt(l_extendedprice), 6) as root
  from lineitem""")
def scalar_functions(t):
    q, disc, flag = F.col("l_quantity"), F.col("l_discount"), F.col("l_returnflag")
    return t.given("lineitem").select(
        "l_orderkey", "l_linenumber", F.round(scalars.logistic(disc * 10), 9).alias("logistic"),
        scalars.round_half_even(q / 8).alias("half_even"), F.round(scalars.clean_pow(q, 1 / 3), 9).alias("cube_root"),
        scalars.cap(q / 40, 1.0).alias("capped"),
        scalars.to_number(F.concat(flag, F.col("l_linenumber").cast("string"))).alias("not_number"),
        scalars.to_number(F.col("l_linenumber").cast("string")).alias("number"),
        scalars.right_closed_bin(disc, (0, 0.02, 0.04, 0.06, 0.08, 0.1)).alias("bin"),
        scalars.fill_text(flag, missing="N").alias("filled"), F.round(F.sqrt("l_extendedprice"), 6).alias("root"))


@query("fill_numbers", """select o_orderkey, coalesce(case when o_orderkey % 3 = 0 then null else o_totalprice end, -100.0) as filled,
  case when o_orderkey % 5 = 0 then -100.0 else o_totalprice end as finite from orders""")
def fill_numbers(t):
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    infinite = F.when(k % 10 == 0, F.lit(float("inf"))).when(k % 5 == 0, F.lit(float("-inf"))).otherwise(price)
    missing = F.when(k % 6 == 0, F.lit(float("nan"))).when(k % 3 != 0, price)
    return t.orders.select("o_orderkey", scalars.fill_number(missing, -100).alias("filled"), scalars.replace_infinite(infinite, -100).alias("finite"))


@query("nan_to_null", "select o_orderkey, case when o_orderkey % 3 = 0 then null else o_totalprice end as price from orders")
def nan_to_null(t):
    price = F.when(F.col("o_orderkey") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    return scalars.nan_to_null(t.orders.select("o_orderkey", price.alias("price")))


@query("min_max_scale", """select AccountNumber, SnapshotDate,
  round((CurrentAmount::double - lo) / (hi - lo), 9) as CurrentAmount, round((MOB - mlo) / (mhi - mlo)::double, 9) as MOB
  from loan_portfolio, (select min(CurrentAmount)::double as lo, max(CurrentAmount)::double as hi, min(MOB) as mlo, max(MOB) as mhi from loan_portfolio) b""", "loan_portfolio")
def min_max_scale(t):
    df = scalars.min_max_scale(t.loan_portfolio.select("AccountNumber", "SnapshotDate", "CurrentAmount", "MOB"), ["CurrentAmount", "MOB"])
    return df.withColumns({c: F.round(c, 9) for c in ("CurrentAmount", "MOB")})


@query("vintage_filter", """select * from loan_portfolio where DisbursedDate between date '1995-03-01' and date '1996-06-01'
  and MOB > 2 and MOB < 20""", "loan_portfolio")
def vintage_filter(t):
    return dates.mob_filter(dates.vintage_filter(t.loan_portfolio, "1995-03-01", "1996-06-01"), above=2, below=20)


@query("disbursed_before_month", "select * from applications where DisbursedDate < date '1995-06-01'", "applications")
def disbursed_before(t):
    return dates.disbursed_before(t.applications, "1995-06-20")
