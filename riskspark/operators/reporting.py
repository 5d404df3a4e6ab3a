"""Monthly reports: stage totals and walk, control figures, special cases, invoices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.dates import DateLike, as_date, month_end_rows, previous_month_end, recent_months
from riskspark.operators.keyed import attach
from riskspark.session import materialise

LIVE_STATUSES = ("COLLECTION", "FROZEN", "OPEN")
CLOSED_STATUSES = ("CANCELLED", "CLOSED", "DECEASED", "PRE_SETTLED", "WRITTEN_OFF")

# Event texts of the credit bureau's monitoring feed (debt relief, emigrated, deceased).
DEBT_RELIEF = "Skuldsanering bevilj"
EMIGRATED = "Personen har utvandr"
DECEASED = "Personen har avlidit"
SPECIAL_EVENTS = (DEBT_RELIEF, EMIGRATED, DECEASED)
LGD_DEBT_RELIEF = 0.5
LGD_OTHER = 1.0

AMOUNTS = {"Balance": "Base", "ECL_SUM": "ECL_SUM", "ECLNPV_SUM": "ECLNPV_SUM"}


def _amount_sums() -> list:
    return [F.sum(src).cast("decimal(38,2)").alias(name) for name, src in AMOUNTS.items()]


def open_rows(df: DataFrame, statuses: Sequence[str] = LIVE_STATUSES) -> DataFrame:
    return df.filter(F.col("AccountStatus").isin(*statuses))


def not_closed_rows(df: DataFrame, closed: Sequence[str] = CLOSED_STATUSES) -> DataFrame:
    return df.filter(~F.col("AccountStatus").isin(*closed))


def accounts_lookup(df: DataFrame, accounts: Sequence[int]) -> DataFrame:
    """Full history of given accounts, for control."""
    return df.filter(F.col("AccountNumber").isin(*accounts)).orderBy("AccountNumber", "SnapshotDate")


def at_latest_snapshot(df: DataFrame, date: str = "SnapshotDate") -> DataFrame:
    """Rows of the latest snapshot; the maximum is a scalar subquery, so the scan can skip row groups."""
    return df.filter(F.col(date) == df.agg(F.max(date)).scalar())


def unpaid_invoices(portfolio: DataFrame, as_of: DateLike) -> DataFrame:
    """Accounts with invoiced interest and fees not fully paid, over the last month."""
    owed = (F.col("InvoicedInterest") - F.col("PaidInterest") + F.col("InvoicedFee") - F.col("PaidFee"))
    rows = not_closed_rows(month_end_rows(recent_months(portfolio, 1, as_of)))
    return (rows.select("AccountNumber", "SnapshotDate", "InvoicedInterest", "PaidInterest", "InvoicedFee", "PaidFee",
                        owed.alias("unpaid")).filter("unpaid > 0").distinct())


def invoice_not_paid(sheet: DataFrame, as_of: DateLike, account: str = "Account", amount: str = "InvNotPaid") -> DataFrame:
    """The finance sheet as a table, stamped with the month-end before `as_of`."""
    return sheet.select(previous_month_end(as_date(as_of)).alias("SnapshotDate"),
                        F.col(account).cast("string").alias("AccountNumber"), F.col(amount).alias("amount"))


def repurchase_load(sheet: DataFrame) -> DataFrame:
    """Repurchased accounts with bought capital: the first four columns, typed."""
    kept = sheet.filter(F.col("BoughtCapital") > 0).select(*sheet.columns[:4])
    return kept.withColumns({"AccountNumber": F.col("AccountNumber").cast("long").cast("string"),
                             "SaleDate": F.to_date("SaleDate")})


def current_result(ecl: DataFrame, report_date: DateLike) -> DataFrame:
    return ecl.filter((F.col("Ord") == 0) & (F.col("ReportDate") == as_date(report_date)))


def stage_totals(ecl: DataFrame, dates: Sequence[DateLike]) -> DataFrame:
    """Balance and expected loss per report date and stage, and a 'Total' row per date.

    The totals are taken from the stage sums, so the portfolio is read and shuffled once.
    """
    rows = ecl.filter((F.col("Ord") == 0) & F.col("ReportDate").isin(*[as_date(d) for d in dates]))
    stages = rows.groupBy("ReportDate", "RiskStage").agg(*_amount_sums())
    sums = [F.sum(c).cast("decimal(38,2)").alias(c) for c in AMOUNTS]
    both = stages.groupingSets([("ReportDate", "RiskStage"), ("ReportDate",)], "ReportDate", "RiskStage").agg(
        F.grouping("RiskStage").alias("__total"), *sums)
    label = F.when(F.col("__total") == 1, "Total").otherwise(F.col("RiskStage"))
    return both.withColumn("RiskStage", label).drop("__total")


def stage_walk(ecl: DataFrame, report_date: DateLike) -> DataFrame:
    """Each account of this and last month with a label for its move between stages."""
    this = current_result(ecl, report_date).select(
        "AccountNumber", F.col("Base").alias("This_Base"), F.col("ECLNPV_SUM").alias("This_ECLNPV_SUM"),
        F.col("RiskStage").alias("This_RiskStage"), F.col("SpecialCase").alias("This_SpecialCase"),
        F.col("FBE").alias("__fbe"))
    last = current_result(ecl, previous_month_end(as_date(report_date))).select(
        "AccountNumber", F.col("Base").alias("Last_Base"), "ECLNPV_SUM", "RiskStage", "SpecialCase",
        F.lit(1).alias("__last"))
    was, now, fbe = F.col("RiskStage"), F.col("This_RiskStage"), F.col("__fbe")
    walk = (F.when((was == "Stage3") & now.isNull(), "WO_Out")
             .when((was == "Stage2") & (now == "Stage3"), "New_Entries_S3")
             .when((was == "Stage2") & (now == "Stage1"), "Cure_S1")
             .when((was == "Stage1") & (now == "Stage2"), "New_Entries_S2_SICR")
             .when((now == "Stage2") & (fbe == "monitoring_paymentrelief"), "monitoring_paymentrelief")
             .when((now == "Stage2") & (fbe == "monitoring_previous_S3"), "monitoring_previous_S3")
             .when(now == "Stage2", "SICR"))
    joined = last.join(this, "AccountNumber", "full").withColumn("Walk", walk)
    # The report shows last month's account number, so an account new this month has none.
    account = F.when(F.col("__last") == 1, F.col("AccountNumber")).alias("AccountNumber")
    return joined.select(account, "Last_Base", "This_Base", "ECLNPV_SUM", "This_ECLNPV_SUM", "RiskStage",
                         "This_RiskStage", "SpecialCase", "This_SpecialCase", "Walk")


def new_stage3_entries(ecl: DataFrame, report_date: DateLike) -> DataFrame:
    """Stage 3 rows of accounts that were in stage 1 or 2 the month before."""
    last = current_result(ecl, previous_month_end(as_date(report_date)))
    before = last.filter(F.col("RiskStage").isin("Stage1", "Stage2")).select("AccountNumber")
    this = current_result(ecl, report_date).filter(F.col("RiskStage") == "Stage3")
    return this.join(before, "AccountNumber", "left_semi")


def write_offs(ecl: DataFrame, report_date: DateLike) -> DataFrame:
    """Last month's stage 3 rows with expected loss whose account is gone this month."""
    last = current_result(ecl, previous_month_end(as_date(report_date)))
    this = current_result(ecl, report_date).select("AccountNumber")
    return last.filter((F.col("RiskStage") == "Stage3") & (F.col("ECL_SUM") > 0)).join(this, "AccountNumber", "left_anti")


def entries_summary(rows: DataFrame, *by: str) -> DataFrame:
    """Count and sums of a set of result rows, optionally by FBE or another column."""
    return rows.groupBy(*by).agg(F.count("*").alias("TotalEntries"), *_amount_sums())


def score_means(scores: DataFrame, columns: Sequence[str], *by: str) -> DataFrame:
    """Average scores, overall or by stage, date, status."""
    return scores.groupBy(*by).agg(*[F.avg(c).alias(c) for c in columns])


def balance_by_stage(scores: DataFrame, portfolio: DataFrame, as_of: DateLike, months: int = 3) -> DataFrame:
    """Open positive balance per snapshot and stage.

    Balances come from the last `months` months; scored snapshots outside them show an empty sum.
    """
    recent = month_end_rows(recent_months(portfolio, months, as_of))
    recent = recent.filter((F.col("CurrentAmount") > 0) & (F.col("IsOpen") == 1))
    balance = recent.select("AccountNumber", "SnapshotDate", "CurrentAmount").distinct()
    joined = scores.select("AccountNumber", "SnapshotDate", "Stageing").join(balance, ["AccountNumber", "SnapshotDate"], "left")
    return joined.groupBy("SnapshotDate", "Stageing").agg(F.sum("CurrentAmount").cast("decimal(38,2)").alias("Balance"))


def open_count_by_snapshot(portfolio: DataFrame, scores: DataFrame | None = None,
                           stages: Sequence[int] | None = None, stage_col: str = "Stageing") -> DataFrame:
    """Open accounts per month-end, optionally only those scored into given stages."""
    rows = month_end_rows(portfolio).filter((F.col("IsOpen") == 1) & (F.col("AccountStatus") == "OPEN"))
    if scores is not None:
        chosen = scores if stages is None else scores.filter(F.col(stage_col).isin(*stages))
        rows = rows.join(chosen.select("AccountNumber", "SnapshotDate"), ["AccountNumber", "SnapshotDate"])
    return rows.groupBy("SnapshotDate").agg(F.count("AccountNumber").alias("count"))


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).count()


def distinct_accounts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count_distinct("AccountNumber").alias("accounts"))


def applications_with_status(applications: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Disbursed applications with the account's status at the latest snapshot."""
    apps = applications.filter(F.col("Status") == "DISBURSED").select(
        "IsMainApplicant", "ApplicantNo", "HasCoapp", "ReceivedDate", "AccountNumber", "DisbursedDate", "Amount", "SSN")
    return apps.join(at_latest_snapshot(portfolio).select("AccountNumber", "AccountStatus"), "AccountNumber")


def both_applicants_hit(rows: DataFrame) -> DataFrame:
    """Keep applications unless exactly one of two applicants is hit: HasCoapp summed must differ from 1.

    One person may have very many events, all on one application. `rows` is read twice.
    """
    hits = rows.groupBy("ApplicationID").agg(F.sum("HasCoapp").alias("HitWithCoapp"))
    return attach(rows, hits.filter("HitWithCoapp <> 1"), ["ApplicationID"], "inner")


def special_events(events: DataFrame, id_map: DataFrame, applications: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Bureau events of disbursed applicants, with account status; both applicants must be hit."""
    chosen = events.filter(F.col("EventTypeDesc").isin(*SPECIAL_EVENTS)).select(
        "SSN", "EventTypeDesc", "DecisionDate", "InsertDate")
    mapped = chosen.join(id_map.select("SSN", "ssn_hash"), "SSN", "left").drop("SSN")
    apps = applications.filter(F.col("Status") == "DISBURSED").select(
        "ApplicationID", "IsMainApplicant", "ApplicantNo", "HasCoapp", "ReceivedDate", "AccountNumber",
        "DisbursedDate", "Amount", F.col("SSN").alias("ssn_hash"))
    hit = both_applicants_hit(materialise(apps.join(mapped, "ssn_hash"), "events"))
    status = at_latest_snapshot(portfolio).select("AccountNumber", "AccountStatus")
    return hit.join(status, "AccountNumber").distinct()


def special_cases(event_rows: DataFrame, old_accounts: DataFrame, app_status: DataFrame,
                  reporting_date: DateLike, disbursed_until: DateLike | None = None) -> DataFrame:
    """Loss given default for accounts in debt relief, emigrated or deceased.

    The old list is added where the bureau events do not already name the account. For a back-dated
    run, `disbursed_until` leaves out loans disbursed from that date on.
    """
    new = open_rows(event_rows).select("AccountNumber", "DisbursedDate", "AccountStatus", "EventTypeDesc", "HasCoapp")
    if disbursed_until is not None:
        new = new.filter(F.col("DisbursedDate") < as_date(disbursed_until))
    new = new.distinct()
    known = app_status.select("AccountNumber", "DisbursedDate", "AccountStatus", "HasCoapp")
    # The sheet adds no columns, and the result is distinct: a semi join, whatever accounts it repeats.
    old = open_rows(known.join(old_accounts.select("AccountNumber"), "AccountNumber", "left_semi"))
    old = old.withColumn("EventTypeDesc", F.lit(DEBT_RELIEF)).distinct()
    old = old.join(new.select("AccountNumber"), "AccountNumber", "left_anti")
    if disbursed_until is not None:
        old = old.filter(F.col("DisbursedDate") < as_date(disbursed_until))
    lgd = F.when(F.col("EventTypeDesc") == DEBT_RELIEF, LGD_DEBT_RELIEF).otherwise(LGD_OTHER)
    # The two parts share no account and each is distinct already.
    return (new.unionByName(old).withColumn("LGD", lgd).withColumn("ReportingDate", as_date(reporting_date))
               .drop("HasCoapp", "DisbursedDate"))
