"""Applicants at admission: credit reports by date, early outcome, imputation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.dates import DateLike, full_years
from riskspark.functions.scalars import fill_number, fill_text, replace_infinite
from riskspark.operators.keyed import first_per_key, prefer_flagged
from riskspark.session import materialise

DAYS_BEFORE = 30
DAYS_WITHOUT_DISBURSAL = 60

# Bureau and application columns by the number that stands for "missing".
FILL_ZERO = (
    "PaymentRemarksNo", "PaymentRemarksAmount", "CreditCardsNo", "ApprovedCardsLimit", "CreditAccountsVolume",
    "CapitalIncome", "PassiveBusinessIncome2", "CapitalIncome2", "ActiveBusinessDeficit2",
    "KFMPublicClaimsAmount", "KFMTotalAmount", "KFMPrivateClaimsAmount", "KFMPublicClaimsNo",
    "KFMPrivateClaimsNo", "HouseTaxValue", "MortgageLoansHouseVolume", "MortgageLoansApartmentVolume",
    "AvgUtilizationRatio12M", "EmploymentIncome", "EmploymentIncome2",
)
FILL_MINUS_ONE = (
    "InstallmentLoansNo", "IndebtednessRatio", "AvgIndebtednessRatio12M", "InstallmentLoansVolume",
    "VolumeChange12MExMortgage", "VolumeChange12MUnsecuredLoans", "VolumeChange12MInstallmentLoans",
    "VolumeChange12MCreditAccounts", "VolumeChange12MMortgageLoans", "AvgUtilizationRatio12M",
    "CreditCardsUtilizationRatio", "UnsecuredLoansVolume", "NumberOfLenders", "CapitalDeficit",
    "CapitalDeficit2", "NewUnsecuredLoans12M", "NewInstallmentLoans12M", "NewCreditAccounts12M", "VolumeUsed",
    "ApprovedCreditVolume", "NumberOfBlancoLoans", "NumberOfCreditCards", "NewMortgageLoans12M",
    "TotalNewExMortgage12M", "NumberOfMortgageLoans", "SharedVolumeMortgageLoans", "SharedVolumeCreditCards",
    "NumberOfUnsecuredLoans", "SharedVolumeUnsecuredLoans", "NumberOfInstallmentLoans",
    "SharedVolumeInstallmentLoans", "NumberOfCreditAccounts", "SharedVolumeCrerditAccounts",
    "UnsecuredLoansNo", "IncomeDelta_1Year", "kids_number", "Inquiries12M",
)
FILL_MINUS_HUNDRED = ("CapitalDeficit_Delta_1Year", "UtilizationRatio", "housing_cost")
INFINITE_TO_MINUS_HUNDRED = ("CapitalDeficit_Delta_1Year", "IncomeDelta_1Year", "ActiveCreditAccounts")


def normalise_coapp_flag(df: DataFrame, flag: str = "CoappFlag") -> DataFrame:
    """Anything but 0 or 1 becomes 0."""
    return df.withColumn(flag, F.when(F.col(flag).isin(0, 1), F.col(flag)).otherwise(0))


def prefer_coapplicant(df: DataFrame) -> DataFrame:
    """An account with a co-applicant row keeps only its co-applicant rows."""
    return prefer_flagged(df, ["AccountNumber"], "CoappFlag")


def prefer_relief_row(df: DataFrame) -> DataFrame:
    """A (snapshot, account) with a relief row keeps only its relief rows."""
    return prefer_flagged(df, ["SnapshotDate", "AccountNumber"], "FBE_eftergift")


def max_mob(monthly: DataFrame, limit: int = 12) -> DataFrame:
    """Last month on book observed up to `limit`, per account."""
    rows = monthly.filter((F.col("IsMonthEnd") == 1) & (F.col("MOB") <= limit))
    return rows.groupBy("AccountNumber").agg(F.max("MOB").alias("MOB"))


def first_months(monthly: DataFrame, limit: int = 12, early_mob: int = 3) -> DataFrame:
    """The month-ends that `early_outcome` reads, written: its joins then run on them alone."""
    rows = monthly.filter((F.col("IsMonthEnd") == 1) & (F.col("MOB") <= max(limit, early_mob)))
    return materialise(rows.select("AccountNumber", "MOB", "Ever30", "Ever90", "DisbursedDate", "IsMonthEnd"), "first-months")


def early_outcome(monthly: DataFrame, limit: int = 12, early_mob: int | None = 3) -> DataFrame:
    """Ever90 at the last month on book up to `limit`, with Ever30 at `early_mob` where that is given."""
    ends = monthly.filter(F.col("IsMonthEnd") == 1)
    out = ends.join(max_mob(monthly, limit), ["AccountNumber", "MOB"])
    out = out.select("AccountNumber", "Ever90", "DisbursedDate", "MOB").distinct()
    if early_mob is None:
        return out
    early = ends.filter(F.col("MOB") == early_mob).select("AccountNumber", "Ever30").distinct()
    return out.join(early, "AccountNumber")


def outcome_at_mob(monthly: DataFrame, mob: int = 12) -> DataFrame:
    """Ever90 at exactly `mob` months on book."""
    rows = monthly.filter((F.col("IsMonthEnd") == 1) & (F.col("MOB") == mob))
    return rows.select("AccountNumber", "Ever90", "DisbursedDate").distinct()


def outcome_history(monthly: DataFrame) -> DataFrame:
    """Ever90 and balance at every month-end."""
    rows = monthly.filter(F.col("IsMonthEnd") == 1)
    return rows.select("AccountNumber", "Ever90", "DisbursedDate", "SnapshotDate", "MOB", "CurrentAmount").distinct()


def _with_window(apps: DataFrame) -> DataFrame:
    """The dates a report may carry for an application: `__lo` to `__hi`, both included."""
    received = F.col("ReceivedDate")
    return apps.withColumns({
        "__lo": F.date_sub(received, DAYS_BEFORE),
        "__hi": F.coalesce(F.col("DisbursedDate"), F.date_add(received, DAYS_WITHOUT_DISBURSAL)),
    })


def _sides(apps: DataFrame, reports: DataFrame, report_id: str) -> tuple[DataFrame, DataFrame]:
    """Both frames ready to join: windows added, the bureau's score named UCScore, the report id named
    `__id`. An application column that the reports also have gets the suffix 1."""
    reports = reports.withColumnRenamed("RiskPrognos", "UCScore").withColumnRenamed(report_id, "__id")
    shared = (set(apps.columns) & set(reports.columns)) - {"SSN"}
    return _with_window(apps.withColumnsRenamed({c: f"{c}1" for c in shared})), reports


def report_choices(apps: DataFrame, reports: DataFrame, report_id: str = "jsonID", newest: bool = True,
                   lowest: bool = True) -> DataFrame:
    """For each distinct (SSN, window) the newest and the lowest-scored of the reports dated inside it, or only
    one of them.

    Reports are first reduced to one row per (SSN, day). Windows are cut into calendar months, so the
    join is an equi join on (SSN, month): one person with very many reports is spread over months, each
    month has at most 31 of them, and each report meets a window exactly once. The result holds keys
    only and is written, so that a hot window can be split when it is joined back.
    """
    apps, reports = _sides(apps, reports, report_id)
    # Structs compare field by field; the day and the id are negated so that the minimum is the newest.
    scored = F.when(F.col("UCScore").isNotNull(), F.struct(F.col("UCScore").alias("score"), (-F.col("__id")).alias("neg")))
    of_day = [F.max("__id").alias("id")] * newest + [F.min(scored).alias("day")] * lowest
    daily = reports.groupBy("SSN", "Date").agg(*of_day)
    windows = apps.select("SSN", "__lo", "__hi").filter("__lo <= __hi").distinct()
    months = F.sequence(F.trunc("__lo", "month"), F.trunc("__hi", "month"), F.expr("interval 1 month"))
    windows = windows.withColumn("__month", F.explode(months))
    daily = daily.withColumn("__month", F.trunc("Date", "month"))
    hits = windows.join(daily, ["SSN", "__month"]).filter(F.col("Date").between(F.col("__lo"), F.col("__hi")))
    of_window = []
    if newest:
        of_window.append(F.max(F.struct("Date", "id")).alias("__newest"))
    if lowest:
        age = (-F.unix_date("Date")).alias("age")
        ranked = F.struct(F.col("day.score").alias("score"), age, F.col("day.neg").alias("neg"))
        of_window.append(F.min(F.when(F.col("day").isNotNull(), ranked)).alias("__lowest"))
    return materialise(hits.groupBy("SSN", "__lo", "__hi").agg(*of_window), "report-choices")


def _fetch(picked: DataFrame, reports: DataFrame, report_id: str, how: str) -> DataFrame:
    """The chosen report's columns; only here do the wide reports move."""
    rows = picked.drop("__newest", "__lowest", "__lo", "__hi")
    return rows.join(reports, ["SSN", "Date", "__id"], how).withColumnRenamed("__id", report_id)


def credit_report_asof(apps: DataFrame, reports: DataFrame, report_id: str = "jsonID",
                       choices: DataFrame | None = None) -> DataFrame:
    """Each (account, person) with the newest credit report around the application, if any.

    A report counts from 30 days before the application was received until disbursal, or until 60 days
    after where nothing was disbursed. `report_id` identifies a report and breaks ties (larger wins).
    `choices` may be shared with `credit_report_min_score`.
    """
    choices = report_choices(apps, reports, report_id, lowest=False) if choices is None else choices
    apps, reports = _sides(apps, reports, report_id)
    matched = apps.join(choices, ["SSN", "__lo", "__hi"], "left")
    order = [F.col("__newest.Date").desc_nulls_last(), F.col("ApplicationID")]
    picked = first_per_key(matched, ["AccountNumber", "SSN"], order)
    return _fetch(picked.withColumns({"Date": F.col("__newest.Date"), "__id": F.col("__newest.id")}), reports, report_id, "left")


def credit_report_min_score(apps: DataFrame, reports: DataFrame, report_id: str = "jsonID",
                            choices: DataFrame | None = None) -> DataFrame:
    """Each account with its lowest-scored report in the window, over all its applicants.

    Ties go to the newest report, then the lowest application, then the largest report id. Accounts
    without a scored report are left out.
    """
    choices = report_choices(apps, reports, report_id, newest=False) if choices is None else choices
    apps, reports = _sides(apps, reports, report_id)
    matched = apps.join(choices.filter("__lowest is not null"), ["SSN", "__lo", "__hi"])
    order = [F.col("__lowest.score"), F.col("__lowest.age"), F.col("ApplicationID"), F.col("__lowest.neg")]
    picked = first_per_key(matched, ["AccountNumber"], order).withColumns({
        "Date": F.date_from_unix_date(-F.col("__lowest.age")), "__id": -F.col("__lowest.neg")})
    return _fetch(picked, reports, report_id, "inner")


def main_applicants(apps: DataFrame, reports: DataFrame, outcome: DataFrame, choices: DataFrame | None = None) -> DataFrame:
    """Sole main applicants of disbursed loans, with early outcome and newest report.

    A full join filtered on the application side is a left join from the applications.
    """
    chosen = apps.filter((F.col("IsMainApplicant") == 1) & (F.col("HasCoapp") == 0) & (F.col("Status") == "DISBURSED"))
    known = outcome.select("AccountNumber", "DisbursedDate", "Ever30", "Ever90")
    return credit_report_asof(chosen.join(known, ["AccountNumber", "DisbursedDate"], "left"), reports, choices=choices)


def co_applicants(apps: DataFrame, reports: DataFrame, outcome: DataFrame, choices: DataFrame | None = None) -> DataFrame:
    """Disbursed loans with two applicants, on the report with the lowest score, with the outcome."""
    chosen = apps.filter((F.col("HasCoapp") == 1) & (F.col("Status") == "DISBURSED"))
    known = outcome.select("AccountNumber", "Ever90")
    return credit_report_min_score(chosen, reports, choices=choices).join(known, "AccountNumber")


def application_type(main: DataFrame, co: DataFrame) -> DataFrame:
    """Stack both frames with Applicationtype: 0 main, 1 co at the same address, 2 co elsewhere.

    Main applicants without a bureau score are dropped.
    """
    same = F.col("CoappSameAddress")
    has = F.col("HasCoapp") == 1
    main = main.filter(F.col("UCScore").isNotNull()).withColumn("Applicationtype", F.lit(0))
    co = co.withColumn("Applicationtype", F.when(has & (same == 1), 1).when(has & (same == 0), 2))
    return main.unionByName(co, allowMissingColumns=True)


def _present(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [c for c in names if c in df.columns]


def impute_admission(df: DataFrame) -> DataFrame:
    """Fill missing values by column group; a column in the first two groups gets 0."""
    cols: dict[str, Column] = {c: fill_number(F.col(c), -100) for c in _present(df, FILL_MINUS_HUNDRED)}
    cols |= {c: fill_number(F.col(c), -1) for c in _present(df, FILL_MINUS_ONE)}
    cols |= {c: fill_number(F.col(c), 0) for c in _present(df, FILL_ZERO)}
    for c in _present(df, INFINITE_TO_MINUS_HUNDRED):
        cols[c] = replace_infinite(cols.get(c, F.col(c)), -100)
    cols |= {f.name: fill_text(F.col(f.name)) for f in df.schema
             if isinstance(f.dataType, T.StringType) and f.name not in cols}
    return df.withColumns(cols) if cols else df


def property_volume(df: DataFrame) -> DataFrame:
    house, flat = F.col("MortgageLoansHouseVolume"), F.col("MortgageLoansApartmentVolume")
    return df.withColumn("PropertyVolume", F.when(house > 0, house).when(flat > 0, flat).otherwise(0.0))


def admission_frame(main: DataFrame, co: DataFrame, as_of: DateLike) -> DataFrame:
    """Both applicant frames, typed, aged at `as_of` and imputed."""
    df = application_type(main, co).withColumn("age", full_years(F.col("BirthDate"), as_of))
    return property_volume(impute_admission(df))
