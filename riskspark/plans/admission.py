"""Admission data: main and co-applicants with credit reports, imputed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.dates import DateLike, disbursed_before
from riskspark.operators.applicants import admission_frame, co_applicants, early_outcome, first_months, main_applicants, report_choices
from riskspark.operators.scoring import ADMISSION, LogitModel, logit_score


def admission_data(applications: DataFrame, reports: DataFrame, monthly: DataFrame, as_of: DateLike) -> DataFrame:
    """One row per account: sole applicants on their newest report, pairs on the lowest score.

    Applications meet reports once, for both, and the running outcomes of the first months are computed once.
    """
    choices = report_choices(applications.filter(F.col("Status") == "DISBURSED"), reports)
    monthly = first_months(monthly)
    main = main_applicants(applications, reports, early_outcome(monthly), choices)
    co = co_applicants(applications, reports, early_outcome(monthly, early_mob=None), choices)
    return admission_frame(main, co, as_of)


def admission_scores(applications: DataFrame, reports: DataFrame, monthly: DataFrame, as_of: DateLike,
                     model: LogitModel = ADMISSION) -> DataFrame:
    """Admission probability of loans disbursed before the month of `as_of`."""
    data = disbursed_before(admission_data(applications, reports, monthly, as_of), as_of)
    scored = logit_score(data, model, "AdmissionModel", raw="P_admission")
    return scored.select("AccountNumber", "PDScoreNew", "UCScore", "age", "Inquiries12M", "PropertyVolume",
                         "AdmissionModel", "ApplicationScore")
