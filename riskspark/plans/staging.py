"""Monthly staging: from the portfolio to customer scores and stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.dates import DateLike, as_date
from riskspark.operators.applicants import normalise_coapp_flag, prefer_coapplicant, prefer_relief_row
from riskspark.operators.reporting import open_rows
from riskspark.operators.scoring import BEHAVIOUR, LogitModel, logit_score, macro_overlay, stage_accounts
from riskspark.session import materialise

OUTPUT = ("AccountNumber", "SnapshotDate", "MOB", "AppliedApplicationScore", "AdjustedBehaviourScore", "PD_Delta",
          "FBE", "SICR", "Stageing")
BEHAVIOUR_COLUMNS = (
    "AccountNumber", "AccountStatus", "SnapshotDate", "MOB", "DisbursedDate", "CurrentAmount", "RemainingTenor",
    "CoappFlag", "Ever30In6Months", "WorstDelinquency6M", "CurrentDelinquencyStatus", "WorstDelinquency12M",
    "Ever30In12Months", "Ever90In12Months", "P", "BehaviourModel", "Ever90", "ForberanceIn6Months",
    "ForberanceIn12Months", "FBE_eftergift")


FEATURE_COLUMNS = tuple(c for c in BEHAVIOUR_COLUMNS if c not in ("P", "BehaviourModel"))


def behaviour_scores(features: DataFrame, model: LogitModel = BEHAVIOUR) -> DataFrame:
    """Live accounts, one applicant and one relief state per snapshot, with the behaviour probability.

    The columns needed are written once: choosing applicants and relief rows reads them several times.
    """
    features = materialise(features.select(*FEATURE_COLUMNS), "features")
    rows = open_rows(prefer_coapplicant(normalise_coapp_flag(features)))
    return logit_score(prefer_relief_row(rows), model, "BehaviourModel").select(*BEHAVIOUR_COLUMNS)


def customer_scores(features: DataFrame, admission: DataFrame, instrument: DataFrame, apply_macro: bool = False,
                    labels: bool = False) -> DataFrame:
    """Scores and stage per account and snapshot.

    The stage uses the lifetime-adjusted score. The score given out is the unadjusted one; with
    `apply_macro` it carries the macro factor.
    """
    together = behaviour_scores(features).join(admission, "AccountNumber", "left")
    staged = stage_accounts(together, labels=labels).distinct()
    return macro_overlay(staged, instrument, apply=apply_macro).select(*OUTPUT)


def latest_month(features: DataFrame, as_of: DateLike) -> DataFrame:
    """Only the snapshots of the month before `as_of`, the ones a monthly run appends."""
    return features.filter(F.col("SnapshotDate") > F.add_months(as_date(as_of), -1))
