"""Scores, significant increase in credit risk, stage and macro overlay."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.dates import DateLike, as_date
from riskspark.functions.scalars import cap, logistic, round_half_even
from riskspark.operators.keyed import attach


@dataclass(frozen=True)
class LogitModel:
    """A logistic model with a logistic calibration of its probability."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    calibration_coefficient: float = 1.0
    calibration_intercept: float = 0.0

    def z(self) -> Column:
        total = F.lit(self.intercept)
        for name, weight in zip(self.features, self.coefficients, strict=True):
            total = total + F.col(name) * F.lit(weight)
        return total


# The production coefficients.
BEHAVIOUR = LogitModel(
    features=("CoappFlag", "Ever30In6Months", "WorstDelinquency6M", "CurrentDelinquencyStatus"),
    coefficients=(-0.44414603, 0.18778622, 0.3539554, 0.70178643),
    intercept=0.0,
    calibration_coefficient=10.11569562,
    calibration_intercept=-8.18226514,
)
ADMISSION = LogitModel(
    features=("UCScore", "age", "Inquiries12M", "PropertyVolume"),
    coefficients=(2.03675292e+00, -2.18071234e-02, 3.39715771e-02, -2.12322589e-07),
    intercept=-0.13407141,
    calibration_coefficient=3.7812065422080856,
    calibration_intercept=-4.336067082588543,
)

# Thresholds of the staging rules.
NEW_SCORE_AFTER = "2023-12-20"
SICR_DELTA = 0.09
DEFAULT_CODES = (4, 9)
LOW_RISK_BELOW = 0.50
LOW_RISK_FACTOR = 1.2
HIGH_RISK_FACTOR = 1.1


def logit_score(df: DataFrame, model: LogitModel, output: str, raw: str = "P") -> DataFrame:
    """Raw probability `raw` and calibrated probability `output`."""
    p = logistic(model.z())
    df = df.withColumn(raw, p)
    z = F.col(raw) * model.calibration_coefficient + model.calibration_intercept
    return df.withColumn(output, logistic(z))


def applied_application_score(df: DataFrame) -> DataFrame:
    """The admission probability in force for the loan; missing becomes 0."""
    new, model = F.col("PDScoreNew"), F.col("AdmissionModel")
    recent = F.col("DisbursedDate") > as_date(NEW_SCORE_AFTER)
    older = F.col("DisbursedDate") <= as_date(NEW_SCORE_AFTER)
    score = (F.when(recent & new.isNotNull() & (round_half_even(new) <= round_half_even(model)), new)
              .when(recent & new.isNull(), model)
              .when(older, F.col("ApplicationScore") / 100)
              .otherwise(model))
    return df.withColumn("AppliedApplicationScore", F.coalesce(score, F.lit(0.0)))


def default_adjusted(df: DataFrame) -> DataFrame:
    """AdjustedBehaviourScore: 1 for accounts in default, else the behaviour score."""
    in_default = F.col("CurrentDelinquencyStatus").isin(*DEFAULT_CODES)
    return df.withColumn("AdjustedBehaviourScore", F.when(in_default, 1.0).otherwise(F.col("BehaviourModel")))


def pd_delta(df: DataFrame) -> DataFrame:
    """Behaviour less admission probability; rows without months on book are dropped."""
    delta = F.col("AdjustedBehaviourScore") - F.col("AppliedApplicationScore")
    return df.filter(F.col("MOB").isNotNull()).withColumn("PD_Delta", F.coalesce(delta, F.lit(0.0)))


def fbe_reason(df: DataFrame) -> DataFrame:
    code = F.col("CurrentDelinquencyStatus")
    cured = (F.col("ForberanceIn12Months") == 1) & (code > 1) & (code < 4)
    return df.withColumn("FBE", F.when(cured, "monitoring_previous_S3")
                                 .when(F.col("FBE_eftergift") == 1, "monitoring_paymentrelief")
                                 .otherwise(""))


def sicr_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("SICR", F.when((F.col("PD_Delta") > SICR_DELTA) | (F.col("FBE") != ""), 1).otherwise(0))


def lifetime_adjust(df: DataFrame, output: str = "LifetimeScore") -> DataFrame:
    """Twelve-month to lifetime probability for accounts with increased risk, capped at 1."""
    score = F.col("AdjustedBehaviourScore")
    factor = F.when(F.col("SICR") == 0, 1.0).when(score < LOW_RISK_BELOW, LOW_RISK_FACTOR).otherwise(HIGH_RISK_FACTOR)
    return df.withColumn(output, cap(score * factor, 1.0))


def assign_stage(df: DataFrame, score: str = "LifetimeScore", labels: bool = False) -> DataFrame:
    """Stage 1 without increased risk, stage 3 at probability 1, else stage 2; as numbers or 'Stage1'.."""
    stage = F.when(F.col("SICR") == 0, 1).when(F.col(score) == 1.0, 3).otherwise(2)
    return df.withColumn("Stageing", F.concat(F.lit("Stage"), stage.cast("string")) if labels else stage)


def macro_overlay(df: DataFrame, instrument: DataFrame, apply: bool = True) -> DataFrame:
    """Multiply the behaviour score by the month's macro instrument; a missing one counts as 1.

    The instrument is written first, so the planner broadcasts it by its known size, or shuffles a large
    one. With `apply=False` the factor is only attached and the score stays as it is.
    """
    months = instrument.select(F.col("Date").alias("SnapshotDate"), F.col("InstrumentRollingMean").alias("__macro"))
    joined = attach(df, months, ["SnapshotDate"])
    factor = F.coalesce(F.col("__macro"), F.lit(1.0))
    joined = joined.withColumn("MacroFactor", factor).drop("__macro")
    if not apply:
        return joined
    in_default = F.col("CurrentDelinquencyStatus").isin(*DEFAULT_CODES)
    scored = F.when(in_default, 1.0).otherwise(F.col("BehaviourModel") * F.col("MacroFactor"))
    return joined.withColumn("AdjustedBehaviourScore", scored)


def stage_accounts(df: DataFrame, labels: bool = False) -> DataFrame:
    """From behaviour and admission probabilities to stage."""
    df = pd_delta(default_adjusted(applied_application_score(df)))
    return assign_stage(lifetime_adjust(sicr_flag(fbe_reason(df))), labels=labels)


def score_snapshot(panel: DataFrame, snapshot: DateLike, tape: DataFrame, model: LogitModel = BEHAVIOUR) -> DataFrame:
    """Score one snapshot of the accounts on the admission tape.

    The tape may repeat an account with the same score; with different scores the account repeats too.
    """
    chosen = panel.filter(F.col("SnapshotDate") == as_date(snapshot))
    joined = chosen.join(tape.select("AccountNumber", "P_calibrated").distinct(), "AccountNumber")
    return logit_score(joined, model, "Recalibrated_Probability_model", raw="Probability_model")
