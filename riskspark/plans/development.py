"""Model development: tape, split, balance, fit, evaluate, calibrate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.dates import mob_filter
from riskspark.operators.applicants import prefer_coapplicant, prefer_relief_row
from riskspark.operators.logistic import by_model, fit_logistic, model_rows, store_model, with_calibration
from riskspark.operators.metrics import classification_metrics, curve_figures
from riskspark.operators.modelling import FEATURES, calibrate
from riskspark.operators.outcomes import sample_account_month
from riskspark.operators.sampling import balance_by_month, split_by_positive_share
from riskspark.operators.scoring import LogitModel
from riskspark.session import materialise

TAPE = ("AccountNumber", "SnapshotDate", "MOB", "DisbursedDate", "AccountStatus", "Ever90", "CoappFlag", "TimeSince30",
        "TimeSince60", "Ever30In6Months", "Ever30In12Months", "Ever30", "Ever60In6Months", "Ever60In12Months", "Ever60",
        "WorstDelinquency6M", "WorstDelinquency12M", "WorstDelinquency", "CurrentDelinquencyStatus", "Score")


def model_tape(features: DataFrame, columns: Sequence[str] = TAPE) -> DataFrame:
    """Clean panel after the first months on book; no late payment so far counts as 0 days since.

    The columns needed are written once, as choosing applicants and relief rows reads them several times.
    """
    kept = [c for c in columns if c in features.columns]
    features = materialise(features.select(*kept, "FBE_eftergift"), "features")
    clean = mob_filter(prefer_relief_row(prefer_coapplicant(features)).distinct(), above=2)
    kept = clean.select(*kept)
    return kept.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("TimeSince30", "TimeSince60")})


def sampled_tape(features: DataFrame, seed: int = 42) -> DataFrame:
    """The tape with a twelve-month outcome for a random healthy month per account and snapshot."""
    return sample_account_month(materialise(model_tape(features), "tape"), seed=seed)


def training_set(tape: DataFrame, label: str = "Ever90_12M") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Balanced train, plain test and validation."""
    parts = materialise(split_by_positive_share(tape, label), "split")
    train, test, validation = (parts.filter(F.col("Split") == n) for n in ("train", "test", "validation"))
    return balance_by_month(train, label), test, validation


#: The inverse penalty of the logistic model, and of its calibration.
MODEL_C, CALIBRATION_C = 0.001, 1.0
NAME = "behaviour"


def all_parts(tape: DataFrame, label: str = "Ever90_12M") -> DataFrame:
    """The balanced train set and the plain others in one frame, told apart by Split."""
    train, test, validation = training_set(tape, label)
    return train.drop("YearMonth").unionByName(test).unionByName(validation)


def fit_behaviour(train: DataFrame, features: Sequence[str] = FEATURES, label: str = "Ever90_12M") -> LogitModel:
    """The logistic model in use, without intercept, and the calibration of its probability on the same rows."""
    model = fit_logistic(train, features, label, c=MODEL_C, fit_intercept=False)
    return with_calibration(model, calibrate(by_model(train, {NAME: model}), label=label, c=CALIBRATION_C))


def metrics_by_split(parts: DataFrame, models: Mapping[str, LogitModel], label: str = "Ever90_12M", cut: float = 0.5) -> DataFrame:
    """Per model and split: confusion counts and rates at the cut, area under the ROC curve, Gini, average precision.

    Every row is scored by all models in one pass; the counts and the curves are grouped, not a job for each model.
    """
    scored = by_model(parts.select(label, "Split", *sorted({f for m in models.values() for f in m.features})), models)
    scored = materialise(scored.select("Model", "Split", label, "Probability_model"), "scored-parts")
    predicted = scored.withColumn("prediction", (F.col("Probability_model") > cut).cast("int"))
    rates = classification_metrics(predicted, label, "prediction", "Model", "Split")
    curves = curve_figures(scored, label, "Probability_model", ["Model", "Split"])
    return rates.join(curves, ["Model", "Split"], "left")


def develop(tape: DataFrame, folder: str, version: int = 1, label: str = "Ever90_12M") -> DataFrame:
    """Split, balance, fit, calibrate and store a version of the model; returns its metrics by split."""
    parts = materialise(all_parts(tape, label), "parts")
    model = fit_behaviour(parts.filter("Split = 'train'"), label=label)
    store_model(model_rows(NAME, version, model, tape.sparkSession), folder)
    return metrics_by_split(parts, {NAME: model}, label)
