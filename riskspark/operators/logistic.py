"""Logistic regression by iteratively reweighted least squares, and models as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.scalars import logistic
from riskspark.operators.scoring import LogitModel
from riskspark.session import materialise

ROUNDS, TOLERANCE = 50, 1e-11
TABLE = "model string, version int, term string, value double"
INTERCEPT, SLOPE, SHIFT = "intercept", "calibration_coefficient", "calibration_intercept"


def _counted(df: DataFrame, features: Sequence[str], label: str, weight: Column) -> DataFrame:
    """Weights of equal rows (x array, y) added up; rows with a NULL among them are left out."""
    x = F.array(*[F.col(f).cast("double") for f in features])
    rows = df.select(x.alias("x"), F.col(label).cast("double").alias("y"), weight.cast("double").alias("w"))
    whole = rows.filter(F.col("y").isNotNull() & F.col("w").isNotNull() & F.forall("x", lambda v: v.isNotNull()))
    return whole.groupBy("x", "y").agg(F.sum("w").alias("w"))


def fit_logistic(df: DataFrame, features: Sequence[str], label: str, weight: Column | None = None, c: float | None = None,
                 fit_intercept: bool = True, rounds: int = ROUNDS) -> LogitModel:
    """The weighted logistic regression whose coefficients (not the intercept) carry a squared penalty of 1 / (2 c).

    Equal rows are counted once and written. Each round is one aggregate over them: gradient, curvature and loss at
    the coefficients so far, k (k + 3) / 2 + 1 sums for k coefficients; the driver solves for the step. A step that
    does not lower the loss is halved. It ends when no coefficient moves by more than TOLERANCE of the largest.
    Without rows all coefficients are 0.
    """
    rows = materialise(_counted(df, features, label, F.lit(1.0) if weight is None else weight), "logistic-rows")
    k = len(features) + fit_intercept
    ridge = np.array([0.0] * fit_intercept + [0.0 if c is None else 1.0 / c] * len(features))
    x = [F.lit(1.0)] * fit_intercept + [F.get("x", F.lit(i)) for i in range(len(features))]

    def sums(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        z = sum((v * F.lit(float(b)) for v, b in zip(x, beta, strict=True)), F.lit(0.0))
        p, w, y = logistic(z), F.col("w"), F.col("y")
        # ln(1 + e^z) without overflow.
        loss = F.sum(w * (F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - y * z))
        gradient = [F.sum(w * (y - p) * v) for v in x]
        curvature = [F.sum(w * p * (1 - p) * x[i] * x[j]) for i in range(k) for j in range(i, k)]
        got = np.array([v or 0.0 for v in rows.agg(loss, *gradient, *curvature).first()])
        h = np.zeros((k, k))
        h[np.triu_indices(k)] = got[1 + k :]
        h += np.triu(h, 1).T
        return got[0] + 0.5 * (ridge * beta) @ beta, got[1 : 1 + k] - ridge * beta, h + np.diag(ridge)

    beta = np.zeros(k)
    loss, gradient, curvature = sums(beta)
    for _ in range(rounds):
        step = np.linalg.lstsq(curvature, gradient, rcond=None)[0]
        if np.abs(step).max(initial=0) <= TOLERANCE * max(1.0, np.abs(beta).max(initial=0)):
            break
        for _ in range(30):
            further = sums(beta + step)
            if further[0] <= loss + 1e-9 * abs(loss):
                break
            step = step / 2
        beta, (loss, gradient, curvature) = beta + step, further
    intercept = float(beta[0]) if fit_intercept else 0.0
    return LogitModel(tuple(features), tuple(map(float, beta[fit_intercept:])), intercept)


def model_rows(name: str, version: int, model: LogitModel, spark: SparkSession) -> DataFrame:
    """A model in long form, (model, version, term, value): one row for each coefficient."""
    terms = {INTERCEPT: model.intercept, SLOPE: model.calibration_coefficient, SHIFT: model.calibration_intercept}
    terms |= {f"feature:{f}": w for f, w in zip(model.features, model.coefficients, strict=True)}
    return spark.createDataFrame([(name, version, t, v) for t, v in terms.items()], TABLE)


def store_model(rows: DataFrame, folder: str) -> None:
    """Append model rows to the model table, a folder by model and version; a version stored again is replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model", "version").parquet(folder)


def model_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(TABLE).parquet(folder)


def _terms(models: DataFrame, name: str, version: int | None) -> Column:
    """The coefficients of one model as a map, a scalar of the plan; by default those of its latest version."""
    own = models.filter(F.col("model") == name)
    own = own.filter(F.col("version") == version) if version is not None else own.filter(F.col("version") == own.agg(F.max("version")).scalar())
    return own.agg(F.map_from_entries(F.collect_list(F.struct("term", "value")))).scalar()


def score_with_table(df: DataFrame, models: DataFrame, name: str, output: str, version: int | None = None, raw: str = "P") -> DataFrame:
    """Raw and calibrated probability by a stored model, whatever its features: those among the frame's columns count.

    The model's rows become one map in the plan, so rows are scored where they are and nothing is collected. A
    feature of the model that `df` doesn't have is an error when the query runs; a NULL one gives a NULL probability.
    """
    t = F.col("__terms")
    known = [c for c in df.columns if dict(df.dtypes)[c] not in ("string", "date", "timestamp", "boolean")]
    weight = lambda c: F.element_at(t, F.lit(f"feature:{c}"))
    # Only features of the model may make a score NULL.
    parts = [F.when(weight(c).isNull(), 0.0).otherwise(weight(c) * F.col(c).cast("double")) for c in known]
    missing = F.filter(F.map_keys(t), lambda k: F.startswith(k, F.lit("feature:")) & ~k.isin(*[f"feature:{c}" for c in known], ""))
    checked = F.when(F.size(missing) > 0, F.raise_error(F.concat(F.lit("no column for "), F.array_join(missing, ", "))).cast("double")).otherwise(F.element_at(t, F.lit(INTERCEPT)))
    z = checked
    for part in parts:
        z = z + part
    scored = df.withColumn("__terms", _terms(models, name, version)).withColumn(raw, logistic(z))
    p = F.coalesce(F.element_at(t, F.lit(SLOPE)), F.lit(1.0)) * F.col(raw) + F.coalesce(F.element_at(t, F.lit(SHIFT)), F.lit(0.0))
    return scored.withColumn(output, logistic(p)).drop("__terms")


def with_calibration(model: LogitModel, calibration: LogitModel) -> LogitModel:
    """The model with a calibration fitted on its raw probability."""
    return LogitModel(model.features, model.coefficients, model.intercept, calibration.coefficients[0], calibration.intercept)


def by_model(df: DataFrame, models: Mapping[str, LogitModel], output: str = "Probability_model") -> DataFrame:
    """Every row once for each model, `Model`, with its raw probability."""
    each = [F.struct(F.lit(name).alias("Model"), logistic(m.z()).alias(output)) for name, m in models.items()]
    return df.select("*", F.inline(F.array(*each)))
