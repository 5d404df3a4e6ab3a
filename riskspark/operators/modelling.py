"""Model development on Spark ML: fits, calibration, grid search and ranking."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from riskspark.operators.logistic import fit_logistic
from riskspark.operators.metrics import confusion_counts, rates_from_counts
from riskspark.operators.sampling import stratified_folds
from riskspark.operators.scoring import LogitModel
from riskspark.session import materialise

FEATURES = ("CoappFlag", "Ever30In6Months", "WorstDelinquency6M", "CurrentDelinquencyStatus")
BAD_WEIGHT = 0.67
METRICS = ("accuracy", "precision", "recall", "f1")
#: Rows of one partition of a fit's data, at the least.
ROWS_PER_PARTITION = 200_000
#: Rows that stand for equal rows of a large fit, at most: far above any least number of rows in a leaf.
UNITS = 2_000


def assemble(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Feature vector and double label; rows with a missing feature or label are an error to Spark ML."""
    typed = df.withColumns({f: F.col(f).cast("double") for f in features} | {"label": F.col(label).cast("double")})
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(typed)


def counted(sizes: DataFrame, columns: Sequence[str], units: int) -> DataFrame:
    """Different rows with their number `__n` as rows with a `weight`, the rows each stands for; the sum is all rows.

    A row that comes n times becomes min(n, units) rows of nearly equal whole weights. Sums by weight are those over the
    single rows. What a fit draws by row is drawn by unit, and a leaf that must hold k rows must hold k units, which is
    the same while k is at most `units`.
    """
    n, parts = F.col("__n"), F.least(F.col("__n"), F.lit(units))
    rows = sizes.withColumn("__unit", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    weight = F.floor(n / parts) + F.when(F.col("__unit") < n % parts, 1).otherwise(0)
    return rows.select(*columns, weight.cast("double").alias("weight"))


def equal_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The different rows of these columns with their number `__n`, written."""
    return materialise(df.groupBy(*dict.fromkeys(columns)).agg(F.count("*").alias("__n")), "equal-rows")


@dataclass
class Counted:
    """A frame, and the `equal_rows` of the columns that a fit reads."""

    rows: DataFrame
    sizes: DataFrame


def assembled(df: DataFrame | Counted, features: Sequence[str], label: str, *more: str, weighted: bool = True) -> DataFrame:
    """The persisted feature vectors, labels and weights of a fit, to be unpersisted by the caller.

    They lie in as many partitions as their size needs: a tree's fit runs a job for every level, and its tasks for
    small frames cost more than their work. In a frame of more rows than one partition takes, equal rows are `counted`,
    so that the passes of a fit grow with the different rows only. In a smaller one, and with `weighted=False`, for
    estimators that take no weights, every row has the weight 1. A `Counted` frame's equal rows aren't counted again.
    """
    columns = list(dict.fromkeys([*features, label, *more]))
    df, sizes = (df.rows, df.sizes) if isinstance(df, Counted) else (df, None)
    rows = df.withColumn("weight", F.lit(1.0))
    if weighted:
        sizes = equal_rows(df, columns) if sizes is None else sizes
        if (sizes.agg(F.sum("__n")).first()[0] or 0) > ROWS_PER_PARTITION:
            rows = counted(sizes, columns, UNITS)
            size = sizes.agg(F.sum(F.least("__n", F.lit(UNITS)))).first()[0]
            rows = rows.repartition(-(-size // ROWS_PER_PARTITION))
    data = assemble(rows, features, label).select("features", "label", "weight", *more).persist(StorageLevel.MEMORY_AND_DISK)
    parts = -(-data.count() // ROWS_PER_PARTITION)
    if parts >= data.rdd.getNumPartitions():
        return data
    packed = data.coalesce(max(int(parts), 1)).persist(StorageLevel.MEMORY_AND_DISK)
    packed.count()
    data.unpersist()
    return packed


#: Estimators that weigh rows; others may have the parameter and pass over it.
WEIGHING = (GBTClassifier, RandomForestClassifier, DecisionTreeClassifier, LogisticRegression)


def takes_weights(*estimators: Estimator) -> bool:
    return all(isinstance(e, WEIGHING) for e in estimators)


def with_weights(estimator: Estimator, params: Mapping[str, Any] | None = None) -> Estimator:
    """A copy with these parameters that reads the weights of `assembled`, if it can."""
    given = dict(params or {}) | ({"weightCol": "weight"} if takes_weights(estimator) else {})
    return estimator.copy({estimator.getParam(k): v for k, v in given.items()})


# Fixed value: the most iterations of a logistic fit; the tolerance ends it long before.
LOGISTIC = {"maxIter": 10_000_000, "tol": 1e-9}


def penalty(c: float, weight_sum: float) -> float:
    """Spark's regParam for an inverse penalty `c`: Spark averages the loss, so the penalty is per row."""
    return 1.0 / (c * weight_sum)


# The parameters of the candidates, of those that rank features, and of the logistic grids.
def default_estimators(n_rows: int, seed: int = 42) -> dict[str, Estimator]:
    """The four candidates with the parameters in use."""
    return {
        "GradientBoostingClassifier": GBTClassifier(
            maxIter=50, stepSize=0.01, maxDepth=15, minInstancesPerNode=1, subsamplingRate=0.6,
            featureSubsetStrategy="log2", seed=seed),
        "RandomForestClassifier": RandomForestClassifier(
            numTrees=4, impurity="gini", maxDepth=3, minInstancesPerNode=2, featureSubsetStrategy="log2",
            minInfoGain=0.01, seed=seed),
        "DecisionTreeClassifier": DecisionTreeClassifier(impurity="gini", maxDepth=7, minInstancesPerNode=7, seed=seed),
        "LogisticRegression": LogisticRegression(
            regParam=penalty(0.001, n_rows), elasticNetParam=0.0, fitIntercept=False, standardization=False, **LOGISTIC),
    }


def importance_estimators(n_rows: int, seed: int = 42) -> dict[str, Estimator]:
    """The deeper candidates used to rank features; fit them on scaled features."""
    return {
        "BGC": GBTClassifier(maxIter=50, stepSize=0.05, maxDepth=15, minInstancesPerNode=100, subsamplingRate=0.6,
                             featureSubsetStrategy="log2", seed=seed),
        "RFS": RandomForestClassifier(numTrees=50, impurity="gini", maxDepth=10, minInstancesPerNode=1,
                                      featureSubsetStrategy="6", seed=seed),
        "LG": LogisticRegression(regParam=penalty(0.001, n_rows), elasticNetParam=0.0, standardization=False, **LOGISTIC),
    }


@dataclass
class FittedModels:
    models: dict[str, Model]
    cross_validation: list[tuple[str, int, float]]


def parallel(spark: SparkSession, jobs: Iterable[Callable[[], Any]], parallelism: int) -> list[Any]:
    """Submit several Spark jobs at once, as CrossValidator does; the work itself stays on the executors."""
    pool = ThreadPool(parallelism)
    try:
        return pool.map(inheritable_thread_target(spark)(lambda job: job()), list(jobs))
    finally:
        pool.close()


def fit_models(train: DataFrame, features: Sequence[str] = FEATURES, label: str = "Ever90_12M",
               estimators: Mapping[str, Estimator] | None = None, folds: int = 5, parallelism: int = 4,
               key: Sequence[str] = ("AccountNumber", "SnapshotDate")) -> FittedModels:
    """Fit each candidate, with its accuracy on `folds` held-out stratified parts (model, fold, accuracy)."""
    needed = train.select(*dict.fromkeys([*features, label, *(key if folds > 1 else ())]))
    dealt = stratified_folds(needed, label, folds, key) if folds > 1 else needed.withColumn("fold", F.lit(0))
    data = assembled(dealt, features, label, "fold", weighted=takes_weights(*(estimators or {}).values()))
    try:
        rows = int(data.agg(F.sum("weight")).first()[0] or 0)
        estimators = {n: with_weights(e) for n, e in (estimators or default_estimators(rows)).items()}
        fitted = parallel(train.sparkSession, [lambda e=e: e.fit(data) for e in estimators.values()], parallelism)

        def accuracy(name: str, fold: int) -> tuple[str, int, float]:
            model = estimators[name].fit(data.filter(F.col("fold") != fold))
            hit = F.sum(F.when(F.col("prediction") == F.col("label"), F.col("weight")).otherwise(0.0)) / F.sum("weight")
            return name, fold + 1, model.transform(data.filter(F.col("fold") == fold)).agg(hit).first()[0]

        cv = parallel(train.sparkSession, [lambda n=n, k=k: accuracy(n, k) for n in estimators for k in range(folds)], parallelism) if folds > 1 else []
        return FittedModels(dict(zip(estimators, fitted, strict=True)), cv)
    finally:
        data.unpersist()


def default_probability(model: Model, df: DataFrame, features: Sequence[str] = FEATURES, output: str = "Probability_model") -> DataFrame:
    """Add the model's probability of default and its class."""
    typed = df.withColumns({f"__{f}": F.col(f).cast("double") for f in features})
    vec = VectorAssembler(inputCols=[f"__{f}" for f in features], outputCol="features").transform(typed)
    scored = model.transform(vec).withColumn(output, vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "probability", *[f"__{f}" for f in features])


def model_importances(models: Mapping[str, Model], features: Sequence[str], spark: SparkSession) -> DataFrame:
    """(method, feature, importance): tree importances, or the size of logistic coefficients."""
    rows = []
    for name, m in models.items():
        values = [abs(v) for v in m.coefficients.toArray()] if hasattr(m, "coefficients") else m.featureImportances.toArray()
        rows += [(name, f, float(v)) for f, v in zip(features, values, strict=True)]
    return spark.createDataFrame(rows, "method string, feature string, importance double")


def calibrate(df: DataFrame, score: str = "Probability_model", label: str = "Ever90_12M", bad_weight: float = BAD_WEIGHT,
              c: float = 1.0) -> LogitModel:
    """Weighted logistic regression on the raw probability; bad rows weigh less as they were repeated."""
    return fit_logistic(df, [score], label, F.when(F.col(label) == 1, bad_weight).otherwise(1.0), c)


def combinations_of(grid: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    return [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]


def logistic_grid(n_rows: int, cs: Sequence[float] = (0.0001, 0.001, 0.01, 0.1, 1, 10, 100, 1000),
                  l1_ratios: Sequence[float] = (0.025, 0.05, 0.075, 0.1, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.925, 0.95, 0.975)
                  ) -> dict[str, list[dict[str, Any]]]:
    """Spark parameters for the four penalties. Solver and warm start have no counterpart in Spark."""
    regs = [penalty(c, n_rows) for c in cs]
    both = [True, False]

    def combos(reg: Sequence[float], mix: Sequence[float]) -> list[dict[str, Any]]:
        return combinations_of({"regParam": reg, "elasticNetParam": mix, "fitIntercept": both, "standardization": [False]})

    return {"l1": combos(regs, [1.0]), "l2": combos(regs, [0.0]), "elasticnet": combos(regs, l1_ratios), "none": combos([0.0], [0.0])}


# The forest grid. Leaf and split counts other than minInstancesPerNode have no counterpart.
FOREST_GRID = {
    "numTrees": (3, 4, 5, 6, 7, 10, 12), "impurity": ("gini",), "maxDepth": (2, 3, 4, 5, 6),
    "minInstancesPerNode": (2, 3, 4, 5, 6), "featureSubsetStrategy": ("log2",), "minInfoGain": (0.0, 0.01, 0.02),
}


def grid_search(estimator: Estimator, combos: Sequence[Mapping[str, Any]], train: DataFrame, test: DataFrame,
                features: Sequence[str] = FEATURES, label: str = "Ever90_12M", parallelism: int = 4, chunk: int = 16) -> DataFrame:
    """Train and test metrics for each parameter combination, and the distance between the two.

    Models are fitted several at a time on cached vectors, of which equal ones of large frames are counted. A chunk of models is then evaluated together:
    each adds a prediction column and one aggregate counts all of them, so the data is read once per
    chunk rather than twice per model. The result has one row per combination.
    """
    spark = train.sparkSession
    weighted = takes_weights(estimator)
    sets = {n: assembled(d, features, label, weighted=weighted) for n, d in (("train", train), ("test", test))}
    rows: list[tuple] = []
    try:
        for start in range(0, len(combos), chunk):
            part = list(combos[start:start + chunk])
            models = parallel(spark, [lambda p=p: with_weights(estimator, p).fit(sets["train"])
                                for p in part], parallelism)
            counted = {n: _count_all(d, models) for n, d in sets.items()}
            for i, p in enumerate(part):
                for n, c in counted.items():
                    rows.append((start + i, params_text(p), n, *[c[f"{k}_{i}"] for k in ("tp", "fp", "fn", "tn")]))
    finally:
        for d in sets.values():
            d.unpersist()
    counts = spark.createDataFrame(rows, "combination int, params string, part string, tp long, fp long, fn long, tn long")
    return metric_distance(rates_from_counts(counts))


def params_text(params: Mapping[str, Any]) -> str:
    return ", ".join(f"{k}={v}" for k, v in sorted(params.items()))


def _count_all(df: DataFrame, models: Sequence[Model]) -> dict[str, int]:
    aggs = []
    for i, m in enumerate(models):
        silent = m.copy().setPredictionCol(f"prediction_{i}").setRawPredictionCol(f"raw_{i}").setProbabilityCol(f"prob_{i}")
        df = silent.transform(df)
        aggs += confusion_counts(F.col("label"), F.col(f"prediction_{i}"), f"_{i}", F.col("weight"))
    return df.agg(*aggs).first().asDict()


def metric_distance(rates: DataFrame) -> DataFrame:
    """Train and test metrics side by side, with the root of their summed squared gaps."""
    wide = [F.max(F.when(F.col("part") == p, F.col(m))).alias(f"{p}_{m}") for p in ("train", "test") for m in METRICS]
    df = rates.groupBy("combination", "params").agg(*wide)
    gaps = [F.pow(F.col(f"train_{m}") - F.col(f"test_{m}"), F.lit(2.0)) for m in METRICS]
    return df.withColumn("metric_distance", F.sqrt(sum(gaps[1:], gaps[0])))


def rank_grid(results: DataFrame, by_precision: int = 3000, keep: int = 1000) -> DataFrame:
    """The combinations with the best objective among those with the best test precision; best first.

    The objective rewards a small train-test distance (half), test F1 (one) and train accuracy (half).
    """
    top = results.orderBy(F.col("test_precision").desc(), F.col("combination").desc()).limit(by_precision)
    cols = ("metric_distance", "test_f1", "train_accuracy")
    bounds = top.agg(F.struct(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))])).scalar()

    def scaled(c: str):
        lo, hi = bounds.getField(f"lo_{c}"), bounds.getField(f"hi_{c}")
        return F.try_divide(F.col(c) - lo, hi - lo)

    objective = ((1 - scaled("metric_distance")) * 0.5 + scaled("test_f1") + scaled("train_accuracy") * 0.5) / 3
    return top.withColumn("objective", objective).orderBy(F.col("objective").desc(), F.col("combination").desc()).limit(keep)
