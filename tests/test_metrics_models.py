import math
import random

import pytest
from helpers import one, rows
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from riskspark.operators import metrics as m
from riskspark.operators import modelling as ml
from riskspark.operators.scoring import BEHAVIOUR, LogitModel


def scored(spark, n=400, hot=False):
    rng = random.Random(1)
    data = [(int(rng.random() < 0.3), 0.5 if hot and i % 3 == 0 else round(rng.random(), 2)) for i in range(n)]
    return spark.createDataFrame(data, "y int, s double"), data


def brute_auc(data):
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def brute_ap(data):
    total, ap, last = sum(y for y, _ in data), 0.0, 0.0
    for t in sorted({s for _, s in data}, reverse=True):
        picked = [y for y, s in data if s >= t]
        ap += (sum(picked) / total - last) * sum(picked) / len(picked)
        last = sum(picked) / total
    return ap


@pytest.mark.parametrize("hot", [False, True])
def test_auc_and_average_precision(spark, hot):
    df, data = scored(spark, hot=hot)
    got = one(m.roc_auc_gini(df, "y", "s"))
    assert got.auc == pytest.approx(brute_auc(data)) and got.gini == pytest.approx(2 * brute_auc(data) - 1)
    assert one(m.average_precision(df, "y", "s"))[0] == pytest.approx(brute_ap(data))
    spark_auc = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(df)
    assert got.auc == pytest.approx(spark_auc)


def test_auc_degenerate(spark):
    single = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, s double")
    assert one(m.roc_auc_gini(single, "y", "s")).auc is None
    same = spark.createDataFrame([(1, 0.2), (0, 0.2), (0, 0.2)], "y int, s double")
    assert one(m.roc_auc_gini(same, "y", "s")).auc == 0.5
    assert one(m.average_precision(same, "y", "s"))[0] == pytest.approx(1 / 3)


def test_roc_points_end_at_one(spark):
    df, _ = scored(spark)
    last = m.roc_points(df, "y", "s").orderBy("threshold").first()
    assert (last.fpr, last.tpr) == (1.0, 1.0)


def test_classification_metrics(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(0, 1)] + [(1, 0)] * 2 + [(0, 0)] * 4, "y int, p int")
    got = one(m.classification_metrics(df, "y", "p"))
    assert (got.tp, got.fp, got.fn, got.tn) == (3, 1, 2, 4)
    assert (got.accuracy, got.precision, got.recall) == pytest.approx((0.7, 0.75, 0.6)) and got.f1 == pytest.approx(2 * 0.75 * 0.6 / 1.35)
    none = one(m.classification_metrics(df.filter("p = 0"), "y", "p"))
    assert none.precision == 0.0 and none.tn_pct == pytest.approx(400 / 6)


def test_histogram_covers_all_rows(spark):
    df, data = scored(spark)
    hist = m.histogram_by_class(df, "y", "s")
    assert rows(hist.groupBy("y").agg(F.count("*").alias("b"), F.sum("n").alias("n")), "y", "b", "n") == [
        (0, 30, sum(1 - y for y, _ in data)), (1, 30, sum(y for y, _ in data))]
    flat = spark.createDataFrame([(0, 0.5), (0, 0.5)], "y int, s double")
    assert m.histogram_by_class(flat, "y", "s").agg(F.sum("n")).first()[0] == 2


def test_anova_matches_spark_ml(spark):
    df = spark.range(300).selectExpr("cast(id % 3 = 0 as int) as y", "cast(id % 7 as double) as a", "cast(id % 3 as double) + id % 5 as b")
    ours = dict(rows(m.anova_f(df, ["a", "b"], "y"), "feature", "f_score"))
    theirs = {r.feature: r for r in m.anova_p_values(df, ["a", "b"], "y").collect()}
    assert {k: pytest.approx(v.f_score) for k, v in theirs.items()} == ours
    assert theirs["b"].p_value < 0.01 < theirs["a"].p_value


def test_importance_rank(spark):
    df = spark.createDataFrame([("A", "x", 3.0), ("A", "z", 1.0), ("B", "x", 0.2), ("B", "z", 0.2), ("B", "AccountNumber", 0.6)], "method string, feature string, importance double")
    assert [tuple(r) for r in m.feature_importance_rank(df).collect()] == [("x", pytest.approx(0.95)), ("z", pytest.approx(0.45))]


def test_summaries(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, 2.0)], "a double, b double")
    assert rows(m.null_columns(df), "column", "nulls") == [("b", 1)]
    assert rows(m.column_summary(df, ["a"]), "min", "max", "mean") == [(1.0, 3.0, 2.0)]
    assert rows(m.highly_correlated(spark.range(9).selectExpr("id as p", "id + pow(id % 3, 2) as q", "-id as r"), ["p", "q", "r"]), "feature") == [("p",), ("q",)]


def test_partial_response(spark):
    df = spark.createDataFrame([(0, 1, 2, 3), (1, 0, 4, 0)], "CoappFlag int, Ever30In6Months int, WorstDelinquency6M int, CurrentDelinquencyStatus int")
    got = {(r.feature, r.i): r for r in m.partial_response(df, BEHAVIOUR, {"CoappFlag": None, "Ever30In6Months": 20, "WorstDelinquency6M": 30, "CurrentDelinquencyStatus": 50}).collect()}
    assert len(got) == 400
    r = got["WorstDelinquency6M", 40]
    w = BEHAVIOUR.coefficients
    assert r.value == 5.0 and pytest.approx(r.P) == 1 / (1 + math.exp(-(0.5 * w[0] + 0.5 * w[1] + 5 * w[2] + 1.5 * w[3])))


def tape(spark, n=600):
    return spark.range(n).selectExpr(
        "id as AccountNumber", "date_add(date'2020-01-01', cast(id as int)) as SnapshotDate", "cast(id % 2 as int) as CoappFlag", "cast(id * 7 % 3 = 0 as int) as Ever30In6Months",
        "cast(id * 11 % 6 as int) as WorstDelinquency6M", "cast(id * 13 % 5 as int) as CurrentDelinquencyStatus", "cast((id * 11 % 6) + (id * 31 % 7) > 7 as int) as Ever90_12M")


def test_fit_and_score(spark):
    df = tape(spark)
    fitted = ml.fit_models(df, estimators={"LogisticRegression": LogisticRegression(regParam=0.0)}, folds=3)
    assert [(n, k) for n, k, _ in fitted.cross_validation] == [("LogisticRegression", i) for i in (1, 2, 3)]
    assert all(0.7 < a <= 1 for _, _, a in fitted.cross_validation)
    scored_df = ml.default_probability(fitted.models["LogisticRegression"], df)
    assert one(m.roc_auc_gini(scored_df, "Ever90_12M", "Probability_model")).auc > 0.8


def test_default_estimators_fit(spark):
    fitted = ml.fit_models(tape(spark, 300), estimators={k: v for k, v in ml.default_estimators(300).items() if k != "GradientBoostingClassifier"}, folds=0)
    ranks = ml.model_importances(fitted.models, ml.FEATURES, spark)
    assert {type(e).__name__ for e in ml.importance_estimators(300).values()} == {"GBTClassifier", "RandomForestClassifier", "LogisticRegression"}
    assert ranks.count() == 12 and set(fitted.models) == {"RandomForestClassifier", "DecisionTreeClassifier", "LogisticRegression"}


def test_calibration_is_the_penalised_optimum(spark):
    df, data = scored(spark)
    model = ml.calibrate(df.withColumnRenamed("s", "Probability_model").withColumnRenamed("y", "Ever90_12M"))
    w, b = model.coefficients[0], model.intercept
    # Gradient of 0.5 w^2 + sum of weighted losses is zero at the optimum.
    gw, gb = w, 0.0
    for y, s in data:
        g = (0.67 if y else 1.0) * (1 / (1 + math.exp(-(w * s + b))) - y)
        gw, gb = gw + g * s, gb + g
    assert abs(gw) < 0.05 and abs(gb) < 0.05


def test_grids():
    sizes = {k: len(v) for k, v in ml.logistic_grid(100).items()}
    assert sizes == {"l1": 16, "l2": 16, "elasticnet": 240, "none": 2}
    assert len(ml.combinations_of(ml.FOREST_GRID)) == 7 * 5 * 5 * 3


def test_grid_search_equals_single_models(spark):
    df = tape(spark, 300)
    train, test = df.filter("AccountNumber < 200"), df.filter("AccountNumber >= 200")
    combos = ml.combinations_of({"regParam": (0.0, 5.0), "fitIntercept": (True, False)})
    got = {r.combination: r for r in ml.grid_search(LogisticRegression(), combos, train, test, chunk=3).collect()}
    assert len(got) == 4
    model = LogisticRegression(regParam=0.0, fitIntercept=True).fit(ml.assemble(train, ml.FEATURES, "Ever90_12M"))
    alone = one(m.classification_metrics(ml.default_probability(model, test), "Ever90_12M", "prediction"))
    assert got[0].test_f1 == pytest.approx(alone.f1) and got[0].test_accuracy == pytest.approx(alone.accuracy)
    r = got[0]
    assert r.metric_distance == pytest.approx(math.sqrt(sum((r[f"train_{k}"] - r[f"test_{k}"]) ** 2 for k in ml.METRICS)))


def test_rank_grid(spark):
    df = spark.createDataFrame([(0, 0.9, 0.1, 0.5, 0.8), (1, 0.8, 0.0, 0.7, 0.9), (2, 0.1, 0.0, 0.9, 0.9)], "combination int, test_precision double, metric_distance double, test_f1 double, train_accuracy double")
    assert [r.combination for r in ml.rank_grid(df, by_precision=2).collect()] == [1, 0]


def test_anova_is_stable_on_large_means(spark):
    data = [(i % 2, float(i % 7), i % 7 + 1e9) for i in range(1000)]
    df = spark.createDataFrame(data, "y int, small double, large double")
    got = {r.feature: r.f_score for r in m.anova_f(df, ["small", "large"], "y").collect()}
    assert abs(got["small"] - got["large"]) < 1e-3 * max(1, abs(got["small"])) and got["large"] >= 0


def test_a_nan_score_has_no_place_in_the_curve(spark):
    data = [(i % 2, (i * 37 % 100) / 100) for i in range(100)]
    df = spark.createDataFrame(data, "y int, s double")
    more = df.unionByName(spark.createDataFrame([(1, float("nan"))], "y int, s double"))
    assert m.roc_auc_gini(more, "y", "s").collect() == m.roc_auc_gini(df, "y", "s").collect()
    assert m.average_precision(more, "y", "s").collect() == m.average_precision(df, "y", "s").collect()


def test_queries_fit_the_models_in_use(spark, monkeypatch):
    from riskspark.catalog import models
    seen = []

    class Stop(Exception):
        pass

    def fit(train, estimators, folds=5):
        seen.append(({k: {p.name: v for p, v in e.extractParamMap().items()} for k, e in estimators.items()}, folds))
        raise Stop

    def search(grid, train, test):
        seen.append(grid)
        raise Stop

    df = tape(spark, 100)
    monkeypatch.setattr(models, "_parts", lambda t: (df, df))
    monkeypatch.setattr(models, "materialise", lambda df, name: df)
    monkeypatch.setattr(ml, "fit_models", fit)
    monkeypatch.setattr(models, "forest_grid_search", search)
    for run in (models.fit_models, models.model_feature_importance, models.fitted_probability, models.grid_search):
        with pytest.raises(Stop):
            run(None)

    def params(estimators):
        return {k: {p.name: v for p, v in e.extractParamMap().items()} for k, e in estimators.items()}

    used = params(ml.default_estimators(df.count()))
    assert seen[0] == (used, 5) and seen[1] == (params(ml.importance_estimators(df.count())), 0)
    assert seen[2] == ({"lr": used["LogisticRegression"]}, 0)
    assert seen[3] == ml.FOREST_GRID
