"""Forest cuts, logistic fits, stored models, special functions, feature statistics and the monthly state."""

import datetime as dt
import math
from collections import Counter

import numpy as np
import pytest
from helpers import one, rows
from pyspark.ml.classification import DecisionTreeClassifier, FMClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from riskspark.functions import special
from riskspark.operators import forests, logistic
from riskspark.operators import metrics as m
from riskspark.operators import modelling as ml
from riskspark.operators.scoring import BEHAVIOUR, LogitModel
from riskspark.plans import development

LABEL = "Ever90_12M"


def tape(spark, n=600):
    return spark.range(n).selectExpr(
        "id as AccountNumber", "date_add(date'2020-01-01', cast(id as int)) as SnapshotDate", "cast(id % 2 as int) as CoappFlag", "cast(id * 7 % 3 = 0 as int) as Ever30In6Months",
        "cast(id * 11 % 6 as int) as WorstDelinquency6M", "cast(id * 13 % 5 as int) as CurrentDelinquencyStatus", "cast((id * 11 % 6) + (id * 31 % 7) > 7 as int) as Ever90_12M")


def cut_result(spark, df, model, trees, depths):
    row = forests.forest_row(forests.forest_nodes(model, spark), depths)
    table = spark.createDataFrame([(0, row)], f"forest int, trees array<{forests.TREE}>")
    x = F.array(*[F.col(f).cast("double") for f in ml.FEATURES])
    got = forests.cut_predictions(df.withColumn("x", x), table, "x", trees, depths).select("AccountNumber", "predicted").collect()
    return {r.AccountNumber: r.predicted for r in got}


def predictions(model, df):
    return {r.AccountNumber: int(r.prediction) for r in ml.default_probability(model, df).select("AccountNumber", "prediction").collect()}


def test_the_whole_forest_is_the_fitted_model(spark):
    df = tape(spark)
    model = RandomForestClassifier(numTrees=6, maxDepth=4, seed=3).fit(ml.assemble(df, ml.FEATURES, LABEL))
    got = cut_result(spark, df, model, [2, 6], [3, 4])
    assert {k: v[3] for k, v in got.items()} == predictions(model, df)


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_a_cut_tree_is_the_tree_fitted_to_that_depth(spark, depth):
    df = tape(spark)
    data = ml.assemble(df, ml.FEATURES, LABEL)
    whole = RandomForestClassifier(numTrees=1, maxDepth=5, featureSubsetStrategy="all", bootstrap=False, minInstancesPerNode=3).fit(data)
    cut = cut_result(spark, df, whole, [1], [1, 2, 3, 5])
    small = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=3).fit(data)
    assert {k: v[depth - 1] for k, v in cut.items()} == predictions(small, df)


def test_equal_leaves_are_merged_and_keep_the_parents_votes():
    leaf = lambda p, counts: forests.Node(p, counts, -1, -1, -1, None)
    nodes = [forests.Node(0.0, [6.0, 4.0], 1, 4, 0, 0.5), forests.Node(0.0, [5.0, 3.0], 2, 3, 1, 0.5), leaf(0.0, [3.0, 0.0]), leaf(1.0, [2.0, 3.0]), leaf(0.0, [1.0, 1.0])]
    # Cut at depth one, both leaves say 0: the root stands for all.
    assert forests.standing_for(nodes, 1) == [0] * 5 and forests.standing_for(nodes, 2) == [-1, -1, 2, 3, 4]
    assert forests.tree_row(nodes, [1, 2])[4][3] == [0.6, 0.4, 0.4, 0.6]


def test_forest_grid_has_every_combination(spark):
    df = tape(spark, 300)
    grid = {"numTrees": (2, 3), "maxDepth": (1, 3), "minInstancesPerNode": (1, 5), "impurity": ("gini",)}
    got = {r.combination: r for r in forests.forest_grid_search(grid, df.filter("AccountNumber < 200"), df.filter("AccountNumber >= 200")).collect()}
    assert sorted(got) == list(range(8)) and len({r.params for r in got.values()}) == 8
    combos = ml.combinations_of(grid)
    assert all(got[i].params == ml.params_text(c) and 0.5 < got[i].train_accuracy <= 1 for i, c in enumerate(combos))


@pytest.mark.parametrize(("c", "intercept"), [(None, True), (0.5, True), (0.001, False)])
def test_logistic_fit_equals_spark_ml(spark, c, intercept):
    df = tape(spark).withColumn("w", F.when(F.col(LABEL) == 1, 0.67).otherwise(1.0))
    own = logistic.fit_logistic(df, ml.FEATURES, LABEL, F.col("w"), c, intercept)
    total = df.agg(F.sum("w")).first()[0]
    other = LogisticRegression(weightCol="w", regParam=0.0 if c is None else ml.penalty(c, total), elasticNetParam=0.0, standardization=False, fitIntercept=intercept,
                               maxIter=1000, tol=1e-14).fit(ml.assemble(df, ml.FEATURES, LABEL))
    assert own.coefficients == pytest.approx(other.coefficients.toArray().tolist(), abs=1e-6) and own.intercept == pytest.approx(other.intercept, abs=1e-6)


def test_logistic_fit_of_odd_frames(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 0), (2.0, None), (3.0, 0), (0.5, 0)], "x double, y int")
    whole = df.filter("x is not null and y is not null")
    assert logistic.fit_logistic(df, ["x"], "y", c=1.0) == logistic.fit_logistic(whole, ["x"], "y", c=1.0)
    assert logistic.fit_logistic(df.limit(0), ["x"], "y", c=1.0) == LogitModel(("x",), (0.0,), 0.0)


def test_scores_come_from_the_latest_stored_version(spark, tmp_path):
    folder = str(tmp_path / "models")
    first, second = LogitModel(("a", "b"), (1.5, -2.0), 0.25, 3.0, -1.0), LogitModel(("b",), (0.5,), -1.0)
    for version, model in ((1, first), (2, second), (1, first)):
        logistic.store_model(logistic.model_rows("x", version, model, spark), folder)
    logistic.store_model(logistic.model_rows("y", 9, BEHAVIOUR, spark), folder)
    models = logistic.model_table(spark, folder)
    assert models.count() == 5 + 4 + 7
    df = spark.createDataFrame([(1, 2.0, "t", 3.0), (None, 1.0, "t", 3.0)], "a int, b double, text string, other double")
    sigmoid = lambda z: 1 / (1 + math.exp(-z))
    got = logistic.score_with_table(df, models, "x", "p").collect()
    assert [r.p for r in got] == pytest.approx([sigmoid(sigmoid(0.0)), sigmoid(sigmoid(-0.5))])
    old = logistic.score_with_table(df, models, "x", "p", version=1).collect()
    assert old[0].p == pytest.approx(sigmoid(3 * sigmoid(0.25 + 1.5 - 4) - 1)) and old[1].p is None
    with pytest.raises(Exception, match="no column for"):
        logistic.score_with_table(df.drop("b"), models, "x", "p").collect()


def test_scoring_collects_nothing_and_keeps_rows_in_place(spark, tmp_path):
    folder = str(tmp_path / "models")
    logistic.store_model(logistic.model_rows("x", 1, LogitModel(("a",), (1.0,), 0.0), spark), folder)
    plan = logistic.score_with_table(spark.range(10).withColumnRenamed("id", "a"), logistic.model_table(spark, folder), "x", "p")
    text = plan._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Exchange" not in text and "Join" not in text


def test_develop_stores_what_scoring_reads(spark, tmp_path):
    df = tape(spark, 900).withColumn("MOB", F.lit(5)).withColumn("DisbursedDate", F.lit("2019-05-01").cast("date"))
    folder = str(tmp_path / "models")
    metrics = {r.Split: r for r in development.develop(df, folder).collect()}
    assert set(metrics) == {"train", "test", "validation"}
    assert all(0 <= v <= 1 for r in metrics.values() for v in (r.auc, r.precision, r.recall, r.average_precision))
    scored = logistic.score_with_table(df, logistic.model_table(spark, folder), development.NAME, "p")
    # Calibrated scores keep the order of the raw ones.
    train = scored.filter("AccountNumber < 300")
    assert one(m.roc_auc_gini(train, LABEL, "p")).auc == pytest.approx(one(m.roc_auc_gini(train, LABEL, "P")).auc)


def test_log_gamma_and_f_tail(spark):
    zs = [0.5, 1.0, 2.5, 9.0, 1e3, 1e7]
    got = spark.createDataFrame([(z,) for z in zs], "z double").select(special.log_gamma(F.col("z")).alias("g")).collect()
    assert [r.g for r in got] == pytest.approx([math.lgamma(z) for z in zs], rel=1e-13, abs=1e-12)
    jvm = spark._jvm.org.apache.commons.math3.distribution.FDistribution
    cases = [(f, a, b) for f in (1e-9, 0.5, 1.7, 30.0) for a, b in ((1.0, 3.0), (1.0, 5000.0), (4.0, 50.0), (2.0, 2e6))]
    df = spark.createDataFrame(cases, "f double, a double, b double")
    got = [r.p for r in df.select(special.f_tail(F.col("f"), F.col("a"), F.col("b")).alias("p")).collect()]
    assert got == pytest.approx([1 - jvm(a, b).cumulativeProbability(f) for f, a, b in cases], abs=1e-9)


def test_p_values_equal_spark_ml(spark):
    df = tape(spark)
    test = spark._jvm.org.apache.spark.ml.stat.ANOVATest.test(ml.assemble(df, ml.FEATURES, LABEL).select("features", "label")._jdf, "features", "label", True)
    from pyspark.sql import DataFrame
    want = {ml.FEATURES[int(r.featureIndex)]: r.pValue for r in DataFrame(test, spark).collect()}
    got = {r.feature: r.p_value for r in m.anova_from_statistics(m.feature_statistics(df, ml.FEATURES, LABEL)).collect()}
    assert got == pytest.approx(want, abs=1e-9)


def test_statistics_of_parts_merge_to_those_of_all(spark):
    df = spark.range(5000).selectExpr("id % 7 as part", "id % 2 as y", "1e9 + id % 13 as large", "case when id % 3 = 0 then null else id * id % 101 end as gaps", "4.0 as same")
    features = ["large", "gaps", "same"]
    merged = m.merged_statistics(m.feature_statistics(df, features, "y", "part"))
    names = ("feature", "class", "n", "lo", "hi")
    whole = m.feature_statistics(df, features, "y")
    assert rows(merged, *names) == rows(whole, *names)
    a, b = ({(r.feature, r["class"]): (r.mean, r.m2) for r in x.collect()} for x in (merged, whole))
    assert all(a[k] == pytest.approx(b[k], rel=1e-6, abs=1e-6) for k in b)
    scaled = m.scaled_by_statistics(df, features, merged)
    assert rows(scaled.agg(F.min("large").alias("a"), F.max("large").alias("b"), F.max("same").alias("c"), F.count("gaps").alias("d")), "a", "b", "c", "d") == [(0.0, 1.0, 0.0, 3333)]


def test_correlations_of_many_features_in_a_plan_of_one_size(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 60)) + rng.normal(size=(300, 1))
    df = spark.createDataFrame([(*map(float, r), None if i % 9 == 0 else float(i), 1.0) for i, r in enumerate(x)], ", ".join([*[f"f{i} double" for i in range(60)], "gaps double", "same double"]))
    names = [f"f{i}" for i in range(60)]
    got = {(r.feature_a, r.feature_b): r.correlation for r in m.correlation_matrix(df, [*names, "gaps", "same"]).collect()}
    want = np.corrcoef(x.T)
    assert len(got) == 62 * 61 / 2 and all(got[f"f{i}", f"f{j}"] == pytest.approx(want[i, j], abs=1e-9) for i in range(60) for j in range(i + 1, 60))
    keep = [i for i in range(300) if i % 9]
    assert got["f3", "gaps"] == pytest.approx(np.corrcoef(x[keep, 3], keep)[0, 1], abs=1e-9) and got["f3", "same"] is None
    assert m.correlation_matrix(df.limit(0), names[:3]).count() in (0, 3)


def test_three_monthly_runs_equal_the_full_run(spark):
    from riskspark.catalog import development as queries
    from riskspark.catalog.inputs import Inputs
    from riskspark.operators.delinquency import delinquency_features
    t = Inputs(spark, "/root/testdata/sf0.001")
    got = queries.monthly_state_features(t)
    full = delinquency_features(t.loan_portfolio, t.applications, t.payment_free_months, t.forbearance, output_after=queries.MONTHS[0]).select(*got.columns)
    assert got.count() > 100 and got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0


def test_a_monthly_run_reads_one_month(spark, tmp_path):
    from riskspark.catalog.inputs import Inputs
    from riskspark.plans import monthly
    from riskspark.sources.tables import append_month
    t = Inputs(spark, "/root/testdata/sf0.001")
    append_month(t.loan_portfolio, str(tmp_path / "portfolio"), "SnapshotDate")
    portfolio, folder = spark.read.parquet(str(tmp_path / "portfolio")), str(tmp_path / "state")
    monthly.start_state(portfolio, t.payment_free_months, folder, "2001-07-31")
    out = monthly.run_month(portfolio, t.applications, t.payment_free_months, t.forbearance, folder, "2001-07-31", "2001-08-31")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SnapshotDate" in plan.split("PartitionFilters: [")[1].split("]")[0] or plan.count("PartitionFilters: [isnotnull(SnapshotDate") >= 1
    assert "StateMonth" in plan and out.count() > 0
    states = {str(r.StateMonth): r["count"] for r in spark.read.parquet(folder).groupBy("StateMonth").count().collect()}
    assert set(states) == {"2001-07-31", "2001-08-31"}


def test_equal_rows_of_a_large_fit_are_counted(spark, monkeypatch):
    rows = [(i, dt.date(2020, 1, 31), i % 2, 0, i % 3, i % 3 if i % 50 else 9, int(i % 7 < i % 3)) for i in range(3000)]
    df = spark.createDataFrame(rows, f"AccountNumber int, SnapshotDate date, CoappFlag int, Ever30In6Months int, WorstDelinquency6M int, CurrentDelinquencyStatus int, {LABEL} int")
    trees = {"tree": DecisionTreeClassifier(maxDepth=7, minInstancesPerNode=7), "lr": LogisticRegression(regParam=0.01, standardization=False, tol=1e-12)}
    plain = ml.fit_models(df, estimators=trees, folds=3)
    combos = ml.combinations_of({"maxDepth": (1, 3)})
    grid = ml.grid_search(trees["tree"], combos, df, df).orderBy("combination").collect()
    monkeypatch.setattr(ml, "ROWS_PER_PARTITION", 100)
    monkeypatch.setattr(ml, "UNITS", 10)
    data = ml.assembled(df, ml.FEATURES, LABEL)
    whole = Counter((*map(float, r[2:6]), float(r[6])) for r in rows)
    seen = Counter()
    for r in data.collect():
        assert r.weight == int(r.weight) >= 1
        seen[(*r.features.toArray().tolist(), r.label)] += int(r.weight)
    assert seen == whole and data.count() == sum(min(n, 10) for n in whole.values()) < 400
    data.unpersist()
    fitted = ml.fit_models(df, estimators=trees, folds=3)
    assert [(n, k) for n, k, _ in fitted.cross_validation] == [(n, k) for n, k, _ in plain.cross_validation]
    assert [a for *_, a in fitted.cross_validation] == pytest.approx([a for *_, a in plain.cross_validation])
    assert fitted.models["lr"].coefficients.toArray() == pytest.approx(plain.models["lr"].coefficients.toArray(), abs=1e-6)
    assert fitted.models["tree"].toDebugString.split("\n")[1:] == plain.models["tree"].toDebugString.split("\n")[1:]
    assert ml.grid_search(trees["tree"], combos, df, df).orderBy("combination").collect() == grid


def test_estimators_without_weights_are_given_single_rows(spark, monkeypatch):
    df = spark.createDataFrame([(i, i % 2, i % 2) for i in range(60)], "AccountNumber int, a int, y int")
    monkeypatch.setattr(ml, "ROWS_PER_PARTITION", 10)
    data = ml.assembled(df, ["a"], "y", weighted=False)
    assert data.count() == 60 and {r.weight for r in data.collect()} == {1.0}
    assert not ml.takes_weights(FMClassifier()) and ml.fit_models(df, ["a"], "y", {"fm": FMClassifier(maxIter=2)}, folds=2, key=["AccountNumber"]).cross_validation


def test_forest_grid_fits_counted_rows_and_counts_all(spark, monkeypatch):
    df = spark.range(2000).selectExpr("cast(id % 2 as int) as a", "cast(id % 3 as int) as b", "cast(id % 6 > 2 as int) as y")
    monkeypatch.setattr(ml, "ROWS_PER_PARTITION", 100)
    monkeypatch.setattr(ml, "UNITS", 20)
    sizes = []

    def recorded(*args):
        data = ml.assembled(*args)
        sizes.append(data.count())
        return data
    monkeypatch.setattr(forests, "assembled", recorded)
    found = forests.forest_grid_search({"numTrees": (3,), "maxDepth": (1, 3), "minInstancesPerNode": (2,)}, df, df, ["a", "b"], "y").collect()
    assert sizes == [6 * 20] and len(found) == 2 and max(r.test_accuracy for r in found) == 1.0


def test_forest_grid_reads_a_large_train_set_once(spark, monkeypatch, tmp_path):
    df = spark.range(2000).selectExpr("cast(id % 2 as int) as a", "cast(id % 3 as int) as b", "cast(if(id % 7 = 0, null, id % 6 > 2) as int) as y")
    df.write.parquet(str(tmp_path / "train"))
    monkeypatch.setattr(ml, "ROWS_PER_PARTITION", 100)
    train = spark.read.parquet(str(tmp_path / "train")).filter("y is not null")
    grid = {"numTrees": (3,), "maxDepth": (1, 3), "minInstancesPerNode": (2,)}
    found = forests.forest_grid_search(grid, train, df, ["a", "b"], "y")
    assert not [f for f in found.inputFiles() if str(tmp_path) in f]
    assert {(r.train_accuracy, r.test_accuracy) for r in found.filter("params like '%maxDepth=3%'").collect()} == {(1.0, 1.0)}
