"""Model evaluation and development."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from riskspark.catalog.registry import query
from riskspark.functions.scalars import min_max_scale
from riskspark.operators import metrics as m
from riskspark.operators import modelling as ml
from riskspark.operators.forests import forest_grid_search
from riskspark.operators.scoring import BEHAVIOUR
from riskspark.plans.development import training_set
from riskspark.session import materialise

LABEL = "Ever90_12M"
# Stated here on their own: the features of the behaviour model and their weights.
WEIGHTS = {"CoappFlag": -0.44414603, "Ever30In6Months": 0.18778622, "WorstDelinquency6M": 0.3539554, "CurrentDelinquencyStatus": 0.70178643}
FEATURES = list(WEIGHTS)


def _rounded(df, *columns, digits=9):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _curve(s: str) -> str:
    return f"""
 g as (select {s} as score, count(*) filter (Ever90_12M = 1) as pos, count(*) filter (Ever90_12M = 0) as neg from model_tape group by 1),
 c as (select *, cast(sum(pos) over w as double) as tp, cast(sum(neg) over w as double) as fp,
     cast(sum(pos) over () as double) as p, cast(sum(neg) over () as double) as n
   from g window w as (order by score desc rows unbounded preceding))"""


AUC = "sum(neg * (tp - pos + pos / 2.0)) / (max(p) * max(n))"
AP = "sum(pos / p * tp / (tp + fp))"


@query("classification_metrics", """
  with x as (select Ever90_12M as y, case when Probability_model > 0.36 then 1 else 0 end as z, Stage from model_tape),
  c as (select Stage, count(*) filter (y = 1 and z = 1) as tp, count(*) filter (y = 0 and z = 1) as fp, count(*) filter (y = 1 and z = 0) as fn,
    count(*) filter (y = 0 and z = 0) as tn from x group by 1)
  select *, round((tp + tn) / (tp + fp + fn + tn), 9) as accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 9) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 9) as recall,
    round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) as f1, round(tp * 100.0 / (tp + fp + fn + tn), 6)::double as tp_pct, round(fp * 100.0 / (tp + fp + fn + tn), 6)::double as fp_pct,
    round(fn * 100.0 / (tp + fp + fn + tn), 6)::double as fn_pct, round(tn * 100.0 / (tp + fp + fn + tn), 6)::double as tn_pct from c""", "model_tape")
def classification_metrics(t):
    df = t.model_tape.withColumn("prediction", F.when(F.col("Probability_model") > 0.36, 1).otherwise(0))
    out = m.classification_metrics(df, LABEL, "prediction", "Stage")
    return _rounded(_rounded(out, "accuracy", "precision", "recall", "f1"), "tp_pct", "fp_pct", "fn_pct", "tn_pct", digits=6)


@query("roc_points", "with " + _curve("Probability_model") + " select score as threshold, round(fp / n, 9) as fpr, round(tp / p, 9) as tpr from c", "model_tape")
def roc_points(t):
    return _rounded(m.roc_points(t.model_tape, LABEL, "Probability_model"), "fpr", "tpr")


@query("precision_recall_points", "with " + _curve("Probability_model") + " select score as threshold, round(tp / (tp + fp), 9) as precision, round(tp / p, 9) as recall from c", "model_tape")
def precision_recall_points(t):
    return _rounded(m.precision_recall_points(t.model_tape, LABEL, "Probability_model"), "precision", "recall")


@query("roc_auc_gini", "with " + _curve("Probability_model") + f" select round({AUC}, 9) as auc, round(2 * {AUC} - 1, 9) as gini from c", "model_tape")
def roc_auc_gini(t):
    return _rounded(m.roc_auc_gini(t.model_tape, LABEL, "Probability_model"), "auc", "gini")


@query("average_precision", "with " + _curve("Probability_model") + f" select round({AP}, 9) as average_precision from c", "model_tape")
def average_precision(t):
    return _rounded(m.average_precision(t.model_tape, LABEL, "Probability_model"), "average_precision")


def _one(s: str) -> str:
    return f"(with {_curve(s)} select '{s}' as score_name, round({AUC}, 9) as auc, round(2 * {AUC} - 1, 9) as gini, round({AP}, 9) as average_precision from c)"


@query("compare_scores", f"select * from {_one('Probability_model')} union all select * from {_one('Score')}", "model_tape")
def compare_scores(t):
    return _rounded(m.compare_scores(t.model_tape, LABEL, ["Probability_model", "Score"]), "auc", "gini", "average_precision")


@query("score_bins", """select Probability_Bins, count(*) as count from (select case when x > 0 and x <= 0.28 then 0 when x <= 0 then null when x <= 0.36 then 1 when x <= 0.46 then 2
    when x <= 0.58 then 3 when x <= 0.71 then 4 when x <= 1 then 5 end as Probability_Bins from (select Probability_model as x from model_tape) y) z group by 1""", "model_tape")
def score_bins(t):
    return m.score_bins(t.model_tape, "Probability_model").groupBy("Probability_Bins").count()


@query("histogram_by_class", """
  with s as (select Ever90_12M, min(Probability_model) as lo, max(Probability_model) as hi, count(*) as total from model_tape group by 1),
  b as (select m.Ever90_12M, least(floor((Probability_model - lo) / (hi - lo) * 30), 29)::int as bin, count(*) as n from model_tape m join s on s.Ever90_12M = m.Ever90_12M group by 1, 2),
  g as (select s.*, cast(unnest(generate_series(0, 29)) as int) as bin from s)
  select g.Ever90_12M, g.bin, round(lo + g.bin * ((hi - lo) / 30), 9) as left_edge, coalesce(n, 0) as n, round(coalesce(n, 0) / (total * ((hi - lo) / 30)), 9) as density
  from g left join b on b.Ever90_12M = g.Ever90_12M and b.bin = g.bin""", "model_tape")
def histogram_by_class(t):
    return _rounded(m.histogram_by_class(t.model_tape, LABEL, "Probability_model"), "left_edge", "density")


@query("column_summary", " union all ".join(f"select '{c}' as column, min({c})::double as min, max({c})::double as max, round(avg({c}::double), 9) as mean from model_tape" for c in ("MOB", "Score")), "model_tape")
def column_summary(t):
    return _rounded(m.column_summary(t.model_tape, ["MOB", "Score"]), "mean")


@query("null_columns", " union all ".join(f"(select '{c}' as column, count(*) filter ({c} is null) as nulls from credit_reports having count(*) filter ({c} is null) > 0)" for c in (
    "SSN", "UCScore", "Inquiries12M", "MortgageLoansHouseVolume", "MortgageLoansApartmentVolume", "UtilizationRatio", "CapitalDeficit", "IndebtednessRatio", "PaymentRemarksNo", "AvgUtilizationRatio12M")), "credit_reports")
def null_columns(t):
    return m.null_columns(t.credit_reports)


CORR = " union all ".join(f"select '{a}' as feature_a, '{b}' as feature_b, round(corr({a}, {b}), 6) as correlation from model_tape" for a, b in combinations(FEATURES, 2))


@query("correlation_matrix", CORR, "model_tape")
def correlation_matrix(t):
    return _rounded(m.correlation_matrix(t.model_tape, FEATURES), "correlation", digits=6)


@query("highly_correlated", f"select distinct unnest([feature_a, feature_b]) as feature from ({CORR}) x where correlation > 0.85 and correlation < 1", "model_tape")
def highly_correlated(t):
    return m.highly_correlated(t.model_tape, FEATURES)


def _anova(f: str) -> str:
    return f"""(select '{f}' as feature, sum(n * (mean - overall) * (mean - overall)) / (count(*) - 1) / (sum(ss) / (sum(n) - count(*))) as f_score
  from (select count(*) as n, avg({f}) as mean, var_pop({f}) * count(*) as ss, (select avg({f}) from model_tape) as overall from model_tape group by Ever90_12M) x)"""


@query("anova_f", "select feature, round(f_score, 4) as f_score from (" + " union all ".join(f"select * from {_anova(f)}" for f in FEATURES) + ") y", "model_tape")
def anova_f(t):
    return _rounded(m.anova_f(t.model_tape, FEATURES, LABEL), "f_score", digits=4)


@query("feature_importance_rank", "with imp as (select 'ANOVA' as method, feature, f_score as importance from (" + " union all ".join(f"select * from {_anova(f)}" for f in FEATURES) + """) y
  union all """ + " union all ".join(f"select 'CORR', '{f}', abs(corr({f}, Ever90_12M)) from model_tape" for f in FEATURES) + """)
  select feature, round(sum(importance / total), 6) as cumulative_importance from imp join (select method, sum(importance) as total from imp group by 1) s on s.method = imp.method group by 1""", "model_tape")
def feature_importance_rank(t):
    anova = m.anova_f(t.model_tape, FEATURES, LABEL).select(F.lit("ANOVA").alias("method"), "feature", F.col("f_score").alias("importance"))
    row = t.model_tape.agg(*[F.abs(F.corr(F.col(f).cast("double"), F.col(LABEL).cast("double"))).alias(f) for f in FEATURES])
    corr = row.unpivot([], FEATURES, "feature", "importance").select(F.lit("CORR").alias("method"), "feature", "importance")
    return _rounded(m.feature_importance_rank(anova.unionByName(corr)), "cumulative_importance", digits=6)


@query("cure_adjusted_pd", """select "group", round(p, 9) as mean_pd, round(p * 0.945, 9) as mean_pd_cured, round((1 + 0.041118483857453376) / (1 + p * 0.945), 9) as gap
  from (select case when CurrentDelinquencyStatus > 1 then 'past_30' else 'up_to_30' end as "group", avg(Probability_model) as p from model_tape group by 1) x""", "model_tape")
def cure_adjusted_pd(t):
    return _rounded(m.cure_adjusted_pd(t.model_tape, "Probability_model"), "mean_pd", "mean_pd_cured", "gap")


DIVISORS = {"CoappFlag": None, "Ever30In6Months": 20, "WorstDelinquency6M": 30, "CurrentDelinquencyStatus": 50}


def _response(f: str) -> str:
    value = "(i % 2)::double" if DIVISORS[f] is None else f"floor(i * max_{f}::double / {DIVISORS[f]})"
    others = " + ".join(f"mean_{o} * {w}" for o, w in WEIGHTS.items() if o != f)
    weight = WEIGHTS[f]
    return f"select i::int as i, '{f}' as feature, {value} as value, round(1 / (1 + exp(-({value} * {weight} + {others}))), 9) as P from range(100) g(i), s"


@query("partial_response", "with s as (select " + ", ".join(f"avg({f}) as mean_{f}, max({f}) as max_{f}" for f in FEATURES) + " from model_tape) " + " union all ".join(_response(f) for f in FEATURES), "model_tape")
def partial_response(t):
    return _rounded(m.partial_response(t.model_tape, BEHAVIOUR, DIVISORS), "P")


def _parts(t):
    tape = materialise(t.model_tape.select("AccountNumber", "MOB", "SnapshotDate", "DisbursedDate", *FEATURES, LABEL), "tape")
    train, _, validation = training_set(tape)
    return train, validation


@query("fit_models")
def fit_models(t):
    """Held-out accuracy per model and fold."""
    train = _parts(t)[0]
    fitted = ml.fit_models(train, estimators=ml.default_estimators(train.count()))
    return t.spark.createDataFrame(fitted.cross_validation, "Model string, CrossValidation int, Accuracy double")


@query("model_feature_importance")
def model_feature_importance(t):
    """Models on scaled features, and the F statistic, added up per feature."""
    train = materialise(min_max_scale(_parts(t)[0], FEATURES), "scaled")
    fitted = ml.fit_models(train, estimators=ml.importance_estimators(train.count()), folds=0)
    anova = m.anova_f(train, FEATURES, LABEL).select(F.lit("ANOVA").alias("method"), "feature", F.col("f_score").alias("importance"))
    return m.feature_importance_rank(ml.model_importances(fitted.models, FEATURES, t.spark).unionByName(anova))


@query("fitted_probability")
def fitted_probability(t):
    train, validation = _parts(t)
    model = ml.fit_models(train, estimators={"lr": ml.default_estimators(train.count())["LogisticRegression"]}, folds=0).models["lr"]
    return ml.default_probability(model, validation).select("AccountNumber", "SnapshotDate", "Probability_model", "prediction")


@query("grid_search")
def grid_search(t):
    train, validation = _parts(t)
    return ml.rank_grid(forest_grid_search(ml.FOREST_GRID, train, validation))


@query("rank_grid", """
  with x as (select o_custkey::int as combination, count(*) filter (o_orderstatus = 'F') / count(*) as a, count(*) filter (o_orderstatus = 'O') / count(*) as b,
      count(*) filter (o_orderpriority = '1-URGENT') / count(*) as c from orders group by 1),
  g as (select combination, a as train_accuracy, b as train_precision, c as train_recall, (a + b) / 2 as train_f1, b as test_accuracy, c as test_precision, a as test_recall, (b + c) / 2 as test_f1,
      sqrt((a - b) * (a - b) + (b - c) * (b - c) + (c - a) * (c - a) + ((a + b) / 2 - (b + c) / 2) * ((a + b) / 2 - (b + c) / 2)) as metric_distance from x),
  top as (select * from g order by test_precision desc, combination desc limit 3000),
  s as (select min(metric_distance) as l1, max(metric_distance) as h1, min(test_f1) as l2, max(test_f1) as h2, min(train_accuracy) as l3, max(train_accuracy) as h3 from top)
  select combination, round(((1 - (metric_distance - l1) / (h1 - l1)) * 0.5 + (test_f1 - l2) / (h2 - l2) + (train_accuracy - l3) / (h3 - l3) * 0.5) / 3, 9) as objective
  from top, s order by ((1 - (metric_distance - l1) / (h1 - l1)) * 0.5 + (test_f1 - l2) / (h2 - l2) + (train_accuracy - l3) / (h3 - l3) * 0.5) / 3 desc, combination desc limit 1000""")
def rank_grid(t):
    def share(cond):
        return F.count_if(cond) / F.count("*")

    x = t.orders.groupBy(F.col("o_custkey").cast("int").alias("combination")).agg(
        share(F.col("o_orderstatus") == "F").alias("a"), share(F.col("o_orderstatus") == "O").alias("b"), share(F.col("o_orderpriority") == "1-URGENT").alias("c"))
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    rates = {"train": (a, b, c, (a + b) / 2), "test": (b, c, a, (b + c) / 2)}
    long = None
    for part, values in rates.items():
        df = x.select("combination", F.lit("").alias("params"), F.lit(part).alias("part"), *[v.alias(n) for n, v in zip(ml.METRICS, values)])
        long = df if long is None else long.unionByName(df)
    return _rounded(ml.rank_grid(ml.metric_distance(long)).select("combination", "objective"), "objective")
