"""The development chain: fit, metrics by split, calibration, stored models, statistics of all tape columns."""

from __future__ import annotations

import uuid
from itertools import combinations

from pyspark.sql import functions as F

from riskspark.catalog.outcomes import CLEAN, FEATURE_USES, _hash, _sample
from riskspark.catalog.registry import query
from riskspark.functions.dates import year_month
from riskspark.operators import logistic as lg
from riskspark.operators import metrics as m
from riskspark.operators import modelling as ml
from riskspark.operators import sampling as s
from riskspark.operators.delinquency import delinquency_features
from riskspark.operators.scoring import BEHAVIOUR
from riskspark.plans import development, monthly
from riskspark.session import materialise, shared_folder

LABEL = "Ever90_12M"
ROUNDS = 12


def newton(data: str, ridge: list[float], name: str) -> str:
    """CTEs that end in `name`(b1 .. bk): Newton steps from 0 for rows (x1 .. xk, y, w) of `data`, unrolled.

    Each round sums gradient and curvature, eliminates, and solves backwards.
    """
    k = len(ridge)
    at = range(1, k + 1)
    out = [f"{name}_0 as (select {', '.join(f'0.0::double as b{i}' for i in at)})"]
    for r in range(1, ROUNDS + 1):
        z = " + ".join(f"b{i} * x{i}" for i in at)
        sums = [f"sum(w * (y - p) * x{i}) - {ridge[i - 1]!r} * max(b{i}) as c{i}" for i in at]
        sums += [f"sum(w * p * (1 - p) * x{i} * x{j}) + {ridge[i - 1] if i == j else 0.0!r} as a{i}_{j}" for i in at for j in at if i <= j]
        out.append(f"{name}_{r}_0 as (select {', '.join(sums)} from (select d.*, b.*, 1 / (1 + exp(-({z}))) as p from {data} d, {name}_{r - 1} b) q)")
        for p in range(1, k):
            cols = [f"c{i} - a{p}_{i} * c{p} / a{p}_{p} as c{i}" if i > p else f"c{i}" for i in at]
            cols += [f"a{i}_{j} - a{p}_{i} * a{p}_{j} / a{p}_{p} as a{i}_{j}" if i > p else f"a{i}_{j}" for i in at for j in at if i <= j]
            out.append(f"{name}_{r}_{p} as (select {', '.join(cols)} from {name}_{r}_{p - 1})")
        solved = f"select *, c{k} / a{k}_{k} as d{k} from {name}_{r}_{k - 1}"
        for i in range(k - 1, 0, -1):
            rest = " - ".join(f"a{i}_{j} * d{j}" for j in range(i + 1, k + 1))
            solved = f"select *, (c{i} - {rest}) / a{i}_{i} as d{i} from ({solved}) q"
        out.append(f"{name}_{r} as (select {', '.join(f'b{i} + d{i} as b{i}' for i in at)} from ({solved}) q, {name}_{r - 1})")
    out.append(f"{name} as (select * from {name}_{ROUNDS})")
    return ",\n".join(out)


FOUR = "CoappFlag, Ever30In6Months, WorstDelinquency6M, CurrentDelinquencyStatus"
PARTS = f"""
  n as (select *, row_number() over w as rn, sum(Ever90_12M) over (order by AccountNumber, MOB, SnapshotDate rows unbounded preceding) as c, sum(Ever90_12M) over () as total
    from model_tape window w as (order by AccountNumber, MOB, SnapshotDate)),
  cuts as (select min(rn) filter (c >= round_even(total * 0.7, 0)) as c1, min(rn) filter (c >= round_even(total * 0.85, 0)) as c2 from n),
  dealt as (select n.*, case when rn < c1 then 'train' when rn < c2 then 'test' else 'validation' end as Split from n, cuts),
  bad as (select *, row_number() over (partition by ym order by AccountNumber, MOB, SnapshotDate) as i, count(*) over (partition by ym) as m
    from (select *, year(DisbursedDate) * 100 + month(DisbursedDate) as ym from dealt where Split = 'train' and Ever90_12M = 1) q),
  copies as (select {FOUR}, Ever90_12M, Split, unnest(generate_series(1, case when m >= 170 then 1 else 170 // m + case when i <= 170 % m then 1 else 0 end end)) as k from bad),
  parts as materialized (select {FOUR}, Ever90_12M, Split from copies union all select {FOUR}, Ever90_12M, Split from dealt where not (Split = 'train' and Ever90_12M = 1)),
  fit_rows as materialized (select CoappFlag::double as x1, Ever30In6Months::double as x2, WorstDelinquency6M::double as x3, CurrentDelinquencyStatus::double as x4,
    Ever90_12M as y, count(*)::double as w from parts where Split = 'train' group by 1, 2, 3, 4, 5),
  """ + newton("fit_rows", [1000.0] * 4, "beta")
RAW = "1 / (1 + exp(-(b1 * CoappFlag + b2 * Ever30In6Months + b3 * WorstDelinquency6M + b4 * CurrentDelinquencyStatus)))"


def _tape(t):
    return materialise(t.model_tape.select("AccountNumber", "MOB", "SnapshotDate", "DisbursedDate", *ml.FEATURES, LABEL), "tape")


def _rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("model_metrics_by_split", "with " + PARTS + f""",
  scored as (select 'behaviour' as Model, Split, Ever90_12M as y, {RAW} as p from parts, beta
    union all select 'production', Split, Ever90_12M, 1 / (1 + exp(-(-0.44414603 * CoappFlag + 0.18778622 * Ever30In6Months + 0.3539554 * WorstDelinquency6M + 0.70178643 * CurrentDelinquencyStatus))) from parts),
  counts as (select Model, Split, count(*) filter (y = 1 and p > 0.5) as tp, count(*) filter (y = 0 and p > 0.5) as fp, count(*) filter (y = 1 and p <= 0.5) as fn,
    count(*) filter (y = 0 and p <= 0.5) as tn from scored group by 1, 2),
  g as (select Model, Split, p as score, count(*) filter (y = 1) as pos, count(*) filter (y = 0) as neg from scored group by 1, 2, 3),
  c as (select *, cast(sum(pos) over w as double) as tps, cast(sum(neg) over w as double) as fps, cast(sum(pos) over v as double) as ps, cast(sum(neg) over v as double) as ns
    from g window w as (partition by Model, Split order by score desc rows unbounded preceding), v as (partition by Model, Split)),
  figures as (select Model, Split, sum(neg * (tps - pos + pos / 2.0)) / (max(ps) * max(ns)) as auc, sum(pos / ps * tps / (tps + fps)) as ap from c group by 1, 2)
  select Model, Split, tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 9) as accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 9) as precision,
    round(coalesce(tp / nullif(tp + fn, 0), 0), 9) as recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) as f1,
    round(auc, 9) as auc, round(2 * auc - 1, 9) as gini, round(ap, 9) as average_precision from counts join figures using (Model, Split)""", "model_tape")
def model_metrics_by_split(t):
    """The fitted logistic model beside the production coefficients, on the train, test and validation rows."""
    parts = materialise(development.all_parts(_tape(t)), "parts")
    fitted = development.fit_behaviour(parts.filter("Split = 'train'"))
    out = development.metrics_by_split(parts, {"behaviour": fitted, "production": BEHAVIOUR})
    return _rounded(out.drop("tp_pct", "fp_pct", "fn_pct", "tn_pct"), 9, "accuracy", "precision", "recall", "f1", "auc", "gini", "average_precision")


CALIBRATION = newton("calibration_rows", [0.0, 1.0], "calibration")


@query("calibrate", "with calibration_rows as materialized (select 1.0::double as x1, Probability_model as x2, Ever90_12M as y, sum(case when Ever90_12M = 1 then 0.67 else 1.0 end)::double as w from model_tape group by 1, 2, 3),\n"
       + CALIBRATION + """
  select 'calibration' as model, term, round(value, 6) as value from (select unnest(['intercept', 'calibration_coefficient', 'calibration_intercept', 'feature:Probability_model']) as term,
    unnest([b1, 1.0, 0.0, b2]) as value from calibration) q""", "model_tape")
def calibrate(t):
    model = ml.calibrate(t.model_tape)
    return _rounded(lg.model_rows("calibration", 1, model, t.spark).drop("version"), 6, "value")


@query("score_with_trained_model", "with " + PARTS + f""",
  calibration_rows as materialized (select 1.0::double as x1, {RAW} as x2, Ever90_12M as y, sum(case when Ever90_12M = 1 then 0.67 else 1.0 end)::double as w from parts, beta where Split = 'train' group by 1, 2, 3),
  {CALIBRATION}
  select AccountNumber, SnapshotDate, round(P, 6) as P, round(1 / (1 + exp(-(c2 * P + c1))), 6) as Probability_model
  from (select t.AccountNumber, t.SnapshotDate, {RAW} as P, c1, c2 from model_tape t, beta, (select b1 as c1, b2 as c2 from calibration) c
    where t.SnapshotDate = (select max(SnapshotDate) from model_tape)) q""", "model_tape")
def score_with_trained_model(t):
    """Fit and calibrate, store the model, and score the latest snapshot with what the model table then holds."""
    tape, folder = _tape(t), f"{shared_folder(t.spark)}/models-{uuid.uuid4().hex}"
    # An earlier version, with the coefficients in production, that scoring must not use.
    lg.store_model(lg.model_rows(development.NAME, 1, BEHAVIOUR, t.spark), folder)
    development.develop(tape, folder, version=2)
    latest = tape.filter(F.col("SnapshotDate") == tape.agg(F.max("SnapshotDate")).scalar())
    scored = lg.score_with_table(latest, lg.model_table(t.spark, folder), development.NAME, "Probability_model")
    return _rounded(scored.select("AccountNumber", "SnapshotDate", "P", "Probability_model"), 6, "P", "Probability_model")


@query("stratified_fold_sizes", f"""
  with r as (select Ever90_12M, (row_number() over (partition by Ever90_12M order by {_hash('AccountNumber', 'SnapshotDate', '42')}, AccountNumber, SnapshotDate) - 1) % 5 as fold,
    AccountNumber from model_tape)
  select Ever90_12M, cast(fold as int) as fold, count(*) as n, cast(sum(AccountNumber) as bigint) as accounts from r group by 1, 2""", "model_tape")
def stratified_fold_sizes(t):
    folds = s.stratified_folds(t.model_tape.select("AccountNumber", "SnapshotDate", LABEL), LABEL)
    return folds.groupBy(LABEL, "fold").agg(F.count("*").alias("n"), F.sum("AccountNumber").alias("accounts"))


@query("group_index_by_month", """select AccountNumber, MOB, SnapshotDate, YearMonth, cast(row_number() over (partition by YearMonth order by AccountNumber, MOB, SnapshotDate) - 1 as int) as index
  from (select *, cast(year(DisbursedDate) * 100 + month(DisbursedDate) as int) as YearMonth from model_tape) q""", "model_tape")
def group_index_by_month(t):
    rows = t.model_tape.select("AccountNumber", "MOB", "SnapshotDate", year_month(F.col("DisbursedDate")).alias("YearMonth"))
    return s.group_index(rows, "YearMonth")


# All numeric columns of the tape but account, dates and score.
COLUMNS = ["MOB", "CoappFlag", "TimeSince30", "TimeSince60", "Ever30In6Months", "Ever30In12Months", "Ever30", "Ever60In6Months", "Ever60In12Months", "Ever60",
           "WorstDelinquency6M", "WorstDelinquency12M", "WorstDelinquency", "CurrentDelinquencyStatus"]
TAPE = "with sampled as materialized (" + _sample("Ever90 = 0 and AccountStatus = 'OPEN'", "AccountNumber, SnapshotDate", _hash("p.AccountNumber", "p.SnapshotDate", "42"), CLEAN) + ")"
LONG = TAPE + ",\n long as (" + " union all ".join(f"select '{c}' as feature, {c}::double as x, Ever90_12M as class, SnapshotDate from sampled where {c} is not null" for c in COLUMNS) + ")"
CLASSES = """
  classes as (select feature, class, count(*) as n, avg(x) as mean, var_pop(x) * count(*) as ss from long group by 1, 2),
  f as (select c.feature, count(*) as k, sum(n) as n, case when count(*) > 1 and sum(ss) > 0 then sum(n * (mean - overall) * (mean - overall)) / (count(*) - 1) / (sum(ss) / (sum(n) - count(*))) end as f_score
    from classes c join (select feature, avg(x) as overall from long group by 1) o on o.feature = c.feature group by 1)"""
# The F distribution's tail: the continued fraction of the incomplete beta function, on the side where it converges.
P_VALUES = """
  sides as (select *, b1 / (b1 + b2 * f_score) as t, b1 / 2.0 as pa, b2 / 2.0 as pb from (select *, (n - k)::double as b1, (k - 1)::double as b2 from f) q),
  turned as (select feature, f_score, t >= (pa + 1) / (pa + pb + 2) as flip, case when t < (pa + 1) / (pa + pb + 2) then t else b2 * f_score / (b1 + b2 * f_score) end as x,
    case when t < (pa + 1) / (pa + pb + 2) then pa else pb end as a, case when t < (pa + 1) / (pa + pb + 2) then pb else pa end as b from sides),
  tails as (select * from (with recursive steps(feature, x, a, b, i, c, d, h) as (
      select feature, x, a, b, 1, 1.0::double, 1 / (1 - (a + b) * x / (a + 1)), 1 / (1 - (a + b) * x / (a + 1)) from turned where f_score is not null
      union all select feature, x, a, b, i + 1, 1 + e / c, 1 / (1 + e * d), h * (1 + e / c) / (1 + e * d)
      from (select *, case when (i + 1) % 2 = 0 then j * (b - j) * x / ((a + 2 * j - 1) * (a + 2 * j)) else -(a + j) * (a + b + j) * x / ((a + 2 * j) * (a + 2 * j + 1)) end as e
        from (select *, ((i + 1) // 2)::double as j from steps where i < 600) q) q)
    select feature, h from steps where i = 600) q),
  p as (select u.feature, u.f_score, case when flip then 1 - v else v end as p_value from (select r.*, exp(a * ln(x) + b * ln(1 - x) + lgamma(a + b) - lgamma(a) - lgamma(b)) * h / a as v
    from turned r left join tails z on z.feature = r.feature) u)"""


def _sampled(t):
    tape = development.sampled_tape(delinquency_features(t.loan_portfolio, t.applications, t.payment_free_months, t.forbearance))
    return materialise(tape.select("SnapshotDate", *COLUMNS, LABEL), "sampled")


def _statistics(t):
    """Statistics of each month, put together."""
    return m.merged_statistics(materialise(m.feature_statistics(_sampled(t), COLUMNS, LABEL, "SnapshotDate"), "month-statistics"))


@query("tape_statistics", LONG + """
  select feature, class, count(*) as n, round(avg(x), 6) as mean, round(var_pop(x) * count(*), 3) as m2, min(x) as lo, max(x) as hi from long group by 1, 2""", FEATURE_USES)
def tape_statistics(t):
    return _rounded(_rounded(_statistics(t), 6, "mean"), 3, "m2")


@query("tape_anova", LONG + "," + CLASSES + "," + P_VALUES + " select feature, round(f_score, 4) as f_score, round(p_value, 8) as p_value from p", FEATURE_USES)
def tape_anova(t):
    return _rounded(_rounded(m.anova_from_statistics(_statistics(t)), 4, "f_score"), 8, "p_value")


@query("tape_top_features", LONG + "," + CLASSES + " select feature, round(f_score, 4) as f_score from f order by f_score desc nulls last, feature limit 8", FEATURE_USES)
def tape_top_features(t):
    return _rounded(m.top_features(_statistics(t), 8).select("feature", "f_score"), 4, "f_score")


@query("tape_correlations", TAPE + " select * from (" + " union all ".join(f"select '{a}' as feature_a, '{b}' as feature_b, case when not isnan(corr({a}, {b})) then round(corr({a}, {b}), 6) end as correlation from sampled" for a, b in combinations(COLUMNS, 2)) + ") q", FEATURE_USES)
def tape_correlations(t):
    return _rounded(m.correlation_matrix(_sampled(t), COLUMNS), 6, "correlation")


@query("tape_scaled", TAPE + ", r as (select " + ", ".join(f"min({c})::double as lo_{c}, max({c})::double as hi_{c}" for c in COLUMNS) + " from sampled) select SnapshotDate, "
       + ", ".join(f"round(coalesce(({c} - lo_{c}) / nullif(hi_{c} - lo_{c}, 0), case when {c} is not null then 0 end), 9) as {c}" for c in COLUMNS) + " from sampled, r", FEATURE_USES)
def tape_scaled(t):
    sampled = _sampled(t)
    stats = m.merged_statistics(m.feature_statistics(sampled, COLUMNS, LABEL, "SnapshotDate"))
    return _rounded(m.scaled_by_statistics(sampled, COLUMNS, materialise(stats, "statistics")).select("SnapshotDate", *COLUMNS), 9, *COLUMNS)


FS = "(" + " union all ".join(f"select '{f}' as feature, {f}::double as x, Ever90_12M as class from model_tape" for f in ml.FEATURES) + ")"


@query("anova_p_values", f"with long as {FS}," + CLASSES + "," + P_VALUES + " select feature, round(f_score, 4) as f_score, round(p_value, 8) as p_value from p", "model_tape")
def anova_p_values(t):
    return _rounded(_rounded(m.anova_p_values(t.model_tape, list(ml.FEATURES), LABEL), 4, "f_score"), 8, "p_value")


# A month's run knows no later month: only what looks back is compared.
MONTHS = ("2001-05-31", "2001-06-30", "2001-07-31", "2001-08-31")
AHEAD = "After|ExposureAt|TimeToFirst"


@query("monthly_state_features", CLEAN.split(",\n  one_side as", 1)[0] + f" select columns(lambda c: not regexp_matches(c, '{AHEAD}')) from features where SnapshotDate > date '{MONTHS[0]}'", FEATURE_USES)
def monthly_state_features(t):
    """Three monthly runs, each from its month and the state that the one before left."""
    folder, out = f"{shared_folder(t.spark)}/state-{uuid.uuid4().hex}", None
    monthly.start_state(t.loan_portfolio, t.payment_free_months, folder, MONTHS[0])
    for before, month in zip(MONTHS, MONTHS[1:]):
        rows = monthly.run_month(t.loan_portfolio, t.applications, t.payment_free_months, t.forbearance, folder, before, month)
        out = rows if out is None else out.unionByName(rows)
    return out.select(*[c for c in out.columns if not any(a in c for a in AHEAD.split("|"))])
