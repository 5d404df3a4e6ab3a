"""Model evaluation and feature statistics, each as one or two aggregates."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from itertools import combinations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.scalars import logistic, right_closed_bin
from riskspark.functions.special import f_tail
from riskspark.operators.keyed import running_totals
from riskspark.operators.scoring import LogitModel

# Probability classes, cure rate, comparison mean, correlation limit.
SCORE_EDGES = (0, 0.28, 0.36, 0.46, 0.58, 0.71, 1)
CURE_RATE = 0.055
COMPARISON_MEAN_PD = 0.041118483857453376
HIGH_CORRELATION = 0.85


def confusion_counts(label: Column, prediction: Column, suffix: str = "", weight: Column | None = None) -> list[Column]:
    """Counts of rows or, with `weight`, of the rows that each one stands for."""
    def count(of: Column) -> Column:
        return F.count_if(of) if weight is None else F.coalesce(F.sum(F.when(of, weight)), F.lit(0)).cast("long")

    return [
        count((label == 1) & (prediction == 1)).alias(f"tp{suffix}"),
        count((label == 0) & (prediction == 1)).alias(f"fp{suffix}"),
        count((label == 1) & (prediction == 0)).alias(f"fn{suffix}"),
        count((label == 0) & (prediction == 0)).alias(f"tn{suffix}"),
    ]


def rates_from_counts(df: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from tp, fp, fn, tn; an empty denominator gives 0."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))

    def share(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return df.withColumns({
        "accuracy": share(tp + tn, tp + fp + fn + tn), "precision": share(tp, tp + fp),
        "recall": share(tp, tp + fn), "f1": share(2 * tp, 2 * tp + fp + fn),
    })


def classification_metrics(df: DataFrame, label: str, prediction: str, *by: str) -> DataFrame:
    """Confusion counts with shares, accuracy, precision, recall, F1; e.g. by Split."""
    counts = df.groupBy(*by).agg(*confusion_counts(F.col(label), F.col(prediction)))
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    shares = {f"{c}_pct": F.try_divide(F.col(c) * 100.0, total) for c in ("tp", "fp", "fn", "tn")}
    return rates_from_counts(counts).withColumns(shares)


def score_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score, within groups `by`: positives and negatives at it (pos, neg), at or below it
    (cum_*) and of all (total_*).

    Rows whose score is NULL or NaN have no place in the order and are left out.
    """
    rows = df.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isNotNull())
    per_score = rows.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    return running_totals(per_score, ["score"], ["pos", "neg"], by)


def _true_false_positives() -> tuple[Column, Column, Column, Column]:
    """Of a curve's row: true and false positives at its threshold, and all positives and negatives."""
    p, n = F.col("total_pos").cast("double"), F.col("total_neg").cast("double")
    return p - (F.col("cum_pos") - F.col("pos")), n - (F.col("cum_neg") - F.col("neg")), p, n


def roc_points(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """False and true positive rate at each threshold (score >= threshold counts as positive)."""
    tp, fp, p, n = _true_false_positives()
    return score_curve(df, label, score, by).select(*by, F.col("score").alias("threshold"), F.try_divide(fp, n).alias("fpr"), F.try_divide(tp, p).alias("tpr"))


def precision_recall_points(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    tp, fp, p, _ = _true_false_positives()
    return score_curve(df, label, score, by).select(
        *by, F.col("score").alias("threshold"), F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, p).alias("recall"))


def curve_figures(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Per group, from one curve: area under the ROC curve by trapezoids over score groups, Gini, and average precision.

    Average precision sums, from the highest score, the gain in recall times precision. With a single class the area
    and Gini are NULL.
    """
    tp, fp, p, n = _true_false_positives()
    below = F.col("cum_neg") - F.col("neg") + F.col("neg") / 2
    step = F.try_divide(F.col("pos").cast("double"), p) * F.try_divide(tp, tp + fp)
    curve = score_curve(df, label, score, by)
    sums = (curve.groupBy(*by) if by else curve).agg(
        F.sum(F.col("pos") * below).alias("area"), F.max(p).alias("p"), F.max(n).alias("n"), F.sum(step).alias("average_precision"))
    auc = F.try_divide(F.col("area"), F.col("p") * F.col("n"))
    return sums.select(*by, auc.alias("auc"), (2 * auc - 1).alias("gini"), "average_precision")


def roc_auc_gini(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve and Gini; NULL with a single class."""
    return curve_figures(df, label, score).select("auc", "gini")


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    return curve_figures(df, label, score).select("average_precision")


def compare_scores(df: DataFrame, label: str, scores: Sequence[str]) -> DataFrame:
    """AUC, Gini and average precision of several scores on the same rows, from one grouped curve."""
    long = df.select(label, F.inline(F.array(*[F.struct(F.lit(s).alias("score_name"), F.col(s).cast("double").alias("value")) for s in scores])))
    return curve_figures(long, label, "value", ["score_name"])


def score_bins(df: DataFrame, score: str, edges: Sequence[float] = SCORE_EDGES, output: str = "Probability_Bins") -> DataFrame:
    """Class of a probability; intervals are closed on the right, so 0 has no class."""
    return df.withColumn(output, right_closed_bin(F.col(score), edges))


def histogram_by_class(df: DataFrame, label: str, score: str, bins: int = 30) -> DataFrame:
    """Density of a score per class (0 and 1) in `bins` equal bins over the class's own range, empty bins included.

    The ranges are a scalar subquery: joining them back on the class would put half of all rows on one key.
    """
    rows = df.filter(F.col(label).isin(0, 1) & F.col(score).isNotNull()).select(label, F.col(score).cast("double").alias("x"))
    in_class = {k: F.when(F.col(label) == k, F.col("x")) for k in (0, 1)}
    stats = rows.agg(F.struct(*[f(x).alias(f"{n}{k}") for k, x in in_class.items()
                                for n, f in (("lo", F.min), ("hi", F.max), ("total", F.count))])).scalar()

    def of_class(name: str) -> Column:
        return F.when(F.col(label) == 1, stats.getField(f"{name}1")).otherwise(stats.getField(f"{name}0"))

    # A constant score gets a range of width one around it.
    half = F.when(of_class("hi") == of_class("lo"), 0.5).otherwise(0.0)
    lo, span = of_class("lo") - half, of_class("hi") - of_class("lo") + 2 * half
    width = span / bins
    index = F.least(F.floor((F.col("x") - lo) / span * bins), F.lit(bins - 1)).cast("int")
    counts = rows.groupBy(label, index.alias("bin")).agg(F.count("*").alias("n"))
    grid = counts.select(label).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    n = F.coalesce(F.col("n"), F.lit(0))
    return grid.join(counts, [label, "bin"], "left").select(
        label, "bin", (lo + F.col("bin") * width).alias("left_edge"), n.alias("n"), (n / (of_class("total") * width)).alias("density"))


def column_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, maximum and mean per column."""
    numbers = [F.struct(F.lit(c).alias("column"), F.min(F.col(c).cast("double")).alias("min"),
                        F.max(F.col(c).cast("double")).alias("max"), F.avg(F.col(c).cast("double")).alias("mean"))
               for c in columns]
    return df.agg(F.array(*numbers).alias("s")).select(F.inline("s"))


def null_columns(df: DataFrame) -> DataFrame:
    """Columns holding NULLs, with their number."""
    counts = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(f"`{c}`").isNull()).alias("nulls")) for c in df.columns]
    return df.agg(F.array(*counts).alias("s")).select(F.inline("s")).filter("nulls > 0")


def correlation_matrix(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pearson correlation of each pair of features; one row per unordered pair.

    Features without NULLs go through Spark ML's correlation of vectors, whose plan is the same for any number of
    them: each task adds up its rows' products, and the driver gets one number a pair. Pairs with a feature that has
    NULLs are taken over the rows that have both, an aggregate each. A constant feature has no correlation (NULL).
    """
    nulls = df.agg(*[F.count_if(F.col(f).isNull()).alias(f) for f in features], F.count("*").alias("__rows")).first().asDict()
    whole = [f for f in features if not nulls[f]]
    known: dict[tuple[str, str], float | None] = {}
    if nulls["__rows"] > 1 and len(whole) > 1:
        vectors = df.select(array_to_vector(F.array(*[F.col(f).cast("double") for f in whole])).alias("v"))
        values = Correlation.corr(vectors, "v").first()[0].toArray()
        place = {f: i for i, f in enumerate(whole)}
        known = {(a, b): float(values[place[a], place[b]]) for a, b in combinations(whole, 2)}
    schema = "feature_a string, feature_b string, correlation double"
    found = df.sparkSession.createDataFrame([(a, b, None if math.isnan(v) else v) for (a, b), v in known.items()], schema)
    rest = [(a, b) for a, b in combinations(features, 2) if (a, b) not in known]
    if not rest:
        return found

    def pearson(a: str, b: str) -> Column:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = (F.when(both, F.col(c).cast("double")) for c in (a, b))
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    pairs = [F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), pearson(a, b).alias("correlation")) for a, b in rest]
    return found.unionByName(df.agg(F.array(*pairs).alias("s")).select(F.inline("s")))


def highly_correlated(df: DataFrame, features: Sequence[str], limit: float = HIGH_CORRELATION) -> DataFrame:
    """Features correlated above `limit`, and below 1, with some other feature."""
    high = correlation_matrix(df, features).filter((F.col("correlation") > limit) & (F.col("correlation") < 1))
    return high.select(F.explode(F.array("feature_a", "feature_b")).alias("feature")).distinct()


def feature_statistics(df: DataFrame, features: Sequence[str], label: str, *by: str) -> DataFrame:
    """(by, feature, class, n, mean, m2, lo, hi): per feature and class the count, mean, summed squared deviations and range.

    One aggregate over the rows in long form, combined before the shuffle; its plan is the same for any number of
    features. NULL values and rows without a label are left out. `merged_statistics` puts parts together.
    """
    values = F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features]))
    long = df.filter(F.col(label).isNotNull()).select(*by, F.col(label).alias("class"), values).filter(F.col("x").isNotNull())
    return long.groupBy(*by, "feature", "class").agg(
        F.count("*").alias("n"), F.avg("x").alias("mean"), (F.var_pop("x") * F.count("*")).alias("m2"), F.min("x").alias("lo"), F.max("x").alias("hi"))


def merged_statistics(parts: DataFrame, *by: str) -> DataFrame:
    """The statistics of all parts together, such as one for each month; `by` are columns to keep apart."""
    one = F.collect_list(F.struct("n", "mean", "m2"))

    def merge(a: Column, b: Column) -> Column:
        n, gap = a["n"] + b["n"], b["mean"] - a["mean"]
        m2 = a["m2"] + b["m2"] + gap * gap * a["n"] * b["n"] / n
        return F.struct(n.alias("n"), (a["mean"] + gap * b["n"] / n).alias("mean"), m2.alias("m2"))

    rows = parts.groupBy(*by, "feature", "class").agg(F.sort_array(one).alias("parts"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    total = F.aggregate(F.slice("parts", F.lit(2), F.size("parts")), F.get("parts", F.lit(0)), merge)
    rows = rows.withColumn("all", total)
    return rows.select(*by, "feature", "class", "all.n", "all.mean", "all.m2", "lo", "hi")


def anova_from_statistics(stats: DataFrame) -> DataFrame:
    """(feature, f_score, p_value): one-way F statistic over the classes and the chance of a larger one."""
    classes = stats.groupBy("feature").agg(F.sort_array(F.collect_list(F.struct("n", "mean", "m2"))).alias("classes"))

    def total(of: Callable[[Column], Column]) -> Column:
        return F.aggregate("classes", F.lit(0.0), lambda a, c: a + of(c))

    n, k = total(lambda c: c["n"].cast("double")), F.size("classes")
    # Means are taken from the first class's, so that a large common part drops out before it is squared.
    origin = F.element_at("classes", 1)["mean"]
    centre = total(lambda c: c["n"] * (c["mean"] - origin)) / n
    between = total(lambda c: c["n"] * F.pow(c["mean"] - origin - F.col("centre"), F.lit(2.0)))
    error = total(lambda c: c["m2"])
    f_value = F.when(k > 1, F.try_divide(between / (k - 1), error / (n - k)))
    out = classes.withColumn("centre", centre).select("feature", f_value.alias("f_score"), (k - 1).alias("k1"), (n - k).alias("nk"))
    return out.select("feature", "f_score", f_tail(F.col("f_score"), F.col("k1"), F.col("nk")).alias("p_value"))


def anova_f(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One-way F statistic of each feature over the classes.

    From each class's count, mean and squared deviations, which merge without the cancelling that sums of squares
    suffer on large means.
    """
    return anova_from_statistics(feature_statistics(df, features, label)).select("feature", "f_score")


def anova_p_values(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """F statistic and p-value (rounded to 10 digits) per feature."""
    return anova_from_statistics(feature_statistics(df, features, label)).withColumn("p_value", F.round("p_value", 10))


def top_features(stats: DataFrame, n: int = 20) -> DataFrame:
    """The `n` features with the largest F statistic, largest first; ties by name."""
    return anova_from_statistics(stats).orderBy(F.col("f_score").desc_nulls_last(), "feature").limit(n)


def scaled_by_statistics(df: DataFrame, features: Sequence[str], stats: DataFrame) -> DataFrame:
    """Features scaled to 0 to 1 by the ranges in their statistics; a constant one becomes 0."""
    ranges = stats.groupBy("feature").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    of = ranges.agg(F.map_from_entries(F.collect_list(F.struct("feature", F.struct("lo", "hi"))))).scalar()
    r = lambda f: F.element_at(F.col("__ranges"), F.lit(f))
    scaled = {f: F.coalesce(F.try_divide(F.col(f).cast("double") - r(f)["lo"], r(f)["hi"] - r(f)["lo"]), F.when(F.col(f).isNotNull(), 0.0)) for f in features}
    return df.withColumn("__ranges", of).withColumns(scaled).drop("__ranges")


def feature_importance_rank(importances: DataFrame, drop: Sequence[str] = ("AccountNumber", "Gender", "degenerate_application_id")) -> DataFrame:
    """Normalise each method's importances to sum 1, add them per feature, largest first."""
    sums = importances.groupBy("method").agg(F.sum("importance").alias("__sum"))
    norm = importances.join(sums, "method").filter(~F.col("feature").isin(*drop))
    total = norm.groupBy("feature").agg(F.sum(F.try_divide(F.col("importance"), F.col("__sum"))).alias("cumulative_importance"))
    return total.orderBy(F.col("cumulative_importance").desc(), "feature")


def cure_adjusted_pd(df: DataFrame, score: str, cure_rate: float = CURE_RATE, code: str = "CurrentDelinquencyStatus") -> DataFrame:
    """Mean probability and mean less cures, for accounts past 30 days and the others.

    `gap` compares with the portfolio's reference mean: (1 + reference) / (1 + mean less cures).
    """
    group = F.when(F.col(code) > 1, "past_30").when(F.col(code) < 2, "up_to_30")
    means = df.groupBy(group.alias("group")).agg(F.avg(score).alias("mean_pd")).filter(F.col("group").isNotNull())
    cured = F.col("mean_pd") * (1 - cure_rate)
    return means.select("group", "mean_pd", cured.alias("mean_pd_cured"), ((1 + COMPARISON_MEAN_PD) / (1 + cured)).alias("gap"))


def partial_response(df: DataFrame, model: LogitModel, divisors: Mapping[str, int | None], steps: int = 100) -> DataFrame:
    """Probability as one feature moves over a grid and the others stay at their mean.

    A feature's grid is int(i x max / divisor) for i < steps; without divisor it alternates 0 and 1.
    """
    stats = df.agg(F.struct(*[F.avg(f).alias(f"mean_{f}") for f in model.features],
                            *[F.max(f).cast("double").alias(f"max_{f}") for f in model.features])).scalar()
    grid = df.sparkSession.range(steps).select(F.col("id").cast("int").alias("i"), stats.alias("s"))
    weights = dict(zip(model.features, model.coefficients, strict=True))
    rows = []
    for f in model.features:
        div = divisors.get(f)
        value = (F.col("i") % 2).cast("double") if div is None else F.floor(F.col("i") * F.col(f"s.max_{f}") / div).cast("double")
        z = F.lit(model.intercept) + value * weights[f]
        for other in model.features:
            if other != f:
                z = z + F.col(f"s.mean_{other}") * weights[other]
        rows.append(F.struct(F.lit(f).alias("feature"), value.alias("value"), logistic(z).alias("P")))
    return grid.select("i", F.inline(F.array(*rows)))
