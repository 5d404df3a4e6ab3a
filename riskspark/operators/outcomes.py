"""Twelve-month outcomes, default rates, cure cohort, samples of account-months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.dates import DateLike, as_date
from riskspark.functions.scalars import rolling_mean
from riskspark.session import materialise


def cure_cohort(monthly: DataFrame, start: DateLike, end: DateLike, code: int = 4) -> DataFrame:
    """Accounts at `code` on the start date, with their amount and code on the end date."""
    first = monthly.filter((F.col("DelinquencyStatusCode") == code) & (F.col("SnapshotDate") == as_date(start))).select(
        "AccountNumber", "CurrentAmount", "AccountStatus")
    later = monthly.filter(F.col("SnapshotDate") == as_date(end)).select(
        "AccountNumber", F.col("CurrentAmount").alias("CurrentAmount_n"),
        F.col("DelinquencyStatusCode").alias("DelinquencyStatusCode_n"))
    return first.join(later, "AccountNumber")


def outcome_12m(panel: DataFrame, carry: Sequence[str] = (), month_end: bool = False) -> DataFrame:
    """Rows with the account's Ever90 and balance twelve months later.

    Dates are shifted by calendar, so a 29 February finds no partner; with `month_end` both sides
    are compared by month-end instead. The join is on account and date, which spreads a long-lived account.
    """
    keep = [c for c in ("AccountNumber", "SnapshotDate", "CurrentAmount", "Ever90", *carry) if c in panel.columns]
    base = panel.select(*dict.fromkeys(keep))
    shifted = F.add_months(F.col("SnapshotDate"), -12)
    later = panel.select("AccountNumber", (F.last_day(shifted) if month_end else shifted).alias("SnapshotDate"),
                         F.col("Ever90").alias("Ever90_12"), F.col("CurrentAmount").alias("CurrentAmount_12"))
    return base.join(later, ["AccountNumber", "SnapshotDate"])


def _months_between(lo: Column, hi: Column) -> Column:
    return F.sequence(F.trunc(lo, "month"), F.trunc(hi, "month"), F.expr("interval 1 month"))


def monthly_counts(df: DataFrame, date: str = "SnapshotDate", share_of: int | None = None, window: int | None = None) -> DataFrame:
    """Rows per month-end from the first to the last month, empty months as 0.

    With `share_of` also count / share_of; with `window` also its rolling mean.
    """
    counts = df.filter(F.col(date).isNotNull()).groupBy(F.last_day(date).alias("Month")).agg(F.count("*").alias("n"))
    spine = counts.agg(F.min("Month").alias("lo"), F.max("Month").alias("hi")).select(
        F.explode(_months_between(F.col("lo"), F.col("hi"))).alias("Month")).select(F.last_day("Month").alias("Month"))
    out = spine.join(counts, "Month", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    if share_of:
        out = out.withColumn("share", F.col("n") / share_of)
    if window:
        out = out.withColumn("rolling", rolling_mean(F.col("share" if share_of else "n").cast("double"), window, F.col("Month")))
    return out


def default_rate_by_month(df: DataFrame, outcome: str = "Ever90_12", window: int = 3, date: str = "SnapshotDate",
                          stages: Sequence[int] | None = None, stage_col: str = "Stage", collapse_months: bool = False) -> DataFrame:
    """Share of bad outcomes per month-end and its rolling mean, after removing repeated rows.

    With `collapse_months` rows that are equal but for their date count once, in the first of their months.

    A class's empty months count 0 between its own first and last month; outside that span of either
    class the rate is unknown.
    """
    rows = df if stages is None else df.filter(F.col(stage_col).isin(*stages))
    rows = rows.filter(F.col(outcome).isin(0, 1) & F.col(date).isNotNull()).distinct()
    if collapse_months:
        rows = rows.groupBy(*[c for c in rows.columns if c != date]).agg(F.min(date).alias(date))
    counts = rows.groupBy(F.last_day(date).alias("Month")).agg(
        F.count_if(F.col(outcome) == 1).alias("bad"), F.count_if(F.col(outcome) == 0).alias("good"))
    # From here on one row per month.
    span = {}
    for c in ("bad", "good"):
        seen = F.when(F.col(c) > 0, F.col("Month"))
        span |= {f"{c}_lo": F.min(seen), f"{c}_hi": F.max(seen)}
    spans = counts.agg(*[e.alias(n) for n, e in span.items()])
    months = F.array_union(
        F.coalesce(_months_between(F.col("bad_lo"), F.col("bad_hi")), F.array().cast("array<date>")),
        F.coalesce(_months_between(F.col("good_lo"), F.col("good_hi")), F.array().cast("array<date>")))
    spine = spans.select("*", F.explode(months).alias("Month")).withColumn("Month", F.last_day("Month"))
    grid = spine.join(counts, "Month", "left")
    for c in ("bad", "good"):
        inside = F.col("Month").between(F.col(f"{c}_lo"), F.col(f"{c}_hi"))
        grid = grid.withColumn(c, F.when(inside, F.coalesce(F.col(c), F.lit(0))))
    grid = grid.withColumn("rate", F.try_divide(F.col("bad").cast("double"), F.col("bad") + F.col("good")))
    return grid.withColumn("rolling", rolling_mean(F.col("rate"), window, F.col("Month"))).select(
        "Month", "bad", "good", "rate", "rolling")


def hash_number(*parts: Column) -> Column:
    """A 32-bit number from the MD5 of the parts; the same in any SQL engine, whatever the partitioning."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def sample_account_month(panel: DataFrame, seed: int = 42, open_only: bool = True, per_snapshot: bool = True) -> DataFrame:
    """A random healthy row for each (account, snapshot), with Ever90 twelve months on book later.

    Eligible rows are healthy rows whose MOB + 12 exists exactly once in the account. They are ranked
    per account, and each snapshot draws one rank by hash, so the work is linear in the rows. With
    `per_snapshot=False` an account draws once. The result is distinct, as the same row may be drawn often.

    The draw is by MOB, so healthy rows sharing the drawn MOB come together. `panel` is read several
    times; materialise one that is costly to derive.
    """
    later = (panel.groupBy("AccountNumber", "MOB").agg(F.count("*").alias("__n"), F.max("Ever90").alias("Ever90_12M"))
                  .filter("__n = 1").select("AccountNumber", (F.col("MOB") - 12).alias("MOB"), "Ever90_12M"))
    healthy = panel.filter(F.col("Ever90") == 0)
    if open_only:
        healthy = healthy.filter(F.col("AccountStatus") == "OPEN")
    eligible = healthy.select("AccountNumber", "MOB").distinct().join(later, ["AccountNumber", "MOB"])
    per_account = Window.partitionBy("AccountNumber")
    ranked = eligible.withColumns({
        "__rank": F.row_number().over(per_account.orderBy("MOB")), "__of": F.count("*").over(per_account)})
    sizes = ranked.filter("__rank = 1").select("AccountNumber", "__of")
    draws = panel.select("AccountNumber", *(["SnapshotDate"] if per_snapshot else [])).distinct().join(sizes, "AccountNumber")
    key = [F.col("AccountNumber")] + ([F.col("SnapshotDate")] if per_snapshot else []) + [F.lit(seed)]
    drawn = draws.select("AccountNumber", (F.pmod(hash_number(*key), F.col("__of")) + 1).alias("__rank")).distinct()
    chosen = drawn.join(ranked.drop("__of"), ["AccountNumber", "__rank"]).drop("__rank")
    return healthy.drop("Ever90").join(chosen, ["AccountNumber", "MOB"]).distinct()


#: Ranges of the hash by which a smallest-k threshold is found: the top 16 of its 32 bits.
HASH_RANGES = 16


def sample_accounts(panel: DataFrame, share: float = 0.05, seed: int = 42) -> DataFrame:
    """All rows of a random share of the accounts: exactly the whole part of share x accounts.

    Those with the smallest hashes (ties: the smaller account). A histogram of the hashes finds the range that holds
    the last of them; only that range is ranked. The panel is read for its accounts and for the result.
    """
    accounts = panel.filter(F.col("AccountNumber").isNotNull()).select("AccountNumber").distinct()
    accounts = accounts.withColumn("__h", hash_number(F.col("AccountNumber"), F.lit(seed)))
    accounts = materialise(accounts.withColumn("__range", F.shiftright("__h", 32 - HASH_RANGES)), "hashed-accounts")
    histogram = accounts.groupBy("__range").agg(F.count("*").alias("n"))
    every = Window.partitionBy(F.lit(0))
    up_to = F.sum("n").over(every.orderBy("__range"))
    # Same order of operations as int(count * share).
    sized = histogram.select("__range", (up_to - F.col("n")).alias("before"), up_to.alias("upto"), F.floor(F.sum("n").over(every) * F.lit(share)).alias("size"))
    edge = sized.filter((F.col("size") > F.col("before")) & (F.col("size") <= F.col("upto")))
    cut = materialise(edge.select("__range", (F.col("size") - F.col("before")).alias("__take")), "hash-cut")
    at = cut.select("__range").scalar()
    first = Window.partitionBy("__range").orderBy("__h", "AccountNumber")
    last = accounts.join(cut, "__range").withColumn("__rank", F.row_number().over(first)).filter("__rank <= __take")
    chosen = accounts.filter(F.col("__range") < at).select("AccountNumber").unionByName(last.select("AccountNumber"))
    return panel.join(chosen, "AccountNumber", "left_semi")
