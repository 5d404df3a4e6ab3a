from helpers import day, frame, rows
from pyspark.sql import functions as F

from riskspark.operators import outcomes as o
from riskspark.operators import sampling as s
from riskspark.operators.keyed import first_per_key, prefer_flagged, running_totals

PANEL = "AccountNumber long, SnapshotDate date, MOB int, Ever90 int, CurrentAmount int, AccountStatus string"


def test_outcome_12m_shift_and_february(spark):
    df = frame(spark, PANEL, [(1, "2023-01-31", 1, 0, 10, "OPEN"), (1, "2024-01-31", 13, 1, 20, "OPEN"),
                              (2, "2024-02-29", 1, 0, 10, "OPEN"), (2, "2025-02-28", 13, 1, 20, "OPEN"), (3, "2023-02-28", 1, 0, 10, "OPEN"), (3, "2024-02-29", 13, 0, 30, "OPEN")])
    assert rows(o.outcome_12m(df), "AccountNumber", "Ever90_12", "CurrentAmount_12") == [(1, 1, 20), (3, 0, 30)]
    assert rows(o.outcome_12m(df, month_end=True), "AccountNumber") == [(1,), (2,), (3,)]


def test_default_rate_spans_and_empty_months(spark):
    data = [("2023-01-31", 0), ("2023-02-28", 0), ("2023-02-28", 1), ("2023-04-30", 1), ("2023-05-31", 0)]
    df = frame(spark, "SnapshotDate date, Ever90_12 int, k int", [(d, y, i) for i, (d, y) in enumerate(data)] + [("2023-02-28", 1, 2)])
    got = [(str(x.Month), x.bad, x.good, x.rate) for x in o.default_rate_by_month(df).orderBy("Month").collect()]
    assert got == [("2023-01-31", None, 1, None), ("2023-02-28", 1, 1, 0.5), ("2023-03-31", 0, 0, None), ("2023-04-30", 1, 0, 1.0), ("2023-05-31", None, 1, None)]
    assert o.default_rate_by_month(df.filter("Ever90_12 = 0")).filter("rate is not null").count() == 0


def test_monthly_counts_fills_months(spark):
    df = frame(spark, "SnapshotDate date", [("2023-01-15",), ("2023-01-31",), ("2023-04-02",)])
    assert [x.n for x in o.monthly_counts(df).orderBy("Month").collect()] == [2, 0, 0, 1]


def test_cure_cohort(spark):
    df = frame(spark, "AccountNumber long, SnapshotDate date, DelinquencyStatusCode int, CurrentAmount int, AccountStatus string", [
        (1, "2022-01-31", 4, 10, "OPEN"), (1, "2023-09-30", 0, 5, "OPEN"), (2, "2022-01-31", 4, 10, "OPEN"), (3, "2022-01-31", 3, 1, "OPEN"), (3, "2023-09-30", 4, 1, "OPEN")])
    assert rows(o.cure_cohort(df, "2022-01-31", "2023-09-30"), "AccountNumber", "CurrentAmount_n", "DelinquencyStatusCode_n") == [(1, 5, 0)]


def panel(spark):
    return spark.range(60 * 30).selectExpr(
        "id div 30 as AccountNumber", "last_day(add_months(date'2020-01-31', cast(id % 30 as int))) as SnapshotDate", "cast(id % 30 as int) as MOB",
        "if(id % 30 > 20 + (id div 30) % 12, 1, 0) as Ever90", "1 as CurrentAmount", "if(id % 7 = 0, 'CLOSED', 'OPEN') as AccountStatus")


def test_sample_account_month_draws_only_eligible_rows(spark):
    df = panel(spark)
    have = {(r.AccountNumber, r.MOB): r for r in df.collect()}
    got = o.sample_account_month(df).collect()
    assert len(got) == len(set(got)) > 500
    for r in got:
        row = have[r.AccountNumber, r.MOB]
        assert row.Ever90 == 0 and row.AccountStatus == "OPEN" and r.Ever90_12M == have[r.AccountNumber, r.MOB + 12].Ever90
    again = o.sample_account_month(df.repartition(7, "MOB")).collect()
    assert sorted(got) == sorted(again)
    assert sorted(o.sample_account_month(df, seed=1).collect()) != sorted(got)
    once = o.sample_account_month(df, open_only=False, per_snapshot=False)
    assert once.count() == once.select("AccountNumber").distinct().count() == 60


def test_sample_account_month_needs_exactly_one_later_row(spark):
    df = frame(spark, PANEL, [(1, "2023-01-31", 1, 0, 1, "OPEN"), (1, "2024-01-31", 13, 0, 1, "OPEN"), (1, "2024-01-31", 13, 1, 1, "OPEN"), (2, "2023-01-31", 1, 0, 1, "OPEN")])
    assert o.sample_account_month(df).count() == 0


def test_sample_accounts_exact_size(spark):
    got = o.sample_accounts(panel(spark), 0.05)
    assert got.select("AccountNumber").distinct().count() == 3 and got.count() == 90


def test_running_totals_equal_plain_window(spark):
    df = spark.range(5000).selectExpr("id * 7919 % 5000 as k", "id % 3 as v", "1L as one")
    got = running_totals(df, ["k"], ["v", "one"]).orderBy("k").collect()
    total = 0
    for i, r in enumerate(got):
        total += r.v
        assert (r.cum_v, r.cum_one, r.total_one) == (total, i + 1, 5000)


def test_running_totals_within_groups(spark):
    """A group with half of all rows is several ranges; a NULL group is one; ties take places of their own."""
    df = spark.range(4000).selectExpr("case when id % 2 = 0 then 0 when id % 3 = 0 then null else id % 5 + 1 end as g", "id % 700 as k", "cast(id as int) as v", "1 as one")
    ranked = running_totals(df, ["k"], ["v", "one"], ["g"])
    assert ranked.count() == 4000
    for g, own in [(g, [r for r in ranked.collect() if r.g == g]) for g in (None, 0, 1, 5)]:
        own.sort(key=lambda r: r.cum_one)
        assert [r.cum_one for r in own] == list(range(1, len(own) + 1)) and [r.k for r in own] == sorted(r.k for r in own)
        assert own[-1].cum_v == own[0].total_v == sum(r.v for r in own) and {r.total_one for r in own} == {len(own)}, g


def test_a_hot_key_is_many_ranges(spark, monkeypatch):
    """One account, or one month, with half of all rows: no range holds it all, and the source is computed once."""
    from riskspark.operators import keyed
    written, write = {}, keyed.materialise
    monkeypatch.setattr(keyed, "materialise", lambda df, name: written.setdefault(name, write(df, name)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(8000).selectExpr("case when id < 4000 then 7 else id end as AccountNumber", "cast(id as int) as MOB", "1 as one")
        got = running_totals(df, ["AccountNumber", "MOB"], ["one"])
        assert sorted(r.cum_one for r in got.collect()) == list(range(1, 8001))
        per_range = written["ranges"].filter("AccountNumber = 7").groupBy("__range").count().collect()
        assert len(per_range) > 1 and max(r["count"] for r in per_range) < 4000
        written.clear()
        by_month = s.group_index(df.withColumn("SnapshotDate", F.lit("2020-01-31")).withColumn("Month", F.when(F.col("MOB") < 4000, 202001).otherwise(202002)), "Month")
        assert sorted(r["index"] for r in by_month.filter("Month = 202001").collect()) == list(range(4000))
        assert written["ranges"].filter("Month = 202001").select("__range").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_running_totals_one_key_and_empty(spark):
    one = spark.createDataFrame([(1.0, 5)], "k double, v long")
    assert rows(running_totals(one, ["k"], ["v"]), "cum_v", "total_v") == [(5, 5)]
    assert running_totals(one.filter("k > 1"), ["k"], ["v"]).count() == 0


def test_folds_of_a_class_differ_by_one_row_at_most(spark):
    df = spark.range(1003).selectExpr("id % 90 as AccountNumber", "date_add(date'2020-01-01', cast(id % 11 as int)) as SnapshotDate", "case when id % 9 = 0 then 1 when id % 100 = 5 then null else 0 end as y")
    folds = s.stratified_folds(df, "y", 5)
    sizes = {}
    for r in folds.groupBy("y", "fold").count().collect():
        sizes.setdefault(r.y, []).append(r["count"])
    assert folds.count() == 1003 and all(len(v) == 5 and max(v) - min(v) <= 1 for v in sizes.values()) and len(sizes) == 3


def test_sampled_accounts_are_those_with_the_smallest_hashes(spark):
    df = spark.range(3000).selectExpr("id % 1000 as AccountNumber", "id as x").unionByName(spark.createDataFrame([(None, 1)], "AccountNumber long, x long"))
    first = df.select("AccountNumber").filter("AccountNumber is not null").distinct().withColumn("h", o.hash_number(F.col("AccountNumber"), F.lit(42))).orderBy("h", "AccountNumber")
    for share in (0.0, 0.001, 0.37, 1.0):
        want = {r.AccountNumber for r in first.limit(int(1000 * share)).collect()}
        got = o.sample_accounts(df, share)
        assert {r.AccountNumber for r in got.collect()} == want and got.count() == 3 * len(want)
    assert o.sample_accounts(df.limit(0), 0.5).count() == 0


def split_rows(spark, labels):
    return frame(spark, "AccountNumber long, MOB int, SnapshotDate date, DisbursedDate date, Ever90_12M int",
                 [(i, 1, "2023-01-31", "2022-01-01", y) for i, y in enumerate(labels)])


def test_split_cuts_at_the_positive(spark):
    labels = [0, 1, 1, 0, 1, 1, 1, 1, 0, 1, 1, 1, 1, 0]
    got = dict(rows(s.split_by_positive_share(split_rows(spark, labels)), "AccountNumber", "Split"))
    # Ten positives: cut at the 7th and, as 8.5 rounds to even, at the 8th.
    positions = [i for i, y in enumerate(labels) if y]
    total = len(positions)
    first, second = round(total * 0.7), round(total * 0.85)
    cut1, cut2 = positions[first - 1], positions[second - 1]
    assert got == {i: "train" if i < cut1 else "test" if i < cut2 else "validation" for i in range(len(labels))}
    sizes = {r.Split: r.n for r in s.split_sizes(s.split_by_positive_share(split_rows(spark, labels))).collect()}
    assert sum(sizes.values()) == len(labels)


def test_split_with_a_hot_account_matches_plain_order(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 1L, id) as AccountNumber", "cast(id % 500 as int) as MOB", "date_add(date'2000-01-01', cast(id as int)) as SnapshotDate", "cast(id * 7 % 5 < 2 as int) as Ever90_12M")
    got = {(r.AccountNumber, r.MOB, r.SnapshotDate): r.Split for r in s.split_by_positive_share(df).collect()}
    ordered = sorted((r.AccountNumber, r.MOB, r.SnapshotDate, r.Ever90_12M) for r in df.collect())
    positives = [i for i, r in enumerate(ordered) if r[3]]
    cut1, cut2 = positives[round(len(positives) * 0.7) - 1], positives[round(len(positives) * 0.85) - 1]
    assert all(got[r[:3]] == ("train" if i < cut1 else "test" if i < cut2 else "validation") for i, r in enumerate(ordered))


def test_split_without_positives_to_reach(spark):
    assert rows(s.split_by_positive_share(split_rows(spark, [0, 0, 0])), "Split") == [("validation",)] * 3


def test_replicate_to_length(spark):
    data = [(i, 1, "2023-01-31", d) for d, n in (("2022-01-05", 1), ("2022-02-05", 170), ("2022-03-05", 171), ("2022-04-05", 3)) for i in range(n)]
    df = frame(spark, "AccountNumber long, MOB int, SnapshotDate date, DisbursedDate date", data)
    got = s.replicate_to_length(df, F.month("DisbursedDate"))
    assert rows(got.groupBy("YearMonth").count(), "YearMonth", "count") == [(1, 170), (2, 170), (3, 171), (4, 170)]
    assert got.select("AccountNumber", "DisbursedDate").distinct().count() == len(data)
    assert rows(got.filter("YearMonth = 4").groupBy("AccountNumber").count(), "AccountNumber", "count") == [(0, 57), (1, 57), (2, 56)]


def test_balance_by_month(spark):
    got = s.balance_by_month(split_rows(spark, [0, 1, 0]))
    assert got.filter("Ever90_12M = 0").count() == 2 and got.filter("Ever90_12M = 1").count() == 170


def test_upsample_minority(spark):
    df = split_rows(spark, [1] * 10 + [0] * 90)
    got = s.upsample_minority(df)
    assert rows(got.groupBy("Ever90_12M").count(), "Ever90_12M", "count") == [(0, 90), (1, 90)]
    assert got.filter("Ever90_12M = 1").select("AccountNumber").distinct().count() > 5
    # A hot row key: all minority rows alike.
    alike = df.withColumn("AccountNumber", F.when(F.col("Ever90_12M") == 1, 1).otherwise(F.col("AccountNumber")))
    assert s.upsample_minority(alike).filter("Ever90_12M = 1").count() == 90
    assert s.upsample_minority(df.filter("Ever90_12M = 0")).count() == 90


def test_first_per_key_limits_before_the_shuffle(spark):
    plan = first_per_key(spark.range(100).selectExpr("id % 2 as k", "id as v"), ["k"], [F.col("v")])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_group_index(spark):
    df = frame(spark, PANEL, [(1, "2023-02-28", 2, 0, 1, "OPEN"), (1, "2023-01-31", 1, 0, 1, "OPEN")])
    assert rows(s.group_index(df, "AccountNumber"), "SnapshotDate", "index") == [(day("2023-01-31"), 0), (day("2023-02-28"), 1)]


def test_hot_key_is_split_in_the_join(spark):
    """Half of all rows on one account: AQE splits the partition, and no row is lost."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = spark.range(200_000).selectExpr("if(id % 2 = 0, -1L, id) as AccountNumber", "cast(id % 5 = 0 as int) as CoappFlag", "uuid() as payload")
        kept = prefer_flagged(df, ["AccountNumber"], "CoappFlag")
        assert kept.filter("AccountNumber = -1").count() == 20_000
        assert kept.filter("AccountNumber <> -1").count() == 100_000
        kept.write.format("noop").mode("overwrite").save()
        counted = kept.selectExpr("count(payload) as n", "count_if(CoappFlag = 1) as f")
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
