from helpers import day, frame, one, rows
from pyspark.sql import functions as F

from riskspark.operators import reporting as r

ECL = "ReportDate date, AccountNumber long, Ord int, RiskStage string, FBE string, SpecialCase string, Base int, ECL_SUM int, ECLNPV_SUM int"
LAST, THIS = "2024-01-31", "2024-02-29"


def ecl(spark, moves):
    data = []
    for account, (was, now, fbe) in enumerate(moves, start=1):
        data += [(LAST, account, 0, was, "", None, 10, 1, 2)] if was else []
        data += [(THIS, account, 0, now, fbe, None, 20, 3, 4)] if now else []
    return frame(spark, ECL, data + [(THIS, 99, 1, "Stage1", "", None, 1000, 0, 0)])


MOVES = [("Stage3", None, ""), ("Stage2", "Stage3", ""), ("Stage2", "Stage1", ""), ("Stage1", "Stage2", "monitoring_paymentrelief"),
         ("Stage2", "Stage2", "monitoring_paymentrelief"), ("Stage3", "Stage2", "monitoring_previous_S3"), (None, "Stage2", ""),
         ("Stage1", "Stage3", ""), ("Stage1", "Stage1", "")]
LABELS = ["WO_Out", "New_Entries_S3", "Cure_S1", "New_Entries_S2_SICR", "monitoring_paymentrelief", "monitoring_previous_S3", "SICR", None, None]


def test_every_walk_label(spark):
    walk = r.stage_walk(ecl(spark, MOVES), THIS)
    got = walk.select(F.coalesce("AccountNumber", F.lit(7)).alias("a"), F.coalesce("Walk", F.lit("-")).alias("w"))
    assert rows(got, "a", "w") == [(i + 1, w or "-") for i, w in enumerate(LABELS)]
    # An account new this month keeps no number, as in the report.
    assert walk.filter("AccountNumber is null").count() == 1


def test_totals_are_the_sum_of_stages(spark):
    totals = r.stage_totals(ecl(spark, MOVES), [THIS, LAST])
    by = {(str(x.ReportDate), x.RiskStage): x.Balance for x in totals.collect()}
    for date in (THIS, LAST):
        assert by[date, "Total"] == sum(v for (d, s), v in by.items() if d == date and s != "Total")
    assert by[THIS, "Total"] == 20 * 8


def test_stage_totals_shuffle_the_portfolio_once(spark):
    plan = r.stage_totals(ecl(spark, MOVES), [THIS, LAST])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") == 1


def test_entries_and_write_offs(spark):
    data = ecl(spark, MOVES)
    assert rows(r.new_stage3_entries(data, THIS), "AccountNumber") == [(2,), (8,)]
    assert tuple(one(r.entries_summary(r.new_stage3_entries(data, THIS)))) == (2, 40, 6, 8)
    assert rows(r.write_offs(data, THIS), "AccountNumber") == [(1,)]
    nothing = r.entries_summary(r.write_offs(data, "2030-01-31"))
    assert one(nothing).TotalEntries == 0


def test_unpaid_invoices(spark):
    cols = "AccountNumber long, SnapshotDate date, AccountStatus string, InvoicedInterest int, PaidInterest int, InvoicedFee int, PaidFee int"
    df = frame(spark, cols, [
        (1, "2024-02-29", "OPEN", 10, 5, 3, 3), (1, "2024-02-29", "OPEN", 10, 5, 3, 3), (2, "2024-02-29", "OPEN", 10, 10, 3, 3),
        (3, "2024-02-29", "CLOSED", 10, 0, 0, 0), (4, "2024-02-28", "OPEN", 10, 0, 0, 0), (5, "2024-01-31", "OPEN", 10, 0, 0, 0), (6, "2024-02-29", None, 10, 0, 0, 0)])
    assert rows(r.unpaid_invoices(df, "2024-03-05"), "AccountNumber", "unpaid") == [(1, 5)]


def test_invoice_and_repurchase_sheets(spark):
    sheet = spark.createDataFrame([(123, 4.5)], "Account long, InvNotPaid double")
    assert tuple(one(r.invoice_not_paid(sheet, "2024-03-05"))) == (day("2024-02-29"), "123", 4.5)
    sale = spark.createDataFrame([(7.0, "2024-01-05", 3.0, 1, "x"), (8.0, "2024-01-05", 0.0, 1, "x")], "AccountNumber double, SaleDate string, BoughtCapital double, Other int, Fifth string")
    got = one(r.repurchase_load(sale))
    assert got.asDict() == {"AccountNumber": "7", "SaleDate": day("2024-01-05"), "BoughtCapital": 3.0, "Other": 1}


def test_balance_by_stage_keeps_scored_months_without_balance(spark):
    scores = frame(spark, "AccountNumber long, SnapshotDate date, Stageing int", [(1, "2024-02-29", 1), (2, "2024-02-29", 1), (1, "2023-02-28", 2)])
    port = frame(spark, "AccountNumber long, SnapshotDate date, CurrentAmount int, IsOpen int", [(1, "2024-02-29", 5, 1), (2, "2024-02-29", 7, 0), (1, "2023-02-28", 5, 1)])
    got = {(str(x.SnapshotDate), x.Stageing): x.Balance for x in r.balance_by_stage(scores, port, "2024-03-05").collect()}
    assert got == {("2024-02-29", 1): 5, ("2023-02-28", 2): None}


def test_special_cases(spark):
    events = frame(spark, "SSN string, EventTypeDesc string, DecisionDate date, InsertDate date", [
        ("p1", r.DEBT_RELIEF, "2024-01-05", "2024-01-06"), ("p2", r.DECEASED, "2024-01-05", "2024-01-06"),
        ("p3", r.DEBT_RELIEF, "2024-01-05", "2024-01-06"), ("p4", r.DEBT_RELIEF, "2024-01-05", "2024-01-06"), ("p5", "other", "2024-01-05", "2024-01-06")])
    ids = spark.createDataFrame([(f"p{i}", f"h{i}") for i in range(1, 6)], "SSN string, ssn_hash string")
    apps = frame(spark, "ApplicationID long, AccountNumber long, SSN string, Status string, IsMainApplicant int, ApplicantNo int, HasCoapp int, ReceivedDate date, DisbursedDate date, Amount int", [
        (1, 1, "h1", "DISBURSED", 1, 1, 0, "2023-01-01", "2023-01-10", 1),
        (2, 2, "h2", "DISBURSED", 1, 1, 1, "2023-01-01", "2023-01-10", 1),  # only one of two applicants hit
        (3, 3, "h3", "DISBURSED", 1, 1, 1, "2023-01-01", "2024-02-10", 1), (3, 3, "h4", "DISBURSED", 0, 2, 1, "2023-01-01", "2024-02-10", 1),
        (5, 5, "h9", "DISBURSED", 1, 1, 0, "2023-01-01", "2023-01-10", 1), (6, 6, "h5", "DISBURSED", 1, 1, 0, "2023-01-01", "2023-01-10", 1)])
    port = frame(spark, "AccountNumber long, SnapshotDate date, AccountStatus string", [(i, "2024-02-29", "OPEN") for i in (1, 2, 3, 5)] + [(6, "2024-02-29", "CLOSED"), (1, "2024-01-31", "CLOSED")])
    hit = r.special_events(events, ids, apps, port)
    assert rows(hit, "AccountNumber", "HitWithCoapp") == [(1, 0), (3, 2), (3, 2)]
    old = spark.createDataFrame([(1,), (5,), (5,), (6,)], "AccountNumber long")
    cases = r.special_cases(hit, old, r.applications_with_status(apps, port), THIS)
    assert rows(cases, "AccountNumber", "LGD") == [(1, 0.5), (3, 0.5), (5, 0.5)]
    assert cases.columns == ["AccountNumber", "AccountStatus", "EventTypeDesc", "LGD", "ReportingDate"]
    back = r.special_cases(hit, old, r.applications_with_status(apps, port), "2023-12-31", "2024-01-01")
    assert rows(back, "AccountNumber") == [(1,), (5,)]
