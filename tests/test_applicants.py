from helpers import day, frame, rows

from riskspark.operators import applicants as a

APPS = "ApplicationID long, AccountNumber long, SSN long, ReceivedDate date, DisbursedDate date"
REPORTS = "SSN long, Date date, jsonID long, UCScore double"


def test_report_window_edges(spark):
    apps = frame(spark, APPS, [(i, i, i, "2023-03-31", None if i >= 5 else "2023-04-10") for i in range(1, 8)])
    reports = frame(spark, REPORTS, [
        (1, "2023-03-01", 1, 0.1), (2, "2023-02-28", 2, 0.1), (3, "2023-04-10", 3, 0.1), (4, "2023-04-11", 4, 0.1),
        (5, "2023-05-30", 5, 0.1), (6, "2023-05-31", 6, 0.1), (7, "2023-03-05", 7, 0.2), (7, "2023-05-01", 8, 0.9), (7, "2023-05-01", 9, 0.8)])
    got = dict(rows(a.credit_report_asof(apps, reports).fillna({"jsonID": -1}), "AccountNumber", "jsonID"))
    assert got == {1: 1, 2: -1, 3: 3, 4: -1, 5: 5, 6: -1, 7: 9}


def test_min_score_and_ties(spark):
    apps = frame(spark, APPS, [
        (11, 1, 1, "2023-03-31", "2023-04-30"), (12, 1, 2, "2023-03-31", "2023-04-30"),
        (21, 2, 3, "2023-03-31", "2023-04-30"), (31, 3, 4, "2023-03-31", "2023-04-30")])
    reports = frame(spark, REPORTS, [
        (1, "2023-04-01", 1, 0.3), (1, "2023-04-02", 2, 0.5), (2, "2023-04-03", 3, 0.3), (2, "2023-04-03", 4, None),
        (3, "2023-04-01", 5, None), (4, "2023-04-01", 6, 0.2), (4, "2023-04-01", 7, 0.2), (4, "2023-05-01", 8, 0.1)])
    got = rows(a.credit_report_min_score(apps, reports), "AccountNumber", "ApplicationID", "jsonID", "UCScore")
    assert got == [(1, 12, 3, 0.3), (3, 31, 7, 0.2)]


def test_hot_person_matches_brute_force(spark):
    """One person with a third of all reports, and many applications."""
    apps = spark.range(300).selectExpr("id as ApplicationID", "id as AccountNumber", "if(id % 3 = 0, 0L, id) as SSN",
                                       "date_add(date'2020-01-01', cast(id % 200 as int)) as ReceivedDate",
                                       "if(id % 7 = 0, null, date_add(date'2020-01-01', cast(id % 200 + id % 40 as int))) as DisbursedDate")
    reports = spark.range(6000).selectExpr("if(id % 3 = 0, 0L, id % 300) as SSN", "date_add(date'2019-11-01', cast(id * 7 % 400 as int)) as Date",
                                           "id as jsonID", "(id * 37 % 1000) / 1000D as UCScore")
    ap, rp = apps.collect(), reports.collect()
    want_newest, want_lowest = {}, {}
    for x in ap:
        hi = (x.DisbursedDate - x.ReceivedDate).days if x.DisbursedDate else 60
        hits = [r for r in rp if r.SSN == x.SSN and -30 <= (r.Date - x.ReceivedDate).days <= hi]
        want_newest[x.AccountNumber] = max(((r.Date, r.jsonID) for r in hits), default=(None, None))[1]
        if hits:
            want_lowest[x.AccountNumber] = min((r.UCScore, -r.Date.toordinal(), -r.jsonID) for r in hits)[2] * -1
    newest = {r.AccountNumber: r.jsonID for r in a.credit_report_asof(apps, reports).collect()}
    assert newest == want_newest
    assert {r.AccountNumber: r.jsonID for r in a.credit_report_min_score(apps, reports).collect()} == want_lowest


MONTHLY = "AccountNumber long, MOB int, IsMonthEnd int, Ever30 int, Ever90 int, DisbursedDate date"


def test_early_outcome(spark):
    m = frame(spark, MONTHLY, [(1, 3, 1, 1, 0, "2020-01-01"), (1, 11, 1, 1, 1, "2020-01-01"), (1, 13, 1, 1, 1, "2020-01-01"),
                               (2, 5, 1, 0, 0, "2020-01-01"), (3, 3, 0, 0, 0, "2020-01-01"), (3, 12, 1, 1, 0, "2020-01-01")])
    assert rows(a.early_outcome(m), "AccountNumber", "MOB", "Ever30", "Ever90") == [(1, 11, 1, 1)]
    assert rows(a.early_outcome(m, early_mob=None), "AccountNumber", "MOB") == [(1, 11), (2, 5), (3, 12)]
    assert rows(a.outcome_at_mob(m), "AccountNumber") == [(3,)]


def test_prefer_rows(spark):
    df = frame(spark, "SnapshotDate date, AccountNumber long, CoappFlag int, FBE_eftergift int", [
        ("2023-01-31", 1, 0, 0), ("2023-01-31", 1, 1, 1), ("2023-01-31", 1, 1, 0), ("2023-01-31", 2, 0, 0), ("2023-02-28", 2, 0, 1), ("2023-02-28", 3, None, 0)])
    assert rows(a.prefer_coapplicant(df).fillna(-1), "AccountNumber", "CoappFlag") == [(1, 1), (1, 1), (2, 0), (2, 0), (3, -1)]
    assert a.prefer_relief_row(df).count() == 4
    assert rows(a.normalise_coapp_flag(df.filter("AccountNumber = 3")), "CoappFlag") == [(0,)]


def test_application_type_drops_unscored_main(spark):
    cols = "ApplicationID long, UCScore double, HasCoapp int, CoappSameAddress int"
    main = spark.createDataFrame([(1, 0.5, 0, 0), (2, None, 0, 0)], cols)
    co = spark.createDataFrame([(3, 0.1, 1, 1), (4, 0.1, 1, 0), (5, None, 1, None)], cols)
    assert rows(a.application_type(main, co).fillna({"Applicationtype": -1}), "ApplicationID", "Applicationtype") == [(1, 0), (3, 1), (4, 2), (5, -1)]


def test_impute(spark):
    df = spark.createDataFrame([(None, None, None, None, "None", None, 5)],
                               "AvgUtilizationRatio12M double, Inquiries12M string, UtilizationRatio double, CapitalDeficit_Delta_1Year double, MaritalStatus string, HouseTaxValue decimal(10,2), Amount int")
    got = a.impute_admission(df).first()
    assert tuple(got) == (0.0, -1.0, -100.0, -100.0, "Unknown", 0.0, 5)
    inf = spark.createDataFrame([(float("-inf"), float("inf"))], "IncomeDelta_1Year double, ActiveCreditAccounts double")
    assert tuple(a.impute_admission(inf).first()) == (-100.0, -100.0)


def test_admission_frame(spark):
    cols = "AccountNumber long, UCScore double, HasCoapp int, CoappSameAddress int, BirthDate date, MortgageLoansHouseVolume double, MortgageLoansApartmentVolume double"
    main = frame(spark, cols, [(1, 0.5, 0, 0, "1990-06-16", 0.0, 7.0)])
    co = frame(spark, cols, [(2, 0.4, 1, 1, "1990-06-15", 9.0, 7.0), (3, 0.4, 1, 1, "1990-06-15", None, None)])
    got = rows(a.admission_frame(main, co, day("2020-06-15")), "AccountNumber", "age", "PropertyVolume", "Applicationtype")
    assert got == [(1, 29, 7.0, 0), (2, 30, 9.0, 1), (3, 30, 0.0, 1)]


def test_shared_column_names_and_bureau_score_name(spark):
    apps = frame(spark, APPS + ", LastPaymentRemarkDate date", [(1, 1, 1, "2023-03-31", "2023-04-10", "2020-01-01")])
    reports = frame(spark, "SSN long, Date date, jsonID long, RiskPrognos double, LastPaymentRemarkDate date", [(1, "2023-04-01", 1, 0.5, "2021-01-01")])
    for got in (a.credit_report_asof(apps, reports), a.credit_report_min_score(apps, reports)):
        assert rows(got, "UCScore", "LastPaymentRemarkDate1", "LastPaymentRemarkDate") == [(0.5, day("2020-01-01"), day("2021-01-01"))]
