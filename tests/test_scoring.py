import math

import pytest
from helpers import day, frame, rows

from riskspark.operators import macro, scoring
from riskspark.operators.scoring import LogitModel


def staged(spark, **values):
    base = dict(MOB=5, DisbursedDate="2024-01-01", CurrentDelinquencyStatus=0, BehaviourModel=0.1, PDScoreNew=0.05, AdmissionModel=0.05,
                ApplicationScore=5.0, FBE_eftergift=0, ForberanceIn12Months=0) | values
    schema = "MOB int, DisbursedDate date, CurrentDelinquencyStatus int, BehaviourModel double, PDScoreNew double, AdmissionModel double, ApplicationScore double, FBE_eftergift int, ForberanceIn12Months int"
    return scoring.stage_accounts(frame(spark, schema, [tuple(base.values())])).first()


def test_logit(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    got = scoring.logit_score(df, LogitModel(("a", "b"), (0.5, -0.25), 0.1, 2.0, -1.0), "cal").first()
    p = 1 / (1 + math.exp(-0.1))
    assert got.P == pytest.approx(p) and got.cal == pytest.approx(1 / (1 + math.exp(-(2 * p - 1))))


@pytest.mark.parametrize(("values", "score"), [
    ({"PDScoreNew": 0.30, "AdmissionModel": 0.304}, 0.30),
    ({"PDScoreNew": 0.31, "AdmissionModel": 0.304}, 0.304),
    ({"PDScoreNew": None, "AdmissionModel": 0.2}, 0.2),
    ({"PDScoreNew": None, "AdmissionModel": None}, 0.0),
    ({"DisbursedDate": "2023-12-20"}, 0.05),
    ({"DisbursedDate": "2023-12-20", "ApplicationScore": None}, 0.0),
    ({"DisbursedDate": "2023-12-21", "PDScoreNew": 0.01}, 0.01),
    ({"DisbursedDate": None, "AdmissionModel": 0.07}, 0.07),
    # Rounding half to even: 0.125 counts as 0.12.
    ({"PDScoreNew": 0.125, "AdmissionModel": 0.12}, 0.125),
])
def test_applied_application_score(spark, values, score):
    assert staged(spark, **values).AppliedApplicationScore == pytest.approx(score)


@pytest.mark.parametrize(("values", "sicr", "stage", "life"), [
    ({"BehaviourModel": 0.25, "PDScoreNew": 0.16, "AdmissionModel": 0.16}, 0, 1, 0.25),
    ({"BehaviourModel": 0.145}, 1, 2, 0.174),
    ({"BehaviourModel": 0.50}, 1, 2, 0.55),
    ({"BehaviourModel": 0.49}, 1, 2, 0.588),
    ({"BehaviourModel": 0.95}, 1, 3, 1.0),
    ({"CurrentDelinquencyStatus": 4}, 1, 3, 1.0),
    # In default but with a high applied score: no increase in risk, so stage 1.
    ({"CurrentDelinquencyStatus": 9, "PDScoreNew": 0.95, "AdmissionModel": 0.95}, 0, 1, 1.0),
    ({"FBE_eftergift": 1}, 1, 2, 0.12),
])
def test_stage(spark, values, sicr, stage, life):
    got = staged(spark, **values)
    assert (got.SICR, got.Stageing) == (sicr, stage) and got.LifetimeScore == pytest.approx(life)


def test_reason(spark):
    assert staged(spark, ForberanceIn12Months=1, CurrentDelinquencyStatus=2, FBE_eftergift=1).FBE == "monitoring_previous_S3"
    assert staged(spark, ForberanceIn12Months=1, CurrentDelinquencyStatus=4, FBE_eftergift=1).FBE == "monitoring_paymentrelief"
    assert staged(spark, ForberanceIn12Months=1, CurrentDelinquencyStatus=1).FBE == ""


def test_missing_month_on_book_is_dropped(spark):
    assert staged(spark, MOB=None) is None
    assert staged(spark, BehaviourModel=None).PD_Delta == 0.0


def test_stage_labels(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 1.0), (1, 0.7)], "SICR int, LifetimeScore double")
    assert rows(scoring.assign_stage(df, labels=True), "Stageing") == [("Stage1",), ("Stage2",), ("Stage3",)]


def test_macro_series_and_instrument(spark):
    months = [f"2023-{m:02d}-15" for m in range(1, 13)] + [f"2024-{m:02d}-15" for m in range(1, 5)]
    raw = frame(spark, "Date date, Inflation string, Forecast double", [(d, "x" if i == 2 else str(float(i)), 4.0) for i, d in enumerate(months)])
    series = macro.macro_series(raw, "2023-01-01", "2024-03-31")
    assert series.count() == 15
    merged = dict(rows(series, "Date", "InflationAll"))
    assert merged[day("2023-03-31")] == 5.0 and merged[day("2023-02-28")] == 2.0
    x = [5.0 if i == 2 else i + 1.0 for i in range(15)]
    mean6 = [sum(x[i - 5:i + 1]) / 6 if i >= 5 else None for i in range(15)]
    lag = mean6[3:] + [None] * 3
    inst = [v ** (1 / 3) if v is not None else None for v in lag]
    mean = sum(v for v in inst if v is not None) / sum(v is not None for v in inst)
    norm = [v / mean if v is not None else None for v in inst]
    want = [(sum(norm[i - 2:i + 1]) / 3) ** 0.1 if i >= 2 and None not in norm[i - 2:i + 1] else None for i in range(15)]
    got = [r[1] for r in sorted(macro.macro_instrument(series).select("Date", "InstrumentRollingMean").collect())]
    assert [g is None for g in got] == [w is None for w in want]
    assert [g for g in got if g is not None] == pytest.approx([w for w in want if w is not None])


def test_macro_negative_base_and_short_series(spark):
    raw = frame(spark, "Date date, Inflation string, Forecast double", [(f"2023-{m:02d}-15", "-9", 0.0) for m in range(1, 13)])
    assert macro.macro_instrument(macro.macro_series(raw)).filter("InstrumentRollingMean is not null").count() == 0
    assert macro.macro_instrument(macro.macro_series(raw.limit(4))).filter("InflationAllMean is not null").count() == 0


def test_macro_overlay_missing_is_one(spark):
    df = frame(spark, "SnapshotDate date, CurrentDelinquencyStatus int, BehaviourModel double", [("2023-01-31", 0, 0.5), ("2023-02-28", 0, 0.5), ("2023-01-31", 9, 0.5)])
    inst = frame(spark, "Date date, InstrumentRollingMean double", [("2023-01-31", 1.2)])
    assert rows(scoring.macro_overlay(df, inst), "SnapshotDate", "AdjustedBehaviourScore") == [
        (day("2023-01-31"), 0.6), (day("2023-01-31"), 1.0), (day("2023-02-28"), 0.5)]
