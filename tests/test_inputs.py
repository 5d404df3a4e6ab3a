"""Loan tables that are written once for several branches."""

import datetime as dt

import pytest

from riskspark.catalog.inputs import Inputs, needed
from riskspark.operators.applicants import early_outcome, first_months


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("orders")
    rows = [(k, k % 7 if k % 31 else None, "FO"[k % 2], 100.0 + k, dt.date(1995, 1, 1) + dt.timedelta(days=k * 13 % 900)) for k in range(300)]
    rows += rows[:5]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date").write.parquet(f"{path}/orders.parquet")
    return str(path)


def bag(df):
    return sorted(map(repr, df.collect()))


def test_written_tables_hold_the_same_rows_and_are_not_derived_again(spark, folder):
    plain, shared = Inputs(spark, folder), Inputs(spark, folder)
    shared.write("loan_portfolio")
    for name in ("loan_portfolio", "loan_portfolio_monthly", "model_tape"):
        assert bag(getattr(shared, name)) == bag(getattr(plain, name))
        assert "o_custkey" in getattr(plain, name)._jdf.queryExecution().optimizedPlan().toString()
        assert "o_custkey" not in getattr(shared, name)._jdf.queryExecution().optimizedPlan().toString()
    assert needed(["model_tape"], ["loan_portfolio"]) == ["loan_portfolio", "loan_portfolio_monthly", "model_tape"]
    assert shared.statements.count() == plain.statements.count()


def test_first_months_give_the_same_early_outcome(spark, folder):
    monthly = Inputs(spark, folder).loan_portfolio_monthly
    early = first_months(monthly)
    assert early.count() < monthly.count()
    assert bag(early_outcome(early)) == bag(early_outcome(monthly)) and early_outcome(monthly).count() > 0
    assert bag(early_outcome(early, early_mob=None)) == bag(early_outcome(monthly, early_mob=None))
