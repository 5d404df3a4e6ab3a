"""The monthly run that keeps a state: one month of the portfolio and the state before it, never all history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.dates import DateLike, as_date
from riskspark.operators.delinquency import STATE_DATES, account_state, delinquency_info, merged_state, month_features
from riskspark.sources.tables import append_month

#: The key of a state table: the month after which it holds.
STATE_MONTH = "StateMonth"


def _until(portfolio: DataFrame, payment_free_months: DataFrame, first: DateLike | None, last: DateLike) -> tuple[DataFrame, DataFrame]:
    """Rows of the months after `first`, up to `last`."""
    ym = F.col("YearMonth")
    end = F.last_day(F.make_date(F.floor(ym / 100).cast("int"), ym % 100, F.lit(1)))
    rows, free = portfolio.filter(F.col("SnapshotDate") <= as_date(last)), payment_free_months.filter(end <= as_date(last))
    if first is not None:
        rows, free = rows.filter(F.col("SnapshotDate") > as_date(first)), free.filter(end > as_date(first))
    return rows, free


def _write_state(state: DataFrame, folder: str, month: DateLike) -> None:
    append_month(state.withColumn(STATE_MONTH, as_date(month)), folder, STATE_MONTH)


def start_state(portfolio: DataFrame, payment_free_months: DataFrame, folder: str, month: DateLike) -> None:
    """Write the state after `month` from all history: once, before the first monthly run."""
    _write_state(account_state(delinquency_info(*_until(portfolio, payment_free_months, None, month))), folder, month)


def run_month(portfolio: DataFrame, applications: DataFrame, payment_free_months: DataFrame, forbearance: DataFrame,
              folder: str, before: DateLike, month: DateLike) -> DataFrame:
    """The features of `month`; reads the state written after the month-end `before` and writes that after `month`.

    Of the portfolio only the snapshots after `before` up to `month` are read, of the state one partition. A rerun
    replaces the state.
    """
    spark = portfolio.sparkSession
    rows, free = _until(portfolio, payment_free_months, before, month)
    state = spark.read.parquet(folder).filter(F.col(STATE_MONTH) == as_date(before)).select("AccountNumber", *STATE_DATES)
    _write_state(merged_state(state, account_state(delinquency_info(rows, free))), folder, month)
    return month_features(rows, applications, free, forbearance, state)
