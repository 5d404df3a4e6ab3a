"""Month-end calendar expressions and date filters. The reporting date is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DateLike = Column | dt.date | str


def as_date(value: DateLike) -> Column:
    """A date column from a column, a `datetime.date` or an ISO string."""
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("date")


def is_month_end(date: Column) -> Column:
    return date == F.last_day(date)


def month_end_rows(df: DataFrame, date: str = "SnapshotDate") -> DataFrame:
    return df.filter(is_month_end(F.col(date)))


def recent_months(df: DataFrame, n: int, as_of: DateLike, date: str = "SnapshotDate") -> DataFrame:
    """Rows dated after `as_of` less `n` months."""
    return df.filter(F.col(date) > F.add_months(as_date(as_of), -n))


def first_of_month(date: Column) -> Column:
    return F.trunc(date, "month")


def previous_month_end(date: Column) -> Column:
    return F.date_sub(F.trunc(date, "month"), 1)


def latest_month_end(df: DataFrame, date: str = "SnapshotDate") -> Column:
    """Largest month-end in `df` as a scalar subquery."""
    return month_end_rows(df, date).agg(F.max(date)).scalar()


def report_dates(df: DataFrame, as_of: DateLike | None = None, date: str = "SnapshotDate") -> DataFrame:
    """One row: ReportDate and the last day of the month before it.

    Without `as_of` the report date is the largest month-end in `df`.
    """
    if as_of is None:
        row = month_end_rows(df, date).agg(F.max(date).alias("ReportDate"))
    else:
        row = df.sparkSession.range(1).select(as_date(as_of).alias("ReportDate"))
    return row.select("ReportDate", previous_month_end(F.col("ReportDate")).alias("PreviousMonthEnd"))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def calendar_months_between(start: Column, end: Column) -> Column:
    """Number of month boundaries crossed, whatever the days."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def year_month(date: Column) -> Column:
    return F.year(date) * 100 + F.month(date)


def roll_to_month_end(date: Column) -> Column:
    """Forward to the month-end; a date already there moves to the next one."""
    return F.when(is_month_end(date), F.last_day(F.date_add(date, 1))).otherwise(F.last_day(date))


def full_years(birth: Column, at: DateLike) -> Column:
    """Completed years at a date."""
    at = as_date(at)
    birthday_ahead = (F.month(at) < F.month(birth)) | (
        (F.month(at) == F.month(birth)) & (F.dayofmonth(at) < F.dayofmonth(birth))
    )
    return F.year(at) - F.year(birth) - F.when(birthday_ahead, 1).otherwise(0)


def disbursed_before(df: DataFrame, as_of: DateLike, date: str = "DisbursedDate") -> DataFrame:
    """Drop loans disbursed in the month of `as_of` or later."""
    return df.filter(F.col(date) < first_of_month(as_date(as_of)))


def vintage_filter(df: DataFrame, start: DateLike | None = None, end: DateLike | None = None,
                   date: str = "DisbursedDate") -> DataFrame:
    """Loans disbursed within [start, end]; either end may be open."""
    if start is not None:
        df = df.filter(F.col(date) >= as_date(start))
    if end is not None:
        df = df.filter(F.col(date) <= as_date(end))
    return df


def mob_filter(df: DataFrame, above: int | None = None, below: int | None = None) -> DataFrame:
    """Months on book strictly above and strictly below the given limits."""
    if above is not None:
        df = df.filter(F.col("MOB") > above)
    if below is not None:
        df = df.filter(F.col("MOB") < below)
    return df
