"""The macro instrument. Inputs are monthly series: a few hundred rows, one per month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.dates import DateLike, as_date, roll_to_month_end
from riskspark.functions.scalars import clean_pow, rolling_mean, to_number

# Fixed value: inflation at or below this is taken as missing and the forecast is used.
INFLATION_FLOOR = -11


def macro_series(raw: DataFrame, start: DateLike | None = None, end: DateLike | None = None,
                 inflation: str = "Inflation", forecast: str = "Forecast") -> DataFrame:
    """Month-end dates within [start, end], numeric inflation and forecast, and their merged series."""
    df = raw.withColumn("Date", roll_to_month_end(F.col("Date")))
    if start is not None:
        df = df.filter(F.col("Date") >= as_date(start))
    if end is not None:
        df = df.filter(F.col("Date") <= as_date(end))
    df = df.withColumns({inflation: to_number(F.col(inflation)), forecast: to_number(F.col(forecast))})
    merged = F.when(F.col(inflation) > INFLATION_FLOOR, F.col(inflation) + 1).otherwise(F.col(forecast) + 1)
    return df.withColumn("InflationAll", merged)


def rolling_means(series: DataFrame, columns: Sequence[str], n: int, suffix: str = "Mean") -> DataFrame:
    return series.withColumns({f"{c}{suffix}": rolling_mean(F.col(c), n, F.col("Date")) for c in columns})


def macro_instrument(series: DataFrame) -> DataFrame:
    """Six-month mean inflation led by three months, cube root, over its own mean, smoothed over three
    months, tenth root."""
    order = Window.partitionBy(F.lit(0)).orderBy("Date")
    whole = Window.partitionBy(F.lit(0))
    df = rolling_means(series, ["InflationAll"], 6)
    df = df.withColumn("InflationAllMeanLagged", F.lead("InflationAllMean", 3).over(order))
    df = df.withColumn("Instrument", clean_pow(F.col("InflationAllMeanLagged"), 1 / 3))
    df = df.withColumn("InstrumentNormalized", F.col("Instrument") / F.avg("Instrument").over(whole))
    smooth = rolling_mean(F.col("InstrumentNormalized"), 3, F.col("Date"))
    return df.withColumn("InstrumentRollingMean", smooth).withColumn(
        "InstrumentRollingMean", clean_pow(F.col("InstrumentRollingMean"), 1 / 10))


def correlation_ranking(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of each feature with the target over rows where both are known, largest first."""
    row = df.agg(*[F.corr(F.col(f).cast("double"), F.col(target).cast("double")).alias(f) for f in features])
    return row.unpivot([], list(features), "Feature", "Correlation").orderBy(F.col("Correlation").desc_nulls_last(), "Feature")
