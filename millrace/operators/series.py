"""Ordered series: calendars, moving means, seasons, autocorrelation, growth, volatility.

Rows are counted by period first, with partial sums before the shuffle; what a window orders afterwards is a row a
period (of a category where there is one), not the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def daily(df: DataFrame, ts: str, by: list[str] | None = None) -> DataFrame:
    """``day, n`` for every day from the first to the last (of all rows), with 0 for days without rows."""
    counts = df.where(F.col(ts).isNotNull()).groupBy(*(by or []), F.to_date(ts).alias("day")).agg(F.count("*").alias("n"))
    return _filled(counts, "day", F.expr("interval 1 day"), by)


def _filled(counts: DataFrame, period: str, step: Column, by: list[str] | None) -> DataFrame:
    span = counts.agg(F.min(period).alias("lo"), F.max(period).alias("hi")).where("lo is not null")
    calendar = span.select(F.explode(F.sequence("lo", "hi", step)).alias(period))
    if by:
        # the grid is a calendar for each category that occurs, made as a list in the category's row; the span is a scalar, no join
        days = span.select(F.sequence("lo", "hi", step)).scalar()
        calendar = counts.select(*by).distinct().withColumn("__days", days).select(*by, F.explode("__days").alias(period))
    return calendar.join(counts, [*(by or []), period], "left").select(*(by or []), period, F.coalesce("n", F.lit(0)).alias("n"))


def rolling_mean(series: DataFrame, period: str = "day", value: str = "n", size: int = 7, by: list[str] | None = None) -> DataFrame:
    """``series`` with ``rolling``: the mean of the last ``size`` periods, null before there are so many."""
    w = W.partitionBy(*(by or [F.lit(0)])).orderBy(period).rowsBetween(1 - size, 0)
    return series.withColumn("rolling", F.when(F.count(value).over(w) == size, F.avg(value).over(w)))


def weekly(df: DataFrame, ts: str, by: list[str] | None = None) -> DataFrame:
    """``week, n`` by the Sunday that ends a week, empty weeks 0."""
    week = F.date_add(F.date_trunc("week", ts).cast("date"), 6)
    counts = df.where(F.col(ts).isNotNull()).groupBy(*(by or []), week.alias("week")).agg(F.count("*").alias("n"))
    return _filled(counts, "week", F.expr("interval 7 days"), by)


def monthly(df: DataFrame, ts: str, by: list[str] | None = None) -> DataFrame:
    """``month, n`` by the last day of a month, empty months 0."""
    counts = df.where(F.col(ts).isNotNull()).groupBy(*(by or []), F.trunc(ts, "month").alias("month")).agg(F.count("*").alias("n"))
    return _filled(counts, "month", F.expr("interval 1 month"), by).withColumn("month", F.last_day("month"))


def by_weekday(df: DataFrame, ts: str) -> DataFrame:
    """``weekday, n``, Monday 0 to Sunday 6."""
    return df.where(F.col(ts).isNotNull()).groupBy(F.weekday(ts).alias("weekday")).agg(F.count("*").alias("n"))


def decompose(series: DataFrame, period: str = "day", value: str = "n", length: int = 7) -> DataFrame:
    """``series`` with ``trend`` (centred mean), ``season`` (centred mean by place in the cycle) and ``residual``."""
    every = W.partitionBy(F.lit(0)).orderBy(period)
    half = length // 2
    around = every.rowsBetween(-half, half)
    place = F.pmod(F.row_number().over(every) - 1, F.lit(length))
    out = series.withColumn("trend", F.when(F.count(value).over(around) == length, F.avg(value).over(around))).withColumn("__place", place)
    out = out.withColumn("__mean", F.avg(F.col(value) - F.col("trend")).over(W.partitionBy("__place")))
    means = out.groupBy("__place").agg(F.first("__mean").alias("m")).agg(F.avg("m").alias("__centre")).withColumn("__k", F.lit(1))
    out = out.withColumn("__k", F.lit(1)).join(means, "__k").withColumn("season", F.col("__mean") - F.col("__centre"))
    return out.withColumn("residual", F.col(value) - F.col("trend") - F.col("season")).drop("__place", "__mean", "__centre", "__k")


def autocorrelation(series: DataFrame, period: str = "day", value: str = "n", most: int = 30) -> DataFrame:
    """``lag, acf`` for lags 0 to min(most, n / 2 - 1): sums of lagged products over the sum of squares."""
    every = W.partitionBy(F.lit(0))
    x = series.select(F.row_number().over(every.orderBy(period)).alias("i"), (F.col(value) - F.avg(value).over(every)).alias("x"), F.count("*").over(every).alias("n"))
    lags = x.select("i", "x", "n", F.explode(F.sequence(F.lit(0), F.least(F.lit(most), F.floor(F.col("n") / 2) - 1).cast("int"))).alias("lag"))
    other = x.select((F.col("i")).alias("j"), F.col("x").alias("y"))
    sums = lags.join(other, F.col("j") == F.col("i") + F.col("lag")).groupBy("lag").agg(F.sum(F.col("x") * F.col("y")).alias("s"))
    return sums.select("lag", (F.col("s") / F.max(F.when(F.col("lag") == 0, F.col("s"))).over(every)).alias("acf"))


def growth_halves(df: DataFrame, ts: str, by: str, middle: Column) -> DataFrame:
    """``by, first_half, second_half, growth_pct``: rows before and from ``middle``; null growth without first rows."""
    counts = df.groupBy(by).agg(F.count_if(F.col(ts) < middle).alias("first_half"), F.count_if(F.col(ts) >= middle).alias("second_half"))
    return counts.withColumn("growth_pct", 100 * F.try_divide(F.col("second_half") - F.col("first_half"), F.col("first_half")))


def volatility(df: DataFrame, ts: str, by: str) -> DataFrame:
    """``by, weeks, mean, cv``: coefficient of variation of zero-filled weekly counts."""
    return weekly(df, ts, [by]).groupBy(by).agg(F.count("*").alias("weeks"), F.avg("n").alias("mean"), F.try_divide(F.stddev_samp("n"), F.avg("n")).alias("cv"))


def period_share(df: DataFrame, ts: str, by: str) -> DataFrame:
    """``month, by, n, pct``: share of each category in its month."""
    counts = df.where(F.col(ts).isNotNull()).groupBy(F.trunc(ts, "month").alias("month"), by).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", 100 * F.col("n") / F.sum("n").over(W.partitionBy("month")))
