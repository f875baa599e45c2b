"""Comparing versions and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import ordered
from millrace.operators.ordered import quantiles, running_counts, value_counts


def key_overlap(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``both, only_left, only_right, left_in_right_pct, right_in_left_pct`` of the distinct non-null keys.

    Each side is made distinct and both are counted by key: one shuffle, no join of the rows.
    """
    a = left.select(F.col(left_key).alias("k"), F.lit(1).alias("l"), F.lit(0).alias("r"))
    b = right.select(F.col(right_key).alias("k"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    keys = a.unionByName(b).where("k is not null").groupBy("k").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    out = keys.agg(F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("both"), F.count_if(F.col("r") == 0).alias("only_left"), F.count_if(F.col("l") == 0).alias("only_right"))
    pct = lambda only: F.round(100 * F.try_divide(F.col("both"), F.col("both") + F.col(only)), 4)
    return out.withColumns({"left_in_right_pct": pct("only_left"), "right_in_left_pct": pct("only_right")})


def missing_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct non-null keys of ``child`` that ``parent`` lacks."""
    ids = parent.select(F.col(parent_column).alias("__p"))
    keys = child.select(F.col(column).alias("key")).where("key is not null").distinct()
    return keys.join(ids, F.col("key") == F.col("__p"), "left_anti")


def version_diff(left: DataFrame, right: DataFrame, dates: tuple[str, ...] = ()) -> DataFrame:
    """``column, left_type, right_type, left_null_pct, right_null_pct, left_low, left_high, right_low, right_high``.

    A row for each column of either version; types from the schemas, the rest from one aggregate a version.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        each = F.array(*[
            F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias(f"{name}_type"), F.round(100 * F.avg(F.col(f"`{f.name}`").isNull().cast("int")), 4).alias(f"{name}_null_pct"),
                     (F.min(f"`{f.name}`").cast("string") if f.name in dates else F.lit(None).cast("string")).alias(f"{name}_low"), (F.max(f"`{f.name}`").cast("string") if f.name in dates else F.lit(None).cast("string")).alias(f"{name}_high"))
            for f in df.schema.fields
        ])
        return df.agg(each.alias("r")).select(F.inline("r"))

    return side(left, "left").join(side(right, "right"), "column", "full")


def row_counts(versions: dict[str, DataFrame]) -> DataFrame:
    """``version, rows``."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(v).alias("version"), "rows") for v, df in versions.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def repeated_across(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Keys that occur in more than one version, with their number of versions."""
    return df.groupBy(*keys).agg(F.count_distinct(version).alias("versions")).where("versions > 1")


def clip_percentiles(df: DataFrame, col: str, low: float = 0.01, high: float = 0.99, by: str | None = None) -> DataFrame:
    """Rows between two percentiles of ``col`` (linear between values, bounds included), of each group if ``by``."""
    if by:
        limits = ordered.group_quantiles(df, [by], col, [low, high]).select(F.col(by).alias("__by"), "q0", "q1").withColumnsRenamed({"q0": "__low", "q1": "__high"})
        return df.join(limits, F.col(by).eqNullSafe(F.col("__by"))).where(F.col(col).between(F.col("__low"), F.col("__high"))).drop("__low", "__high", "__by")
    one = quantiles(df, col, [low, high])
    return df.where(F.col(col).between(*one)) if one else df.limit(0)


def iqr_outliers(df: DataFrame, col: str, reach: float = 1.5) -> DataFrame:
    """``q1, q3, low_fence, high_fence, outliers, pct``."""
    q = quantiles(df, col, [0.25, 0.75])
    if q is None:
        return df.sparkSession.createDataFrame([], "q1 double, q3 double, low_fence double, high_fence double, outliers long, pct double")
    lo, hi = q[0] - reach * (q[1] - q[0]), q[1] + reach * (q[1] - q[0])
    out = ~F.col(col).between(lo, hi)
    return df.agg(F.lit(q[0]).alias("q1"), F.lit(q[1]).alias("q3"), F.lit(lo).alias("low_fence"), F.lit(hi).alias("high_fence"), F.count_if(out).alias("outliers"), (100 * F.avg(out.cast("int"))).alias("pct"))


def median_ratio(df: DataFrame, by: str, over: Column, under: Column) -> DataFrame:
    """``by, n, ratio``: the median of ``over / under`` of each group."""
    rows = df.select(F.col(by), F.try_divide(over, under).cast("double").alias("__r"))
    return ordered.with_quantiles(rows.groupBy(by).agg(F.count("__r").alias("n")), rows, [by], "__r", {"ratio": 0.5})


def close_share(df: DataFrame, a: Column, b: Column, within: float = 1.0) -> DataFrame:
    """``pct``: rows in which two values differ by less than ``within``."""
    return df.agg((100 * F.avg((F.abs(a - b) < within).cast("int"))).alias("pct"))


def ecdf(df: DataFrame, col: str) -> DataFrame:
    """``value, share``: the share of rows up to each distinct value."""
    return running_counts(value_counts(df, col)).select(F.col("v").alias("value"), (F.col("upto") / F.col("total")).alias("share"))


def extremes(df: DataFrame, col: str, n: int, ties: str, low: bool = False) -> DataFrame:
    """The ``n`` largest rows, or smallest positive ones, of a column (ties by another)."""
    return df.where(F.col(col) > 0).orderBy(F.col(col).asc(), ties).limit(n) if low else df.where(F.col(col).isNotNull()).orderBy(F.col(col).desc(), ties).limit(n)


def top_per_group(df: DataFrame, by: str, col: str, n: int, ties: str) -> DataFrame:
    """The ``n`` largest rows of each group with their ``rank``.

    Spark limits each task to the first ``n`` rows of a group before the shuffle, so a hot group stays small.
    """
    from pyspark.sql import Window as W

    return df.withColumn("rank", F.row_number().over(W.partitionBy(by).orderBy(F.col(col).desc_nulls_last(), ties))).where(F.col("rank") <= n)


def in_order(df: DataFrame, col: str, order: list[str]) -> DataFrame:
    """``position`` and the rows of ``df`` for each of the declared values; values without a row get nulls."""
    wanted = df.sparkSession.createDataFrame(list(enumerate(order)), "position int, __v string")
    return wanted.join(df, F.col("__v") == F.col(col), "left").drop(col).withColumnRenamed("__v", col)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows by the MD5 of seed and key: the same rows however the table is partitioned, in any engine."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string"))), key).limit(n)
