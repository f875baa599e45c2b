"""Splits in which no group is in two parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def check_input(df: DataFrame, group: str, target: str, least_groups: int = 10) -> None:
    """Raise on null groups, targets that are null, not finite or not positive, and too few groups; one aggregate."""
    t = F.col(target)
    bad = t.isNull() | F.isnan(t) | (F.abs(t) == float("inf")) | (t <= 0)
    r = df.agg(F.count_if(F.col(group).isNull()).alias("null_group"), F.count_if(bad).alias("bad_target"), F.count_distinct(group).alias("groups")).first()
    if r["null_group"] or r["bad_target"] or r["groups"] < least_groups:
        raise ValueError(f"not fit for a split: {r.asDict()}")


def group_split(df: DataFrame, group: str, test: float = 0.2, validation: float = 0.1, seed: int = 42, digits: int = 3) -> DataFrame:
    """``df`` with ``split``: a share ``test`` of the *groups*, then ``validation`` of all of them, the rest train.

    Groups are ranked by the MD5 of seed and group (then by the group itself, so that the order is total); any engine can
    repeat it. Ranks are found in two steps: groups are counted in ranges of the hash's first hex ``digits``, then ranked
    within a range, so that no task sorts all groups. The cuts are ceil(test * groups) and, of the rest,
    ceil(validation / (1 - test) * rest).
    """
    h = F.md5(F.concat_ws(":", F.lit(seed), F.col("g").cast("string")))
    groups = df.select(F.col(group).alias("g")).distinct().withColumn("h", h).withColumn("part", F.substring("h", 1, digits))
    sizes = groups.groupBy("part").agg(F.count("*").alias("n"))
    every = W.orderBy("part")
    sizes = sizes.select("part", (F.sum("n").over(every) - F.col("n")).alias("before"), F.sum("n").over(W.partitionBy(F.lit(1))).alias("total"))
    ranked = groups.withColumn("rank", F.row_number().over(W.partitionBy("part").orderBy("h", "g"))).join(sizes, "part")
    n_test = F.ceil(F.lit(test) * F.col("total"))
    n_validation = F.ceil(F.lit(round(validation / (1 - test), 12)) * (F.col("total") - n_test))
    place = F.col("before") + F.col("rank")
    named = ranked.select(F.col("g").alias("__g"), F.when(place <= n_test, "test").when(place <= n_test + n_validation, "validation").otherwise("train").alias("split"))
    return df.join(named, F.col(group).eqNullSafe(F.col("__g"))).drop("__g")


def ratio_audit(df: DataFrame, split: str = "split") -> DataFrame:
    """``split, rows, pct``."""
    sizes = df.groupBy(split).agg(F.count("*").alias("rows"))
    return sizes.select(split, "rows", F.round(100 * F.col("rows") / F.sum("rows").over(W.partitionBy(F.lit(1))), 4).alias("pct"))


def overlap(df: DataFrame, group: str, split: str = "split") -> DataFrame:
    """``shared_groups``: groups that are in more than one split; 0 in a sound one."""
    return df.groupBy(group).agg(F.count_distinct(split).alias("n")).agg(F.count_if(F.col("n") > 1).alias("shared_groups"))


def conserved(before: DataFrame, after: DataFrame, row_id: str, split: str = "split") -> DataFrame:
    """``rows_before, rows_after, shared_rows``: rows are kept and each is in one split."""
    b = before.agg(F.count("*").alias("rows_before")).withColumn("k", F.lit(1))
    shared = after.groupBy(row_id).agg(F.count_distinct(split).alias("n"), F.count("*").alias("m"))
    a = shared.agg(F.sum("m").alias("rows_after"), F.count_if(F.col("n") > 1).alias("shared_rows")).withColumn("k", F.lit(1))
    return b.join(a, "k").drop("k")
