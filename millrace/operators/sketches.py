"""Sketches of distinct keys, stored a version and compared later without reading the version again."""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Binary logarithm of the hashes that a sketch keeps: up to so many distinct keys it is exact.
LOG_ENTRIES = 12
#: Standard errors within which an estimate is stated to lie (99.7 % of them do), relative to the union of what is compared.
DEVIATIONS = 3


def stated_error(log_entries: int = LOG_ENTRIES) -> float:
    """The relative error that is stated for an estimate: DEVIATIONS over the root of the hashes kept."""
    return DEVIATIONS / (1 << log_entries) ** 0.5


def key_sketches(df: DataFrame, version: str, keys: dict[str, list[str]], log_entries: int = LOG_ENTRIES) -> DataFrame:
    """``version, key, rows, known, sketch``: of each named set of columns the rows, those without a null, and a theta sketch.

    One pass for all keys: tasks sketch what they read and sketches of a fixed size are merged. A single column is taken
    as it is, several as text with a separator that no other value makes equal.
    """

    def value(columns: list[str]) -> tuple[Column, Column]:
        there = reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in columns])
        text = [F.col(f"`{c}`").cast("string") for c in columns]
        joined = text[0] if len(columns) == 1 else F.to_json(F.array(*text))
        return there, F.when(there, joined)

    each = []
    for name, columns in keys.items():
        there, x = value(columns)
        each.append(F.struct(F.lit(name).alias("key"), F.count("*").alias("rows"), F.count_if(there).alias("known"), F.theta_sketch_agg(x, F.lit(log_entries)).alias("sketch")))
    return df.agg(F.array(*each).alias("r")).select(F.inline("r")).select(F.lit(version).alias("version"), "key", "rows", "known", "sketch")


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """``version, key, rows, known, distinct`` of stored sketches."""
    return sketches.select("version", "key", "rows", "known", F.theta_sketch_estimate("sketch").alias("distinct"))


def union_estimates(sketches: DataFrame, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """``key, versions, distinct``: distinct keys over all stored versions."""
    return sketches.groupBy("key").agg(F.count("*").alias("versions"), F.theta_sketch_estimate(F.theta_union_agg("sketch", F.lit(log_entries))).alias("distinct"))


def overlap_estimates(sketches: DataFrame, left: str, right: str) -> DataFrame:
    """``key, both, only_left, only_right`` of two stored versions."""
    a, b = (sketches.where(F.col("version") == v).select("key", F.col("sketch").alias(n)) for v, n in ((left, "a"), (right, "b")))
    both, only = F.theta_intersection("a", "b"), lambda x, y: F.theta_sketch_estimate(F.theta_difference(x, y))
    return a.join(b, "key").select("key", F.theta_sketch_estimate(both).alias("both"), only("a", "b").alias("only_left"), only("b", "a").alias("only_right"))


def repeated_estimates(sketches: DataFrame, versions: list[str]) -> DataFrame:
    """``key, repeated``: keys that more than one of ``versions`` has, from the union of the versions' pairwise intersections."""
    wide = sketches.where(F.col("version").isin(*versions)).groupBy("key").agg(*[F.max(F.when(F.col("version") == v, F.col("sketch"))).alias(f"s{k}") for k, v in enumerate(versions)])
    pairs = [F.theta_intersection(f"s{i}", f"s{j}") for i, j in itertools.combinations(range(len(versions)), 2)]
    return wide.select("key", (F.theta_sketch_estimate(reduce(F.theta_union, pairs)) if pairs else F.lit(0).cast("long")).alias("repeated"))
