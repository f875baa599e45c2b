"""Hot keys in joins, and stored sketches against exact counts."""

from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from millrace.core.schemas import ForeignKey
from millrace.operators import clean, consolidate, sketches, skew


def lines(spark, n=30_000):
    """A third of the rows on one key, a tenth without one."""
    k = F.col("id")
    return spark.range(n).select(k.alias("row"), F.when(k % 3 == 0, F.lit(5)).when(k % 10 != 1, k % 4001).cast("long").alias("k"))


def test_hot_keys(spark):
    assert skew.hot_keys(lines(spark), "k") == [5]
    texts = spark.createDataFrame([("a",)] * 50 + [(None,)] * 50 + [(f"t{i}",) for i in range(40)], "k string")
    assert skew.hot_keys(texts, "k", 0.2) == ["a"]
    assert skew.hot_keys(texts.limit(0), "k") == [] and skew.hot_keys(texts.where("k is null"), "k") == []


@pytest.mark.parametrize("operator", ["join", "orphans"])
def test_rows_of_a_hot_key_are_balanced(spark, operator):
    """Joined by shuffle, with nothing left to adaptive execution: no task gets much more than another."""
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in held}
    right = spark.range(0, 4001, 2).select(F.col("id").alias("key"), (F.col("id") * 10).alias("v"))
    right = right.unionByName(spark.createDataFrame([(5, 50)], "key long, v long"))
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        sizes, rows = {}, {}
        for share in (None, skew.HOT_SHARE):
            if operator == "join":
                out, _ = consolidate.safe_left_join(lines(spark), right, "k", "key", "hit", hot_share=share)
            else:
                out = clean.drop_orphans(lines(spark), (ForeignKey("k", "p", "key"),), {"p": right}, hot_share=share)
            sizes[share] = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            rows[share] = sorted(map(str, out.collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert rows[None] == rows[skew.HOT_SHARE]
    assert max(sizes[None]) > 2.5 * statistics.median(sizes[None])
    assert max(sizes[skew.HOT_SHARE]) < 2 * statistics.median(sizes[skew.HOT_SHARE])


def test_bridge_names_with_hot_values(spark):
    bridge = spark.createDataFrame([(k, 1 if k % 3 else k % 7) for k in range(300)] + [(1, 9), (1, None), (None, 1)], "job long, skill long")
    names = spark.createDataFrame([(1, "one"), (2, "two"), (1, "uno"), (9, None), (4, "four")], "skill long, name string")
    spec = consolidate.BridgeSummary("b", "job", "skill", "skill", "n", "skill", "name")
    plain, measured = (sorted(map(str, consolidate.summarise_bridge(bridge, spec, names, share).collect())) for share in (None, 0.1))
    assert plain == measured and "Row(job=1, skill_count=1, top_skill='one', skill_list=['one'])" in plain


def test_sketches_keep_to_the_stated_error(spark):
    """Overlaps of tens of thousands of keys, far beyond the hashes that a sketch keeps."""
    bounds = {"v1": (0, 40_000), "v2": (25_000, 70_000), "v3": (60_000, 90_000)}
    made = lambda v: spark.range(*bounds[v]).select(F.col("id").alias("k"), F.when(F.col("id") % 5 != 0, F.col("id") % 1000).alias("small"))
    parts = [sketches.key_sketches(made(v).unionByName(made(v)), v, {"k": ["k"], "pair": ["k", "small"]}) for v in bounds]
    stored = parts[0].unionByName(parts[1]).unionByName(parts[2]).cache()
    error, whole = sketches.stated_error(), 90_000
    found = {(r["version"], r["key"]): r for r in sketches.distinct_estimates(stored).collect()}
    for v, (a, b) in bounds.items():
        assert abs(found[v, "k"]["distinct"] - (b - a)) <= error * (b - a)
        assert (found[v, "k"]["rows"], found[v, "k"]["known"], found[v, "pair"]["known"]) == (2 * (b - a), 2 * (b - a), 2 * (b - a) * 4 // 5)
    union = {r["key"]: r for r in sketches.union_estimates(stored).collect()}
    assert union["k"]["versions"] == 3 and abs(union["k"]["distinct"] - whole) <= error * whole
    both = {r["key"]: r for r in sketches.overlap_estimates(stored, "v1", "v2").collect()}
    for key, share in (("k", 1.0), ("pair", 0.8)):
        for measure, n in (("both", 15_000), ("only_left", 25_000), ("only_right", 30_000)):
            assert abs(both[key][measure] - share * n) <= error * share * 70_000
    again = {r["key"]: r["repeated"] for r in sketches.repeated_estimates(stored, list(bounds)).collect()}
    assert abs(again["k"] - 25_000) <= error * whole
    assert sketches.repeated_estimates(stored, ["v1"]).first()["repeated"] == 0
    stored.unpersist()


def test_small_sketches_are_exact(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2), (None, None)], "x string, y int")
    stored = sketches.key_sketches(rows, "v", {"x": ["x"], "xy": ["x", "y"]}).unionByName(sketches.key_sketches(rows.limit(0), "none", {"x": ["x"], "xy": ["x", "y"]}))
    assert {tuple(r) for r in sketches.distinct_estimates(stored).collect()} == {("v", "x", 5, 3, 2), ("v", "xy", 5, 2, 1), ("none", "x", 0, 0, 0), ("none", "xy", 0, 0, 0)}
    assert {tuple(r) for r in sketches.overlap_estimates(stored, "v", "none").collect()} == {("x", 0, 2, 0), ("xy", 0, 1, 0)}
