"""Counts of steps, quantiles by bits and tail probabilities against plain versions."""

from __future__ import annotations

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from millrace.core.schemas import CleaningRule, ForeignKey
from millrace.functions import stats
from millrace.operators import clean, features, groups, ordered, steps


def test_bits_keep_the_order_of_doubles(spark):
    rng = random.Random(1)
    values = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    values += [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, float("inf"), float("-inf"), 1.7976931348623157e308]
    values += [x for k in range(-1020, 1023) for x in (2.0**k, 2.0**k * (1 - 2.0**-53), 2.0**k * (1 + 2.0**-52), -(2.0**k))]
    got = spark.createDataFrame([(v,) for v in values if v == v], "v double").select("v", ordered.bits(F.col("v")).alias("b")).collect()
    for r in got:
        raw = struct.unpack("<q", struct.pack("<d", r["v"]))[0]
        assert r["b"] == (raw if raw >= 0 else -(raw & (1 << 63) - 1))
    assert spark.range(1).select(ordered.bits(F.lit(float("nan"))).alias("b")).first()["b"] > max(r["b"] for r in got)


@pytest.mark.parametrize("room", [16, 2])
def test_group_quantiles(spark, monkeypatch, room):
    """With cells that are put in order, and with ones that are split down to single values."""
    monkeypatch.setattr(ordered, "ORDERED_BITS", room)
    rng = random.Random(2)
    draw = lambda: rng.choice([rng.gauss(0, 1), float(rng.randrange(4)), 1e300 * rng.random(), -1e-310 * rng.random(), None, 7.25])
    rows = [(rng.choice(["a", "b", None]), rng.randrange(2), draw()) for _ in range(3000)] + [("one", 0, -3.5), ("none", 0, None), ("inf", 0, float("inf")), ("inf", 0, float("-inf")), ("inf", 1, float("nan"))]
    df = spark.createDataFrame(rows, "k string, j int, v double")
    shares = [0.0, 0.1, 0.5, 0.99, 1.0]
    got = {(r["k"], r["j"]): (r["n"], [r[f"q{i}"] for i in range(5)]) for r in ordered.group_quantiles(df, ["k", "j"], "v", shares).collect()}
    want = {(r["k"], r["j"]): (r["n"], r["p"]) for r in df.where("v is not null").groupBy("k", "j").agg(F.count("v").alias("n"), F.percentile("v", shares).alias("p")).collect()}
    assert got.keys() == want.keys()
    for k, (n, p) in want.items():
        assert got[k][0] == n
        assert all(a == pytest.approx(b, rel=1e-12, nan_ok=True) for a, b in zip(got[k][1], p))
    assert {r["n"] for r in ordered.group_quantiles(df, ["k"], "v", [0.5], support=100).collect()} == {want[k, 0][0] + want[k, 1][0] for k in ("a", "b", None)}
    assert ordered.group_quantiles(df.limit(0), ["k"], "v", [0.5]).collect() == []
    assert ordered.group_quantiles(df.where("k = 'one'"), [], "v", [0.5]).first().asDict() == {"n": 1, "q0": -3.5}


def test_medians_of_a_hot_group_meet_in_no_task(spark):
    """A third of all rows in one group with values that share their first bits: its cell is dealt over the parts."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), (1 + F.col("id") / 1e9).alias("v"))
    rows = ordered._inside(df.select(F.struct("k").alias("g"), "v", ordered.bits(F.col("v")).alias("bits")), spark.createDataFrame([(("hot",), 0x3FF0)], "g struct<k: string>, prefix long"), 48)
    sizes = [r["count"] for r in rows.groupBy(F.pmod(F.hash("bits"), F.lit(ordered.CELL_PARTS))).count().collect()]
    assert sum(sizes) == 10_000 and len(sizes) == ordered.CELL_PARTS and max(sizes) < 1000
    found = {r["k"]: r["q0"] for r in ordered.group_quantiles(df, ["k"], "v", [0.5], support=2).collect()}
    assert found == {"hot": pytest.approx(1 + 14998.5 / 1e9, abs=1e-15)}


def test_group_reports(spark):
    df = spark.createDataFrame([("a", "x y", 1.0, 3.0), ("a", "y", 2.0, None), (None, "x x", 9.0, 4.0), ("b", None, None, 5.0), ("b", "z", 4.0, 1.0)], "k string, items string, v double, w double")
    items = F.split("items", " ")
    assert {tuple(r) for r in groups.with_without(df, items, "v", 2).select("item", "n", "with_median", "without_median").collect()} == {("x", 2, 5.0, 3.0), ("y", 2, 1.5, 6.5)}
    assert groups.with_without(df.limit(0), items, "v").collect() == []
    assert {(r["k"], r["n"], r["median"]) for r in groups.group_stats(df, "k", "v").collect()} == {("a", 2, 1.5), (None, 1, 9.0), ("b", 1, 4.0)}
    assert {r["k"]: r["median"] for r in groups.group_stats(df, "k", "v", accuracy=100).collect()}["a"] in (1.0, 2.0)
    assert {tuple(r) for r in groups.pivot_median(df, "k", "items", "v", ["y", "z"]).collect()} == {("a", 2.0, None), (None, None, None), ("b", None, 4.0)}
    assert groups.key_cardinality(df, ["k"]).first()["median"] == 2.0
    assert groups.key_cardinality(df.limit(0), ["k"]).first()["median"] is None
    audit = {r["column"]: r for r in groups.numeric_audit(df, ["v", "w"]).collect()}
    assert audit["v"]["p50"] == 3.0 and audit["w"]["p75"] == 4.25 and audit["v"]["missing"] == 1
    filled = features.fill_missing(df, {"v": "median", "k": "mode", "items": "mode"}, mode_limit=3)
    assert sorted(r["v"] for r in filled.collect()) == [1.0, 2.0, 3.0, 4.0, 9.0]
    assert {r["k"] for r in filled.collect()} == {"a", "b"} and filled.where("items is null").count() == 1
    ints = spark.createDataFrame([(2, True, 1), (None, None, 4), (10, False, None), (10, False, None), (2, True, None)], "n int, b boolean, m long")
    assert {tuple(r) for r in features.fill_missing(ints, {"n": "mode", "b": "mode", "m": "median"}).collect()} == {(2, True, 1), (2, False, 4), (10, False, 3), (2, True, 3)}


def tail(f, df1, df2):
    """The beta integral of an F tail by Simpson's rule over t = u**2, which takes the pole at 0 away."""
    x, a, b = df2 / (df2 + df1 * f), df2 / 2, df1 / 2
    g = lambda u: 2 * u ** (2 * a - 1) * (1 - u * u) ** (b - 1)
    n, end = 20_000, math.sqrt(x)
    total = sum((4 if k % 2 else 2) * g(end * k / n) for k in range(1, n)) + g(end) + (0 if a > 0.5 else g(1e-300))
    return total * end / n / 3 / math.exp(math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b))


def test_tail_of_f(spark):
    cases = [(4.0, 3, 20), (1.0, 5, 5), (0.2, 2, 7), (9.0, 4, 3), (1.3, 24, 600), (50.0, 2, 30)]
    df = spark.createDataFrame([(float(f), a, b) for f, a, b in cases], "f double, a long, b long")
    for (f, a, b), r in zip(cases, df.select(stats.f_tail(F.col("f"), F.col("a"), F.col("b")).alias("p")).collect()):
        assert r["p"] == pytest.approx(tail(f, a, b), rel=1e-6)
    odd = spark.createDataFrame([(None, 1, 2), (1.0, 0, 2), (0.0, 3, 9), (float("inf"), 2, 3)], "f double, a long, b long")
    assert [r["p"] for r in odd.select(stats.f_tail(F.col("f"), F.col("a"), F.col("b")).alias("p")).collect()] == [None, None, 1.0, 0.0]
    x = [0.5, 1.0, 3.7, 40.0, 3e5]
    assert [r["g"] for r in spark.createDataFrame([(v,) for v in x], "x double").select(stats.log_gamma(F.col("x")).alias("g")).collect()] == pytest.approx([math.lgamma(v) for v in x], abs=1e-9, rel=1e-13)


def test_anova_of_several_categories(spark):
    rng = random.Random(4)
    rows = [(rng.choice("abc"), rng.choice([None, "u", "v"]), rng.gauss(0, 1) + 3) for _ in range(200)] + [("lone", None, 5.0), ("a", "u", None)]
    got = {r["category"]: r for r in groups.anova(spark.createDataFrame(rows, "x string, y string, v double"), ["x", "y"], "v").collect()}
    for name, place in (("x", 0), ("y", 1)):
        parts = {}
        for r in rows:
            if r[2] is not None:
                parts.setdefault(r[place], []).append(r[2])
        parts = [p for p in parts.values() if len(p) > 1]
        n, grand = sum(map(len, parts)), sum(map(sum, parts)) / sum(map(len, parts))
        between = sum(len(p) * (sum(p) / len(p) - grand) ** 2 for p in parts) / (len(parts) - 1)
        within = sum((v - sum(p) / len(p)) ** 2 for p in parts for v in p) / (n - len(parts))
        assert (got[name]["groups"], got[name]["n"]) == (len(parts), n) and got[name]["f"] == pytest.approx(between / within)
        assert got[name]["p"] == pytest.approx(tail(between / within, len(parts) - 1, n - len(parts)), rel=1e-5)


@pytest.mark.parametrize("again", [False, True])
def test_step_log_of_cleaning(spark, tmp_path, monkeypatch, again):
    """The same counts from the writing run, and counted anew where tasks of that run were sent again."""
    monkeypatch.setattr(steps, "ran_again", lambda spark, group: again)
    tables = {
        "a": spark.createDataFrame([("1", " x  y", "5"), ("1.0", "x y", "-2"), ("zz", None, "7"), (None, "b", None)], "id string, v string, w string"),
        "b": spark.createDataFrame([(1,), (3,), (None,), (None,)], "a_id long"),
        "bad": spark.createDataFrame([(1,)], "k long"),
    }
    rules = {"a": CleaningRule(("id",), drop_null=("id",), fill_null={"v": "none"}, lower_bounds={"w": 0.0}, low_values="nullify"), "b": CleaningRule((), foreign_keys=(ForeignKey("a_id", "a", "id"),)), "bad": CleaningRule(("k",))}
    log = steps.StepLog()
    done, failed = clean.clean_version(tables, rules, {"a": {"id": "bigint", "w": "double"}}, {"a": [F.col("w")]}, folder=str(tmp_path), log=log)
    assert list(failed) == ["bad"]
    found = {(r["table"], r["name"], r["metric"]): r["value"] for r in log.report(spark).collect()}
    assert [found["a", s, "rows"] for s in ("input", "strings", "nulls dropped", "nulls filled", "types", "bounds", "duplicates", "orphans")] == [4, 4, 3, 3, 3, 3, 2, 2]
    assert [found["a", s, "nulls"] for s in ("input", "nulls dropped", "nulls filled", "types", "bounds")] == [3, 1, 0, 1, 2]
    assert (found["a", "nulls dropped", "filled"], found["a", "nulls filled", "lost"], found["a", "types", "low"]) == (1, 1, 1)
    assert not any(t == "bad" for t, _, _ in found) and found["b", "orphans", "rows"] == done["b"].count() == 2
    assert {tuple(r)[:4] for r in log.changes(spark).collect()} == {("a", 4, 2, 2), ("b", 4, 2, 2)}
    with pytest.raises(ValueError, match="folder"):
        clean.clean_version(tables, rules, {}, {}, log=steps.StepLog())


def test_steps_must_be_written(spark):
    log = steps.StepLog()
    log.watch(spark.range(3).toDF("x"), "t", "first")
    with pytest.raises(ValueError, match="first of t"):
        log.report(spark)
    assert not steps.ran_again(spark, "no such group")
