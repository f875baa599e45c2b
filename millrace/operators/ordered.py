"""Exact ranks and quantiles without a single-task sort: values are counted, dealt into ranges, and summed range by range."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.core.scratch import materialize

#: Bits by which a pass of ``group_quantiles`` narrows the cell of a rank, and parts over which a cell's rows are dealt.
CELL_BITS, CELL_PARTS = 16, 16
#: Binary logarithm of the distinct values up to which a cell is put in order.
ORDERED_BITS = 16
#: Ranges into which distinct values are dealt.
RANGES = 512


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``v, n``: the distinct non-null values of a numeric column and their rows."""
    return df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("v")).agg(F.count("*").alias("n"))


def running_counts(counts: DataFrame, ranges: int = RANGES) -> DataFrame:
    """``v, n, upto, total``: rows with a value up to ``v``, and all rows.

    The bounds of the ranges are approximate quantiles of the distinct values (a few hundred numbers on the driver), so
    ranges hold about as many values each; sums run within a range, and over a row a range, never over all values.
    """
    points = counts.agg(F.percentile_approx("v", [k / ranges for k in range(1, ranges)], 20 * ranges)).first()[0]
    inner = sorted({p for p in points or [] if abs(p) != float("inf") and p == p})
    splits = [-float("inf"), *(inner or [0.0]), float("inf")]
    dealt = Bucketizer(splits=splits, inputCol="v", outputCol="__range", handleInvalid="keep").transform(counts)
    sums = dealt.groupBy("__range").agg(F.sum("n").alias("s"))
    order = W.partitionBy(F.lit(0)).orderBy("__range")
    sums = sums.select("__range", (F.sum("s").over(order) - F.col("s")).alias("before"), F.sum("s").over(W.partitionBy(F.lit(0))).alias("total"))
    within = F.sum("n").over(W.partitionBy("__range").orderBy("v"))
    return dealt.withColumn("within", within).join(sums, "__range").select("v", "n", (F.col("before") + F.col("within")).alias("upto"), "total")


def positions(values: DataFrame, col: str, ranges: int = RANGES) -> DataFrame:
    """``values`` (distinct, not null) with ``position``, from 0, in the order of ``col``, which may be text.

    The bounds of the ranges are the values with the smallest hashes (fewer than ``ranges`` of them on the driver), so
    they are the same on every run; rows are numbered within a range and shifted by the sizes of those before it.
    """
    bounds = sorted(r[0] for r in values.select(col).orderBy(F.xxhash64(col), col).limit(ranges - 1).collect())
    below = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(col))) if bounds else F.lit(0)
    dealt = values.withColumn("__range", below)
    order = W.partitionBy(F.lit(0)).orderBy("__range")
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("__n")).select("__range", (F.sum("__n").over(order) - F.col("__n")).alias("__before"))
    numbered = dealt.withColumn("__place", F.row_number().over(W.partitionBy("__range").orderBy(col)) - 1)
    return numbered.join(sizes, "__range").withColumn("position", F.col("__before") + F.col("__place")).drop("__range", "__before", "__place")


def quantiles(df: DataFrame, col: str, shares: list[float]) -> list[float] | None:
    """Exact quantiles with linear interpolation; None for a column without values. Only two numbers a share reach the driver."""
    ranked = running_counts(value_counts(df, col))

    def at(place: Column) -> Column:
        return F.min(F.when(F.col("upto") > place, F.col("v")))

    cols = []
    for q in shares:
        low = F.floor(F.lit(q) * (F.col("total") - 1))
        high = F.ceil(F.lit(q) * (F.col("total") - 1))
        cols += [at(low), at(high)]
    row = ranked.agg(F.max("total"), *cols).first()
    if row[0] is None:
        return None
    out = []
    for k, q in enumerate(shares):
        place = q * (row[0] - 1)
        a, b = row[1 + 2 * k], row[2 + 2 * k]
        out.append(a + (b - a) * (place - int(place)))
    return out


def bits(value: Column) -> Column:
    """A double as a long of the same order: its binary form, mirrored for negative numbers.

    Both zeros are equal and NaN is above all. Powers of two are exact, so exponent and fraction are read off by
    divisions without rounding; the logarithm's guess of the exponent is set right by one step.
    """
    v = value.cast("double")
    a = F.abs(v)
    guess = F.floor(F.log2(F.when((a >= 2.0**-1022) & (a < float("inf")), a)))
    exponent = guess - F.when(F.pow(F.lit(2.0), guess) > a, 1).otherwise(0) + F.when(F.pow(F.lit(2.0), guess + 1) <= a, 1).otherwise(0)
    # 2.0 ** 1023 is the largest power; a / 2 ** exponent is in [1, 2) and exact
    part = ((a / F.pow(F.lit(2.0), exponent) - 1) * float(1 << 52)).cast("bigint")
    normal = (exponent + 1023) * (1 << 52) + part
    size = F.when(F.isnan(a), F.lit(0x7FF8 << 48)).when(a == float("inf"), F.lit(0x7FF0 << 48)).when(a < 2.0**-1022, (a * 2.0**537 * 2.0**537).cast("bigint")).otherwise(normal)
    return F.when(v < 0, -size).otherwise(size)


def _inside(rows: DataFrame, cells: DataFrame, low: int) -> DataFrame:
    """The rows of the wanted cells, with their ``prefix``; each cell is met by its rows in CELL_PARTS tasks."""
    dealt = cells.select("g", "prefix", F.explode(F.sequence(F.lit(0), F.lit(CELL_PARTS - 1))).alias("part"))
    placed = rows.withColumns({"prefix": F.shiftright("bits", low), "part": F.pmod(F.hash("bits"), F.lit(CELL_PARTS))})
    return placed.join(dealt, ["g", "prefix", "part"], "left_semi").drop("part")


def _wanted_of(counted: DataFrame) -> DataFrame:
    """The rows of ``counted`` (with ``n`` and ``upto``) in which a wanted rank lies; ranks count from the start of the row."""
    begun = F.col("upto") - F.col("n")
    here = F.filter("wanted", lambda x: (x.place >= F.col("begun")) & (x.place < F.col("upto")))
    here = F.transform(here, lambda x: F.struct(x.k.alias("k"), (x.place - F.col("begun")).alias("place")))
    return counted.withColumn("begun", begun).withColumn("wanted", here).where(F.size("wanted") > 0)


def group_quantiles(df: DataFrame, by: list[str], value: str, shares: list[float], support: int = 1) -> DataFrame:
    """``by, n, q0, q1 ...``: exact quantiles (linear between values) of the non-null ``value`` of every group at once.

    Values are counted by (group, value), then found by their bits: a pass counts each group's values by their next 16
    bits and keeps the cells in which a wanted rank lies (four passes at most). A cell of up to 65,536 distinct values is
    put in order; a larger one is split by its next bits. So a task orders or sums at most 65,536 rows of a group, never
    all its values; a cell with many values is dealt over several tasks before it is split. Groups with fewer than
    ``support`` values are left out; null is a group; NaN is the largest value.
    """
    group = F.struct(*[F.col(f"`{c}`") for c in by]) if by else F.struct(F.lit(0).alias("all"))
    counts = df.where(F.col(f"`{value}`").isNotNull()).select(group.alias("g"), F.col(f"`{value}`").cast("double").alias("v")).groupBy("g", "v").agg(F.count("*").alias("n"))
    rows = materialize(counts.withColumn("bits", bits(F.col("v"))), "quantile-counts")
    found: list[DataFrame] = []
    cells: DataFrame | None = None
    for low in range(64 - CELL_BITS, -1, -CELL_BITS):
        keys = ["g"] if cells is None else ["g", "prefix"]
        w = W.partitionBy(*keys)
        summed = rows.withColumn("next", F.shiftright("bits", low) if low else F.col("bits")).groupBy(*keys, "next").agg(F.sum("n").alias("n"), F.count("*").alias("values"), F.min("v").alias("least"))
        summed = summed.withColumn("upto", F.sum("n").over(w.orderBy("next").rowsBetween(W.unboundedPreceding, 0)))
        if cells is None:
            place = [f(F.lit(float(q)) * (F.col("total") - 1)) for q in shares for f in (F.floor, F.ceil)]
            wanted = F.array(*[F.struct(F.lit(k).alias("k"), p.alias("place")) for k, p in enumerate(place)])
            summed = summed.withColumn("total", F.sum("n").over(w)).where(F.col("total") >= support).withColumn("wanted", wanted)
        else:
            summed = summed.join(cells, keys)
        kept = materialize(_wanted_of(summed).select("g", F.col("next").alias("prefix"), "total", "values", "least", "wanted"), "quantile-cells")
        one, small = F.col("values") == 1, F.col("values") <= 1 << ORDERED_BITS
        found.append(kept.where(one).select("g", "total", F.col("least").alias("v"), F.explode("wanted.k").alias("k")))
        upto = F.sum("n").over(W.partitionBy("g", "prefix").orderBy("bits").rowsBetween(W.unboundedPreceding, 0))
        few = kept.where(~one & small).select("g", "prefix", "total", "wanted")
        in_order = _wanted_of(_inside(rows, few, low).withColumn("upto", upto).join(few, ["g", "prefix"]))
        found.append(in_order.select("g", "total", "v", F.explode("wanted.k").alias("k")))
        cells = kept.where(~small).select("g", "prefix", "total", "wanted")
        if cells.isEmpty():
            break
        rows = _inside(rows, cells, low)
    out = reduce(DataFrame.unionByName, found).groupBy("g", "total").agg(*[F.max(F.when(F.col("k") == k, F.col("v"))).alias(f"v{k}") for k in range(2 * len(shares))])

    def between(k: int, q: float) -> Column:
        a, b, p = F.col(f"v{2 * k}"), F.col(f"v{2 * k + 1}"), F.lit(float(q)) * (F.col("total") - 1)
        return F.when(a == b, a).otherwise(a + (b - a) * (p - F.floor(p))).alias(f"q{k}")

    return out.select(*[F.col(f"g.`{c}`").alias(c) for c in by], F.col("total").alias("n"), *[between(k, q) for k, q in enumerate(shares)])


def with_quantiles(stats: DataFrame, rows: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """``stats`` (one row a group of ``by``) with the quantiles of ``value`` in the groups of ``rows``, by name; null without values."""
    keys = {c: f"__by_{k}" for k, c in enumerate(by)}
    found = group_quantiles(rows, by, value, list(shares.values()))
    found = found.select(*[F.col(f"`{c}`").alias(k) for c, k in keys.items()], *[F.col(f"q{k}").alias(name) for k, name in enumerate(shares)])
    same = reduce(Column.__and__, [F.col(f"`{c}`").eqNullSafe(F.col(k)) for c, k in keys.items()], F.lit(True))
    return stats.join(found, same, "left").drop(*keys.values())
