"""Group statistics, profiles, pivots and correlations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.core.scratch import materialize
from millrace.functions.stats import f_tail
from millrace.operators import ordered
from millrace.operators.ordered import running_counts


def value_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """``value, n`` of non-null values; the ``n`` most frequent (of equals the smallest) if asked for."""
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "value").limit(n) if n else counts


def _stats(df: DataFrame, by: str, value: str, shares: dict[str, float], accuracy: int | None, **aggs: Column) -> DataFrame:
    """``by``, the aggregates and the quantiles of ``value``: exact and found by bits, or from a sketch of ``accuracy`` in one pass."""
    if accuracy is not None:
        aggs |= {name: F.percentile_approx(value, share, accuracy) for name, share in shares.items()}
    out = df.groupBy(by).agg(*[c.alias(n) for n, c in aggs.items()])
    return out if accuracy is not None else ordered.with_quantiles(out, df, [by], value, shares)


def group_stats(df: DataFrame, by: str, value: str, support: int = 1, top: int | None = None, accuracy: int | None = None) -> DataFrame:
    """``by, n, mean, median`` of groups with ``support`` values or more; the ``top`` by median if asked for."""
    out = _stats(df, by, value, {"median": 0.5}, accuracy, n=F.count(value), mean=F.avg(value)).where(F.col("n") >= support)
    return out.orderBy(F.desc("median"), by).limit(top) if top else out


def group_quartiles(df: DataFrame, by: str, value: str, accuracy: int | None = None) -> DataFrame:
    """``by, n, q1, median, q3, iqr, std``."""
    out = _stats(df, by, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, accuracy, n=F.count(value), std=F.stddev_samp(value))
    return out.select(by, "n", "q1", "median", "q3", (F.col("q3") - F.col("q1")).alias("iqr"), "std")


def median_vs_overall(df: DataFrame, by: str, value: str, accuracy: int | None = None) -> DataFrame:
    """``by, median, overall, pct``: a group's median as a percent above the median of all."""
    every = ordered.group_quantiles(df, [], value, [0.5]).first()
    out = _stats(df, by, value, {"median": 0.5}, accuracy, n=F.count(value)).drop("n").withColumn("overall", F.lit(every["q0"] if every else None).cast("double"))
    return out.withColumn("pct", 100 * (F.try_divide(F.col("median"), F.col("overall")) - 1))


def pivot_counts(df: DataFrame, row: Column, row_name: str, col: str, values: list) -> DataFrame:
    """Rows counted by ``row`` and, as columns, by the given values of ``col``; 0 where there are none."""
    return df.groupBy(row.alias(row_name)).pivot(col, values).count().na.fill(0)


def pivot_median(df: DataFrame, row: str, col: str, value: str, values: list) -> DataFrame:
    """Medians of ``value`` by ``row`` and, as columns, by the given values of ``col``; null where there are none."""
    found = ordered.group_quantiles(df.where(F.col(col).isin(*values)), [row, col], value, [0.5])
    cells = found.groupBy(row).agg(*[F.max(F.when(F.col(col) == v, F.col("q0"))).alias(str(v)) for v in values])
    every = df.select(F.col(row).alias("__row")).distinct()
    return every.join(cells, F.col("__row").eqNullSafe(F.col(row)), "left").drop(row).withColumnRenamed("__row", row)


def crosstab_share(df: DataFrame, row: str, col: str) -> DataFrame:
    """``row, col, n, share``: counts and their share of the row, in long form."""
    counts = df.groupBy(row, col).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(row)))


def crosstab_wide(df: DataFrame, row: str, col: str, values: list, normalise: bool = False) -> DataFrame:
    out = pivot_counts(df, F.col(row), row, col, values)
    if not normalise:
        return out
    total = reduce(Column.__add__, [F.col(f"`{v}`") for v in values])
    return out.select(row, *[F.try_divide(F.col(f"`{v}`"), total).alias(str(v)) for v in values])


def rollup_first(df: DataFrame, by: str, order: str, attributes: list[str]) -> DataFrame:
    """``by, n`` and the attributes of the first row in ``order``."""
    return df.groupBy(by).agg(F.count("*").alias("n"), *[F.min_by(c, order).alias(c) for c in attributes])


def rate_by_group(df: DataFrame, by: str, flag: Column) -> DataFrame:
    """``by, n, hits, pct``."""
    one = F.coalesce(flag, F.lit(False)).cast("int")
    return df.groupBy(by).agg(F.count("*").alias("n"), F.sum(one).alias("hits"), (100 * F.avg(one)).alias("pct"))


def _stacked(df: DataFrame, columns: list[str], what: dict[str, callable]) -> DataFrame:
    each = F.array(*[F.struct(F.lit(c).alias("column"), *[f(c).alias(n) for n, f in what.items()]) for c in columns])
    return df.agg(each.alias("r")).select(F.inline("r"))


def profile(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    """``column, dtype, non_null, null_pct, distinct, distinct_pct`` in one pass (``exact=False``: approximate distinct)."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    count = F.count_distinct if exact else F.approx_count_distinct
    return _stacked(df, columns or df.columns, {
        "dtype": lambda c: F.lit(kinds[c]), "non_null": lambda c: F.count(F.col(c)), "null_pct": lambda c: F.round(100 * F.avg(F.col(c).isNull().cast("int")), 4),
        "distinct": lambda c: count(F.col(c)), "distinct_pct": lambda c: F.round(100 * F.try_divide(count(F.col(c)), F.count("*")), 4),
    })


PERCENTS = (1, 5, 25, 50, 75, 95, 99, 99.9)


def _long(df: DataFrame, columns: dict[str, Column], where: dict[str, Column] | None = None) -> DataFrame:
    """``name, v``: the values of several columns under one another, of the rows for which ``where`` holds."""
    cells = [F.struct(F.lit(n).alias("name"), (F.when(where[n], c) if where else c).cast("double").alias("v")) for n, c in columns.items()]
    return df.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def numeric_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, n, missing, low, p1 ... p99_9, high, mean, std, zeros, negatives``: one pass, and the exact percentiles of
    all columns from one long table."""
    found = ordered.group_quantiles(_long(df, {c: F.col(c) for c in columns}), ["name"], "v", [x / 100 for x in PERCENTS])

    out = _stacked(df, columns, {
        "n": lambda c: F.count(F.col(c)), "missing": lambda c: F.count_if(F.col(c).isNull()), "low": lambda c: F.min(F.col(c)).cast("double"), "high": lambda c: F.max(F.col(c)).cast("double"),
        "mean": lambda c: F.avg(F.col(c)), "std": lambda c: F.stddev_samp(F.col(c)), "zeros": lambda c: F.count_if(F.col(c) == 0), "negatives": lambda c: F.count_if(F.col(c) < 0),
    })
    named = [F.col(f"q{i}").alias("p" + str(x).replace(".", "_")) for i, x in enumerate(PERCENTS)]
    return out.join(found.drop("n"), F.col("column") == F.col("name"), "left").select("column", "n", "missing", "low", *named, "high", "mean", "std", "zeros", "negatives")


def distribution(df: DataFrame, col: str) -> DataFrame:
    """``scale, skewness, kurtosis, p5, p25, p50, p75, p95`` (population, excess) of a column and of its log(1 + x)."""
    scales, percents = {"raw": F.col(col), "log1p": F.log1p(col)}, (5, 25, 50, 75, 95)
    each = F.array(*[F.struct(F.lit(n).alias("scale"), F.skewness(x).alias("skewness"), F.kurtosis(x).alias("kurtosis")) for n, x in scales.items()])
    found = ordered.group_quantiles(_long(df, scales), ["name"], "v", [p / 100 for p in percents])
    out = df.agg(each.alias("r")).select(F.inline("r")).join(found, F.col("scale") == F.col("name"), "left")
    return out.select("scale", "skewness", "kurtosis", *[F.col(f"q{k}").alias(f"p{p}") for k, p in enumerate(percents)])


def missing_bands(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column, missing, pct, band``; bands end below 5, 20 and 50 percent."""
    out = _stacked(df, columns or df.columns, {"missing": lambda c: F.count_if(F.col(c).isNull()), "pct": lambda c: F.round(100 * F.avg(F.col(c).isNull().cast("int")), 4)})
    return out.withColumn("band", F.when(F.col("pct") == 0, "complete").when(F.col("pct") < 5, "low").when(F.col("pct") < 20, "moderate").when(F.col("pct") < 50, "high").otherwise("severe"))


def rare_categories(df: DataFrame, col: str, limits: tuple[int, ...] = (1, 5, 10, 20, 50)) -> DataFrame:
    """``limit, categories, rows, row_pct``: categories with at most so many rows, and the rows that they hold."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    each = F.array(*[F.struct(F.lit(x).alias("limit"), F.count_if(F.col("n") <= x).alias("categories"), F.coalesce(F.sum(F.when(F.col("n") <= x, F.col("n"))), F.lit(0)).alias("rows"), F.sum("n").alias("total")) for x in limits])
    out = counts.agg(each.alias("r")).select(F.inline("r"))
    return out.select("limit", "categories", "rows", F.round(100 * F.try_divide(F.col("rows"), F.col("total")), 4).alias("row_pct"))


def binned(df: DataFrame, col: str, bins: list[tuple[str, float, float]], value: str) -> DataFrame:
    """``bin, n, median`` of ``value`` by half-open bins of ``col``: (name, above, up to)."""
    name = reduce(lambda w, b: w.when((F.col(col) > b[1]) & (F.col(col) <= b[2]), b[0]), bins[1:], F.when((F.col(col) > bins[0][1]) & (F.col(col) <= bins[0][2]), bins[0][0]))
    rows = df.select(name.alias("bin"), F.col(value)).where("bin is not null")
    return ordered.with_quantiles(rows.groupBy("bin").agg(F.count("*").alias("n")), rows, ["bin"], value, {"median": 0.5})


def scenarios(df: DataFrame, fields: dict[str, list[str]], value: str) -> DataFrame:
    """``scenario, n, coverage_pct, median, vs_all_pct``: rows in which all fields of a scenario are present.

    One pass for the counts, one long table for the exact medians of all scenarios and of all rows.
    """
    there = {s: reduce(Column.__and__, [F.col(c).isNotNull() for c in cols]) for s, cols in fields.items()}
    found = {r["name"]: r["q0"] for r in ordered.group_quantiles(_long(df, dict.fromkeys(["", *fields], F.col(value)), {"": F.lit(True), **there}), ["name"], "v", [0.5]).collect()}
    number = lambda s: F.lit(found.get(s)).cast("double")
    each = F.array(*[F.struct(F.lit(s).alias("scenario"), F.count_if(c).alias("n"), (100 * F.avg(c.cast("int"))).alias("coverage_pct"), number(s).alias("median")) for s, c in there.items()])
    out = df.agg(each.alias("r")).select(F.inline("r"))
    return out.withColumn("vs_all_pct", 100 * (F.try_divide(F.col("median"), number("")) - 1))


def threshold_counts(df: DataFrame, col: str, limits: list[float]) -> DataFrame:
    """``limit, above``."""
    each = F.array(*[F.struct(F.lit(float(x)).alias("limit"), F.count_if(F.col(col) > x).alias("above")) for x in limits])
    return df.agg(each.alias("r")).select(F.inline("r"))


def key_cardinality(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, mean, std, low, median, high`` of the number of rows a key."""
    sizes = materialize(df.groupBy(*keys).agg(F.count("*").alias("n")).select("n"), "key-sizes")
    middle = ordered.group_quantiles(sizes, [], "n", [0.5]).first()
    return sizes.agg(F.count("*").alias("keys"), F.avg("n").alias("mean"), F.stddev_samp("n").alias("std"), F.min("n").alias("low"), F.lit(middle["q0"] if middle else None).cast("double").alias("median"), F.max("n").alias("high"))


def average_ranks(df: DataFrame, col: str, out: str) -> DataFrame:
    """``df`` with the rank of ``col``, ties sharing their mean rank; null values have none."""
    counts = running_counts(ordered.value_counts(df, col))
    ranks = counts.select(F.col("v").alias("__v"), (F.col("upto") - F.col("n") + (F.col("n") + 1) / 2).alias(out))
    return df.join(ranks, F.col(col).cast("double") == F.col("__v"), "left").drop("__v")


def correlations(df: DataFrame, columns: list[str], method: str = "pearson") -> DataFrame:
    """``a, b, r`` of each pair of columns, in one pass; ``spearman`` ranks them first, ``loglog`` takes log(1 + x)."""
    names = dict(zip(columns, columns))
    if method == "spearman":
        df = df.dropna(subset=columns)
        for c in columns:
            df = average_ranks(df, c, f"__rank_{c}")
            names[c] = f"__rank_{c}"
    col = (lambda c: F.log1p(F.col(names[c]))) if method == "loglog" else (lambda c: F.col(names[c]).cast("double"))
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    each = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(col(a), col(b)).alias("r")) for a, b in pairs])
    return df.agg(each.alias("r")).select(F.inline("r"))


def strong_pairs(df: DataFrame, columns: list[str], least: float = 0.6) -> DataFrame:
    return correlations(df, columns).where(F.abs("r") > least)


def anova(df: DataFrame, by: str | list[str], value: str) -> DataFrame:
    """``category, groups, n, f, p, df_between, df_within, median_spread`` for each column of ``by``, over its groups with two rows or more.

    All categories go through one long table of (category, group, value). Sums of squares come from a row a group; the
    values are not gathered. ``p`` is the probability of a larger F, computed in the engine.
    """
    names = [by] if isinstance(by, str) else by
    cells = F.array(*[F.struct(F.lit(c).alias("category"), F.col(f"`{c}`").cast("string").alias("group")) for c in names])
    rows = df.where(F.col(value).isNotNull()).select(F.explode(cells).alias("x"), F.col(value).cast("double").alias("v")).select("x.*", "v")
    each = rows.groupBy("category", "group").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.var_pop("v").alias("var")).where("n > 1")
    each = ordered.with_quantiles(each, rows, ["category", "group"], "v", {"median": 0.5})
    total = W.partitionBy("category")
    grand = F.sum(F.col("n") * F.col("mean")).over(total) / F.sum("n").over(total)
    parts = each.withColumn("between", F.col("n") * F.pow(F.col("mean") - grand, 2)).withColumn("within", F.col("n") * F.col("var"))
    out = parts.groupBy("category").agg(F.count("*").alias("groups"), F.sum("n").alias("n"), F.sum("between").alias("b"), F.sum("within").alias("w"), (F.max("median") - F.min("median")).alias("median_spread"))
    out = out.withColumns({"df_between": F.col("groups") - 1, "df_within": F.col("n") - F.col("groups")})
    out = out.withColumn("f", F.try_divide(F.try_divide("b", "df_between"), F.try_divide("w", "df_within")))
    return out.select("category", "groups", "n", "f", f_tail(F.col("f"), F.col("df_between"), F.col("df_within")).alias("p"), "df_between", "df_within", "median_spread")


def keyword_gradient(df: DataFrame, text: str, value: str, keywords: list[str]) -> DataFrame:
    """``keyword, n, median, mean`` of ``value`` over the rows whose text has the keyword as a word."""
    hits = F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.regexp_like(F.lower(F.col(text)), F.concat(F.lit(r"\b"), k, F.lit(r"\b"))))
    rows = materialize(df.select(F.explode(hits).alias("keyword"), F.col(value).alias("v")), "keyword-rows")
    return ordered.with_quantiles(rows.groupBy("keyword").agg(F.count("*").alias("n"), F.avg("v").alias("mean")), rows, ["keyword"], "v", {"median": 0.5}).select("keyword", "n", "median", "mean")


def item_frequency(df: DataFrame, items: Column) -> DataFrame:
    """``item, n, pct``: rows that hold an item and their share of all rows."""
    rows = df.select(F.array_distinct(items).alias("items"))
    counts = rows.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n"))
    return counts.select("item", "n", (100 * F.col("n") / F.lit(df.count())).alias("pct"))


def item_stats(df: DataFrame, items: Column, value: str, support: int = 1) -> DataFrame:
    """``item, n, mean, median, std, low, high`` of ``value`` over the rows that hold an item."""
    rows = df.where(F.col(value).isNotNull()).select(F.explode(F.array_distinct(items)).alias("item"), value)
    out = rows.groupBy("item").agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("low"), F.max(value).alias("high"))
    return ordered.with_quantiles(out.where(F.col("n") >= support), rows, ["item"], value, {"median": 0.5}).select("item", "n", "mean", "median", "std", "low", "high")


def with_without(df: DataFrame, items: Column, value: str, top: int = 50) -> DataFrame:
    """``item, n, with_median, without_median, difference`` for the ``top`` most frequent items (a report's length).

    A row counts for each of the ``top`` items on one side or the other; the exact medians of all sides are found at
    once from the counts of (item, side, value).
    """
    rows = df.where(F.col(value).isNotNull()).select(F.array_distinct(items).alias("items"), F.col(value).cast("double").alias("v"))
    counts = rows.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "item").limit(top)
    counts = materialize(counts, "top-items")
    names = [r["item"] for r in counts.collect()]
    sides = F.array(*[F.struct(F.lit(n).alias("item"), F.array_contains("items", n).alias("has")) for n in names]).cast("array<struct<item: string, has: boolean>>")
    cells = rows.select(F.explode(sides).alias("x"), "v").select("x.*", "v")
    found = ordered.group_quantiles(cells, ["item", "has"], "v", [0.5])
    found = found.groupBy("item").agg(F.max(F.when(F.col("has"), F.col("q0"))).alias("with_median"), F.max(F.when(~F.col("has"), F.col("q0"))).alias("without_median"))
    return counts.join(found, "item", "left").withColumn("difference", F.col("with_median") - F.col("without_median"))


def pattern_share(df: DataFrame, text: str, pattern: str, flag: Column) -> DataFrame:
    """``pct, flagged_pct``: rows whose text matches, of all and of the flagged ones."""
    hit = F.coalesce(F.col(text).rlike(pattern), F.lit(False)).cast("int")
    return df.agg((100 * F.avg(hit)).alias("pct"), (100 * F.avg(F.when(flag, hit))).alias("flagged_pct"))


def agreement(df: DataFrame, condition: Column) -> DataFrame:
    """``n, agree, pct`` of a condition where it is known (top value in its list, equal texts, flags)."""
    return df.agg(F.count(condition).alias("n"), F.count_if(condition).alias("agree"), (100 * F.avg(condition.cast("int"))).alias("pct"))


def same_category(df: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs, agree, pct``: rows in which two columns name one category: equal in lower case, with underscores as spaces; nulls are equal."""
    plain = lambda c: F.coalesce(F.translate(F.lower(F.col(c).cast("string")), "_", " "), F.lit(""))
    counts = df.groupBy(a, b).agg(F.count("*").alias("n"))
    out = counts.agg(F.count("*").alias("pairs"), F.coalesce(F.sum(F.when(plain(a) == plain(b), F.col("n"))), F.lit(0)).alias("agree"), F.sum("n").alias("n"))
    return out.select("pairs", "agree", (100 * F.try_divide(F.col("agree"), F.col("n"))).alias("pct"))


def top_agreement(df: DataFrame, by: str, value: str) -> DataFrame:
    """``by, n, agree, pct``: the rows of a group that have its most frequent value (of equals the smallest), in one count a value."""
    counts = df.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("n"))
    out = counts.groupBy(by).agg(F.sum("n").alias("n"), F.max("n").alias("agree"))
    return out.withColumn("pct", 100 * F.col("agree") / F.col("n"))


def duplicate_rate(df: DataFrame, subsets: dict[str, list[str]]) -> DataFrame:
    """``keys, rows, duplicates, pct`` for each set of columns; null is a value."""
    parts = []
    for name, cols in subsets.items():
        counts = df.groupBy(*cols).agg(F.count("*").alias("n"))
        parts.append(counts.agg(F.lit(name).alias("keys"), F.sum("n").alias("rows"), (F.sum("n") - F.count("*")).alias("duplicates")))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("pct", F.round(100 * F.try_divide(F.col("duplicates"), F.col("rows")), 4))


def text_lengths(df: DataFrame, col: str) -> DataFrame:
    """``n, coverage_pct, mean, median, p95, longest`` of a text column's length."""
    n = F.length(col)
    middle, p95 = ordered.quantiles(df.select(n.alias("n")), "n", [0.5, 0.95]) or (None, None)
    return df.agg(F.count(col).alias("n"), F.round(100 * F.avg(F.col(col).isNotNull().cast("int")), 4).alias("coverage_pct"), F.avg(n).alias("mean"), F.lit(middle).cast("double").alias("median"), F.lit(p95).cast("double").alias("p95"), F.max(n).alias("longest"))


def presence_patterns(df: DataFrame, columns: list[str]) -> DataFrame:
    """``pattern, n``: rows by which of ``columns`` are present, their names joined by "+", "none" for none."""
    there = F.concat_ws("+", *[F.when(F.col(c).isNotNull(), F.lit(c)) for c in columns])
    return df.groupBy(F.when(there == "", "none").otherwise(there).alias("pattern")).agg(F.count("*").alias("n"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
