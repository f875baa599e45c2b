"""Validation: violations are counted in one pass a table and nothing is changed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.core.schemas import ForeignKey, ValidationRules, ValueRule

REPORT = "table string, check string, column string, violations long"


def breaks(c: Column, rule: ValueRule) -> Column:
    """True where a non-null value breaks any part of ``rule`` (so a row counts once however many parts it breaks)."""
    text, number = c.cast("string"), c.try_cast("double")
    parts = []
    if rule.allowed is not None:
        numbers = [float(v) for v in rule.allowed if isinstance(v, (int, float))]
        texts = [v for v in rule.allowed if isinstance(v, str)]
        inside = F.lit(False)
        if numbers:
            inside = inside | F.coalesce(number.isin(*numbers), F.lit(False))
        if texts:
            inside = inside | text.isin(*texts)
        parts.append(~inside)
    if rule.low is not None:
        parts.append(number < rule.low)
    if rule.high is not None:
        parts.append(number > rule.high)
    if rule.pattern is not None:
        parts.append(~text.rlike(f"^(?:{rule.pattern})"))
    return c.isNotNull() & reduce(Column.__or__, [F.coalesce(p, F.lit(False)) for p in parts], F.lit(False))


def not_numeric(c: Column) -> Column:
    return c.isNotNull() & c.try_cast("double").isNull()


def structural(df: DataFrame, rules: ValidationRules) -> list[str]:
    """Columns that the rules name and the table lacks."""
    named = [*rules.unique, *rules.not_null, *rules.values, *rules.numeric, *(k.column for k in rules.foreign_keys)]
    return [c for c in dict.fromkeys(named) if c not in df.columns]


def validate(df: DataFrame, rules: ValidationRules, table: str = "") -> DataFrame:
    """``table, check, column, violations``: absent columns, nulls, values and types, from one aggregate of the table."""
    there = set(df.columns)
    checks: dict[tuple[str, str], Column] = {("structure", c): F.lit(1).cast("long") for c in structural(df, rules)}
    checks |= {("null", c): F.count_if(F.col(f"`{c}`").isNull()) for c in rules.not_null if c in there}
    checks |= {("value", c): F.count_if(breaks(F.col(f"`{c}`"), r)) for c, r in rules.values.items() if c in there}
    numeric = [*rules.numeric, *(c for c, r in rules.values.items() if r.low is not None or r.high is not None)]
    checks |= {("type", c): F.count_if(not_numeric(F.col(f"`{c}`"))) for c in dict.fromkeys(numeric) if c in there}
    if not checks:
        return df.sparkSession.createDataFrame([], REPORT)
    each = F.array(*[F.struct(F.lit(table).alias("table"), F.lit(k).alias("check"), F.lit(c).alias("column"), v.cast("long").alias("violations")) for (k, c), v in checks.items()])
    return df.agg(each.alias("r")).select(F.inline("r"))


def duplicate_keys(df: DataFrame, keys: tuple[str, ...], samples: int = 5) -> DataFrame:
    """``duplicate_rows, duplicate_keys, sample_keys``: rows whose key occurs more than once, first ones included."""
    text = F.concat_ws("|", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys])
    many = df.groupBy(*[f"`{k}`" for k in keys]).agg(F.count("*").alias("n")).where("n > 1").withColumn("key", text)
    total = many.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"), F.count("*").alias("duplicate_keys")).withColumn("k", F.lit(1))
    few = many.orderBy("key").limit(samples).agg(F.array_join(F.array_sort(F.collect_list("key")), ";").alias("sample_keys")).withColumn("k", F.lit(1))
    return total.join(few, "k").drop("k")


def orphan_count(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """``orphans``: non-null keys of ``child`` that ``parent`` lacks."""
    ids = parent.select(F.col(f"`{parent_column}`").alias("__parent")).distinct()
    return child.where(F.col(f"`{column}`").isNotNull()).join(ids, F.col(f"`{column}`") == F.col("__parent"), "left_anti").agg(F.count("*").alias("orphans"))


def validate_version(tables: dict[str, DataFrame], rules: dict[str, ValidationRules]) -> DataFrame:
    """Reports of all tables with duplicate keys and orphans; a foreign key without its parent table is skipped."""
    parts = []
    for name, df in tables.items():
        own = rules.get(name)
        if own is None:
            continue
        parts.append(validate(df, own, name))
        if own.unique and all(c in df.columns for c in own.unique):
            parts.append(duplicate_keys(df, own.unique).select(F.lit(name).alias("table"), F.lit("duplicate").alias("check"), F.lit(",".join(own.unique)).alias("column"), F.col("duplicate_rows").alias("violations")))
        for k in own.foreign_keys:
            if k.parent in tables and k.column in df.columns and k.parent_column in tables[k.parent].columns:
                parts.append(_orphans(df, k, tables[k.parent], name))
    return reduce(DataFrame.unionByName, parts)


def _orphans(df: DataFrame, k: ForeignKey, parent: DataFrame, name: str) -> DataFrame:
    return orphan_count(df, k.column, parent, k.parent_column).select(F.lit(name).alias("table"), F.lit("orphan").alias("check"), F.lit(k.column).alias("column"), F.col("orphans").alias("violations"))


def validation_summary(report: DataFrame, tables: list[str]) -> DataFrame:
    """``passed, failed, skipped, violations`` over ``tables``; skipped ones have no rule."""
    by_table = report.groupBy("table").agg(F.sum("violations").alias("v"))
    every = report.sparkSession.createDataFrame([(t,) for t in tables], "table string")
    joined = every.join(by_table, "table", "left")
    return joined.agg(F.count_if(F.col("v") == 0).alias("passed"), F.count_if(F.col("v") > 0).alias("failed"), F.count_if(F.col("v").isNull()).alias("skipped"), F.coalesce(F.sum("v"), F.lit(0)).alias("violations"))


def enforce(report: DataFrame, raise_on: tuple[str, ...]) -> None:
    """Raise one error that names every check of ``raise_on`` with violations."""
    found = {r["check"]: r["v"] for r in report.groupBy("check").agg(F.sum("violations").alias("v")).collect()}
    broken = [f"{c}: {found[c]}" for c in raise_on if found.get(c)]
    if broken:
        raise ValueError("validation failed: " + ", ".join(broken))
