"""Cleaning: strings, nulls, types, bounds, duplicates, orphans, in this order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.core.schemas import CleaningRule, ForeignKey
from millrace.operators import skew
from millrace.operators.steps import StepLog

#: Texts that are a missing value once trimmed.
NULL_TEXTS = ("", "nan", "None", "<NA>")


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def cleaned_text(c: Column, lower: bool = False) -> Column:
    """Trimmed, runs of white space one space, optionally in lower case, texts for missing values null."""
    out = F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), r"(?U)\s+", " ")
    out = F.lower(out) if lower else out
    return F.when(~out.isin(*NULL_TEXTS), out)


def clean_strings(df: DataFrame, columns: list[str] | None = None, lowercase: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with its string columns (or ``columns``) cleaned."""
    names = string_columns(df) if columns is None else columns
    return df.withColumns({c: cleaned_text(F.col(f"`{c}`"), c in lowercase) for c in names}) if names else df


def modified_cells(df: DataFrame, columns: list[str] | None = None, lowercase: tuple[str, ...] = ()) -> DataFrame:
    """``column, modified``: cells that ``clean_strings`` changes; one pass for all columns."""
    names = string_columns(df) if columns is None else columns
    pairs = [x for c in names for x in (F.lit(c), F.count_if(~F.col(f"`{c}`").eqNullSafe(cleaned_text(F.col(f"`{c}`"), c in lowercase))))]
    return df.agg(F.create_map(*pairs).alias("m")).select(F.explode("m").alias("column", "modified"))


def handle_nulls(df: DataFrame, drop: tuple[str, ...] = (), fill: dict[str, object] | None = None) -> DataFrame:
    """Rows with a null in a ``drop`` column go; nulls of ``fill`` columns get their value."""
    out = df.na.drop(subset=list(drop)) if drop else df
    return out.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(v)) for c, v in fill.items()}) if fill else out


def as_key(c: Column) -> Column:
    """A whole number from any writing of it ('101', '101.0'); other values null."""
    number = c.cast("string").try_cast("decimal(38,6)")
    return F.when(number == F.floor(number), number).try_cast("bigint")


def convert(df: DataFrame, types: dict[str, str], strict: dict[str, bool] | None = None) -> DataFrame:
    """``df`` with columns of ``types`` cast. Whole numbers that cannot be read become null.

    Another column is cast only if all its values can be (``strict``: column to that verdict, see ``castable``).
    """
    new = {}
    for c, kind in types.items():
        if c not in df.columns:
            continue
        if kind == "bigint":
            new[c] = as_key(F.col(f"`{c}`"))
        elif strict is None or strict.get(c, True):
            new[c] = F.col(f"`{c}`").try_cast(kind)
    return df.withColumns(new) if new else df


def castable(df: DataFrame, types: dict[str, str]) -> dict[str, bool]:
    """For each column but whole numbers whether all its values can be cast; one aggregate."""
    names = [c for c, kind in types.items() if kind != "bigint" and c in df.columns]
    if not names:
        return {}
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(types[c]).isNull()).alias(f"k{i}") for i, c in enumerate(names)]).first()
    return {c: row[i] == 0 for i, c in enumerate(names)}


def apply_bounds(df: DataFrame, bounds: dict[str, float], policy: str) -> DataFrame:
    """Values below their bound: ``drop_row``, ``nullify`` or ``leave``; null and text that is no number are not below."""
    low = {c: F.coalesce(F.col(f"`{c}`").try_cast("double") < b, F.lit(False)) for c, b in bounds.items() if c in df.columns}
    if policy == "leave" or not low:
        return df
    if policy == "nullify":
        return df.withColumns({c: F.when(~bad, F.col(f"`{c}`")) for c, bad in low.items()})
    if policy == "drop_row":
        return df.where(~reduce(Column.__or__, low.values()))
    raise ValueError(f"unknown policy: {policy}")


def count_low(df: DataFrame, bounds: dict[str, float]) -> DataFrame:
    """``column, low`` in one pass."""
    pairs = [x for c, b in bounds.items() for x in (F.lit(c), F.count_if(F.col(f"`{c}`").try_cast("double") < b))]
    return df.agg(F.create_map(*pairs).alias("m")).select(F.explode("m").alias("column", "low"))


def dedupe(df: DataFrame, keys: list[str] | None, order: list[Column] | None = None, keep: str = "first") -> DataFrame:
    """One row a key (``first`` or ``last`` in ``order``), or only keys that occur once (``drop_all``); null is a value.

    Without ``keys`` whole rows are compared, which needs no order for first and last.
    """
    if keep not in ("first", "last", "drop_all"):
        raise ValueError(f"unknown policy: {keep}")
    if not keys and keep != "drop_all":
        return df.dropDuplicates()
    by = [F.col(f"`{c}`") for c in (keys or df.columns)]
    if keep == "drop_all":
        return df.withColumn("__n", F.count("*").over(W.partitionBy(*by))).where("__n = 1").drop("__n")
    if not order:
        raise ValueError("an order is needed to keep a first or last row")
    way = [o.desc() for o in order] if keep == "last" else [o.asc() for o in order]
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*by).orderBy(*way))).where("__n = 1").drop("__n")


def drop_orphans(df: DataFrame, keys: tuple[ForeignKey, ...], parents: dict[str, DataFrame], hot_share: float | None = None) -> DataFrame:
    """Rows whose foreign keys have a parent; a null key stays, and a key whose parent table is absent is not tested.

    With ``hot_share`` keys that hold so much of the table are measured first and dealt over several tasks.
    """
    for k in keys:
        parent = parents.get(k.parent)
        if parent is None or k.column not in df.columns or k.parent_column not in parent.columns:
            continue
        ids = parent.select(F.col(f"`{k.parent_column}`").alias("__parent")).where("__parent is not null").distinct()
        hot = skew.hot_keys(df, k.column, hot_share) if hot_share else []
        ids = ids.withColumn("__part", F.explode(skew.parts_of_key(F.col("__parent"), hot)))
        salted = df.withColumn("__salt", skew.part_of_row(df, k.column, hot))
        hit = salted.join(ids, (F.col(f"`{k.column}`") == F.col("__parent")) & (F.col("__salt") == F.col("__part")), "left")
        df = hit.where(F.col("__parent").isNotNull() | F.col(f"`{k.column}`").isNull()).drop("__parent", "__part", "__salt")
    return df


def parents_first(rules: dict[str, CleaningRule]) -> list[str]:
    """Tables so that each comes after the parents of its foreign keys; a circle is an error."""
    left, out = {t: {k.parent for k in r.foreign_keys if k.parent in rules and k.parent != t} for t, r in rules.items()}, []
    while left:
        free = sorted(t for t, needs in left.items() if needs <= set(out))
        if not free:
            raise ValueError(f"foreign keys go in a circle: {', '.join(sorted(left))}")
        out += free
        for t in free:
            del left[t]
    return out


def _lost(df: DataFrame, types: dict[str, str], strict: dict[str, bool]) -> list[Column]:
    """Counts of the values that ``convert`` cannot read, a column each."""
    read = {c: as_key(F.col(f"`{c}`")) if k == "bigint" else F.col(f"`{c}`").try_cast(k) for c, k in types.items() if c in df.columns and (k == "bigint" or strict.get(c, True))}
    return [F.count_if(F.col(f"`{c}`").isNotNull() & x.isNull()) for c, x in read.items()]


def clean_table(df: DataFrame, rule: CleaningRule, types: dict[str, str], order: list[Column], parents: dict[str, DataFrame], log: StepLog | None = None, name: str = "") -> DataFrame:
    """All steps for one table. With ``log`` each is watched as a step of table ``name``.

    Counts besides rows and nulls: ``filled`` (cells that the next step fills), ``lost`` (cells that the types cannot
    read) and ``low`` (cells below their bound).
    """

    def seen(out: DataFrame, step: str, **counts: list[Column]) -> DataFrame:
        return log.watch(out, name, step, **{n: reduce(Column.__add__, c, F.lit(0)) for n, c in counts.items()}) if log is not None else out

    texts, drop = string_columns(df), tuple(c for c in rule.drop_null if c in df.columns)
    fill = {c: v for c, v in rule.fill_null.items() if c in df.columns}
    bounds = {c: b for c, b in rule.lower_bounds.items() if c in df.columns}
    strict = castable(handle_nulls(clean_strings(df, texts, rule.lowercase), drop, fill), types)
    out = clean_strings(seen(df, "input"), texts, rule.lowercase)
    out = handle_nulls(seen(out, "strings"), drop)
    out = handle_nulls(seen(out, "nulls dropped", filled=[F.count_if(F.col(f"`{c}`").isNull()) for c in fill]), fill=fill)
    out = convert(seen(out, "nulls filled", lost=_lost(out, types, strict)), types, strict)
    out = seen(out, "types", low=[F.count_if(F.col(f"`{c}`").try_cast("double") < b) for c, b in bounds.items()])
    out = dedupe(seen(apply_bounds(out, rule.lower_bounds, rule.low_values), "bounds"), list(rule.keys) or None, order, rule.duplicates)
    return seen(drop_orphans(seen(out, "duplicates"), rule.foreign_keys, parents), "orphans")


def clean_version(
    tables: dict[str, DataFrame], rules: dict[str, CleaningRule], types: dict[str, dict[str, str]], order: dict[str, list[Column]], continue_on_error: bool = True, folder: str | None = None, log: StepLog | None = None
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Clean all tables of a version, parents first, each against its cleaned parents; and what failed, by table.

    A failing table is left as it came and does not end the run. ``order`` says which row of a key is its first, for
    instance by ``readers.with_ordinal``; a table whose rule keeps first or last rows fails without one. With ``folder``
    each cleaned table is written there once, and its children and reports read it; without, they clean it again. A
    ``log`` (which needs the folder) gets the counts of all steps from the runs that write.
    """
    if log is not None and not folder:
        raise ValueError("steps are counted while tables are written: give a folder")
    done, failed = dict(tables), {}
    for name in parents_first({t: r for t, r in rules.items() if t in tables}):
        try:
            out = clean_table(tables[name], rules[name], types.get(name, {}), order.get(name, []), {p: done[p] for p in done if p != name}, log, name)
            if folder:
                out = (log or StepLog()).write(out, f"{folder}/{name}")
            done[name] = out
        except Exception as error:
            if not continue_on_error:
                raise
            if log is not None:
                log.forget(name)
            failed[name] = str(error)
    return done, failed


def cleaning_report(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """``table, rows_before, rows_after, removed, removed_pct``."""
    parts = []
    for name in before:
        b = before[name].agg(F.count("*").alias("rows_before")).withColumn("table", F.lit(name))
        a = after[name].agg(F.count("*").alias("rows_after")).withColumn("table", F.lit(name))
        parts.append(b.join(a, "table"))
    rows = reduce(DataFrame.unionByName, parts)
    removed = F.col("rows_before") - F.col("rows_after")
    return rows.select("table", "rows_before", "rows_after", removed.alias("removed"), F.round(100 * F.try_divide(removed, F.col("rows_before")), 4).alias("removed_pct"))
