"""Joining dimensions, latest snapshots and summarised bridges onto a fact table without changing its rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators import skew
from millrace.operators.steps import StepLog


@dataclass(frozen=True)
class DimensionJoin:
    table: str
    left_key: str
    right_key: str
    rename: dict[str, str] = field(default_factory=dict)
    columns: tuple[str, ...] | None = None
    keep: str = "first"
    order: tuple[str, ...] = ()
    enabled: bool = True


@dataclass(frozen=True)
class SnapshotJoin:
    table: str
    left_key: str
    right_key: str
    order: str | None = None
    ties: tuple[str, ...] = ()
    rename: dict[str, str] = field(default_factory=dict)
    columns: tuple[str, ...] | None = None
    enabled: bool = True


@dataclass(frozen=True)
class BridgeSummary:
    table: str
    key: str
    value: str
    prefix: str
    names: str | None = None
    names_key: str | None = None
    names_value: str | None = None
    fact_key: str | None = None
    most: int = 10
    with_count: bool = True
    with_list: bool = True
    with_top: bool = True
    enabled: bool = True


def _named(df: DataFrame, key: str, rename: dict[str, str], columns: tuple[str, ...] | None) -> DataFrame:
    kept = [c for c in df.columns if c == key or columns is None or c in columns]
    return df.select(*[F.col(f"`{c}`").alias(rename.get(c, c) if c != key else c) for c in kept])


def safe_left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, marker: str | None = None, hot_share: float | None = None) -> tuple[DataFrame, list[str]]:
    """Left join that adds the columns of ``right`` that ``left`` lacks, and the names it left out.

    ``right`` must have one row a key. ``marker`` names a column that tells whether a row matched. Spark chooses the
    join by the sizes that it knows, so a dimension is broadcast only while it is small. Rows without a key are dealt
    over all tasks. With ``hot_share`` the keys that hold so much of ``left`` are measured first and dealt over several
    tasks, with copies of their one row of ``right``; the result is the same.
    """
    hot = skew.hot_keys(left, left_key, hot_share) if hot_share else []
    there = {c.lower() for c in left.columns}
    new = [c for c in right.columns if c != right_key and c.lower() not in there]
    skipped = [c for c in right.columns if c != right_key and c.lower() in there]
    side = right.select(F.col(f"`{right_key}`").alias("__key"), F.explode(skew.parts_of_key(F.col(f"`{right_key}`"), hot)).alias("__part"), *[F.col(f"`{c}`") for c in new], *([F.lit(True).alias(marker)] if marker else []))
    salted = left.withColumn("__salt", skew.part_of_row(left, left_key, hot))
    return salted.join(side, (F.col(f"`{left_key}`") == F.col("__key")) & (F.col("__salt") == F.col("__part")), "left").drop("__key", "__salt", "__part"), skipped


def one_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(f"`{key}`").orderBy(*order))).where("__n = 1").drop("__n")


def dimension(df: DataFrame, spec: DimensionJoin) -> DataFrame:
    """A dimension ready to join: one row a key, renamed, cut to its columns."""
    order = [F.col(c).desc() if spec.keep == "last" else F.col(c) for c in (spec.order or tuple(c for c in df.columns if c != spec.right_key))]
    return _named(one_per_key(df, spec.right_key, order), spec.right_key, spec.rename, spec.columns)


def snapshot(df: DataFrame, spec: SnapshotJoin) -> DataFrame:
    """The latest row of each key (nulls last, ties by ``ties``); without an order the first by ``ties``."""
    ties = [F.col(c) for c in (spec.ties or tuple(c for c in df.columns if c not in (spec.right_key, spec.order)))]
    order = [F.col(spec.order).desc_nulls_last(), *ties] if spec.order else ties
    return _named(one_per_key(df, spec.right_key, order), spec.right_key, spec.rename, spec.columns)


def summarise_bridge(bridge: DataFrame, spec: BridgeSummary, names: DataFrame | None = None, hot_share: float | None = None) -> DataFrame:
    """``key`` with ``<prefix>_count, top_<prefix>, <prefix>_list`` of a bridge's distinct non-null values.

    Values are replaced by their names where ``names`` is given. The top value is the most frequent, of equals the
    smallest; the list holds the first ``most`` values in order. Pairs are counted first, with partial sums before the
    shuffle, so a key with a third of all rows arrives as its distinct values.
    """
    value = F.col(f"`{spec.value}`")
    rows = bridge
    if names is not None and spec.names_value:
        side = one_per_key(names, spec.names_key, [F.col(spec.names_value)]).select(F.col(f"`{spec.names_key}`").alias("__key"), F.col(f"`{spec.names_value}`").alias("__name"))
        named, _ = safe_left_join(rows.select(F.col(f"`{spec.key}`"), value), side, spec.value, "__key", hot_share=hot_share)
        rows, value = named, F.col("__name")
    pairs = rows.select(F.col(f"`{spec.key}`").alias("__k"), value.alias("__v")).where("__k is not null and __v is not null").groupBy("__k", "__v").agg(F.count("*").alias("__n"))
    aggs = []
    if spec.with_count:
        aggs.append(F.count("*").alias(f"{spec.prefix}_count"))
    if spec.with_top:
        aggs.append(F.min_by("__v", F.struct(-F.col("__n"), F.col("__v"))).alias(f"top_{spec.prefix}"))
    if spec.with_list:
        aggs.append(F.slice(F.array_sort(F.collect_list("__v")), 1, spec.most).alias(f"{spec.prefix}_list"))
    return pairs.groupBy(F.col("__k").alias(spec.key)).agg(*aggs)


def consolidate(tables: dict[str, DataFrame], fact: str, dimensions: tuple[DimensionJoin, ...] = (), snapshots: tuple[SnapshotJoin, ...] = (), bridges: tuple[BridgeSummary, ...] = (), markers: bool = False, log: StepLog | None = None, hot_share: float | None = None) -> tuple[DataFrame, dict[str, list[str]]]:
    """The fact table with all joins in order, and the column names that each join left out because they were there.

    Absent tables and disabled specs are passed over. With ``markers`` a column ``__hit_<table>`` tells what matched.
    With ``log`` the fact table and the result of every join are watched as steps, with the rows that ``matched``.
    With ``hot_share`` the hot keys of every join are measured and dealt over several tasks, those of bridges too.
    """
    out, skipped = log.watch(tables[fact], fact, "fact") if log else tables[fact], {}
    for spec in [s for s in (*dimensions, *snapshots, *bridges) if s.enabled and s.table in tables]:
        marker = f"__hit_{spec.table}" if markers or log else None
        if isinstance(spec, DimensionJoin):
            right, left_key, right_key = dimension(tables[spec.table], spec), spec.left_key, spec.right_key
        elif isinstance(spec, SnapshotJoin):
            right, left_key, right_key = snapshot(tables[spec.table], spec), spec.left_key, spec.right_key
        else:
            right, left_key, right_key = summarise_bridge(tables[spec.table], spec, tables.get(spec.names or ""), hot_share), spec.fact_key or spec.key, spec.key
        out, skipped[spec.table] = safe_left_join(out, right, left_key, right_key, marker, hot_share)
        if isinstance(spec, BridgeSummary) and spec.with_count and f"{spec.prefix}_count" not in skipped[spec.table]:
            out = out.withColumn(f"{spec.prefix}_count", F.coalesce(f"{spec.prefix}_count", F.lit(0)))
        if log:
            out = log.watch(out, fact, spec.table, without=() if markers else (marker,), matched=F.count(marker))
            out = out if markers else out.drop(marker)
    return out, skipped


def match_stats(df: DataFrame, tables: list[str]) -> DataFrame:
    """``table, total, matched, unmatched, rate`` of the joins of a frame that was consolidated with markers; one pass."""
    each = F.array(*[F.struct(F.lit(t).alias("table"), F.count("*").alias("total"), F.count(f"__hit_{t}").alias("matched")) for t in tables])
    rows = df.agg(each.alias("r")).select(F.inline("r"))
    return rows.select("table", "total", "matched", (F.col("total") - F.col("matched")).alias("unmatched"), F.round(F.try_divide(F.col("matched"), F.col("total")), 6).alias("rate"))


def integrity(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """``rows_before, rows_after, duplicate_keys, null_keys``: equal rows and zeros tell of a sound join."""
    b = before.agg(F.count("*").alias("rows_before")).withColumn("k", F.lit(1))
    a = after.agg(F.count("*").alias("rows_after"), (F.count(key) - F.count_distinct(key)).alias("duplicate_keys"), F.count_if(F.col(key).isNull()).alias("null_keys")).withColumn("k", F.lit(1))
    return b.join(a, "k").drop("k")


def check_integrity(before: DataFrame, after: DataFrame, key: str) -> None:
    """Raise if rows were added or lost, or the key has repeats or nulls."""
    r = integrity(before, after, key).first()
    if r["rows_before"] != r["rows_after"] or r["duplicate_keys"] or r["null_keys"]:
        raise ValueError(f"joins broke the fact table: {r.asDict()}")


def union_versions(versions: dict[str, DataFrame], tag: str = "dataset_version") -> DataFrame:
    """All versions under one another with their tag; a column that one lacks is null there; keys are not merged."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(tag, F.lit(v)) for v, df in versions.items()])


def coverage(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column, coverage``: the share of non-null values."""
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.round(F.avg(F.col(f"`{c}`").isNotNull().cast("int")), 6).alias("coverage")) for c in (columns or df.columns)])
    return df.agg(each.alias("r")).select(F.inline("r"))


# The joins of the listing tables.
LISTING_DIMENSIONS = (DimensionJoin("companies", "company_id", "company_id", {"name": "company_name", "description": "company_description", "state": "company_state", "country": "company_country", "city": "company_city", "zip_code": "company_zip_code", "address": "company_address", "url": "company_url"}),)
LISTING_SNAPSHOTS = (
    SnapshotJoin("employee_counts", "company_id", "company_id", "time_recorded", rename={"employee_count": "company_employee_count", "follower_count": "company_follower_count", "time_recorded": "company_employee_count_recorded_at"}),
    SnapshotJoin("salaries", "job_id", "job_id", rename={"min_salary": "listed_min_salary", "max_salary": "listed_max_salary", "med_salary": "listed_med_salary", "pay_period": "listed_pay_period", "currency": "listed_currency", "compensation_type": "listed_compensation_type"}),
)
LISTING_BRIDGES = (
    BridgeSummary("job_industries", "job_id", "industry_id", "industry", "industries", "industry_id", "industry_name"),
    BridgeSummary("job_skills", "job_id", "skill_abr", "skill", "skills", "skill_abr", "skill_name"),
    BridgeSummary("benefits", "job_id", "type", "benefit"),
    BridgeSummary("company_specialities", "company_id", "speciality", "speciality"),
)
