"""The feature store: types, dates, missing values, booleans, categories, texts, lists, derived columns."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import columns as C
from millrace.operators import ordered
from millrace.operators.steps import StepLog

# Column groups and strategies of the listing features.
IDENTIFIERS = ("job_id", "company_id", "salary_id")
DATETIMES = ("listed_time", "original_listed_time", "expiry", "closed_time", "time_recorded")
BOOLEANS = ("remote_allowed", "sponsored")
CATEGORIES = ("formatted_work_type", "work_type", "formatted_experience_level", "pay_period", "compensation_type", "currency", "application_type", "company_size", "company_state", "company_country", "company_city", "top_industry", "top_skill")
TEXTS = ("title", "description", "company_name", "company_description", "location", "company_address")
LISTS = ("skill_list", "benefit_list", "industry_list", "speciality_list")
STRATEGIES = {"min_salary": "leave", "med_salary": "leave", "max_salary": "leave", "normalized_salary": "leave", "views": "median", "applies": "median", "company_employee_count": "median", "company_follower_count": "median", "zip_code": "leave", "fips": "leave", "formatted_experience_level": "constant", "company_size": "constant"}


@dataclass(frozen=True)
class FeatureConfig:
    identifiers: tuple[str, ...] = IDENTIFIERS
    datetimes: tuple[str, ...] = DATETIMES
    booleans: tuple[str, ...] = BOOLEANS
    categories: tuple[str, ...] = CATEGORIES
    texts: tuple[str, ...] = TEXTS
    lists: tuple[str, ...] = LISTS
    strategies: dict[str, str] = field(default_factory=lambda: dict(STRATEGIES))
    constants: dict[str, object] = field(default_factory=lambda: {"formatted_experience_level": "UNKNOWN", "company_size": "UNKNOWN"})
    numeric_default: str = "median"
    category_default: str = "mode"
    text_default: str = "constant"
    number_fill: float = -1.0
    text_fill: str = "UNKNOWN"
    mode_limit: int = 100


def column_groups(df: DataFrame, cfg: FeatureConfig) -> dict[str, list[str]]:
    """The configured groups, cut to the columns that are there, and the remaining numeric columns."""
    there = df.columns
    groups = {g: [c for c in getattr(cfg, g) if c in there] for g in ("identifiers", "datetimes", "booleans", "categories", "texts", "lists")}
    used = {c for cs in groups.values() for c in cs}
    groups["numeric"] = [f.name for f in df.schema.fields if f.name not in used and isinstance(f.dataType, T.NumericType)]
    return groups


def standardize_types(df: DataFrame, numeric: list[str]) -> DataFrame:
    """Numeric columns that are not numbers become doubles; what cannot be read is null."""
    new = {f.name: F.col(f"`{f.name}`").try_cast("double") for f in df.schema.fields if f.name in numeric and not isinstance(f.dataType, T.NumericType)}
    return df.withColumns(new) if new else df


def standardize_datetimes(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: C.epoch_ms(F.col(f"`{c}`")) for c in columns if not isinstance(df.schema[c].dataType, T.TimestampType)})


def _modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, value, distinct``: the most frequent value as text (of equals the smallest) and the distinct values.

    All columns go through one count of (column, value), so no task holds the values of a column.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def cell(c: str) -> Column:
        col, kind = F.col(f"`{c}`"), kinds[c]
        whole = isinstance(kind, (T.IntegralType, T.BooleanType))
        return F.struct(F.lit(c).alias("column"), (col.cast("bigint") if whole else F.lit(None).cast("bigint")).alias("whole"), (col.cast("double") if isinstance(kind, T.FractionalType) else F.lit(None).cast("double")).alias("real"), col.cast("string").alias("text"))

    cells = df.select(F.explode(F.array(*[cell(c) for c in columns])).alias("x")).select("x.*").where("text is not null")
    counts = cells.groupBy("column", "whole", "real", "text").agg(F.count("*").alias("n"))
    return counts.groupBy("column").agg(F.min_by("text", F.struct(-F.col("n"), "whole", "real", "text")).alias("value"), F.count("*").alias("distinct"))


def fill_values(df: DataFrame, strategies: dict[str, str], constants: dict[str, object] | None = None, number_fill: float = -1.0, text_fill: str = "UNKNOWN", mode_limit: int = 100) -> dict[str, object]:
    """What ``filled`` puts in place of nulls, by column: the statistics of ``strategies`` (see ``fill_missing``).

    Medians of all columns are found in one long table of (column, value), by their leading bits, and modes in another;
    only a value a column reaches the driver.
    """
    constants = constants or {}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    wanted = {c: s for c, s in strategies.items() if c in kinds and not isinstance(kinds[c], (T.ArrayType, T.MapType)) and s != "leave"}
    medians, modes = ([c for c, s in wanted.items() if s == k] for k in ("median", "mode"))
    found: dict[str, object] = {}
    if medians:
        cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("v")) for c in medians])).alias("x")).select("x.*")
        for r in ordered.group_quantiles(cells, ["column"], "v", [0.5]).collect():
            found[r["column"]] = r["q0"] if isinstance(kinds[r["column"]], T.FractionalType) else float(_half_up(r["q0"]))
    if modes:
        found |= {r["column"]: r["value"] for r in _modes(df, modes).collect() if r["distinct"] <= mode_limit}
    found |= {c: constants.get(c, number_fill if isinstance(kinds[c], T.NumericType) else text_fill) for c, s in wanted.items() if s == "constant"}
    return {c: found[c] for c in wanted if c in found}


def _half_up(x: float) -> int:
    """``x`` rounded, halves away from zero."""
    return int(abs(x) + 0.5) * (1 if x >= 0 else -1)


def filled(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """``df`` with the nulls of the columns of ``values`` replaced."""
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(v).try_cast(df.schema[c].dataType)) for c, v in values.items()}) if values else df


def fill_missing(df: DataFrame, strategies: dict[str, str], constants: dict[str, object] | None = None, number_fill: float = -1.0, text_fill: str = "UNKNOWN", mode_limit: int = 100) -> DataFrame:
    """Fill nulls by ``strategies``: leave, median, mode (skipped above ``mode_limit`` distinct values) or constant.

    Medians and modes are exact; the mode of equals is the smallest value. A column without values stays as it is.
    """
    return filled(df, fill_values(df, strategies, constants, number_fill, text_fill, mode_limit))


def default_strategies(df: DataFrame, groups: dict[str, list[str]], cfg: FeatureConfig) -> dict[str, str]:
    """The strategy of each column: configured, or by its group."""
    out = {}
    for g, default in (("numeric", cfg.numeric_default), ("booleans", cfg.numeric_default), ("categories", cfg.category_default), ("texts", cfg.text_default)):
        for c in groups[g]:
            kind = df.schema[c].dataType
            out[c] = cfg.strategies.get(c, cfg.category_default if g == "booleans" and not isinstance(kind, T.NumericType) else default)
    return out


def derived(df: DataFrame) -> DataFrame:
    """Flags and counts from the columns that are there."""
    there = set(df.columns)
    new: dict[str, Column] = {}
    pay = [c for c in ("min_salary", "med_salary", "max_salary", "normalized_salary") if c in there]
    if pay:
        new["salary_available"] = F.coalesce(*[F.col(c) for c in pay]).isNotNull()
    for flag, c in (("has_description", "description"), ("has_company_description", "company_description"), ("listing_age_available", "listed_time")):
        if c in there:
            new[flag] = F.col(c).isNotNull()
    for count, c in (("skill_count", "skill_list"), ("benefit_count", "benefit_list"), ("industry_count", "industry_list"), ("speciality_count", "speciality_list")):
        if c in there:
            new[count] = C.list_length(F.col(c))
    return df.withColumns(new) if new else df


def build_features(df: DataFrame, cfg: FeatureConfig | None = None, dedupe: bool = True, log: StepLog | None = None, name: str = "features") -> DataFrame:
    """All steps in their default order: missing values are filled before booleans, categories and texts are cleaned.

    With ``log`` each step is watched as one of table ``name``; ``lost`` counts the cells that the next step cannot read.
    """
    cfg = cfg or FeatureConfig()
    groups = column_groups(df, cfg)

    def seen(out: DataFrame, step: str, lost: DataFrame | None = None) -> DataFrame:
        if log is None:
            return out
        return log.watch(out, name, step, **({} if lost is None else {"lost": _lost(out, lost)}))

    typed = lambda x: standardize_types(x, groups["numeric"]).drop(*groups["identifiers"])
    dated = lambda x: standardize_datetimes(x, groups["datetimes"])
    plain = dated(typed(df))
    values = fill_values(plain, default_strategies(plain, groups, cfg), cfg.constants, cfg.number_fill, cfg.text_fill, cfg.mode_limit)
    out = typed(seen(df, "input"))
    out = dated(seen(out, "types", dated(out)))
    out = seen(filled(seen(out, "dates"), values), "missing values")
    new: dict[str, Column] = {c: C.boolean(F.col(c)) for c in groups["booleans"]}
    new |= {c: C.category(F.col(c)) if isinstance(out.schema[c].dataType, T.StringType) else C.upper_snake(F.col(c).cast("string")) for c in groups["categories"]}
    new |= {c: C.clean_text(F.col(c)) for c in groups["texts"]}
    new |= {c: C.standard_list(F.col(c) if isinstance(out.schema[c].dataType, T.ArrayType) else C.list_items(F.col(c))) for c in groups["lists"]}
    out = seen(derived(seen(out.withColumns(new) if new else out, "values")), "derived")
    return seen(out.dropDuplicates(), "duplicates") if dedupe else out


def _lost(before: DataFrame, after: DataFrame) -> Column:
    """Cells of the datetime columns that ``after`` makes of ``before`` and cannot read."""
    changed = [f.name for f in before.schema.fields if f.dataType != after.schema[f.name].dataType]
    return reduce(Column.__add__, [F.count_if(F.col(f"`{c}`").isNotNull() & C.epoch_ms(F.col(f"`{c}`")).isNull()) for c in changed], F.lit(0))


def check_store(df: DataFrame, needed: tuple[str, ...] = ()) -> None:
    """Raise if the store is empty, repeats a column name or lacks a derived column."""
    lower = [c.lower() for c in df.columns]
    if len(set(lower)) < len(lower):
        raise ValueError("repeated column names")
    if missing := [c for c in needed if c not in df.columns]:
        raise ValueError(f"derived columns are missing: {', '.join(missing)}")
    if df.isEmpty():
        raise ValueError("the feature store is empty")

