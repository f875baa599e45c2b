"""Annual pay targets with a rejection funnel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators import ordered

# Predictors, and columns that would leak the target.
PREDICTORS = ("title", "formatted_experience_level", "formatted_work_type", "company_state", "company_country", "company_size", "company_employee_count", "company_follower_count", "top_industry", "top_skill", "skill_list", "skill_count")
METADATA = ("company_name", "location", "original_listed_time", "listed_time", "dataset_version")
LEAKS = ("min_salary", "med_salary", "max_salary", "normalized_salary", "listed_min_salary", "listed_med_salary", "listed_max_salary", "salary_available", "views", "applies", "closed_time", "expiry", "dataset_version", "pay_period", "currency", "listed_currency", "listed_pay_period", "listed_compensation_type")


@dataclass(frozen=True)
class PayConfig:
    """Columns and limits of the target."""

    low: str = "min_salary"
    high: str = "max_salary"
    middle: str = "med_salary"
    period: str = "pay_period"
    currency: str = "currency"
    accepted: str = "usd"
    most_hourly: float = 300.0
    least: float = 10_000.0
    most: float = 1_000_000.0


def with_target(df: DataFrame, cfg: PayConfig | None = None) -> DataFrame:
    """``df`` with ``raw_pay, target_annual_salary, target_log_salary, salary_target_source, reject_reason``.

    Raw pay is the middle of low and high if both are positive and in order, else the median if positive. Rows go
    through the tests in order (no pay, hourly too high, currency, period, bounds); the first that fails is the reason
    and the targets are null.
    """
    cfg = cfg or PayConfig()
    low, high, middle = (F.col(c).try_cast("double") for c in (cfg.low, cfg.high, cfg.middle))
    ranged = F.coalesce((low > 0) & (high > 0) & (low <= high), F.lit(False))
    single = F.coalesce(middle > 0, F.lit(False))
    raw = F.when(ranged, (low + high) / 2).when(single, middle)
    period, currency = F.lower(F.trim(F.col(cfg.period))), F.lower(F.trim(F.col(cfg.currency)))
    annual = raw * C.pay_multiplier(F.col(cfg.period))
    reason = (
        F.when(raw.isNull(), "no_pay")
        .when((period == "hourly") & (raw > cfg.most_hourly), "hourly_too_high")
        .when(~F.coalesce(currency == cfg.accepted, F.lit(False)), "currency")
        .when(annual.isNull(), "period")
        .when(~annual.between(cfg.least, cfg.most), "out_of_bounds")
    )
    out = df.withColumns({"raw_pay": raw, "salary_target_source": F.when(ranged, "midpoint").when(single, "median"), "reject_reason": reason})
    target = F.when(F.col("reject_reason").isNull(), annual)
    return out.withColumns({"target_annual_salary": target, "target_log_salary": F.log1p(target)})


def funnel(df: DataFrame) -> DataFrame:
    """Counters of a frame with targets, in one pass: rows, candidates (with pay) and a counter for each reason."""
    reason = F.col("reject_reason")
    named = ("hourly_too_high", "currency", "period", "out_of_bounds")
    return df.agg(F.count("*").alias("rows"), F.count("raw_pay").alias("candidates"), F.count_if(reason == "no_pay").alias("no_pay"), *[F.count_if(reason == r).alias(r) for r in named], F.count("target_annual_salary").alias("accepted"))


def resolve_predictors(df: DataFrame, wanted: tuple[str, ...] = PREDICTORS, leaks: tuple[str, ...] = LEAKS) -> list[str]:
    """The wanted predictors that are there; one that leaks the target is an error."""
    if both := sorted(set(wanted) & set(leaks)):
        raise ValueError(f"predictors leak the target: {', '.join(both)}")
    return [c for c in wanted if c in df.columns]


def modelling_frame(df: DataFrame, group_cols: tuple[str, ...] = ("title", "company_name", "location"), numeric: tuple[str, ...] = ("company_employee_count", "company_follower_count")) -> DataFrame:
    """Rows with a target: targets, predictors, logged numbers, group id and metadata, each column once."""
    predictors = resolve_predictors(df)
    logs = {f"log_{c}": C.safe_log1p(F.col(c)) if c in df.columns else F.lit(None).cast("double") for c in numeric}
    there = [F.col(c) if c in df.columns else F.lit(None).cast("string") for c in group_cols]
    out = df.where("target_annual_salary is not null").withColumns(logs | {"posting_group_id": C.group_id(*there)})
    names = ["target_annual_salary", "target_log_salary", "salary_target_source", *predictors, *logs, "posting_group_id", *[c for c in METADATA if c in df.columns]]
    return out.select(*dict.fromkeys(names))


def violations(df: DataFrame, cfg: PayConfig | None = None, tolerance: float = 1e-9) -> DataFrame:
    """Counters that must be 0: null, infinite and out-of-bounds targets, and logs that do not fit; one pass."""
    cfg = cfg or PayConfig()
    t, log = F.col("target_annual_salary"), F.col("target_log_salary")
    infinite = lambda c: (F.abs(c) == float("inf")) | F.isnan(c)
    return df.agg(
        F.count_if(t.isNull() | log.isNull()).alias("null_target"),
        F.count_if(infinite(t) | infinite(log)).alias("infinite_target"),
        F.count_if(~t.between(cfg.least, cfg.most)).alias("out_of_bounds"),
        F.count_if(F.abs(F.log1p(t) - log) > tolerance).alias("log_differs"),
    )


def describe(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """``rows, low, high, mean, median, std`` of a column, of each group if ``by``."""
    c = F.col(col)
    out = df.groupBy(*(by or [])).agg(F.count(c).alias("rows"), F.min(c).alias("low"), F.max(c).alias("high"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"))
    out = ordered.with_quantiles(out, df, by or [], col, {"median": 0.5})
    return out.select(*(by or []), "rows", "low", "high", "mean", "median", "std")


def share(condition: Column) -> Column:
    """Percent of rows for which a condition holds."""
    return 100 * F.avg(F.coalesce(condition, F.lit(False)).cast("int"))
