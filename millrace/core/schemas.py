"""Canonical schemas and default rules of the listing tables. The values here are fixed: other data depends on them."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSchema:
    """Canonical columns in order with their types; accepted other names; columns that must be present."""

    columns: dict[str, str]
    aliases: dict[str, tuple[str, ...]] = field(default_factory=dict)
    required: tuple[str, ...] = ()


@dataclass(frozen=True)
class ValueRule:
    """What a value may be: one of ``allowed``, within bounds, matching ``pattern`` from its start."""

    allowed: tuple | None = None
    low: float | None = None
    high: float | None = None
    pattern: str | None = None


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class ValidationRules:
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    values: dict[str, ValueRule] = field(default_factory=dict)
    numeric: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()


@dataclass(frozen=True)
class CleaningRule:
    """Keys, what to do with nulls and low values, columns in lower case, and parents."""

    keys: tuple[str, ...] = ()
    drop_null: tuple[str, ...] = ()
    fill_null: dict[str, object] = field(default_factory=dict)
    lowercase: tuple[str, ...] = ()
    lower_bounds: dict[str, float] = field(default_factory=dict)
    low_values: str = "leave"  # drop_row, nullify or leave
    duplicates: str = "first"  # first, last or drop_all
    foreign_keys: tuple[ForeignKey, ...] = ()


# Canonical columns and types of the ten tables.
LISTING_SCHEMAS: dict[str, TableSchema] = {
    "postings": TableSchema(
        {
            "job_id": "bigint", "company_id": "bigint", "title": "string", "description": "string", "location": "string", "views": "bigint", "applies": "bigint",
            "min_salary": "double", "med_salary": "double", "max_salary": "double", "pay_period": "string", "currency": "string", "compensation_type": "string",
            "normalized_salary": "double", "formatted_work_type": "string", "work_type": "string", "remote_allowed": "double", "formatted_experience_level": "string",
            "listed_time": "double", "original_listed_time": "double", "expiry": "double", "closed_time": "double", "sponsored": "bigint", "zip_code": "string", "fips": "double",
        },
        {"job_id": ("id",), "title": ("job_title",), "description": ("job_description",), "formatted_work_type": ("work_type_name",), "formatted_experience_level": ("experience_level",)},
        ("job_id",),
    ),
    "companies": TableSchema(
        {"company_id": "bigint", "name": "string", "description": "string", "company_size": "double", "state": "string", "country": "string", "city": "string", "zip_code": "string", "address": "string", "url": "string"},
        {"name": ("company_name",)},
        ("company_id",),
    ),
    "industries": TableSchema({"industry_id": "bigint", "industry_name": "string"}, required=("industry_id",)),
    "job_industries": TableSchema({"job_id": "bigint", "industry_id": "bigint"}, required=("job_id", "industry_id")),
    "benefits": TableSchema({"job_id": "bigint", "inferred": "bigint", "type": "string"}, required=("job_id",)),
    "company_specialities": TableSchema({"company_id": "bigint", "speciality": "string"}, required=("company_id",)),
    "employee_counts": TableSchema({"company_id": "bigint", "employee_count": "bigint", "follower_count": "bigint", "time_recorded": "double"}, required=("company_id",)),
    "job_skills": TableSchema({"job_id": "bigint", "skill_abr": "string"}, required=("job_id",)),
    "skills": TableSchema({"skill_abr": "string", "skill_name": "string"}, required=("skill_abr",)),
    "salaries": TableSchema(
        {"salary_id": "bigint", "job_id": "bigint", "max_salary": "double", "med_salary": "double", "min_salary": "double", "pay_period": "string", "currency": "string", "compensation_type": "string"},
        required=("job_id",),
    ),
}

# File names by table; the first four tables must be there.
MANDATORY_FILES = {"postings": ("postings.csv", "job_postings.csv"), "companies": ("companies.csv",), "industries": ("industries.csv",), "job_industries": ("job_industries.csv",)}
OPTIONAL_FILES = {t: (f"{t}.csv",) for t in ("benefits", "company_specialities", "employee_counts", "job_skills", "skills", "salaries")}

# Epoch milliseconds of the years 2000 and 2100, and closed vocabularies.
EPOCH_MS = ValueRule(low=946684800000, high=4102444800000)
NON_NEGATIVE = ValueRule(low=0)
WORK_TYPES = ("FULL_TIME", "PART_TIME", "CONTRACT", "TEMPORARY", "INTERNSHIP", "VOLUNTEER", "OTHER")
EXPERIENCE_LEVELS = ("Internship", "Entry level", "Associate", "Mid-Senior level", "Director", "Executive")
PAY_PERIODS = ("HOURLY", "WEEKLY", "BIWEEKLY", "MONTHLY", "YEARLY", "ONCE")

_JOB = ForeignKey("job_id", "postings", "job_id")
_COMPANY = ForeignKey("company_id", "companies", "company_id")
_SKILL = ForeignKey("skill_abr", "skills", "skill_abr")
_INDUSTRY = ForeignKey("industry_id", "industries", "industry_id")

LISTING_VALIDATION: dict[str, ValidationRules] = {
    "postings": ValidationRules(
        ("job_id",),
        ("job_id", "company_id", "title"),
        {
            "min_salary": NON_NEGATIVE, "max_salary": NON_NEGATIVE, "listed_time": EPOCH_MS, "original_listed_time": EPOCH_MS, "expiry": EPOCH_MS, "closed_time": EPOCH_MS,
            "remote_allowed": ValueRule(allowed=(0, 1)), "work_type": ValueRule(allowed=WORK_TYPES), "formatted_experience_level": ValueRule(allowed=EXPERIENCE_LEVELS), "pay_period": ValueRule(allowed=PAY_PERIODS),
        },
        foreign_keys=(_COMPANY,),
    ),
    "companies": ValidationRules(("company_id",), ("company_id", "name")),
    "industries": ValidationRules(("industry_id",), ("industry_id", "industry_name")),
    "job_industries": ValidationRules(("job_id", "industry_id"), ("job_id", "industry_id"), foreign_keys=(_JOB, _INDUSTRY)),
    "benefits": ValidationRules(not_null=("job_id",), foreign_keys=(_JOB,)),
    "company_specialities": ValidationRules(not_null=("company_id",), foreign_keys=(_COMPANY,)),
    "employee_counts": ValidationRules(not_null=("company_id",), values={"employee_count": NON_NEGATIVE, "follower_count": NON_NEGATIVE}, foreign_keys=(_COMPANY,)),
    "job_skills": ValidationRules(not_null=("job_id", "skill_abr"), foreign_keys=(_JOB, _SKILL)),
    "skills": ValidationRules(("skill_abr",), ("skill_abr",)),
    "salaries": ValidationRules(not_null=("job_id",), values={"min_salary": NON_NEGATIVE, "max_salary": NON_NEGATIVE}, foreign_keys=(_JOB,)),
}

LISTING_CLEANING: dict[str, CleaningRule] = {
    "postings": CleaningRule(("job_id",), drop_null=("company_id",), foreign_keys=(_COMPANY,)),
    "companies": CleaningRule(("company_id",), fill_null={"name": "Unknown Company"}),
    "industries": CleaningRule(("industry_id",), fill_null={"industry_name": "Unspecified"}, lowercase=("industry_name",)),
    "job_industries": CleaningRule(("job_id", "industry_id"), foreign_keys=(_JOB, _INDUSTRY)),
    "benefits": CleaningRule(lowercase=("type",), foreign_keys=(_JOB,)),
    "company_specialities": CleaningRule(lowercase=("speciality",), foreign_keys=(_COMPANY,)),
    "employee_counts": CleaningRule(foreign_keys=(_COMPANY,)),
    "job_skills": CleaningRule(("job_id", "skill_abr"), foreign_keys=(_JOB, _SKILL)),
    "salaries": CleaningRule(lower_bounds={"med_salary": 0.0, "min_salary": 0.0, "max_salary": 0.0}, low_values="drop_row", foreign_keys=(_JOB,)),
    "skills": CleaningRule(("skill_abr",), lowercase=("skill_name",)),
}
