"""Aligning tables to canonical schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.core.schemas import TableSchema

UNMAPPED = "unmapped__"
REPORT = "version string, table string, action string, column string, source string"


def resolve(columns: list[str], schema: TableSchema) -> dict[str, str | None]:
    """Canonical column to the first of its names that ``columns`` has in any letter case."""
    by_lower: dict[str, str] = {}
    for c in columns:
        by_lower.setdefault(c.lower(), c)
    return {name: next((by_lower[a.lower()] for a in (name, *schema.aliases.get(name, ())) if a.lower() in by_lower), None) for name in schema.columns}


def align(df: DataFrame, schema: TableSchema | None, keep_unmapped: bool = True, cast: bool = False) -> DataFrame:
    """``df`` in canonical column order: aliases renamed, absent columns null of their type, others kept under a prefix.

    A missing required column is an error. Values keep their types unless ``cast``. Without a schema the table passes
    through. Stateless column expressions: it takes a streaming DataFrame as well.
    """
    if schema is None:
        return df
    found = resolve(df.columns, schema)
    missing = [c for c in schema.required if found[c] is None]
    if missing:
        raise ValueError(f"required columns are missing: {', '.join(missing)}")
    cols = []
    for name, kind in schema.columns.items():
        src = found[name]
        col = F.lit(None).cast(kind) if src is None else F.col(f"`{src}`").try_cast(kind) if cast else F.col(f"`{src}`")
        cols.append(col.alias(name))
    used = set(found.values())
    rest = [F.col(f"`{c}`").alias(UNMAPPED + c) for c in df.columns if c not in used] if keep_unmapped else []
    return df.select(*cols, *rest)


def alignment_report(df: DataFrame, schema: TableSchema, version: str = "", table: str = "", keep_unmapped: bool = True) -> DataFrame:
    """A row for each column that was renamed, is missing, preserved or dropped; from the schema alone."""
    found = resolve(df.columns, schema)
    used = set(found.values())
    rows = [(version, table, "renamed", n, s) for n, s in found.items() if s is not None and s != n]
    rows += [(version, table, "missing", n, None) for n, s in found.items() if s is None]
    rows += [(version, table, "preserved" if keep_unmapped else "dropped", UNMAPPED + c if keep_unmapped else c, c) for c in df.columns if c not in used]
    return df.sparkSession.createDataFrame(rows, REPORT)


def empty_required(df: DataFrame, schema: TableSchema) -> DataFrame:
    """``column, non_null`` of each required column: 0 tells of one that is all null (reported, not an error)."""
    pairs = [x for c in schema.required for x in (F.lit(c), F.count(f"`{c}`"))]
    return _long(df.agg(F.create_map(*pairs).alias("m")), "m", "column", "non_null")


def _long(df: DataFrame, map_col: str, key: str, value: str) -> DataFrame:
    return df.select(F.explode(map_col).alias(key, value))


def alignment_summary(report: DataFrame) -> DataFrame:
    """``action, columns, tables`` over all reports."""
    return report.groupBy("action").agg(F.count("*").alias("columns"), F.count_distinct("version", "table").alias("tables"))
