"""Writing tables, their archive copies, splits and reports."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.core.fingerprint import schema_fingerprint


def _flat(df: DataFrame, delimiter: str = "|") -> DataFrame:
    """``df`` with lists joined to text, for formats without lists."""
    return df.select(*[F.array_join(F.col(f"`{f.name}`").cast("array<string>"), delimiter).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, delimiter: str = "|") -> None:
    """CSV with a header; lists as texts joined by ``delimiter``."""
    _flat(df, delimiter).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report table as JSON lines."""
    report.write.mode("overwrite").json(path)


def write_dataset(df: DataFrame, out_dir: str, report: DataFrame | None = None, archive: bool = True, run_id: str | None = None, form: str = "parquet") -> dict[str, str]:
    """Write ``df`` to ``out_dir/latest`` and, once more, to ``out_dir/archive/<run>`` with a sidecar of its metadata.

    The sidecar is a one-row table: run, fingerprint of the schema, and the columns. Spark's committer writes to a
    temporary folder and moves the files when all tasks are done, so a reader never sees a half-written table.
    """
    run_id = run_id or datetime.now(UTC).strftime("%Y%m%dT%H%M%S%f")
    spark = df.sparkSession
    meta = [(run_id, schema_fingerprint(df), json.dumps([[f.name, f.dataType.simpleString()] for f in df.schema.fields]))]
    sidecar = spark.createDataFrame(meta, "run string, schema_fingerprint string, columns string")
    paths = {"latest": f"{out_dir}/latest"} | ({"archive": f"{out_dir}/archive/{run_id}"} if archive else {})
    for path in paths.values():
        if form == "csv":
            write_csv(df, f"{path}/data")
        else:
            df.write.mode("overwrite").parquet(f"{path}/data")
        sidecar.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")
        if report is not None:
            write_report(report, f"{path}/report")
    return paths


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """One folder a split."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def read_splits(spark, path: str, split_col: str = "split") -> dict[str, DataFrame]:
    """The splits of ``write_splits``; only the files of a split are read for it."""
    df = spark.read.parquet(path)
    names = [r[0] for r in df.select(split_col).distinct().orderBy(split_col).collect()]
    return {n: df.where(F.col(split_col) == n).drop(split_col) for n in names}
