"""Reading dataset versions and single tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.core.schemas import MANDATORY_FILES, OPTIONAL_FILES

#: Text that stands for a missing value in a CSV file.
MISSING_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
#: Column that holds the order of the rows in their files.
ORDINAL = "_ord"

Catalog = dict[str, dict[str, DataFrame]]


def _children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """Names below ``path`` on any file system that Spark reads, and whether each is a folder."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [(s.getPath().getName(), s.isDirectory()) for s in files.listStatus(where)] if files.exists(where) else []


def discover_versions(spark: SparkSession, root: str, prefix: str = "Version_") -> list[str]:
    """Folders ``<prefix><number>`` under ``root`` by number; none is an error."""
    found = [name for name, folder in _children(spark, root) if folder and re.fullmatch(re.escape(prefix) + r"\d+", name)]
    if not found:
        raise FileNotFoundError(f"no {prefix}* folder in {root}")
    return sorted(found, key=lambda name: int(name.removeprefix(prefix)))


def read_csv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """A CSV file with a header, every column a string, texts for missing values null; a file without rows is an error.

    A multi-line file is one task: convert large ones to Parquet once.
    """
    df = spark.read.option("header", True).option("multiLine", multiline).option("quote", '"').option("escape", '"').csv(path)
    if df.isEmpty():
        raise ValueError(f"{path} has no rows")
    missing = F.array(*[F.lit(x) for x in MISSING_TEXTS])
    return df.select(*[F.when(~F.array_contains(missing, F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) for c in df.columns])


#: Column of the text of a record that does not fit its header.
BAD_RECORD = "_bad_record"


def read_csv_checked(spark: SparkSession, path: str | list[str], names: list[str] | None = None, multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """Good rows as ``read_csv`` gives them, and ``file, record`` of those with fewer or more fields than the header.

    ``names`` are the columns of files without a header. A file without rows adds none; no good row at all is an error.
    Both frames scan the files; count the second by file with ``bad_record_counts``.
    """
    reader = spark.read.option("header", names is None).option("multiLine", multiline).option("quote", '"').option("escape", '"')
    if names is None:
        names = reader.csv(path).columns
    if BAD_RECORD in names:
        raise ValueError(f"{path} has a column {BAD_RECORD}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, BAD_RECORD]])
    # a parser that leaves out columns does not see how many fields a record has
    rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_RECORD).option("columnPruning", False).schema(schema).csv(path)
    # Spark reads the text of a bad record only together with a column of the file: this always holds and names one
    rows = rows.where(F.coalesce(F.length(f"`{names[0]}`"), F.lit(0)) >= 0)
    missing = F.array(*[F.lit(x) for x in MISSING_TEXTS])
    good = rows.where(F.col(BAD_RECORD).isNull()).select(*[F.when(~F.array_contains(missing, F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) for c in names])
    if good.isEmpty():
        raise ValueError(f"{path} has no rows")
    bad = rows.where(F.col(BAD_RECORD).isNotNull())
    return good, bad.select(F.col("_metadata.file_path").alias("file"), F.col(BAD_RECORD).alias("record"))


def bad_record_counts(bad: DataFrame) -> DataFrame:
    """``file, records``: bad records of each file that has any."""
    return bad.groupBy("file").agg(F.count("*").alias("records"))


def with_ordinal(df: DataFrame) -> DataFrame:
    """``df`` with the order of its rows: by file, then by place in it, for the rules that keep a first or last row."""
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return df.withColumn(ORDINAL, place)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    """A table by its ending (.parquet, .pq, .csv); other endings, no rows and repeated column names are errors."""
    ending = path.rsplit(".", 1)[-1].lower()
    if ending in ("parquet", "pq"):
        df = spark.read.parquet(path)
    elif ending == "csv":
        df = read_csv(spark, path)
    else:
        raise ValueError(f"unsupported file type: {path}")
    names = [c.lower() for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"repeated column names in {path}")
    if df.isEmpty():
        raise ValueError(f"{path} has no rows")
    return df


def load_version(spark: SparkSession, folder: str, mandatory: dict[str, tuple[str, ...]] | None = None, optional: dict[str, tuple[str, ...]] | None = None) -> tuple[dict[str, DataFrame], list[str]]:
    """Tables of a version by the first accepted file name that exists, and the optional tables that are missing."""
    mandatory, optional = mandatory or MANDATORY_FILES, optional or OPTIONAL_FILES
    there = {name for name, _ in _children(spark, folder)}
    tables, absent = {}, []
    for name, accepted in (mandatory | optional).items():
        file = next((f for f in accepted if f in there), None)
        if file is not None:
            tables[name] = load_table(spark, f"{folder}/{file}")
        elif name in mandatory:
            raise FileNotFoundError(f"{name}: none of {', '.join(accepted)} in {folder}")
        else:
            absent.append(name)
    return tables, absent


def load_catalog(spark: SparkSession, root: str) -> Catalog:
    """All versions under ``root``; lazy, nothing but file names and emptiness is looked at."""
    return {v: load_version(spark, f"{root}/{v}")[0] for v in discover_versions(spark, root)}
