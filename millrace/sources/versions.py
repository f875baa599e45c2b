"""The tables of all versions as one data source: a partition a file, versions pruned while the scan is planned.

    spark.dataSource.register(versions.VersionTables)
    spark.read.format("version_tables").option("path", root).option("table", "postings").option("versions", "Version_9,Version_13").load()

The versions wanted are an option of the read. Filters that Spark pushes to a Python source are not taken: it plans a
source once and keeps the first filter for every later use of the same frame (Spark 4.1), which would lose rows.
"""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv
import pyarrow.parquet
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from millrace.sources.readers import MISSING_TEXTS

#: Name of the format, and of the column that tells a row's version.
FORMAT, VERSION = "version_tables", "dataset_version"
_ENDINGS = (".csv", ".parquet", ".pq")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``path`` (local, or any that Arrow knows by its URI) and the path in it."""
    local = re.fullmatch(r"file:/*(/.*)|(/.*)", path)
    return (fs.LocalFileSystem(), local[1] or local[2]) if local else fs.FileSystem.from_uri(path)


def _files(files: fs.FileSystem, root: str, table: tuple[str, ...], prefix: str, wanted: set[str] | None) -> list[tuple[str, str]]:
    """(version, file) of ``table``: the first of its accepted names that a version has, or the part files of a folder of that name.

    Folders of other versions than the ``wanted`` ones (None: all) are not looked into.
    """
    folders = [f for f in files.get_file_info(fs.FileSelector(root)) if f.type == fs.FileType.Directory and re.fullmatch(re.escape(prefix) + r"\d+", f.base_name)]
    if not folders:
        raise FileNotFoundError(f"no {prefix}* folder in {root}")
    if absent := (wanted or set()) - {f.base_name for f in folders}:
        raise FileNotFoundError(f"{', '.join(sorted(absent))} not in {root}")
    out, folders = [], [f for f in folders if wanted is None or f.base_name in wanted]
    for folder in sorted(folders, key=lambda f: int(f.base_name.removeprefix(prefix))):
        there = {f.base_name: f for f in files.get_file_info(fs.FileSelector(folder.path))}
        found = next((there[name] for name in table if name in there), None)
        if found is None:
            continue
        parts = [found] if found.type == fs.FileType.File else files.get_file_info(fs.FileSelector(found.path))
        out += [(folder.base_name, p.path) for p in sorted(parts, key=lambda p: p.path) if p.type == fs.FileType.File and p.size and not p.base_name.startswith(("_", "."))]
    return out


def _schema(files: fs.FileSystem, path: str) -> pa.Schema:
    """Columns of a file: those of a Parquet footer, or the header of a CSV file as texts."""
    if path.endswith((".parquet", ".pq")):
        return pa.parquet.read_schema(path, filesystem=files)
    with files.open_input_stream(path) as stream:
        header = next(csv.reader(io.TextIOWrapper(stream, "utf-8-sig", newline="")))
    return pa.schema([(n, pa.string()) for n in header])


@dataclass
class FilePart(InputPartition):
    version: str
    path: str


class VersionTables(DataSource):
    """Options: ``path`` (folder of the versions), ``table`` (or ``names``, accepted file names), ``versions``, ``prefix``; lists are joined by commas."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _where(self) -> tuple[str, tuple[str, ...], str, set[str] | None]:
        if "path" not in self.options or not {"table", "names"} & set(self.options):
            raise ValueError("give the path of the versions and a table")
        names = self.options.get("names") or ",".join(self.options["table"] + e for e in _ENDINGS)
        wanted = set(self.options["versions"].split(",")) if "versions" in self.options else None
        return self.options["path"], tuple(names.split(",")), self.options.get("prefix", "Version_"), wanted

    def schema(self) -> StructType:
        """All columns of all versions in the order of their first appearance; one type a column."""
        root, names, prefix, wanted = self._where()
        files, folder = _open(root)
        parts, kinds = _files(files, folder, names, prefix, wanted), {}
        first = {version: path for version, path in reversed(parts)}
        if not first:
            raise FileNotFoundError(f"no version in {root} has any of {', '.join(names)}")
        for version in sorted(first, key=lambda v: int(v.removeprefix(prefix))):
            for field in _schema(files, first[version]):
                if kinds.setdefault(field.name, field.type) != field.type:
                    raise ValueError(f"{field.name} is {kinds[field.name]} and, in {version}, {field.type}")
        if VERSION in kinds:
            raise ValueError(f"a file has a column {VERSION}")
        own = from_arrow_schema(pa.schema(list(kinds.items())))
        return StructType([*own.fields, StructField(VERSION, StringType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return VersionReader(schema, *self._where())


class VersionReader(DataSourceReader):
    def __init__(self, schema: StructType, root: str, names: tuple[str, ...], prefix: str, wanted: set[str] | None) -> None:
        self.columns, self.root, self.names, self.prefix, self.wanted = schema.json(), root, names, prefix, wanted

    def partitions(self) -> list[FilePart]:
        files, folder = _open(self.root)
        return [FilePart(v, p) for v, p in _files(files, folder, self.names, self.prefix, self.wanted)]

    def read(self, part: FilePart) -> Iterator[pa.RecordBatch]:
        """The batches of a file as they are read; a column that it lacks is null. A CSV value that stands for a missing one is null."""
        if part is None:  # Spark asks so where no partition is left
            return
        files, _ = _open(self.root)
        target = to_arrow_schema(StructType.fromJson(json.loads(self.columns)))
        with files.open_input_file(part.path) as source:
            if part.path.endswith((".parquet", ".pq")):
                batches = pa.parquet.ParquetFile(source).iter_batches()
            else:
                texts = pa.csv.ConvertOptions(column_types={f.name: pa.string() for f in target}, null_values=list(MISSING_TEXTS), strings_can_be_null=True, quoted_strings_can_be_null=True)
                batches = pa.csv.open_csv(source, parse_options=pa.csv.ParseOptions(newlines_in_values=True), convert_options=texts)
            for b in batches:
                there = set(b.schema.names)
                made = [pa.array([part.version] * b.num_rows) if f.name == VERSION else b.column(b.schema.names.index(f.name)).cast(f.type) if f.name in there else pa.nulls(b.num_rows, f.type) for f in target]
                yield pa.RecordBatch.from_arrays(made, schema=target)


def read_versions(spark: SparkSession, root: str, table: str, only: tuple[str, ...] = (), prefix: str = "Version_", names: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``table`` in all versions under ``root`` (or ``only`` some, whose files alone are opened) with their ``dataset_version``."""
    spark.dataSource.register(VersionTables)
    options = {"path": root, "prefix": prefix, "table": table} | ({"names": ",".join(names)} if names else {}) | ({"versions": ",".join(only)} if only else {})
    return spark.read.format(FORMAT).options(**options).load()
