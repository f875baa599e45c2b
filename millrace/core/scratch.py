"""Scratch tables in the shared folder: they cut lineage, survive lost executors and go when the session ends."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.core.session import shared_dir


@functools.cache
def _own_folder(shared: str, application: str, run: str) -> str:
    """The folder of this session; Hadoop deletes it when the driver's JVM ends."""
    from pyspark import SparkContext

    jvm, folder = SparkContext._active_spark_context._jvm, f"{shared}/millrace/{application}-{run}"
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(SparkContext._active_spark_context._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


_RUN = uuid.uuid4().hex[:12]


def new_path(spark: SparkSession, tag: str) -> str:
    """A path in the session's folder that nothing has used."""
    return f"{_own_folder(shared_dir(spark), spark.sparkContext.applicationId, _RUN)}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: later stages restart from the files."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
