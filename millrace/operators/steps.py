"""Counts of the frames between steps, taken by the one run that writes the result."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REPORT = "table string, step int, name string, metric string, value long"


@dataclass(frozen=True)
class Step:
    table: str
    name: str
    frame: DataFrame
    wanted: list[Column]
    columns: int
    seen: Observation


def _wanted(columns: list[str], counts: dict[str, Column]) -> list[Column]:
    nulls = reduce(Column.__add__, [F.count_if(F.col(f"`{c}`").isNull()) for c in columns], F.lit(0))
    return [F.count(F.lit(1)).alias("rows"), nulls.cast("long").alias("nulls"), *[c.cast("long").alias(n) for n, c in counts.items()]]


@dataclass
class StepLog:
    """Steps of one or more tables. ``watch`` a frame after each step, ``write`` the last one, then read ``report``.

    Rows, nulls and further counts are gathered while the rows pass by (``DataFrame.observe``), so a chain of any length
    is read once. Spark adds up what every task saw; where a finished task had to run again (an executor was lost) its
    rows would count twice, so the log then counts the frames of that run by themselves.
    """

    steps: list[Step] = field(default_factory=list)
    values: dict[int, dict[str, int]] = field(default_factory=dict)

    def watch(self, df: DataFrame, table: str, name: str, without: tuple[str, ...] = (), **counts: Column) -> DataFrame:
        """``df`` with rows, nulls (of the columns but ``without``) and ``counts`` (aggregates) observed as step ``name`` of ``table``."""
        columns = [c for c in df.columns if c not in without]
        step = Step(table, name, df, _wanted(columns, counts), len(columns), Observation(f"{table} {name} {uuid.uuid4().hex}"))
        self.steps.append(step)
        return df.observe(step.seen, *step.wanted)

    def forget(self, table: str) -> None:
        """Drop the steps of ``table``, for instance of one that failed."""
        kept = [(s, self.values.get(k)) for k, s in enumerate(self.steps) if s.table != table]
        self.steps, self.values = [s for s, _ in kept], {k: v for k, (_, v) in enumerate(kept) if v is not None}

    def write(self, df: DataFrame, path: str) -> DataFrame:
        """Write ``df`` as Parquet, settle the steps that the run has passed, and return what was written."""
        spark = df.sparkSession
        group, before = f"steps-{uuid.uuid4().hex}", spark.sparkContext.getLocalProperty("spark.jobGroup.id")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", group)
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", before)
        again = ran_again(spark, group)
        for k, step in enumerate(self.steps):
            if k not in self.values:
                found = {} if again else step.seen.get
                self.values[k] = found or step.frame.agg(*step.wanted).first().asDict()
        return spark.read.schema(df.schema).parquet(path)

    def report(self, spark: SparkSession) -> DataFrame:
        """``table, step, name, metric, value``: ``rows``, ``columns``, ``nulls`` and further counts of each step, from 0 a table."""
        rows, place = [], {}
        for k, step in enumerate(self.steps):
            if k not in self.values:
                raise ValueError(f"step {step.name} of {step.table} has not been written")
            n = place[step.table] = place.get(step.table, -1) + 1
            rows += [(step.table, n, step.name, m, int(v or 0)) for m, v in {**self.values[k], "columns": step.columns}.items()]
        return spark.createDataFrame(rows, REPORT)

    def changes(self, spark: SparkSession) -> DataFrame:
        """``table, rows_before, rows_after, removed, removed_pct``: the first step of each table against its last."""
        rows = self.report(spark).where("metric = 'rows'").groupBy("table").agg(F.min_by("value", "step").alias("rows_before"), F.max_by("value", "step").alias("rows_after"))
        removed = F.col("rows_before") - F.col("rows_after")
        return rows.select("table", "rows_before", "rows_after", removed.alias("removed"), F.round(100 * F.try_divide(removed, F.col("rows_before")), 4).alias("removed_pct"))


def ran_again(spark: SparkSession, group: str) -> bool:
    """Whether any task of the jobs of ``group`` failed or was sent again."""
    tracker = spark.sparkContext.statusTracker()
    jobs = [j for j in map(tracker.getJobInfo, tracker.getJobIdsForGroup(group)) if j is not None]
    stages = [s for job in jobs for s in map(tracker.getStageInfo, job.stageIds) if s is not None]
    return any(s.numFailedTasks > 0 or s.currentAttemptId > 0 for s in stages)
