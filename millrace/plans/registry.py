"""How plans register their queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    """Queries of a plan module and their SQL."""

    queries: dict[str, Query] = field(default_factory=dict)
    oracles: dict[str, str] = field(default_factory=dict)

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Register a function as a query under its own name."""

        def put(fn: Query) -> Query:
            self.queries[fn.__name__] = fn
            if sql is not None:
                self.oracles[fn.__name__] = sql
            return fn

        return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """``df`` with its fractional columns rounded, so that results compare across engines."""
    return df.select(*[F.round(F.col(f"`{n}`"), digits).alias(n) if k in ("double", "float") else F.col(f"`{n}`") for n, k in df.dtypes])


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")
