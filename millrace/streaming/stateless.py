"""Operators for streams: column work without state, applied to a streaming DataFrame as to any other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.core.schemas import CleaningRule, TableSchema
from millrace.operators import align, clean, target


def prepare(stream: DataFrame, schema: TableSchema, rule: CleaningRule) -> DataFrame:
    """Alignment, text cleaning, nulls, types and bounds of rows as they arrive; whole-column verdicts are left out.

    Duplicates and orphans need other rows, so they stay with the batch operators.
    """
    out = align.align(stream, schema)
    out = clean.clean_strings(out, None, rule.lowercase)
    out = clean.handle_nulls(out, tuple(c for c in rule.drop_null if c in out.columns), {c: v for c, v in rule.fill_null.items() if c in out.columns})
    out = clean.convert(out, schema.columns)
    return clean.apply_bounds(out, rule.lower_bounds, rule.low_values)


def prepare_listings(stream: DataFrame, schema: TableSchema, rule: CleaningRule, pay: target.PayConfig | None = None) -> DataFrame:
    """``prepare`` and the pay target."""
    return target.with_target(prepare(stream, schema, rule), pay)


def write_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived to Parquet and stop; a restart goes on where the checkpoint ends."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
