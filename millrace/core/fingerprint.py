"""Fingerprints of schemas (driver side, no data) and of contents (one aggregate)."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def schema_fingerprint(df: DataFrame, ordered: bool = False) -> str:
    """SHA-256 of column names and types, sorted by name unless ``ordered``."""
    fields = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return hashlib.sha256("\n".join(f"{n} {t}" for n, t in (fields if ordered else sorted(fields))).encode()).hexdigest()


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])


def content_fingerprint(df: DataFrame) -> DataFrame:
    """``rows, hash_sum, hash_xor``: equal for equal bags of rows in any order or partitioning."""
    h = _row_hash(df)
    return df.agg(F.count("*").alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("hash_sum"), F.bit_xor(h).alias("hash_xor"))


def unchanged(df: DataFrame, stored: DataFrame) -> bool:
    """Whether ``df`` has the fingerprint in ``stored`` (what ``content_fingerprint`` returned when it was written)."""
    return content_fingerprint(df).first() == stored.select("rows", "hash_sum", "hash_xor").first()
