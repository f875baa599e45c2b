"""Scratch tables of the operators, and names that no column has."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.core.scratch import materialize, new_path

__all__ = ["fresh", "materialize", "new_path"]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
