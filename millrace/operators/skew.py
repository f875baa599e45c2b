"""Keys that hold a large share of a table: found by a counter sketch, dealt over several tasks in joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import null_salt

#: A key is hot with this share of the rows that have one; so there are 256 hot keys at most.
HOT_SHARE = 1 / 256
#: Keys that the sketch of a task counts; a count is off by a 3000th of all rows at most.
TRACKED = 4096
#: Tasks over which the rows of a hot key are dealt.
PARTS = 32


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """The keys with ``share`` or more of the non-null rows, about.

    Every task keeps a bounded table of counters and the tables are merged (the frequent-items sketch of
    ``approx_top_k``), so the pass reads one column and shuffles next to nothing. A key near the share may be taken for
    hot or not; joins give the same rows either way.
    """
    c = F.col(f"`{key}`")
    most = min(TRACKED, round(1 / share))
    row = df.where(c.isNotNull()).agg(F.count("*").alias("n"), F.call_function("approx_top_k", c, F.lit(most), F.lit(TRACKED)).alias("top")).first()
    return [x["item"] for x in row["top"] or [] if x["count"] >= max(2, share * row["n"])]


def part_of_row(df: DataFrame, key: str, hot: list) -> Column:
    """The part of each row in a join on ``key``: 0, but for hot keys and rows without a key a number of the row's other values."""
    salt = null_salt(df, key)
    if not hot:
        return salt
    spread = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return F.when(F.col(f"`{key}`").isin(*hot), F.pmod(F.hash(*spread), F.lit(PARTS))).otherwise(salt)


def parts_of_key(key: Column, hot: list) -> Column:
    """The parts in which the other side's row of ``key`` is wanted, as an array: copies for hot keys only."""
    return F.when(key.isin(*hot), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0))) if hot else F.array(F.lit(0))
