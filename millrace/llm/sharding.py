"""Sharding by proportional stratified interleaving. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.scratch import fresh, materialize

#: Bytes that a document takes besides its text.
OVERHEAD = 16
#: Bits of ``monotonically_increasing_id`` that count within a partition.
_WITHIN = (1 << 33) - 1


def _in_order(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` in ranges of ``order``, each sorted, with the range and the place in it; written, so that both stand.

    Every range is sorted by itself, none is ever gathered; the places of all rows follow from the sizes of the ranges.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ranged.withColumns({"range": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN))}), "shard-order")


def _before(sizes: DataFrame) -> DataFrame:
    """``range, before, total``: rows in the ranges before each, and in all; one row a range is what meets here."""
    each, w = sizes.groupBy("range").agg(F.sum("n").alias("n")), W.orderBy("range")
    total = F.sum("n").over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return each.select("range", F.coalesce(F.sum("n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"), total.alias("total"))


def interleave(docs: DataFrame, shards: int, source_col: str = "source", seed: str = "interleave") -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (from 0 without gaps in each shard).

    Rows of a source are put in a seeded random order; the row of rank r of n has the fraction (r + 1/2) / n. All rows in
    the order of their fractions are cut into shards whose counts are at most one apart, so each shard holds every
    source in proportion, and within a shard any run of slots does too.

    Two range sorts and no group in one task: ranks come from the places in the ranges of (source, hash), so a source
    with most rows is spread over many ranges, and so are rows that repeat in all columns. The order depends on the rows and ``seed``
    alone; repeated rows (and rows that differ in maps only) may change places with each other. A null source is a
    source; an empty table gives an empty result. Names of the new columns get underscores where ``docs`` has them already.
    """
    shard, slot = fresh(docs, "shard"), fresh(docs, "slot")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col(f"`{source_col}`").cast("string").alias("source"), F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind]).alias("hash"))
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    own = _in_order(rows, F.col("source").asc_nulls_last(), F.col("hash"), F.col("tie"))

    parts = own.groupBy("range", "source").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    parts = materialize(parts.join(_before(parts).drop("total"), "range"), "shard-parts")
    sources = parts.groupBy("source").agg(F.sum("n").alias("rows"), F.min(F.col("before") + F.col("first")).alias("start"))
    of_source = parts.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    of_source = of_source.select(F.col("range").alias("r"), "s", "rows", (F.col("before") - F.col("start")).alias("shift"))
    ranked = own.join(of_source, (F.col("range") == F.col("r")) & F.col("source").eqNullSafe(F.col("s")))
    ranked = ranked.select("row", "source", "hash", "tie", ((F.col("at") + F.col("shift") + 0.5) / F.col("rows")).alias("fraction"))

    mixed = _in_order(ranked, F.col("fraction"), F.col("source").asc_nulls_last(), F.col("hash"), F.col("tie"))
    sizes = materialize(_before(mixed.groupBy("range").agg(F.count("*").alias("n"))), "shard-sizes")
    placed = mixed.join(sizes, "range").withColumn("place", F.col("before") + F.col("at"))
    placed = placed.withColumn(shard, F.call_function("div", F.col("place") * shards, F.col("total")))
    begun = F.call_function("div", F.col(shard) * F.col("total") + (shards - 1), F.lit(shards).cast("long"))
    return placed.select("row.*", F.col(shard).cast("int").alias(shard), (F.col("place") - begun).alias(slot))


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "interleave") -> DataFrame:
    """``id, size, text_crc32, law, shard, slot, grown_shard`` of every row of ``docs``; texts themselves are not moved.

    ``size`` is the text's UTF-8 bytes (null: none) plus 16; a null text has the checksum of an empty one. The law is
    ``rows``: counts of shards are at most one apart; ``grown_shard`` is null under it. Rows that are equal in id, text
    and source are dealt each by itself. Equal texts are not held together: one group may be larger than a shard.
    """
    raw = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"), (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    return interleave(rows, shards, "source", seed).select("id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, folder: str, shards: int, source_col: str = "source", seed: str = "interleave") -> DataFrame:
    """Write ``docs`` as Parquet, a folder ``shard=k`` each, rows in the order of their slots; return what was written.

    A shard is one task's sorted output; it holds a fixed share of the rows, so choose ``shards`` by the size a reader takes.
    """
    placed = interleave(docs, shards, source_col, seed)
    shard, slot = placed.columns[-2:]
    placed.repartition(shards, shard).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(folder)
    return docs.sparkSession.read.schema(placed.schema).parquet(folder).select(*placed.columns)
