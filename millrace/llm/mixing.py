"""Mixing sources to target weights: whole copies for certain, the rest by Pareto order sampling. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.scratch import fresh, materialize
from millrace.llm.text import unit_hash, word_count

#: Weights of the sources in the order of their names (null last), repeated.
WEIGHTS = (1, 2, 3)
#: Times its size that a source, and so a document, is taken at most.
MOST = 3
#: Copies wanted grow with a document's length from a quarter to the whole of the source's level; half of the way up at so many words.
HALF_WORDS = 100


def _measured(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    size = word_count(F.col(text_col))
    key = F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    return {"id": F.col(id_col), "source": F.col(source_col).cast("string"), "size": size, "key": key}


def _favour(size: Column) -> Column:
    """A whole number up to 1000 to which a document's wanted copies are proportional."""
    return F.floor(250 + 750 * size / (size + HALF_WORDS)).cast("long")


def _stratum(size: Column) -> Column:
    """Documents of about one length: the four leading bits of the size, so strata are exact below 16 and 1/8 wide above."""
    low = F.greatest(F.lit(0), F.length(F.bin(size)) - 4)
    return F.call_function("shiftleft", F.call_function("shiftright", size, low), low)


def _numbered(names: DataFrame, order: Column) -> DataFrame:
    """``names`` with ``place``, from 0 in the order given: ranges are numbered side by side, and only their sizes meet."""
    ranged = materialize(names.repartitionByRange(order).withColumn("__range", F.spark_partition_id()), "mix-ranges")
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("__range", before.alias("__before"))
    own = F.row_number().over(W.partitionBy("__range").orderBy(order))
    return ranged.withColumn("__own", own).join(sizes, "__range").withColumn("place", F.col("__before") + F.col("__own") - 1).drop("__range", "__own", "__before")


def target_sizes(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, weight, target`` from rows of ``source, size``.

    Sources share the sum of all sizes by weight; a target stops at ``most`` times its source's size and what is over
    is shared again by weight among the others, until none is above. Every round is one sum over the table of sources.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    table = F.array(*[F.lit(w) for w in weights])
    rows = _numbered(by_source, F.col("source").asc_nulls_last()).withColumn("weight", F.element_at(table, (F.col("place") % len(weights) + 1).cast("int"))).drop("place")
    rows = materialize(rows, "mix-sources")
    cap = (most * F.col("source_size")).cast("double")
    total, level, stopped = rows.agg(F.sum("source_size")).first()[0] or 0, 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) >= cap if level else F.lit(False)
        n, held, free = rows.agg(F.count_if(over), F.sum(F.when(over, F.col("source_size"))), F.sum(F.when(~over, F.col("weight")))).first()
        if n == stopped or not free:
            break
        stopped, level = n, (total - most * (held or 0)) / free
    return rows.select("source", "source_size", "weight", (F.least(cap, F.col("weight") * F.lit(level)) if level else F.lit(0.0)).alias("target"))


def _plan(sizes: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """``source, stratum, rows, favours, copies, more``: of each stratum, whole copies of all and the size of its sample.

    Every document of a source has the whole copies that the target holds for certain. The words that are left go to the
    strata from the longest documents down, in the array of each source (some hundred strata): each gets them in
    proportion to its favour, rounded to whole documents, one copy more at most (or up to ``most`` in all where the
    shorter ones could not take the rest). What rounding leaves is shared by the shorter ones, so that a source ends
    within about its shortest documents of the target.
    """
    strata = sizes.where("size > 0").groupBy("source", _stratum(F.col("size")).alias("stratum"))
    strata = strata.agg(F.count("*").alias("rows"), F.sum("size").alias("words"), F.sum(_favour(F.col("size"))).alias("favours"))
    lists = strata.groupBy("source").agg(F.reverse(F.array_sort(F.collect_list(F.struct("stratum", "rows", "words", "favours")))).alias("strata"))
    lists = lists.join(targets.select(F.col("source").alias("__s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    lists = lists.withColumn("whole", F.least(F.lit(most), F.floor(F.col("target") / F.col("source_size") + 1e-12)).cast("bigint"))
    pull = lambda x: x.words * (x.favours / x.rows)
    start = F.struct(
        (F.col("target") - F.col("whole") * F.col("source_size")).alias("left"), F.aggregate("strata", F.lit(0.0), lambda a, x: a + pull(x)).alias("pull"),
        F.col("source_size").cast("double").alias("words"), F.array().cast("array<bigint>").alias("taken"),
    )

    def settle(a: Column, x: Column) -> Column:
        each = F.when(a.pull > 0.5, F.greatest(F.lit(0.0), a.left) / a.pull * (x.favours / x.rows)).otherwise(F.lit(0.0))
        cap = F.when(a.left > a.words, F.lit(most) - F.col("whole")).otherwise(F.least(F.lit(1), F.lit(most) - F.col("whole")))
        taken = F.least(F.floor(F.least(cap.cast("double"), each) * x.rows + 0.5), cap * x.rows).cast("bigint")
        return F.struct((a.left - taken * (x.words / x.rows)).alias("left"), (a.pull - pull(x)).alias("pull"), (a.words - x.words).alias("words"), F.concat(a.taken, F.array(taken)).alias("taken"))

    settled = lists.select("source", "whole", F.explode(F.arrays_zip("strata", F.aggregate("strata", start, settle, lambda a: a.taken).alias("taken"))).alias("x"))
    rows = settled.select("source", "whole", "x.strata.stratum", "x.strata.rows", "x.strata.favours", F.col("x.taken").alias("taken"))
    return rows.select("source", "stratum", "rows", "favours", (F.col("whole") + F.floor(F.col("taken") / F.col("rows"))).cast("int").alias("copies"), (F.col("taken") % F.col("rows")).alias("more"))


def _ranked(sizes: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """``sizes`` with its stratum's plan, the inclusion probability of one copy more, and the Pareto rank in (0, 1).

    The probabilities of a stratum sum to its sample's size ``more``. Up to half of the rows they are proportional to
    its documents' favours; of more than half, the chances of being left out fall with the favour by the same shares,
    so that none reaches 1 (favours in a stratum, which is 1/8 wide in length, differ by far less than a factor of 2).
    The rank is x / (1 + x), where x is the random odds over the inclusion odds, times the odds of the stratum's mean
    probability: that keeps the order of a stratum and spreads its ranks evenly.
    """
    other = plan.withColumnsRenamed({"source": "__source", "stratum": "__stratum"})
    rows = sizes.join(other, F.col("source").eqNullSafe(F.col("__source")) & (_stratum(F.col("size")) == F.col("__stratum")), "left")
    mean = F.col("more") / F.col("rows")
    p = mean + F.least(mean, 1 - mean) * (_favour(F.col("size")) * F.col("rows") / F.col("favours") - 1)
    u = unit_hash(F.col("key"), seed=seed)
    x = (u / (1 - u)) / (p / (1 - p)) * (mean / (1 - mean))
    return rows.withColumn("inclusion", F.when(F.col("more") > 0, p).otherwise(F.lit(0.0))).withColumn("rank", F.when(F.col("more") > 0, x / (1 + x)))


def _cut(sizes: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """``plan`` with the rank and key of the last document that each stratum's sample takes (null: it takes none).

    A stratum of n documents is counted in about sqrt(n) parts of the rank; only the part in which the sample ends is
    put in order, so the most that meets in one task grows with the root of the stratum.
    """
    drawn = _ranked(sizes.where("size > 0"), plan, seed).where("more > 0")
    parts = F.ceil(F.sqrt("rows"))
    drawn = drawn.withColumn("part", F.least(F.floor(F.col("rank") * parts), parts - 1))
    stratum = ["__source", "__stratum"]
    counts = drawn.groupBy(*stratum, "part").agg(F.count("*").alias("n"), F.first("more").alias("more"))
    upto = F.sum("n").over(W.partitionBy(*stratum).orderBy("part"))
    ends = counts.withColumn("upto", upto).where("upto >= more and upto - n < more").select(F.col("__source").alias("s"), F.col("__stratum").alias("t"), F.col("part").alias("end"), (F.col("more") - F.col("upto") + F.col("n")).alias("place"))
    ends = materialize(ends, "mix-ends")
    edge = drawn.join(ends, F.col("__source").eqNullSafe(F.col("s")) & (F.col("__stratum") == F.col("t")) & (F.col("part") == F.col("end")))
    edge = edge.withColumn("at", F.row_number().over(W.partitionBy(*stratum).orderBy("rank", "key"))).where(F.col("at") == F.col("place"))
    last = edge.select(F.col("s").alias("__s"), F.col("t").alias("__t"), F.col("rank").alias("last_rank"), F.col("key").alias("last_key"))
    return plan.join(last, F.col("source").eqNullSafe(F.col("__s")) & (F.col("stratum") == F.col("__t")), "left").drop("__s", "__t")


def _taken(sizes: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """``sizes`` with ``copies`` and ``inclusion`` of each row."""
    rows = _ranked(sizes, plan, seed)
    more = (F.col("rank") < F.col("last_rank")) | (F.col("rank") == F.col("last_rank")) & (F.col("key") <= F.col("last_key"))
    return rows.withColumn("copies", (F.coalesce("copies", F.lit(0)) + F.coalesce(more, F.lit(False)).cast("int")).cast("int"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = "pareto") -> DataFrame:
    """Return ``id, source, size, source_size, target, copies, inclusion, taken`` for each row of ``docs``.

    Documents of a source and of about one length are a stratum. Each has whole copies for certain, and a sample of
    fixed size by Pareto order gets one copy more: ``inclusion`` is a document's probability of that. ``taken`` is
    copies times size, and a document is never taken more than ``most`` times. The choice depends on id, text and
    ``seed`` alone, so reruns agree and a lost executor's rows come out the same. Null and empty texts have size 0 and
    take nothing; a null source is a source; rows that repeat id and text are taken alike (so they may overshoot); an
    empty table gives an empty result.
    """
    sizes = materialize(docs.select(*[c.alias(n) for n, c in _measured(docs, id_col, text_col, source_col).items()]), "mix-sizes")
    targets, plan = _planned(sizes, weights, most, seed)
    rows = _taken(sizes, plan, seed)
    rows = rows.join(targets.select(F.col("source").alias("__t"), "source_size", "target"), F.col("source").eqNullSafe(F.col("__t")))
    return rows.select("id", "source", "size", "source_size", "target", "copies", "inclusion", (F.col("copies") * F.col("size")).alias("taken"))


def _planned(sizes: DataFrame, weights: tuple[int, ...], most: int, seed: str) -> tuple[DataFrame, DataFrame]:
    targets = materialize(target_sizes(sizes, weights, most), "mix-targets")
    plan = materialize(_plan(sizes, targets, most), "mix-plan")
    return targets, materialize(_cut(sizes, plan, seed), "mix-cut")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = "pareto") -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with the columns as they came; treats odd rows as ``mix`` does."""
    measured = _measured(docs, id_col, text_col, source_col)
    sizes = materialize(docs.select(*[c.alias(n) for n, c in measured.items()]), "mix-sizes")
    _, plan = _planned(sizes, weights, most, seed)
    row = fresh(docs, "__row")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), *[c.alias(n) for n, c in measured.items()])
    taken = _taken(rows, plan, seed).where("copies > 0")
    return taken.select(row, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select(f"{row}.*")
