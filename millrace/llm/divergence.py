"""Source divergence audit: how far the term use of each source lies from the other sources of its language and from the language."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.scratch import materialize

#: A lang keeps the terms that so many of its documents hold.
LEAST_DOCS = 10
#: Ranks of the part ``term``.
MOST_TERMS = 10
#: Parts per so many: the unit of p.
UNIT = 1_000_000_000
#: Kept terms of a lang in one slice (on average) and groups in one tile: what one pair task holds of both sides.
SLICE_TERMS, TILE_GROUPS = 1 << 14, 16
#: Distinct (group, term) entries after which a counting task hands on what it has.
HELD_TERMS = 1 << 18
#: Bytes of a text that are cut into terms at once.
PIECE_BYTES = 1 << 20
#: Terms whose places a galloping search settles together.
GALLOP = 256

#: What separates terms becomes a space, A-Z becomes a-z; bytes of characters beyond ASCII stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])
_PAIRS = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("low_a", pa.int64()), ("low_b", pa.int64()), ("kept", pa.int64()), ("value", pa.int64()), ("covered", pa.int64())])


def term_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, in lists from pieces of bounded size that end between terms."""
    flat, at = text.translate(_FOLD), 0
    while at < len(flat):
        end = flat.find(b" ", at + PIECE_BYTES)
        end = len(flat) if end < 0 else end
        yield flat[at:end].split()
        at = end


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by group, added up over the task; a row without a term for each group."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def handed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            terms = [None, *n]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.binary()), pa.array([0, *n.values()], pa.int64()), pa.array([0, *(docs[t] for t in n)], pa.int64())], schema=_COUNTS)
        groups.clear()

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            seen: set[bytes] = set()
            for terms in term_pieces(text.as_py()):
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
        if sum(len(n) for n, _ in groups.values()) > HELD_TERMS:
            yield from handed()
    yield from handed()


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (n + 2) / (total + 2 * kept)) as a long, in exact decimals; null where nothing is kept."""
    part = F.lit(UNIT).cast("decimal(10,0)") * (n.cast("decimal(20,0)") + 2)
    whole = F.nullif(total.cast("decimal(20,0)") + 2 * kept.cast("decimal(20,0)"), F.lit(0))
    return 1 + F.call_function("div", part, whole)


def _priced(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def price(p: np.ndarray, q: np.ndarray | int) -> int:
    """Sum of floor((p - q)**2 / (p + q)); shares stay under 2**30, so that squares fit a long."""
    return int(((p - q) ** 2 // (p + q)).sum())


def gallop(few: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For each of the sorted ``few`` the first place in the sorted ``many`` that is not below it.

    The search walks both arrays once: from the place of the last block of ``few`` it doubles its steps until it has
    passed the next block, and settles that block between the two ends.
    """
    places, low = np.empty(len(few), np.int64), 0
    for k in range(0, len(few), GALLOP):
        block, step = few[k : k + GALLOP], GALLOP
        while low + step < len(many) and many[low + step] < block[-1]:
            step *= 2
        places[k : k + GALLOP] = low + np.searchsorted(many[low : low + step + 1], block)
        low = int(places[min(k + GALLOP, len(few)) - 1])
    return places


def merge(ids_a: np.ndarray, p: np.ndarray, low_a: int, ids_b: np.ndarray, q: np.ndarray, low_b: int) -> tuple[int, int]:
    """Price of the terms that one or both groups hold, and how many these are; ``low_a``, ``low_b``: shares of absent terms."""
    if len(ids_a) > len(ids_b):
        return merge(ids_b, q, low_b, ids_a, p, low_a)
    at = gallop(ids_a, ids_b)
    both = np.zeros(len(ids_a), bool)
    inside = at < len(ids_b)
    both[inside] = ids_b[at[inside]] == ids_a[inside]
    alone = np.ones(len(ids_b), bool)
    alone[at[both]] = False
    value = price(p[both], q[at[both]]) + price(p[~both], low_b) + price(q[alone], low_a)
    return value, len(ids_a) + int(alone.sum())


def _pair_task(left: pa.Table, right: pa.Table) -> pa.Table:
    """All unordered pairs of a tile of groups with another (or itself) on one slice of terms."""

    def rows(table: pa.Table) -> list[tuple]:
        table = table.combine_chunks()
        ids, shares = table["ids"], table["shares"]
        return [(place, source, low, ids[k].values.to_numpy(), shares[k].values.to_numpy()) for k, (place, source, low) in enumerate(zip(*(table[c].to_pylist() for c in ("place", "source", "low"))))]

    out: list[tuple] = []
    if left.num_rows and right.num_rows:
        lang, kept = left["lang"][0].as_py(), left["kept"][0].as_py()
        others = rows(right)
        for place, a, low_a, ids_a, p in rows(left):
            for other, b, low_b, ids_b, q in others:
                if place < other:
                    out.append((lang, a, b, low_a, low_b, kept, *merge(ids_a, p, low_a, ids_b, q, low_b)))
    columns = zip(*out) if out else [[] for _ in _PAIRS]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PAIRS)], schema=_PAIRS)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, source, term, n, lang_n, first`` for the kept terms of each group, and one row without a term for each group.

    Terms are runs of letters a-z and of characters beyond ASCII, A-Z folded; nulls are read as ''. A term is kept where
    ``least_docs`` rows of the lang hold it; ``first`` marks one row of each kept (lang, term). Counts are added up in
    the reading tasks, then dealt once by (lang, term), so a frequent term or a large group arrives as one row a task.
    """
    name = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(name(lang_col).alias("lang"), name(source_col).alias("source"), name(text_col).cast("binary").alias("text"))
    parts = rows.mapInArrow(_count, "lang string, source string, term binary, n long, docs long")
    counts = parts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    w = W.partitionBy("lang", "term")
    counts = counts.withColumns({"lang_docs": F.sum("docs").over(w), "lang_n": F.sum("n").over(w), "first": F.min("source").over(w) == F.col("source")})
    return counts.where(F.col("term").isNull() | (F.col("lang_docs") >= least_docs)).select("lang", "source", F.col("term").cast("string").alias("term"), "n", "lang_n", "first")


def _groups(counts: DataFrame) -> DataFrame:
    """One row a group: totals of the group and its lang, kept terms, place among the lang's sources, slices and tiles."""
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if(F.col("first") & F.col("term").isNotNull()).alias("firsts"))
    w = W.partitionBy("lang")
    own = own.withColumns({"kept": F.sum("firsts").over(w), "lang_total": F.sum("total").over(w), "place": F.row_number().over(w.orderBy("source")) - 1, "sources": F.count("*").over(w)})
    slices = F.greatest(F.lit(1), F.ceil(F.col("kept") / SLICE_TERMS)).cast("int")
    tiles = F.ceil(F.col("sources") / TILE_GROUPS).cast("int")
    low = F.coalesce(_share(F.lit(0), F.col("total"), F.col("kept")), F.lit(1))
    return own.select("lang", "source", "total", "kept", "lang_total", "place", slices.alias("slices"), tiles.alias("tiles"), low.alias("low"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, most_terms: int = MOST_TERMS) -> DataFrame:
    """Return ``lang, source, part, item, value, rank`` of every group (lang, source) of ``docs``.

    With p = 1 + floor(10**9 * (count + 2) / (N + 2 * V)) of a kept term in a group (N: its occurrences of all V kept
    terms of the lang), part ``pair`` has for each other source of the lang the sum of floor((p - q)**2 / (p + q)) over
    all kept terms, 0 if there are none; part ``term`` has the ``most_terms`` terms that lie farthest above the lang's
    own share. Ranks fall by value, ties by item in UTF-8 order; all arithmetic is on whole numbers.

    Each group's counts are sorted arrays of (term id, share) in slices of the vocabulary. A task takes a tile of 16 groups
    and another on one slice and merges every pair of them once: overlaps by galloping, one-sided terms against the
    other group's share of absent terms; terms that both lack are priced when the slices are added up. Prices are the
    same both ways, and each pair is returned for both of its groups.

    Nulls count as ''; empty texts have no terms, their groups are returned all the same; repeated rows count each
    time; an empty table gives an empty result.
    """
    counts = materialize(term_counts(docs, text_col, lang_col, source_col, least_docs), "divergence-counts")
    groups = materialize(_groups(counts), "divergence-groups")
    rows = counts.where("term is not null").drop("first").join(groups, ["lang", "source"])
    rows = rows.withColumns({"share": _share(F.col("n"), F.col("total"), F.col("kept")), "lang_share": _share(F.col("lang_n"), F.col("lang_total"), F.col("kept")), "slice": F.pmod(F.xxhash64("term"), F.col("slices")).cast("int")})
    rows = rows.select("lang", "slice", "source", "place", "tiles", "low", "kept", "term", "share", "lang_share")
    bare = groups.select("lang", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "source", "place", "tiles", "low", "kept")
    rows = rows.unionByName(bare, allowMissingColumns=True)
    numbered = rows.repartition("lang", "slice").withColumn("id", F.dense_rank().over(W.partitionBy("lang", "slice").orderBy("term")))
    entry = F.when(F.col("term").isNotNull(), F.struct("id", "share"))
    arrays = numbered.groupBy("lang", "slice", "source", "place", "tiles", "low", "kept").agg(F.array_sort(F.collect_list(entry)).alias("x"))
    arrays = arrays.select("lang", "slice", "source", "place", "tiles", "low", "kept", F.col("x.id").alias("ids"), F.col("x.share").alias("shares"))
    arrays = materialize(arrays, "divergence-arrays").withColumn("tile", F.floor(F.col("place") / TILE_GROUPS).cast("int"))

    task = ["lang", "slice", "tile_a", "tile_b"]
    left = arrays.withColumnRenamed("tile", "tile_a").withColumn("tile_b", F.explode(F.sequence("tile_a", F.col("tiles") - 1)))
    right = arrays.withColumnRenamed("tile", "tile_b").withColumn("tile_a", F.explode(F.sequence(F.lit(0), "tile_b")))
    pairs = left.groupBy(*task).cogroup(right.groupBy(*task)).applyInArrow(_pair_task, "lang string, a string, b string, low_a long, low_b long, kept long, value long, covered long")
    pairs = pairs.groupBy("lang", "a", "b", "low_a", "low_b", "kept").agg(F.sum("value").alias("value"), F.sum("covered").alias("covered"))
    value = F.col("value") + (F.col("kept") - F.col("covered")) * _priced(F.col("low_a"), F.col("low_b"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = pairs.select("lang", value.alias("value"), ways.alias("w")).select("lang", "w.source", F.lit("pair").alias("part"), "w.item", "value")

    terms = rows.where("share > lang_share").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _priced(F.col("share"), F.col("lang_share")).alias("value"))
    order = W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(terms).where(F.col("rank") <= most_terms))
