"""Quality rules with thresholds from mergeable quantile sketches per language and source. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.scratch import materialize
from millrace.llm.text import words

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A measure, the measure at its least once chance is allowed for, and whether low values are the bad ones."""

    name: str
    measure: str
    least: str
    low: bool = False


def _rate(name: str, count: str, of: str) -> Rule:
    """1000 times the root of a rate; at its least, the root of the count is four standard deviations lower (each a half)."""
    return Rule(name, f"1000 * sqrt({count}) / sqrt({of})", f"1000 * greatest(sqrt({count}) - 2, 0.0e0) / sqrt({of})")


_LENGTH = "1000 * word_chars / n_words"
#: A document fails where a measure, at its least, lies beyond the bound of its language and source; see ``bound_of``.
#: Sketches hold the measures as they are, so what is usual in a group (some repeated lines, say) raises its bound.
RULES = (
    _rate("symbols", "n_symbols", "n_words"),
    _rate("dup_lines", "n_dup_lines", "n_lines"),
    _rate("repeats", "n_repeat_words", "n_words"),
    Rule("long_words", _LENGTH, _LENGTH),
    Rule("short_words", _LENGTH, _LENGTH, low=True),
)
#: Documents of its language that are merged, by weight, into the sketch of a group, and of all into that of a language.
PRIOR_ROWS = 200
#: Quantiles of a sketch, per mille: the middle, and where the tail begins (from the other side for ``low``).
MIDDLE, TAIL = 500, 900
#: Times the distance from the middle to the tail's beginning that a bound lies beyond that. Of measures with an exponential
#: tail one document in 6,000 is beyond it, of normal ones none; a group may have up to a tenth of bad documents.
SPREAD = 4


def _windows(tokens: Column) -> Column:
    """A 64-bit hash of each window of three words."""
    return F.transform(F.slice(tokens, 1, F.greatest(F.size(tokens) - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(tokens, i + 1), F.get(tokens, i + 2)))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines`` of each whole text.

    Texts whose windows all differ (most) end after one hash set; in others the windows are sorted by hash, and the
    words that the repeated ones cover are counted in order.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.translate(text, " \t\n\x0b\x0c\r", "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), text.alias("text"), words(F.col(text_col)).alias("tokens"), lines.alias("lines"), F.length(bare).cast("long").alias("word_chars"))
    rows = rows.withColumn("grams", _windows(F.col("tokens")))
    rows = rows.withColumn("twice", F.size("grams") > F.size(F.array_distinct("grams")))
    # (hash, place) sorted: a window repeats if a neighbour has its hash
    at = F.array_sort(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    places = F.filter(F.transform(F.col("at"), lambda x, k: F.when((x.g == F.get("at", k - 1).g) | (x.g == F.get("at", k + 1).g), x.i)), lambda i: i.isNotNull())
    rows = rows.withColumn("at", F.when(F.col("twice"), at)).withColumn("places", F.array_sort(F.when(F.col("twice"), places)))
    covered = F.aggregate("places", F.struct(F.lit(0).alias("n"), F.lit(-9).alias("end")), lambda a, i: F.struct((a.n + F.least(F.lit(3), i + 3 - a.end)).alias("n"), (i + 3).alias("end")), lambda a: a.n)
    return rows.select(
        "doc_id", "lang", "source", F.size("tokens").cast("long").alias("n_words"), "word_chars",
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("twice"), covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )


def _cell(value: Column) -> Column:
    """The cell of the sketch that holds ``value``: its six leading bits, so cells are exact below 64 and 3 % wide above."""
    low = F.greatest(F.lit(0), F.length(F.bin(value)) - 6)
    return F.call_function("shiftleft", F.call_function("shiftright", value, low), low)


def sketches(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``lang, source, rule, cell, n``: counts of each measure by cell.

    Two sketches merge by adding the counts of a cell, in any order, so partial sketches are combined before they are
    dealt out and a source with a third of all rows is a few hundred rows per task.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), _cell(F.floor(F.expr(r.measure))).alias("cell")) for r in rules]))
    return measured.select("lang", "source", cells.alias("at")).groupBy("lang", "source", "at.rule", "at.cell").agg(F.count("*").alias("n"))


def _quantiles(weights: Column) -> tuple[Column, Column]:
    """The sum of ``weights`` (cell and weight, in the order of the cells), and the cells at its quantiles as a struct.

    The latter reads the sum from a column ``__total``.
    """
    kind = "decimal(38,0)"
    zero = F.lit(0).cast(kind)
    total = F.aggregate(weights, zero, lambda s, x: (s + x.w).cast(kind))
    names = {"low_tail": 1000 - TAIL, "middle": MIDDLE, "tail": TAIL}
    start = F.struct(zero.alias("upto"), *[F.lit(None).cast("long").alias(n) for n in names])

    def step(at: Column, x: Column) -> Column:
        upto = (at.upto + x.w).cast(kind)
        found = [F.coalesce(at[n], F.when(1000 * upto >= q * at_total, x.cell)).alias(n) for n, q in names.items()]
        return F.struct(upto.alias("upto"), *found)

    at_total = F.col("__total")
    return total, F.aggregate(weights, start, step)


def bound_of(q: Column, low: bool) -> Column:
    """The bound from quantiles: beyond the tail's beginning by SPREAD times its distance from the middle."""
    if low:
        return q.low_tail - SPREAD * (q.middle - q.low_tail)
    return q.tail + SPREAD * (q.tail - q.middle)


def thresholds(sketch: DataFrame, rules: tuple[Rule, ...] = RULES, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """``lang, source`` and a bound a rule, from the group's sketch merged by weight with those above it.

    A group's sketch is merged with its language's, which counts as ``prior_rows`` documents whatever its size, and
    that with the sketch of all in the same way: small groups lean on what is above them, large ones stand alone, and
    nothing switches. Weights are whole numbers (counts times the other sketches' sizes), so merging is exact.
    """
    kind = "decimal(38,0)"
    cells = F.collect_list(F.struct("cell", "n"))
    group = sketch.groupBy("lang", "source", "rule").agg(cells.alias("g"))
    lang = sketch.groupBy("lang", "rule", "cell").agg(F.sum("n").alias("n"))
    every = lang.groupBy("rule", "cell").agg(F.sum("n").alias("n")).groupBy("rule").agg(cells.alias("a"), F.sum("n").cast(kind).alias("a_rows"))
    lang = lang.groupBy(F.col("lang").alias("__lang"), "rule").agg(cells.alias("l"), F.sum("n").cast(kind).alias("l_rows"))
    # a sketch has at most some hundreds of cells a rule, and there is one sketch of all
    joined = group.join(lang, (group.rule == lang.rule) & F.col("lang").eqNullSafe(F.col("__lang"))).drop(lang.rule).join(F.broadcast(every), "rule")
    k = F.lit(prior_rows).cast(kind)

    def weighted(name: str, weight: Column) -> Column:
        return F.transform(name, lambda x: F.struct(x.cell.alias("cell"), (x.n.cast(kind) * weight).cast(kind).alias("w")))

    parts = [weighted("g", (F.col("a_rows") * (F.col("l_rows") + k)).cast(kind)), weighted("l", (k * F.col("a_rows")).cast(kind)), weighted("a", (k * k).cast(kind))]
    merged = joined.select("lang", "source", "rule", F.array_sort(F.concat(*parts)).alias("__w"))
    total, quantiles = _quantiles(F.col("__w"))
    merged = merged.withColumn("__total", total).select("lang", "source", "rule", quantiles.alias("q"))
    bounds = [F.max(F.when(F.col("rule") == r.name, bound_of(F.col("q"), r.low))).alias(r.name) for r in rules]
    return merged.groupBy("lang", "source").agg(*bounds)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", rules: tuple[Rule, ...] = RULES, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """Return the measures of each row of ``docs`` with ``base_failed, kept``.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated windows. Sketches are made of the
    rows that pass that. ``kept``: passes it and no measure, at its least, lies beyond its group's threshold. Null text has no words;
    null languages and sources are groups; repeated rows get equal answers; an empty table gives an empty result.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = materialize(measures(docs, id_col, text_col, lang_col, source_col).withColumn("base_failed", failed), "measures")
    sound = measured.where("not base_failed")
    sketch = materialize(sketches(sound, rules), "sketches")
    limits = materialize(thresholds(sketch, rules, prior_rows), "thresholds")
    limits = limits.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), *[F.col(r.name).alias(f"__{r.name}") for r in rules])
    joined = measured.join(limits, F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left")
    fine = F.lit(True)
    for r in rules:
        cell = _cell(F.expr(f"case when n_words > 0 and n_lines > 0 then floor({r.least}) end"))
        fine = fine & (cell >= F.col(f"__{r.name}") if r.low else cell <= F.col(f"__{r.name}"))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.coalesce(fine, F.lit(False))).alias("kept"))
