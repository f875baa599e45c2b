"""Features for regression, fitted on the training rows: TF-IDF, multi-hot, categories, numbers."""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, OneHotEncoder, SQLTransformer, StringIndexer, TargetEncoder, TargetEncoderModel, VectorAssembler
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from millrace.core.scratch import materialize
from millrace.functions.columns import without_accents
from millrace.operators import ordered
from millrace.operators.target_stats import PRIOR_ROWS, ordered_statistics, permutation


@dataclass(frozen=True)
class TfidfConfig:
    min_df: int = 5
    max_df: float = 0.95
    bigrams: bool = True
    sublinear: bool = True


def text_words(c: Column) -> Column:
    """Lower-case words of two word characters or more, without accents; null has none."""
    return F.regexp_extract_all(without_accents(F.lower(F.coalesce(c, F.lit("")))), F.lit(r"[\p{L}\p{N}_]{2,}"), 0)


def with_pairs(words: Column) -> Column:
    """The words and their neighbouring pairs. ``words`` is read six times, so it should be a column that has been made."""
    # neighbours by zipping two slices: a lambda that looks into ``words`` would make the words anew for each of them
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.concat(words, F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat_ws(" ", a, b)))


def text_tokens(c: Column, bigrams: bool = True) -> Column:
    """``text_words`` and, with ``bigrams``, their neighbouring pairs."""
    words = text_words(c)
    return with_pairs(words) if bigrams else words


def list_tokens(c: Column, delimiter: str = "|") -> Column:
    """Distinct trimmed lower-case items of a joined list."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "\\" + delimiter), lambda x: F.lower(F.trim(x))), lambda x: x != ""))


#: Bytes up to which a vocabulary passes through the driver to every executor; entries that a counting task holds before it hands them on.
VOCABULARY_BYTES, HELD_TERMS = 4 << 20, 1 << 18
#: Bytes of text that are weighed together, with the vocabulary of these texts alone; weights that are sent on together.
CHUNK_BYTES, WEIGHT_ROWS = 4 << 20, 1 << 16
_WORD = re.compile(r"\w{2,}")


def _plain(c: Column) -> Column:
    """A text as its words are cut from it: lower case, no accents, null as empty."""
    return without_accents(F.lower(F.coalesce(c, F.lit(""))))


def row_terms(text: str, bigrams: bool) -> list[str]:
    """``text_tokens`` of a text that ``_plain`` has prepared, for tasks that count inside a row."""
    words = _WORD.findall(text)
    return [*words, *(f"{a} {b}" for a, b in itertools.pairwise(words))] if bigrams else words


def document_frequencies(df: DataFrame, text: str, bigrams: bool = True) -> DataFrame:
    """``term, df``: rows of ``df`` whose text holds each term. Tasks add up their rows, so a frequent term is one row a task."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for x in batch.column(0).to_pylist():
                held.update(set(row_terms(x, bigrams)))
                if len(held) > HELD_TERMS:
                    yield pa.RecordBatch.from_pydict({"term": list(held), "df": list(held.values())})
                    held.clear()
        if held:
            yield pa.RecordBatch.from_pydict({"term": list(held), "df": list(held.values())})

    return df.select(_plain(F.col(f"`{text}`")).alias("x")).mapInArrow(count, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))


@dataclass(frozen=True)
class TfidfModel:
    """``vocabulary``: term, df, idf."""

    vocabulary: DataFrame
    cfg: TfidfConfig

    def weights(self, df: DataFrame, row_id: str, text: str, vocabulary_bytes: int = VOCABULARY_BYTES) -> DataFrame:
        """``row_id, term, weight`` of each row: sublinear counts times idf, of length 1. Terms outside the vocabulary drop out.

        Terms are counted inside their row. A vocabulary that is measured to have at most ``vocabulary_bytes`` goes to all
        executors, and a row is finished where it is read; of a larger one each chunk of rows gets its own terms (``_weigh``).
        """
        cfg = self.cfg
        size = self.vocabulary.agg(F.sum(F.octet_length("term") + 100)).first()[0] or 0
        if size <= vocabulary_bytes:
            rows, kind = df.select(F.col(f"`{row_id}`"), _plain(F.col(f"`{text}`")).alias("__text")), df.schema[row_id].dataType.simpleString()
            idf = df.sparkSession.sparkContext.broadcast({r["term"]: r["idf"] for r in self.vocabulary.select("term", "idf").collect()})
            return rows.mapInArrow(lambda batches: (out for b in batches for out in _weights(b.column(0), b.column(1), row_id, cfg, idf.value)), f"`{row_id}` {kind}, term string, weight double")
        rows = _chunks(df, row_id, text, _text_bytes(df, text)[1])
        return _weigh(rows, _chunk_terms(rows, cfg).join(self.vocabulary, "term"), row_id, cfg)


def _text_bytes(df: DataFrame, text: str) -> tuple[int, int]:
    """Rows and bytes of text."""
    total, size = df.agg(F.count("*"), F.sum(F.octet_length(F.col(f"`{text}`")))).first()
    return total, size or 0


def _chunks(df: DataFrame, row_id: str, text: str, size: int) -> DataFrame:
    """The rows with ``__text`` and ``__chunk``, which deals them by their hash into chunks of about CHUNK_BYTES."""
    chunk = F.pmod(F.xxhash64(F.col(f"`{row_id}`"), F.col(f"`{text}`")), F.lit(1 + size // CHUNK_BYTES))
    return df.select(F.col(f"`{row_id}`"), _plain(F.col(f"`{text}`")).alias("__text"), chunk.alias("__chunk"))


def _chunk_terms(rows: DataFrame, cfg: TfidfConfig) -> DataFrame:
    """``__chunk, term, n``: rows of each chunk that hold each of its terms."""

    def count(chunk: pa.Table) -> pa.Table:
        held: Counter = Counter()
        for x in chunk["__text"]:
            held.update(set(row_terms(x.as_py(), cfg.bigrams)))
        return pa.table({"__chunk": pa.repeat(chunk["__chunk"][0], len(held)), "term": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})

    return rows.groupBy("__chunk").applyInArrow(count, "__chunk long, term string, n long")


def _weigh(rows: DataFrame, known: DataFrame, row_id: str, cfg: TfidfConfig) -> DataFrame:
    """``row_id, term, weight`` of ``rows`` with ``known``, the idf of each chunk's terms.

    A chunk meets its own part of the vocabulary only: neither the driver nor a task holds all of it, no count of a row
    is shuffled, and a frequent term is one row a chunk.
    """

    def weigh(chunk: pa.Table, terms: pa.Table) -> pa.Table:
        idf = dict(zip(terms["term"].to_pylist(), terms["idf"].to_pylist()))
        schema = pa.schema([(row_id, chunk.schema.field(row_id).type), ("term", pa.string()), ("weight", pa.float64())])
        return pa.Table.from_batches([out for b in chunk.to_batches() for out in _weights(b.column(row_id), b.column("__text"), row_id, cfg, idf)], schema)

    kind = rows.schema[row_id].dataType.simpleString()
    known = known.select("__chunk", "term", "idf")
    return rows.groupBy("__chunk").cogroup(known.groupBy("__chunk")).applyInArrow(weigh, f"`{row_id}` {kind}, term string, weight double")


def _weights(row_ids: pa.Array, texts: pa.Array, row_id: str, cfg: TfidfConfig, idf: dict[str, float]) -> Iterator[pa.RecordBatch]:
    """Weights of rows, of length 1, by the terms of ``idf``."""
    ids, terms, weights = [], [], []
    for place, x in enumerate(texts):
        counts = Counter(row_terms(x.as_py(), cfg.bigrams))
        row = [(t, (1 + math.log(n) if cfg.sublinear else float(n)) * idf[t]) for t, n in counts.items() if t in idf]
        norm = math.sqrt(sum(w * w for _, w in row))
        ids += [place] * len(row)
        terms += [t for t, _ in row]
        weights += [w / norm for _, w in row]
        if len(ids) > WEIGHT_ROWS or place == len(texts) - 1:
            yield pa.RecordBatch.from_arrays([row_ids.take(pa.array(ids, pa.int64())), pa.array(terms, pa.string()), pa.array(weights, pa.float64())], [row_id, "term", "weight"])
            ids, terms, weights = [], [], []


def _kept(counts: DataFrame, cfg: TfidfConfig, total: int) -> DataFrame:
    """``counts`` (term, df and more) of the terms that the limits leave, with their smoothed ``idf``."""
    return counts.where((F.col("df") >= cfg.min_df) & (F.col("df") <= cfg.max_df * total)).withColumn("idf", F.log((1.0 + total) / (1 + F.col("df"))) + 1)


def fit_weights(df: DataFrame, row_id: str, text: str, cfg: TfidfConfig | None = None) -> DataFrame:
    """``fit_tfidf(df, text).weights(df, row_id, text)`` for a vocabulary of any size, which is not written or sent anywhere whole.

    The terms of each chunk are counted once; added up over the chunks they are the vocabulary, which goes back to the
    chunks that its terms came from.
    """
    cfg = cfg or TfidfConfig()
    total, size = _text_bytes(df, text)
    rows = _chunks(df, row_id, text, size)
    terms = _chunk_terms(rows, cfg).withColumn("df", F.sum("n").over(W.partitionBy("term")))
    return _weigh(rows, _kept(terms, cfg, total), row_id, cfg)


def fit_tfidf(df: DataFrame, text: str, cfg: TfidfConfig | None = None) -> TfidfModel:
    """Document frequencies, cut to at least ``min_df`` rows and at most ``max_df`` of them; smoothed idf. Written once."""
    cfg = cfg or TfidfConfig()
    total = df.count()
    return TfidfModel(materialize(_kept(document_frequencies(df, text, cfg.bigrams), cfg, total).select("term", "df", "idf"), "vocabulary"), cfg)


def vocabulary_sizes(df: DataFrame, text: str, limits: tuple[int, ...] = (1, 2, 5, 10, 20), bigrams: bool = True) -> DataFrame:
    """``min_df, terms``: size of the vocabulary for each limit."""
    each = F.array(*[F.struct(F.lit(x).alias("min_df"), F.count_if(F.col("df") >= x).alias("terms")) for x in limits])
    return document_frequencies(df, text, bigrams).agg(each.alias("r")).select(F.inline("r"))


def mean_weights(weights: DataFrame, rows: int, top: int) -> DataFrame:
    """``term, mean_weight`` of the ``top`` terms over all rows."""
    return weights.groupBy("term").agg((F.sum("weight") / F.lit(float(rows))).alias("mean_weight")).orderBy(F.desc("mean_weight"), "term").limit(top)


def shape(weights: DataFrame, width: int, rows: int) -> DataFrame:
    """``width, filled, sparsity`` of the matrix that ``weights`` are the filled cells of."""
    cells = F.lit(float(max(1, width * rows)))
    return weights.agg(F.lit(width).cast("long").alias("width"), F.count("*").alias("filled"), (1 - F.count("*") / cells).alias("sparsity"))


def multi_hot(df: DataFrame, row_id: str, items: Column) -> DataFrame:
    """``row_id, item, position``: each row's distinct items with their place in the sorted vocabulary."""
    rows = df.select(row_id, F.explode(items).alias("item")).distinct()
    vocabulary = ordered.positions(rows.select("item").where("item is not null").distinct(), "item")
    return rows.join(vocabulary, "item").select(row_id, "item", "position")


@dataclass(frozen=True)
class FeatureSet:
    """Columns of an experiment."""

    name: str
    model: str = "ridge"
    categories: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    text: str | None = None
    items: str | None = None
    item_encoding: str = "none"  # none, tfidf or multi_hot
    min_df: int = 5


def cells(df: DataFrame, row_id: list[str], vector: str = "features") -> DataFrame:
    """``row_id, position, value``: the filled cells of a vector column, dense or sparse, as a long table."""
    v = F.unwrap_udt(F.col(f"`{vector}`"))
    places = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1))
    pairs = df.select(*row_id, F.explode(F.arrays_zip(places.alias("position"), v["values"].alias("value"))).alias("x"))
    return pairs.select(*row_id, "x.position", "x.value").where("value <> 0")


def _column_sql(name: str, expr: str) -> SQLTransformer:
    return SQLTransformer(statement=f"SELECT *, {expr} AS {name} FROM __THIS__")


def missing_columns(df: DataFrame, s: FeatureSet) -> list[str]:
    return [c for c in (*s.categories, *s.numbers, *([s.text] if s.text else []), *([s.items] if s.items else [])) if c not in df.columns]


def feature_pipeline(train: DataFrame, s: FeatureSet, label: str | None = None) -> PipelineModel:
    """Branches of a feature set, fitted on ``train``, ending in ``features``.

    Nulls of a category are a category of their own, unseen ones are zeros. Numbers get the training median and are
    scaled by the population deviation. Text and lists as TF-IDF get the weights of ``fit_tfidf``; no vocabulary is cut.
    With ``label`` a category is its mean target instead, drawn to the mean of all rows as ``target_stats`` does; an
    unseen one is that mean. All stages are distributed; the driver holds a vocabulary and a few numbers. Every stage can be saved by Spark.
    """
    if absent := missing_columns(train, s):
        raise ValueError(f"{s.name}: columns are missing: {', '.join(absent)}")
    stages, parts = [], []
    for c in s.categories:
        stages.append(_column_sql(f"c_{c}", f"coalesce(cast(`{c}` as string), '__MISSING__')"))
    if s.categories and label is not None:
        names = [f"c_{c}" for c in s.categories]
        stages.append(StringIndexer(inputCols=names, outputCols=[f"i_{n}" for n in names], handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(TargetEncoder(inputCols=[f"i_{n}" for n in names], outputCols=[f"t_{n}" for n in names], labelCol=label, targetType="continuous", smoothing=PRIOR_ROWS, handleInvalid="keep"))
        parts += [f"t_{n}" for n in names]
    elif s.categories:
        names = [f"c_{c}" for c in s.categories]
        stages.append(StringIndexer(inputCols=names, outputCols=[f"i_{n}" for n in names], handleInvalid="keep", stringOrderType="alphabetAsc"))
        # the indexer's last place is that of unseen values; dropping it leaves them zeros
        stages.append(OneHotEncoder(inputCols=[f"i_{n}" for n in names], outputCols=[f"o_{n}" for n in names], dropLast=True, handleInvalid="error"))
        parts += [f"o_{n}" for n in names]
    if s.numbers:
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("v")) for c in s.numbers])
        found = {r["column"]: r["q0"] for r in ordered.group_quantiles(train.select(F.explode(cells).alias("x")).select("x.*"), ["column"], "v", [0.5]).collect()}
        medians = {c: found.get(c) for c in s.numbers}
        filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c] if medians[c] is not None else 0.0)) for c in s.numbers}
        row = train.agg(*[x for c in s.numbers for x in (F.avg(filled[c]), F.stddev_pop(filled[c]))]).first()
        for k, c in enumerate(s.numbers):
            mean, std = row[2 * k] or 0.0, row[2 * k + 1] or 1.0
            fill = medians[c] if medians[c] is not None else 0.0
            stages.append(_column_sql(f"n_{c}", f"(coalesce(cast(`{c}` as double), cast({fill!r} as double)) - cast({mean!r} as double)) / cast({std!r} as double)"))
        stages.append(VectorAssembler(inputCols=[f"n_{c}" for c in s.numbers], outputCol="numbers"))
        parts.append("numbers")
    if s.text:
        stages += [terms := Terms(s.text, "t_terms"), Tfidf("t_terms", "text_vector", s.min_df, made_by=terms)]
        parts.append("text_vector")
    if s.items and s.item_encoding != "none":
        stages.append(_column_sql("s_items", f"array_distinct(filter(transform(split(coalesce(`{s.items}`, ''), '[|]'), x -> lower(trim(x))), x -> x <> ''))"))
        if s.item_encoding == "multi_hot":
            stages.append(MultiHot("s_items", "item_vector"))
        else:
            stages.append(Tfidf("s_items", "item_vector", s.min_df))
        parts.append("item_vector")
    if not parts:
        stages.append(_column_sql("one", "1.0D"))
        parts = ["one"]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages).fit(train)


def training_rows(train: DataFrame, s: FeatureSet, made: PipelineModel, label: str, seed: int = 42) -> DataFrame:
    """``features, label`` of the rows that ``made`` was fitted on with its label: each category by the rows before a row only.

    The pipeline itself gives a row the mean of its whole category, which the row's own target is a part of; a model that
    learns from that trusts rare categories too much.
    """
    *stages, assembler = made.stages
    rows = PipelineModel([t for t in stages if not isinstance(t, TargetEncoderModel)]).transform(train)
    keys = [f.name for f in train.schema.fields if "map<" not in f.dataType.simpleString()]
    used = [c for c in assembler.getInputCols() if c in rows.columns]
    # the columns that nothing but the order is made of stay behind
    rows = rows.select(*[f"c_{c}" for c in s.categories], *used, F.col(f"`{label}`").cast("double").alias(label), F.unhex(permutation(keys, seed)).alias("__place"))
    rows = ordered_statistics(rows, {f"t_c_{c}": f"c_{c}" for c in s.categories}, label, [], place="__place")
    return assembler.transform(rows.select(*assembler.getInputCols(), label)).select("features", label)


def term_counts(df: DataFrame, terms: str, min_df: int = 1, max_df: float = 1.0, made_by: Terms | None = None) -> tuple[list[tuple[str, int]], int]:
    """The terms of a list column within the limits with their rows, most frequent first, and all rows.

    Equal lists, or equal texts that ``made_by`` makes them of, are counted first, so that a title which many rows share
    is taken apart once; no row is kept for a second pass.
    """
    total, source = df.count(), made_by.getInputCol() if made_by else terms
    lists = df.groupBy(F.col(f"`{source}`").alias(source)).agg(F.count("*").alias("n"))
    lists = made_by.transform(lists) if made_by else lists
    counts = lists.select(F.explode(F.array_distinct(f"`{terms}`")).alias("term"), "n").groupBy("term").agg(F.sum("n").alias("df"))
    found = counts.where((F.col("df") >= min_df) & (F.col("df") <= max_df * total)).collect()
    if not found:
        raise ValueError(f"no term of {terms} is within the limits")
    return sorted(((r["term"], r["df"]) for r in found), key=lambda x: (-x[1], x[0])), total


class MultiHot(Estimator):
    """A list as ones in the places of its items; no item is cut."""

    def __init__(self, items: str, out: str) -> None:
        super().__init__()
        self.items, self.out = items, out

    def _fit(self, df: DataFrame) -> CountVectorizerModel:
        return CountVectorizerModel.from_vocabulary([t for t, _ in term_counts(df, self.items)[0]], inputCol=self.items, outputCol=self.out).setBinary(True)


class Terms(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """``text_tokens`` of a column as a stage."""

    def __init__(self, text: str | None = None, out: str | None = None) -> None:
        super().__init__()
        if text is not None:
            self._set(inputCol=text, outputCol=out)

    def _transform(self, df: DataFrame) -> DataFrame:
        words = f"{self.getOutputCol()}_words"
        return df.withColumn(words, text_words(F.col(f"`{self.getInputCol()}`"))).withColumn(self.getOutputCol(), with_pairs(F.col(f"`{words}`"))).drop(words)


class LogCounts(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Sublinear counts as a stage: 1 + ln(count) of the filled cells.

    No Spark function maps over the cells of a vector, so its parts are taken out, mapped, and read back as a vector
    through JSON, all in the JVM; a row without repeated terms stays as it is.
    """

    def __init__(self, counts: str | None = None, out: str | None = None) -> None:
        super().__init__()
        if counts is not None:
            self._set(inputCol=counts, outputCol=out)

    def _transform(self, df: DataFrame) -> DataFrame:
        v = F.unwrap_udt(F.col(f"`{self.getInputCol()}`"))
        logs = F.transform(v["values"], lambda x: F.when(x > 0, 1 + F.log(x)).otherwise(F.lit(0.0)))
        parts = F.struct(v["type"].alias("type"), v["size"].alias("size"), v["indices"].alias("indices"), logs.alias("values"))
        made = F.from_json(F.to_json(F.struct(parts.alias("v"))), StructType([StructField("v", VectorUDT())]))["v"]
        return df.withColumn(self.getOutputCol(), F.when(F.exists(v["values"], lambda x: x > 1), made).otherwise(F.col(f"`{self.getInputCol()}`")))


class Tfidf(Estimator):
    """The weights of ``fit_tfidf`` as a vector: 1 + ln(count), times ln((rows + 1) / (df + 1)) + 1, of length 1."""

    def __init__(self, terms: str, out: str, min_df: int = 5, max_df: float = 0.95, made_by: Terms | None = None) -> None:
        super().__init__()
        self.terms, self.out, self.min_df, self.max_df, self.made_by = terms, out, min_df, max_df, made_by

    def _fit(self, df: DataFrame) -> PipelineModel:
        tf, log_tf, raw = (f"{self.out}_{k}" for k in ("tf", "log_tf", "raw"))
        found, total = term_counts(df, self.terms, self.min_df, self.max_df, self.made_by)
        counts = CountVectorizerModel.from_vocabulary([t for t, _ in found], inputCol=self.terms, outputCol=tf)
        weights = ElementwiseProduct(scalingVec=Vectors.dense([math.log((total + 1) / (n + 1)) + 1 for _, n in found]), inputCol=log_tf, outputCol=raw)
        return PipelineModel([counts, LogCounts(tf, log_tf), weights, Normalizer(inputCol=raw, outputCol=self.out, p=2.0)])
