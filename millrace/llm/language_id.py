"""Language ID by compression: the language whose zstandard raw-content dictionary shortens a text most."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.scratch import fresh, materialize

#: Bytes of raw content that a language's dictionary holds at most (the bound of the labelled sample).
DICTIONARY_BYTES = 256 << 10
#: Bytes that all dictionaries hold together at most; with many languages each gets less.
ALL_BYTES = 32 << 20
#: Code points of the pieces into which labelled texts are cut; pieces are picked, so that no text fills a dictionary.
PIECE_CHARS = 1000
#: Raw bytes picked for a byte of dictionary, as only letters go into it, and pieces picked for a full one at most.
PICKED, PIECES = 2, 16
#: Dictionaries of different lengths are compared cut to the same length, one of DICTIONARY_BYTES over powers of this.
STEP = 4
#: Texts are encoded in blocks of so many bytes, so that the dictionary stays in reach.
BLOCK_BYTES = 32 << 10
LEVEL = 6
#: Below this share of the second size, the lead of the best language is too narrow.
MIN_MARGIN = 0.01

UNKNOWN = "und"

_OTHER = regex.compile(r"[^\p{L}\p{M}]+")


def _normal(text: str) -> bytes:
    """The letters of a text with their marks in lower case, its other characters as single spaces."""
    return f" {_OTHER.sub(' ', text.lower()).strip()} ".encode()


def _pieces(text: str) -> Iterator[tuple[int, str]]:
    """The pieces of a whole text that hold a letter, with their hashes."""
    for k in range(0, len(text), PIECE_CHARS):
        piece = text[k : k + PIECE_CHARS]
        if any(map(str.isalpha, piece)):
            yield xxhash.xxh64_intdigest(piece.encode(), 17) >> 1, piece


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", where: Column | None = None, dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Raw-content dictionaries by language, from a bounded hash-picked sample of the labelled rows.

    Every language with a letter in some text is learned. Whole texts are cut into pieces; of each language's distinct
    pieces those with the smallest hashes go into its dictionary until it holds ``dictionary_bytes``, so a text that
    repeats counts once and a rare language keeps all it has. A language's dictionary does not depend on the others,
    unless there are more than ALL_BYTES / ``dictionary_bytes`` of them. Rows with a null language or text are left
    out; repeated rows change nothing; an empty table gives no dictionary. What reaches the driver is the sample.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = (rows if where is None else rows.where(where)).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(lang, h, len(piece.encode())) for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)) for h, piece in _pieces(text.as_py())]
            columns = zip(*found) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))], names=["lang", "h", "bytes"])

    pieces = materialize(rows.mapInArrow(hashes, "lang string, h long, bytes long").groupBy("lang", "h").agg(F.max("bytes").alias("bytes")), "pieces")
    languages = pieces.select("lang").distinct().count()
    if not languages:
        return {}
    dictionary_bytes = max(1, min(dictionary_bytes, ALL_BYTES // languages))
    # the smallest hashes of each language: Spark cuts each partition to so many rows before it deals them out
    most = max(1, PIECES * dictionary_bytes // PIECE_CHARS)
    smallest = pieces.withColumn("place", F.row_number().over(W.partitionBy("lang").orderBy("h"))).where(F.col("place") <= most)
    before = F.sum("bytes").over(W.partitionBy("lang").orderBy("h").rowsBetween(W.unboundedPreceding, 0)) - F.col("bytes")
    picked = smallest.withColumn("before", before).where(F.col("before") < PICKED * dictionary_bytes).select("lang", "h")
    wanted: dict[str, set[int]] = {}
    for r in picked.toLocalIterator():
        wanted.setdefault(r["lang"], set()).add(r["h"])
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = sent.value
        done: set[tuple[str, int]] = set()
        for batch in batches:
            found = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for h, piece in _pieces(text.as_py()):
                    if h in kept[lang] and (lang, h) not in done:
                        done.add((lang, h))
                        found.append((lang, h, piece))
            columns = zip(*found) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string()))], names=["lang", "h", "piece"])

    sample: dict[str, dict[int, str]] = {}
    for r in rows.mapInArrow(texts, "lang string, h long, piece string").groupBy("lang", "h").agg(F.min("piece").alias("piece")).toLocalIterator():
        sample.setdefault(r["lang"], {})[r["h"]] = r["piece"]
    return {lang: b"".join(_normal(found[h]) for h in sorted(found))[:dictionary_bytes] for lang, found in sorted(sample.items())}


class Classifier:
    """Sizes of a text under each dictionary, dictionaries of different lengths cut to the same one.

    Languages fall into steps by the length of their dictionaries. Those of the longest step are compared first; the
    best two then meet, cut to its length, those of each shorter step. There, a language takes over if it leads the best
    by a wider margin than the best leads the others, since a short dictionary says little and a chance lead is narrow.
    """

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL) -> None:
        self.dictionaries = dictionaries
        plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.params = zstandard.ZstdCompressionParameters.from_level(level, **plain)
        self.encoders: dict[tuple[str, int], Callable[[bytes], bytes]] = {}
        longest = max((len(d) for d in dictionaries.values()), default=1)
        steps: dict[int, list[str]] = {}
        for name in sorted(dictionaries):
            size = longest
            while size > max(1, len(dictionaries[name])):
                size = -(-size // STEP)
            steps.setdefault(size, []).append(name)
        self.steps = sorted(steps.items(), reverse=True)

    def _size(self, blocks: list[bytes], name: str, length: int) -> int:
        encode = self.encoders.get((name, length))
        if encode is None:
            content = zstandard.ZstdCompressionDict(self.dictionaries[name][:length], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=self.params)
            encode = self.encoders[name, length] = zstandard.ZstdCompressor(dict_data=content, compression_params=self.params).compress
        return sum(len(encode(b)) for b in blocks)

    def __call__(self, text: str | None) -> tuple[str, float]:
        """Best language and score, its lead as a share of the second size; no letter: unknown and 0.

        Of a single learned language the score is 1. Where a shorter dictionary disputes the lead, the score is the
        difference of the two leads.
        """
        if not self.steps or text is None or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        data = _normal(text)
        blocks = [data[k : k + BLOCK_BYTES] for k in range(0, len(data), BLOCK_BYTES)]
        best, second, score = "", "", -1.0
        for length, names in self.steps:
            sizes = {name: self._size(blocks, name, length) for name in [*filter(None, (best, second)), *names]}
            order = sorted(sizes, key=lambda k: (sizes[k], k))
            if score < 0:
                best, second = order[0], order[1] if len(order) > 1 else ""
                score = (sizes[second] - sizes[best]) / sizes[second] if second else -1.0
                continue
            challenger = min(names, key=lambda k: (sizes[k], k))
            lead = (sizes[best] - sizes[challenger]) / sizes[best]
            if lead > score:
                best, second, score = challenger, best, lead - score
            elif lead > 0:
                score -= lead
        return best, 1.0 if score < 0 else score


def predict(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` with ``lang_pred, score, rejected`` (names lengthened on a clash).

    ``lang_pred`` is a learned language, or ``und`` for a text that is null or has no letter (or when nothing was
    learned). ``score`` is the lead over the second-best size as a share of it (0 to 1; 1 if one language was learned).
    ``rejected`` holds for ``und`` and for leads under ``min_margin``. Whole texts are encoded, in blocks. Ties go to
    the smaller name (and are rejected). Repeated rows get equal answers; an empty table gives an empty result.
    """
    names = [fresh(docs, n) for n in ("lang_pred", "score", "rejected")]
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)

    @F.pandas_udf("lang string, score double")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Classifier(sent.value)
        for texts in batches:
            yield pd.DataFrame([model(t) for t in texts], columns=["lang", "score"])

    both = fresh(docs, "__language")
    out = docs.withColumn(both, classify(F.col(text_col)))
    verdict = (F.col(f"{both}.lang") == UNKNOWN) | (F.col(f"{both}.score") < min_margin)
    return out.withColumns({names[0]: F.col(f"{both}.lang"), names[1]: F.col(f"{both}.score"), names[2]: verdict}).drop(both)


def known(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of ``docs`` that ``predict`` does not reject, with their columns as they came."""
    named = predict(docs, dictionaries, text_col, min_margin)
    return named.where(~F.col(named.columns[-1])).select(*docs.columns)
