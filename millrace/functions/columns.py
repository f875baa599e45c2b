"""Column functions: text, lists, booleans, dates, pay."""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that are true.
TRUTHY = ("1", "1.0", "true", "t", "yes", "y")
#: Months and hours by pay period, as multiples of a year's pay.
PERIODS = {"yearly": 1, "annual": 1, "monthly": 12, "biweekly": 26, "weekly": 52, "hourly": 2080}


def upper_snake(c: Column) -> Column:
    """'Full time' as 'FULL_TIME': runs of anything but letters and digits are one underscore, none at the ends."""
    return F.regexp_replace(F.upper(F.regexp_replace(F.trim(c), r"[^A-Za-z0-9]+", "_")), r"^_+|_+$", "")


def category(c: Column) -> Column:
    """Trimmed and in lower case; texts for missing values null."""
    out = F.lower(F.trim(c))
    return F.when(~out.isin("", "nan", "none", "null"), out)


def boolean(c: Column) -> Column:
    """Null stays; a value of TRUTHY in any letter case is true and everything else false."""
    return F.when(c.isNotNull(), F.lower(F.trim(c.cast("string"))).isin(*TRUTHY))


def epoch_ms(c: Column) -> Column:
    """Timestamp of epoch milliseconds, or of a text with a date; what cannot be read is null."""
    return F.coalesce(F.timestamp_millis(c.try_cast("double").try_cast("bigint")), F.try_to_timestamp(c.cast("string")))


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode NFKC, which Spark SQL has no function for; a batch at a time."""
    return texts.str.normalize("NFKC")


@F.pandas_udf(T.StringType())
def without_marks(texts: pd.Series) -> pd.Series:
    """Letters without their combining marks."""
    return texts.str.normalize("NFKD").str.replace(r"[̀-ͯ᪰-᫿᷀-᷿⃐-⃿︠-︯]", "", regex=True)


@functools.cache
def accents() -> tuple[str, str]:
    """Letters of European scripts that carry marks, and the letters below them, place by place."""
    parts = {chr(k): unicodedata.normalize("NFD", chr(k)) for k in range(0xC0, 0x2000)}
    found = {c: d[0] for c, d in parts.items() if d != c and d[0].isalpha() and all(0x300 <= ord(x) <= 0x36F for x in d[1:])}
    return "".join(found), "".join(found.values())


def without_accents(c: Column) -> Column:
    """``c`` without the accents of European letters, whole or as marks of their own; no Python worker is needed."""
    return F.regexp_replace(F.translate(c, *accents()), "[̀-ͯ]", "")


def null_salt(df: DataFrame, key: str, parts: int = 1024) -> Column:
    """0 where ``key`` is known, else a number of the row's other values below ``parts``.

    As a second key of a left join (0 on the right) it deals the rows without a key over all tasks.
    """
    others = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return F.when(F.col(f"`{key}`").isNotNull(), F.lit(0)).otherwise(F.pmod(F.hash(*others), F.lit(parts)))


def clean_text(c: Column) -> Column:
    """NFKC, white space collapsed and trimmed, empty null."""
    out = F.trim(F.regexp_replace(nfkc(c), r"(?U)\s+", " "))
    return F.when(out != "", out)


def list_items(c: Column) -> Column:
    """Items of a text list: a bracketed list with quotes, or parts between pipes, commas, semicolons or slashes."""
    bare = F.regexp_replace(F.regexp_replace(c, r"^\s*\[|\]\s*$", ""), r"['\"]", "")
    return F.filter(F.transform(F.split(bare, r"[|,;/]"), lambda x: F.trim(x)), lambda x: x != "")


def standard_list(items: Column) -> Column:
    """Items in UPPER_SNAKE, distinct, in order."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(items, upper_snake), lambda x: x != "")))


def list_length(items: Column) -> Column:
    """Length of a list, 0 for null."""
    return F.coalesce(F.size(items), F.lit(0))


def group_id(*cols: Column) -> Column:
    """SHA-256 of the trimmed, collapsed, lower-case values joined by two bars; a null counts as 'unknown'."""
    parts = [F.coalesce(F.regexp_replace(F.lower(F.trim(c)), r"\s+", " "), F.lit("unknown")) for c in cols]
    return F.sha2(F.concat_ws("||", *parts), 256)


def safe_log1p(c: Column) -> Column:
    """log(1 + x); negative values and what is no number are null."""
    x = c.try_cast("double")
    return F.when(x >= 0, F.log1p(x))


def pay_multiplier(period: Column) -> Column:
    """Times that a pay period goes into a year; null for unknown periods."""
    table = F.create_map(*[F.lit(x) for kv in PERIODS.items() for x in kv])
    return F.try_element_at(table, F.lower(F.trim(period)))


def tokens(c: Column, stop_words: tuple[str, ...] = ()) -> Column:
    """Lower-case words of two letters or more."""
    out = F.regexp_extract_all(F.lower(c), F.lit(r"([a-z]{2,})"), 1)
    return F.filter(out, lambda w: ~w.isin(*stop_words)) if stop_words else out


def bigrams(words: Column) -> Column:
    """Neighbouring pairs joined by a space."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat_ws(" ", a, b))


def mentions(c: Column, terms: list[str]) -> Column:
    """The terms that a text names, each once, in the order of their first place; longer terms win over their parts."""
    ordered = sorted({t.lower() for t in terms}, key=lambda t: (-len(t), t))
    pattern = "(?<![a-z0-9])(" + "|".join(_quote(t) for t in ordered) + ")(?![a-z0-9])"
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(pattern), 1))


def _quote(term: str) -> str:
    return "".join("\\" + ch if ch in r"\.^$|?*+()[]{}-&#~" else ch for ch in term)
