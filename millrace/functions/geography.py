"""States and countries as column expressions: a state is named only where exactly one can be meant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import without_marks

# Abbreviations of the states, spellings seen, and texts that name no place.
STATES = {
    "al": "alabama", "ak": "alaska", "az": "arizona", "ar": "arkansas", "ca": "california", "co": "colorado", "ct": "connecticut", "de": "delaware", "fl": "florida",
    "ga": "georgia", "hi": "hawaii", "id": "idaho", "il": "illinois", "in": "indiana", "ia": "iowa", "ks": "kansas", "ky": "kentucky", "la": "louisiana", "me": "maine",
    "md": "maryland", "ma": "massachusetts", "mi": "michigan", "mn": "minnesota", "ms": "mississippi", "mo": "missouri", "mt": "montana", "ne": "nebraska", "nv": "nevada",
    "nh": "new hampshire", "nj": "new jersey", "nm": "new mexico", "ny": "new york", "nc": "north carolina", "nd": "north dakota", "oh": "ohio", "ok": "oklahoma", "or": "oregon",
    "pa": "pennsylvania", "ri": "rhode island", "sc": "south carolina", "sd": "south dakota", "tn": "tennessee", "tx": "texas", "ut": "utah", "vt": "vermont", "va": "virginia",
    "wa": "washington", "wv": "west virginia", "wi": "wisconsin", "wy": "wyoming", "dc": "district of columbia", "pr": "puerto rico",
}
SPELLINGS = {"louisianna": "louisiana", "massachussetts": "massachusetts", "californie": "california", "califorina": "california"}
NO_STATE = ("0", "", "n/a", "na", "none", "null", "state", "stateprovincewide", "global", "globally", "worldwide", "remote", "anywhere", "office address", "unknown", "tbd", "usa", "us", "online", "select a state")
NO_COUNTRY = ("0", "oo", "", "n/a", "na", "none", "null", "unknown")


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def country(c: Column) -> Column:
    """Lower-case country, null for texts that name none."""
    out = F.lower(F.trim(c))
    return F.when(~out.isin(*NO_COUNTRY), out)


def bare_place(c: Column) -> Column:
    """A place in lower case without marks, dots and punctuation."""
    bare = F.regexp_replace(without_marks(F.lower(F.trim(c))), r"\.", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"[\[\](),/-]", " "), r"\s+", " "))


def us_state(bare: Column, in_country: Column) -> Column:
    """Full lower-case name of the one state that a bare place means; null outside the US, for zip codes and if unclear."""
    spelled = F.try_element_at(_lookup(SPELLINGS), bare)
    words = F.transform(F.split(bare, " "), lambda w: F.coalesce(F.try_element_at(_lookup(SPELLINGS), w), w))
    short = F.filter(F.transform(words, lambda w: F.try_element_at(_lookup(STATES), w)), lambda s: s.isNotNull())
    names = F.array(*[F.lit(n) for n in STATES.values()])
    named = F.filter(names, lambda n: F.contains(bare, n))
    hits = F.array_distinct(F.concat(short, named))
    # 'west virginia' holds 'virginia': a text that is a name is that state
    exact = F.when(F.array_contains(names, bare), bare)
    usable = ~bare.isin(*NO_STATE) & ~F.regexp_replace(bare, " ", "").rlike(r"^\d{3,}$")
    one = F.coalesce(exact, F.when(F.size(hits) == 1, F.get(hits, F.lit(0))))
    return F.when(F.lower(F.trim(in_country)) == "us", F.coalesce(spelled, F.when(usable, one)))


def with_us_state(df: DataFrame, state: str, in_country: str, out: str) -> DataFrame:
    """``df`` with the state's name; the bare place is a column of its own, as lambdas cannot hold the batch function."""
    rows = df.withColumn("__bare", bare_place(F.col(state)))
    return rows.withColumn(out, us_state(F.col("__bare"), F.col(in_country))).drop("__bare")
