"""Text normalisation and record views as column expressions. Non-ASCII strings are folded
by an Arrow UDF (case, combining marks); it is given nulls for all others."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import java

# Fixed values, needed for equal results: tokens, aliases, and words that carry no identity.
TOKEN = "[a-z0-9]+"
NUMERIC = "^[0-9]{1,6}$"
BLOCK_ALIASES = {
    "corp": "corporation", "co": "company", "pvt": "private", "ltd": "limited", "st": "street", "rd": "road",
    "ave": "avenue", "blvd": "boulevard", "ctr": "center",
}
PAIR_ALIASES = BLOCK_ALIASES | {"dr": "drive", "ln": "lane", "ste": "suite", "apt": "apartment", "hwy": "highway", "fl": "floor"}
LEGAL = ["inc", "incorporated", "llc", "corporation", "company", "private", "limited", "plc", "llp"]
ADDRESS_GENERIC = ["street", "road", "avenue", "boulevard", "near", "opposite", "floor", "unit", "building", "block"]


def _strip_marks(s: str) -> str:
    folded = s.casefold().replace("&", " and ")
    return "".join(c for c in unicodedata.normalize("NFKD", folded) if not unicodedata.combining(c))


@F.pandas_udf(T.StringType())
def _fold_udf(s: pd.Series) -> pd.Series:
    return s.map(_strip_marks, na_action="ignore")


@F.pandas_udf(T.StringType())
def _casefold_udf(s: pd.Series) -> pd.Series:
    return s.map(str.casefold, na_action="ignore")


def _non_ascii(c: Column) -> Column:
    return F.when(c.rlike("[^\\x00-\\x7F]"), c)


def strip(c: Column) -> Column:
    """Blank-stripped text, '' for null; strips every kind of white space."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"^[\s\x1c-\x1f\u0085\p{Z}]+|[\s\x1c-\x1f\u0085\p{Z}]+$", "")


def folded(c: Column) -> Column:
    """Case-folded, ``&`` spelled out, compatibility-decomposed, without combining marks."""
    c = F.coalesce(c, F.lit(""))
    return F.coalesce(_fold_udf(_non_ascii(c)), F.lower(F.replace(c, F.lit("&"), F.lit(" and "))))


def raw_tokens(c: Column) -> Column:
    return F.regexp_extract_all(folded(c), F.lit(TOKEN), F.lit(0))


def tokens(c: Column, aliases: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return F.transform(raw_tokens(c), lambda t: F.coalesce(F.try_element_at(table, t), t))


def country(c: Column) -> Column:
    s = strip(c)
    return F.coalesce(_casefold_udf(_non_ascii(s)), F.lower(s))


def is_number(t: Column) -> Column:
    return t.rlike(NUMERIC)


def first_number(ts: Column) -> Column:
    return F.get(F.filter(ts, is_number), F.lit(0))


def selected(ts: Column, ignored: list[str], most: int) -> Column:
    """Up to ``most`` distinct identifying tokens: three characters or more, neither ignored nor a
    short number; longest first, then alphabetical."""
    good = F.filter(F.array_distinct(ts), lambda t: (F.length(t) >= 3) & ~t.isin(ignored) & ~is_number(t))
    ranked = F.sort_array(F.transform(good, lambda t: F.struct((-F.length(t)).alias("k"), t.alias("v"))))
    return F.slice(F.transform(ranked, lambda s: s["v"]), 1, most)


@cache
def _folds() -> str:
    """What ``folded`` makes of each character, as far as tokens go, for Texts.java; what is not there separates."""
    every = [c for c in range(128, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    into = re.sub("[^a-z0-9\n]", " ", _strip_marks("\n".join(map(chr, every)))).split("\n")
    return "\n".join(["38  and ", *(f"{c} {s}" for c, s in zip(every, into, strict=True) if s != " " and (s.strip() or not s))])


def _text(what: int, kind: str, c: Column, aliases: dict[str, str], words: list[str], most: int = 0) -> Column:
    table = " ".join(x for kv in aliases.items() for x in kv)
    return java.call("Texts", T._parse_datatype_string(kind), (what, _folds(), table, " ".join(words), most), c)


def halves(c: Column) -> Column:
    """(name, address): the first half of a text's ``raw_tokens``, and the second, joined by blanks."""
    return _text(0, "name string, address string", c, {}, [])


def viewed(c: Column, ignored: list[str], most: int) -> Column:
    """(best, num): ``selected`` and ``first_number`` of a text's tokens with the aliases of blocking."""
    return _text(1, "best array<string>, num string", c, BLOCK_ALIASES, ignored, most)


def profiled(c: Column) -> Column:
    """(clean, legal, house, nums): of a text's tokens with the aliases of pairs these joined by blanks, the last legal form,
    ``first_number`` and all short numbers without repeats."""
    return _text(2, "clean string, legal string, house string, nums array<string>", c, PAIR_ALIASES, LEGAL)


def record_view(df, id_col="entity_id", keep=()):
    """Entities to their blocking view: id, nt (up to 4 name tokens), at (up to 3 address tokens),
    num (first short number of the address), ctry."""
    t = df.select(id_col, *keep, viewed(F.col("business_name"), LEGAL, 4).alias("_n"), viewed(F.col("business_address"), ADDRESS_GENERIC, 3).alias("_a"), country(F.col("country")).alias("ctry"))
    return t.select(id_col, *keep, F.col("_n.best").alias("nt"), F.col("_a.best").alias("at"), F.col("_a.num").alias("num"), "ctry")


def profile(df, id_col="entity_id", keep=()):
    """Entities to what pair features need."""
    t = df.select(
        id_col, *keep, F.coalesce("business_name", F.lit("")).alias("name_raw"), F.coalesce("business_address", F.lit("")).alias("addr_raw"),
        profiled(F.col("business_name")).alias("_n"), profiled(F.col("business_address")).alias("_a"), country(F.col("country")).alias("ctry"),
    )
    words = lambda c: F.array_distinct(F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.split(c, " ")))
    return t.select(
        id_col, *keep, "name_raw", "addr_raw", "ctry", F.col("_n.clean").alias("name_clean"), F.col("_a.clean").alias("addr_clean"),
        words("_n.clean").alias("name_s"), words("_a.clean").alias("addr_s"),
        F.col("_n.legal").alias("legal"), F.col("_a.house").alias("house"), F.col("_a.nums").alias("nums"),
    )


def raw_house_number(address: Column) -> Column:
    """The other reading of a house number: the first white-space word that is 1-6 digits once
    ``,.-#/\\`` are stripped from its ends."""
    words = F.transform(F.split(F.coalesce(address, F.lit("")), r"\s+"), lambda w: F.regexp_replace(w, r"^[ ,.\-#/\\]+|[ ,.\-#/\\]+$", ""))
    return first_number(words)
