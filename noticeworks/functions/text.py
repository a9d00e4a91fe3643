"""Text functions: stripping, folding, keywords, tokens."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: What Python's str.strip() takes for white space: Unicode's and U+001C to U+001F.
BLANK = r"[\s\x1c-\x1f]"


def strip(x: Column) -> Column:
    """Without white space of any alphabet at both ends; Spark's trim() knows the space only."""
    return F.regexp_replace(x, rf"(?U)^{BLANK}+|{BLANK}+$", "")


def blank_to_null(x: Column) -> Column:
    return F.nullif(strip(x), F.lit(""))


def first_text(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values))


@F.pandas_udf(StringType())
def fold(values: pd.Series) -> pd.Series:
    """Lower case without combining marks (NFKD). Spark has no such function built in."""

    def one(x: str | None) -> str | None:
        if x is None:
            return None
        return x.lower() if x.isascii() else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)).lower()

    return values.map(one)


def fold_word(x: str) -> str:
    """``fold`` for configuration on the driver."""
    return "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)).lower()


def has_word(text: Column, keyword: str) -> Column:
    """Whether folded text has a keyword as a whole word, by Unicode's letters and digits."""
    return text.rlike(rf"(?U)(?<!\w){re.escape(fold_word(keyword))}(?!\w)")


def tokens(folded: Column, longer_than: int = 2) -> Column:
    """Runs of letters and digits of more than so many characters, in order."""
    return F.filter(F.regexp_extract_all(folded, F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)), lambda t: F.length(t) > longer_than)


def block_key(folded: Column, words: int = 4, missing: str = "sin-comprador") -> Column:
    """The first words longer than two characters; a fixed name where there are none."""
    long_ones = F.filter(F.split(strip(F.coalesce(folded, F.lit(""))), r"(?U)\s+"), lambda t: F.length(t) > 2)
    return F.when(F.size(long_ones) == 0, missing).otherwise(F.array_join(F.slice(long_ones, 1, words), " "))


def country_code(x: Column) -> Column:
    """ESP as ES; two capital letters as they are; else null."""
    return F.when(x == "ESP", "ES").when(x.rlike(r"^\p{Lu}{2}$"), x)


def last_segment(x: Column, separator: str = "/") -> Column:
    return F.substring_index(x, separator, -1)


def distinct_nonblank(values: Column) -> Column:
    """Stripped, without empty ones, each once at its first place."""
    return F.array_distinct(F.filter(F.transform(F.array_compact(values), strip), lambda v: v != ""))
