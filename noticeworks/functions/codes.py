"""Hierarchical eight-digit codes: level, parents, validity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def significant(code: Column) -> Column:
    """Digits up to the last that isn't zero."""
    return F.length(F.rtrim(code, F.lit("0")))


def level(code: Column) -> Column:
    """1 for a division (two digits), then one more for each digit."""
    return F.greatest(F.lit(1), significant(code) - 1).cast("tinyint")


def structural_parent(code: Column) -> Column:
    """The code with its last significant digit zeroed; null for divisions."""
    k = significant(code)
    return F.when(k > 2, F.rpad(F.substring(code, F.lit(1), k - 1), 8, "0"))


def is_valid(code: Column) -> Column:
    """Eight digits, a division, and no zero between it and the last significant digit."""
    return F.coalesce(code.rlike("^[0-9]{8}$") & ~code.rlike("^00") & F.rtrim(code, F.lit("0")).rlike("^[0-9]{1,2}[1-9]*$"), F.lit(False))


def ancestors(code: Column) -> Column:
    """All shorter codes up to the division, the nearest first; not null for divisions: empty."""
    k = significant(code)
    lengths = F.when(k > 2, F.sequence(k - 1, F.lit(2))).otherwise(F.array().cast("array<int>"))
    return F.transform(lengths, lambda n: F.rpad(F.substring(code, F.lit(1), n), 8, "0"))


def longest_prefix(code: Column, prefixes: list[tuple[str, str]]) -> Column:
    """The value of the longest prefix of (prefix, value) that fits; ties to the first given."""
    found = F.lit(None).cast("string")
    order = sorted(range(len(prefixes)), key=lambda i: (len(prefixes[i][0]), -i))
    for i in order:
        found = F.when(code.startswith(prefixes[i][0]), prefixes[i][1]).otherwise(found)
    return found
