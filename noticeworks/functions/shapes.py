"""Payload fields of usual shape as plain texts, and of any shape as VARIANTs, read alike.

Nearly all payloads hold strings, numbers, lists of them and objects of those by language. Their
fields are read by one ``from_json`` into texts: a string is itself, everything else the exact
text of its JSON, whose first character tells what it is. ``is_odd`` finds the payloads for
which that isn't enough, by their text alone: strings that look like a list or an object,
zeros and false (which are not truthy, as a text "0" is), numbers whose text isn't their value's,
lists of lists or objects, escaped or empty containers, and a listed key whose value is null.
These go through VARIANT, so that both kinds give the same values.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeworks.functions import jsonx
from noticeworks.functions.money import let
from noticeworks.functions.text import BLANK

#: A string that is a list or an object by its ends: "[x]", not "[x] y".
_BRACKETED = r'"(?:\[(?:[^"\\]|\\.)*\]|\{(?:[^"\\]|\\.)*\})"'
#: Between fields joined by U+0001: zeros, false and numbers with a fraction or an exponent; lists
#: of lists or objects, containers of white space, such numbers in containers.
_ODD = (
    r"\x01(?:-?0+\x01|false\x01|-?\d+[.eE][^\x01]*\x01"
    r"|\[\s*[\[{]|\[\s+\]|\{\s+\}|[\[{](?:[^\x01]*[\[,:])?\s*-?\d+[.eE]|[\[{][^\x01]*[\[,]\s*[\[{])"
)

_ZERO = r"\x01(?:-?0[.0]*(?:[eE][+-]?\d+)?|false)\x01"


def is_odd(payload: Column, f: Column, names: Iterable[str], exact: Iterable[str] = (), present: Iterable[str] = (), listed: Iterable[str] = ()) -> Column:
    """Whether a payload, of whose fields ``f`` has the texts, needs VARIANT. ``exact``: fields
    whose numbers are wanted as they are written; ``present``: fields that count as there even
    if they are null; ``listed``: fields that are lists or single values, but no objects."""
    exact = set(exact)
    joined = F.concat_ws("\x01", F.lit(""), *(f[n] for n in names if n not in exact), F.lit(""))
    odd = F.when(payload.contains('"[') | payload.contains('"{'), payload.rlike(_BRACKETED)).otherwise(F.lit(False)) | joined.rlike(_ODD)
    if exact:
        odd = odd | F.concat_ws("\x01", F.lit(""), *(f[n] for n in sorted(exact)), F.lit("")).rlike(_ZERO)
    for name in listed:
        odd = odd | F.coalesce(f[name].startswith("{"), F.lit(False))
    for name in present:
        odd = odd | (payload.contains(f'"{name}"') & f[name].isNull())
    return odd


class Variants:
    """Reads fields of any shape: ``f`` is a struct of VARIANTs."""

    def __init__(self, f: Column) -> None:
        self.f = f

    def value(self, name: str) -> Column:
        return self.f[name]

    truthy = staticmethod(jsonx.is_truthy)
    given = staticmethod(jsonx.is_given)
    text = staticmethod(jsonx.as_text)
    link = staticmethod(jsonx.link_of)

    @staticmethod
    def shown(values: Iterable[Column]) -> Column:
        """An array of the values' texts, null where there is none. One expression reads them
        all: what is built for each value is planned and compiled for each."""
        return _full(F.transform(F.array(*values), lambda x: F.when(x.isNotNull(), jsonx.shown_text(x))))

    @staticmethod
    def items(values: Iterable[Column]) -> Column:
        """An array of the texts of each list's elements, or of a value as a list of one; null
        for null."""
        return F.transform(F.array(*values), lambda x: F.transform(jsonx.items(x), lambda i: jsonx.shown_text(i, depth=1)))


class Texts:
    """Reads fields of usual shape: ``f`` is a struct of texts."""

    def __init__(self, f: Column) -> None:
        self.f = f

    def value(self, name: str) -> Column:
        return self.f[name]

    @staticmethod
    def truthy(x: Column) -> Column:
        return F.coalesce(~x.isin("", "[]", "{}"), F.lit(False))

    @staticmethod
    def given(x: Column) -> Column:
        return x.isNotNull()

    @staticmethod
    def text(x: Column) -> Column:
        return x

    @staticmethod
    def link(x: Column) -> Column:
        """As of ``jsonx.link_of``: few rows have no other address."""
        return F.when(x.isNotNull(), jsonx.link_of(F.try_parse_json(x)))

    @staticmethod
    def shown(values: Iterable[Column]) -> Column:
        return _full(F.transform(F.array(*values), lambda x: F.when(x.isNotNull(), _nested(x))))

    @staticmethod
    def items(values: Iterable[Column]) -> Column:
        return F.transform(F.array(*values), lambda x: F.when(_is(x, "[", "]"), F.from_json(x, "array<string>")).when(x.isNotNull(), F.array(x)))


def _nested(x: Column) -> Column:
    """The text of a list or of an object by language, of texts or lists of texts."""
    listed = lambda t: _first_full(F.from_json(t, "array<string>"))
    inner = lambda t: F.when(_is(t, "[", "]"), listed(t)).when(_is(t, "{", "}"), _first_full(F.map_values(F.from_json(t, "map<string,string>")))).otherwise(_stripped(t))

    def other(m: Column) -> Column:
        values = F.transform(F.array_sort(F.map_keys(m)), lambda k: inner(m[k]))
        return F.get(F.filter(values, lambda t: t != ""), F.lit(0))

    # most objects have the preferred language, whose value alone is read then
    own = let(F.from_json(x, "spa string")["spa"], lambda t: F.when(t.isNotNull(), inner(t)).otherwise(let(F.from_json(x, "map<string,string>"), other)))
    return F.when(_is(x, "[", "]"), listed(x)).when(_is(x, "{", "}"), own).otherwise(_stripped(x))


def _full(texts: Column) -> Column:
    """Null for an empty text. NULLIF would compute what it compares twice within a lambda."""
    return F.transform(texts, lambda t: F.when(t != "", t))


def _is(x: Column, opening: str, closing: str) -> Column:
    return x.startswith(opening) & x.endswith(closing)


def _stripped(x: Column) -> Column:
    """``text.strip``, where the ends are looked at before a pattern runs over the whole."""
    inside = F.ascii(x).between(33, 126) & F.ascii(F.right(x, F.lit(1))).between(33, 126)
    return F.when(inside, x).otherwise(F.regexp_replace(x, rf"(?U)^{BLANK}+|{BLANK}+$", ""))


def _first_full(values: Column) -> Column:
    return F.get(F.filter(F.transform(F.array_compact(values), _stripped), lambda t: t != ""), F.lit(0))


def by_source(source: Column, choices: Mapping[str, Column]) -> Column:
    found = F.lit(None)
    for name, choice in choices.items():
        found = F.when(source == name, choice).otherwise(found)
    return found


def text_schema(names: Iterable[str]) -> str:
    return ", ".join(f"`{n}` string" for n in names)


def distinct(values: Column) -> Column:
    """``text.distinct_nonblank``, with little work for stripped texts; empty for null."""
    some = F.array_distinct(F.filter(F.transform(F.array_compact(values), _stripped), lambda t: t != ""))
    return F.when(values.isNotNull(), some).otherwise(F.array().cast("array<string>"))
