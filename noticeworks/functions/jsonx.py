"""Fields of JSON payloads, through VARIANT.

Payloads are heterogeneous: the same field may be a string, a list or an object by language,
so nothing is inferred, and a value's own type decides how it is read. A field is *present*
when its key is there, *given* when it isn't null, and *truthy* unless it is null, "", 0, false,
an empty list or an empty object; a string is never taken for a list.

Functions of a payload ``v`` take names of its fields; those of a value ``x`` take the VARIANT
of one. ``fields`` reads many at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeworks.functions.text import distinct_nonblank, strip


def payload(text: Column) -> Column:
    """VARIANT of a JSON text; null where it is none."""
    return F.try_parse_json(text)


def fields(v: Column, names: Iterable[str]) -> Column:
    """A struct of the named fields as VARIANTs, read in one pass: null where the key isn't
    there, a VARIANT of null where its value is null."""
    return F.try_variant_get(v, "$", f"struct<{', '.join(f'`{n}`: variant' for n in names)}>")


def value(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$['{name}']", "variant")


def as_text(x: Column) -> Column:
    return F.try_variant_get(x, "$", "string")


def field(v: Column, name: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, f"$['{name}']", kind)


def schema_of(v: Column, name: str) -> Column:
    return F.schema_of_variant(value(v, name))


def is_given(x: Column) -> Column:
    return x.isNotNull() & ~F.is_variant_null(x)


def is_truthy(x: Column) -> Column:
    """Whether a value is there and none of the empty ones; never null."""
    kind, text = F.schema_of_variant(x), as_text(x)
    full = (
        F.when(kind == "STRING", text != "").when(kind == "BOOLEAN", text == "true").when(kind == "VOID", False)
        .when(kind.startswith("ARRAY"), text != "[]").when(kind.startswith("OBJECT"), text != "{}").otherwise(F.try_variant_get(x, "$", "double") != 0)
    )
    return F.coalesce(full, F.lit(False))


def first_value(*values: Column) -> Column:
    """The first truthy one of several values; null if none is."""
    return F.coalesce(*(F.when(is_truthy(x), x) for x in values))


def truthy(v: Column, name: str) -> Column:
    return is_truthy(value(v, name))


def first_truthy(v: Column, *names: str) -> Column:
    """The first truthy field's text; null if none is."""
    return as_text(first_value(*(value(v, n) for n in names)))


def first_given(v: Column, *names: str) -> Column:
    """The first field that isn't null, even if it is empty or invalid."""
    return F.coalesce(*(field(v, n) for n in names))


def present(text: Column, name: str) -> Column:
    """Whether the JSON object has the key, be its value null."""
    return F.coalesce(F.array_contains(F.json_object_keys(text), name), F.lit(False))


def items(x: Column) -> Column:
    """A list's elements, a single value as a list of one; null for null."""
    return F.when(is_given(x), F.coalesce(F.try_variant_get(x, "$", "array<variant>"), F.array(x)))


def _first_full(values: Column, shown: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.get(F.filter(F.transform(values, shown), lambda t: t != ""), F.lit(0)), F.lit(""))


def shown_text(x: Column, language: str = "spa", depth: int = 2) -> Column:
    """Text of a value that is a string, a list, or either by language; "" if it has none.

    An object gives its ``language`` if that isn't null, even if empty; else its first value
    with text, by key. A list gives its first element with text. ``depth`` levels of lists and
    objects are entered.
    """
    plain = F.coalesce(strip(as_text(x)), F.lit(""))
    if not depth:
        return plain
    inner = lambda y: shown_text(y, language, depth - 1)
    listed, by_key = F.try_variant_get(x, "$", "array<variant>"), F.try_variant_get(x, "$", "map<string,variant>")
    own = F.try_variant_get(x, f"$['{language}']", "variant")
    of_object = F.when(is_given(own), inner(own)).otherwise(_first_full(F.map_values(by_key), inner))
    kind = F.schema_of_variant(x)
    return F.when(kind.startswith("OBJECT"), of_object).when(kind.startswith("ARRAY"), _first_full(listed, inner)).otherwise(plain)


def localized(v: Column, name: str, language: str = "spa") -> Column:
    return shown_text(value(v, name), language)


def codes_of(x: Column) -> Column:
    """Distinct texts of a list or a single value, in order."""
    return distinct_nonblank(F.coalesce(F.transform(items(x), lambda i: shown_text(i, depth=1)), F.array().cast("array<string>")))


def codes(v: Column, *names: str) -> Column:
    """Distinct codes of a list or scalar field, the first truthy of several."""
    return codes_of(first_value(*(value(v, n) for n in names)))


def single_of(*values: Column) -> Column:
    """The one distinct text that all the values give together; null for none or several."""
    none = F.array().cast("array<variant>")
    found = distinct_nonblank(F.transform(F.concat(*(F.coalesce(items(x), none) for x in values)), lambda i: shown_text(i, depth=1)))
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


def single_value(v: Column, *names: str) -> Column:
    return single_of(*(value(v, n) for n in names))


#: Fixed: languages of a notice's page in order of preference.
LINK_LANGUAGES = ("ENG", "SPA", "DEU", "FRA")


def link_of(links: Column) -> Column:
    """A notice's page: the html by language in order of preference, else the first by key."""
    html = F.try_variant_get(links, "$['html']", "map<string,string>")
    preferred = [F.nullif(F.try_variant_get(links, f"$['html']['{x}']", "string"), F.lit("")) for x in LINK_LANGUAGES]
    first = F.element_at(html, F.get(F.array_sort(F.map_keys(html)), F.lit(0)))
    return F.nullif(strip(F.coalesce(*preferred, first)), F.lit(""))


def link(v: Column, name: str = "links") -> Column:
    return link_of(value(v, name))


