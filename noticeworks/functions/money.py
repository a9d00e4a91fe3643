"""Amounts: normalising their text, exact decimals."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed: the contract's money type.
MONEY = "decimal(20,2)"


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f of x, where f refers to x often and x is computed once."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def amount_text(x: Column) -> Column:
    """A number's text with a point as decimal sign.

    Of two kinds of separators the last is the decimal one; a lone comma is; a point that
    occurs once is, several are thousands separators. Spaces go.
    """
    spaceless = F.when(x.rlike(r"(?U)[\s ]"), F.regexp_replace(x, r"(?U)[\s ]+", "")).otherwise(x)
    return let(spaceless, _with_point)


def _with_point(t: Column) -> Column:
    comma, point = F.length(F.substring_index(t, ",", -1)), F.length(F.substring_index(t, ".", -1))
    both = t.contains(",") & t.contains(".")
    return (
        F.when(both & (comma < point), F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when(both, F.replace(t, F.lit(","), F.lit("")))
        .when(t.contains(","), F.replace(t, F.lit(","), F.lit(".")))
        .when(F.length(t) - F.length(F.replace(t, F.lit("."), F.lit(""))) > 1, F.replace(t, F.lit("."), F.lit("")))
        .otherwise(t)
    )


#: A decimal number; digits may have single underscores between them.
_FLOAT = r"^[+-]?(?:\p{Nd}+(?:_\p{Nd}+)*[.]?(?:\p{Nd}+(?:_\p{Nd}+)*)?|[.]\p{Nd}+(?:_\p{Nd}+)*)(?:[eE][+-]?\p{Nd}+(?:_\p{Nd}+)*)?$"
#: An amount that is its own exact decimal.
_PLAIN = r"^[0-9]{1,18}(?:[.][0-9]{1,2})?$"


def _ascii_digits(x: Column) -> Column:
    """Digits of other alphabets as those of ASCII: each block of ten begins with its zero."""
    zeros = [chr(c) for c in range(0x80, 0x1FFFF) if unicodedata.decimal(chr(c), None) == 0]
    return F.translate(x, "".join(chr(ord(z) + i) for z in zeros for i in range(10)), "0123456789" * len(zeros))


def lenient_amount(x: Column) -> Column:
    """A double; null for what isn't a number, isn't finite or is negative.

    A number is decimal, with an exponent or not; digits of any alphabet count, underscores
    between digits too. Other forms that a cast would take (suffixes, hexadecimal) are none.
    """

    def cast(t: Column) -> Column:
        usual = F.when(t.rlike("^[0-9.]+$"), t).when(t.rlike(_FLOAT), F.replace(_ascii_digits(t), F.lit("_"), F.lit("")))
        return usual.try_cast("double")

    return let(let(amount_text(x), cast), lambda d: F.when((d >= 0) & (d < float("inf")), d))


def exact_amount(x: Column) -> Column:
    """Struct (value, error): the exact decimal, or why a number can't be one.

    Malformed and negative amounts give null without an error. More than two significant
    fraction digits, or more than 18 digits before the point, are errors: a cast would round.
    Exponents move the point: 1.5e3 is 1500.
    """

    def split(t: Column) -> Column:
        plain = t.rlike(r"^([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]{1,9})?$")
        digits = F.substring_index(t, "e", 1)
        moved = F.coalesce(F.when(t.contains("e"), F.substring_index(t, "e", -1).try_cast("int")), F.lit(0))
        whole = F.ltrim(F.substring_index(digits, ".", 1), F.lit("0"))
        fraction = F.when(digits.contains("."), F.rtrim(F.substring_index(digits, ".", -1), F.lit("0"))).otherwise("")
        return F.struct(t.alias("t"), plain.alias("plain"), moved.alias("moved"), whole.alias("whole"), fraction.alias("fraction"))

    def judged(s: Column) -> Column:
        whole, fraction, t = s["whole"], s["fraction"], s["t"]
        zero = (whole == "") & (fraction == "")
        trailing = F.when(fraction == "", F.length(whole) - F.length(F.rtrim(whole, F.lit("0")))).otherwise(0)
        leading = F.length(fraction) - F.length(F.ltrim(fraction, F.lit("0")))
        places = F.length(fraction) - s["moved"] - trailing
        before = s["moved"] + F.when(whole == "", -leading).otherwise(F.length(whole))
        error = F.when(s["plain"] & ~zero & (places > 2), "too_many_fraction_digits").when((s["plain"] & ~zero & (before > 18)) | t.isin("inf", "infinity"), "too_large")
        value = F.when(s["plain"], F.when(zero, F.lit(0).cast(MONEY)).when((places <= 2) & (before <= 18), t.try_cast(MONEY)))
        return F.struct(value.alias("value"), error.alias("error"))

    kept = F.struct(x.try_cast(MONEY).alias("value"), F.lit(None).cast("string").alias("error"))
    return F.when(x.rlike(_PLAIN), kept).otherwise(let(let(F.lower(F.regexp_replace(amount_text(x), "^[+]", "")), split), judged))


def currency_of(amount: Column, currency: Column, default: str | None = None) -> Column:
    """The currency, only beside an amount."""
    return F.when(amount.isNotNull(), F.coalesce(currency, F.lit(default)) if default else currency)


def share(part: Column, whole: Column) -> Column:
    """Quotient to four places, half to even; 0 for an empty whole."""
    return F.coalesce(F.bround(F.try_divide(part.cast("double"), whole.cast("double")), 4), F.lit(0.0))
