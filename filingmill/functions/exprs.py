"""Column expressions with the text, number and tolerance rules of the fact pipeline.

White space and digits are Unicode ones throughout, and every conversion yields null instead of
an error, since sessions run in ANSI mode.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,6)"


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: str | Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(col(x), r"(?U)^\s+|\s+$", "")


def collapsed(x: str | Column) -> Column:
    """White space runs as one space, trimmed."""
    return F.trim(F.regexp_replace(col(x), r"(?U)\s+", " "))


def or_null(x: Column) -> Column:
    """Empty as null."""
    return F.nullif(x, F.lit(""))


def normalized_text(x: str | Column) -> Column:
    return or_null(collapsed(x))


def label(x: str | Column) -> Column:
    """A row label for exact alias matching."""
    return collapsed(F.lower(col(x)))


def contains_any(lowered: str | Column, keywords: Iterable[str]) -> Column:
    """Whether an already lower-cased text holds any keyword; false for a null text."""
    out = F.lit(False)
    for k in keywords:
        out = out | F.contains(col(lowered), F.lit(k.lower()))
    return F.coalesce(out, F.lit(False))


def first_match(lowered: str | Column, groups: Sequence[tuple[object, Sequence[str]]], longest: bool = False) -> tuple[Column, Column]:
    """The first group with a pattern in the text, and that pattern; null if there is none.

    Groups and patterns are tried in order, or with ``longest`` by falling length of pattern, which
    keeps a short unit from hiding a longer one that ends in it.
    """
    tries = [(g, p) for g, patterns in groups for p in patterns]
    if longest:
        tries.sort(key=lambda t: -len(t[1]))
    text = col(lowered)
    found = [(F.contains(text, F.lit(p.lower())), g, p) for g, p in tries]
    if not found:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return F.coalesce(*[F.when(c, F.lit(g)) for c, g, _ in found]), F.coalesce(*[F.when(c, F.lit(p)) for c, _, p in found])


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parse_decimal(raw: str | Column) -> Column:
    """The first number of a cell; commas are dropped, an enclosing pair of parentheses negates.

    Empty, ``-`` and ``--`` are null, as are texts without digits and numbers that don't fit.
    """
    def number(text: Column) -> Column:
        bracketed = F.startswith(text, F.lit("(")) & F.endswith(text, F.lit(")"))
        signed = F.when(bracketed, F.concat(F.lit("-"), F.substring(text, F.lit(2), F.greatest(F.length(text) - 2, F.lit(0))))).otherwise(text)
        return F.regexp_extract(signed, r"(?U)-?\d+(?:\.\d+)?", 0).try_cast(MONEY)  # no match is '', which casts to null

    return bound(F.replace(strip(raw), F.lit(","), F.lit("")), number)


def decimal_text(value: str | Column, scale: str | Column) -> Column:
    """A decimal in plain notation with ``scale`` fraction digits."""
    text, s = col(value).cast("string"), col(scale)
    return F.when(s > 0, F.substring(text, F.lit(1), F.instr(text, ".") + s)).otherwise(F.substring_index(text, ".", 1))


def within_tolerance(diff: str | Column, lhs: str | Column, absolute: Decimal | str, relative: Decimal | str) -> Column:
    """|diff| <= absolute, or for lhs other than 0, |diff| <= |lhs| * relative.

    The product is exact; a quotient of decimals would be rounded to few digits.
    """
    places = max(0, -Decimal(str(relative)).as_tuple().exponent)
    bound = F.abs(col(lhs)).try_cast("decimal(28,6)") * F.lit(str(relative)).cast(f"decimal(9,{max(places, 1)})")
    size = F.abs(col(diff))
    return (size <= F.lit(str(absolute)).cast(MONEY)) | F.coalesce((col(lhs) != 0) & (size <= bound), F.lit(False))


def stable_id(*parts: str | Column) -> Column:
    """A key derived from the natural key, equal in every run."""
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(col(p).cast("string"), F.lit("\u0000")) for p in parts]), 256)


def sorted_json(entries: str | Column) -> Column:
    """A map as JSON with sorted keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(col(entries)))))
