"""Dates of a column from its header, in three scripts.

A header names a day (``December 31, 2025``, ``31 Dec 2025``, ``2025-12-31``, ``12/31/2025``, ``2025年12月31日``), a month
(``2025年6月``, ``June 2025``: its last day) or a year (``FY2025``, ``2025年度``, ``year ended 2025``: its last day).
The first of these kinds that a header has decides, within a kind the first place. What isn't a date of the
calendar (``2025-02-30``) is none. Durations: twelve, nine, six and three months by the words beside the date.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from filingmill.functions.exprs import bound

# Month names by number, their first three letters decide.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_NAME = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\\.?"
_YEAR = "((?:19|20)[0-9]{2})"
_LEAD, _TAIL = "(?<![0-9])", "(?![0-9])"

#: (pattern, groups of year, month and day): a day, a month or a year. Month and day of 0 aren't named.
DAYS = (
    (f"{_LEAD}{_YEAR}\\s*年\\s*([0-9]{{1,2}})\\s*月\\s*([0-9]{{1,2}})\\s*日", (1, 2, 3)),
    (f"{_LEAD}{_YEAR}[-/.]([0-9]{{1,2}})[-/.]([0-9]{{1,2}}){_TAIL}", (1, 2, 3)),
    (f"{_NAME}\\s+([0-9]{{1,2}})(?:st|nd|rd|th)?,?\\s+{_YEAR}{_TAIL}", (3, 1, 2)),
    (f"{_LEAD}([0-9]{{1,2}})(?:st|nd|rd|th)?\\s+{_NAME},?\\s+{_YEAR}{_TAIL}", (3, 2, 1)),
    (f"{_LEAD}([0-9]{{1,2}})/([0-9]{{1,2}})/{_YEAR}{_TAIL}", (3, 1, 2)),
)
WHOLE = (
    (f"{_LEAD}{_YEAR}\\s*年\\s*([0-9]{{1,2}})\\s*月", (1, 2, 0)),
    (f"{_NAME},?\\s+{_YEAR}{_TAIL}", (2, 1, 0)),
    (f"{_LEAD}{_YEAR}{_TAIL}", (1, 0, 0)),
)

# Words that say how many months a period has; longer ones come first.
DURATIONS = (
    (3, ("three months", "3 months", "quarter", "本季度", "季度", "三個月", "三个月")),
    (6, ("six months", "6 months", "half-year", "half year", "半年", "六個月", "六个月")),
    (9, ("nine months", "9 months", "前三季度", "九個月", "九个月")),
    (12, ("twelve months", "12 months", "year ended", "years ended", "fiscal year", "年度", "全年")),
)
#: Words of nine months that contain one of three.
_FIRST = ("前三季度",)


def _number(text: Column) -> Column:
    """A month's number from its name or digits."""
    named = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(text, 1, 3))
    return F.when(named > 0, named.cast("int")).otherwise(text.try_cast("int"))


def _date(text: Column, pattern: str, groups: tuple[int, int, int]) -> Column:
    """The date that the first match of a pattern names, null without one or if there is no such day."""
    year, month, day = (F.regexp_extract(text, pattern, g) if g else None for g in groups)
    m = _number(month) if month is not None else F.lit(12)
    first = F.try_to_date(F.concat_ws("-", year, F.lpad(m.cast("string"), 2, "0"), F.lit("01")), "yyyy-MM-dd")
    if day is None:
        return F.last_day(first)
    d = day.try_cast("int")
    return F.when((d >= 1) & (d <= F.dayofmonth(F.last_day(first))), F.date_add(first, d - 1))


def header_date(header: Column) -> Column:
    """The date that a header names: a day before a month before a year."""
    return bound(F.lower(F.coalesce(header, F.lit(""))), lambda t: F.coalesce(*[_date(t, p, g) for p, g in (*DAYS, *WHOLE)]))


def header_months(header: Column) -> Column:
    """How many months the period of a header has, null if it doesn't say."""

    def months(text: Column) -> Column:
        out = F.when(F.lit(False), F.lit(0))
        for word in _FIRST:
            out = out.when(F.contains(text, F.lit(word)), F.lit(9))
        for n, words in DURATIONS:
            for word in words:
                out = out.when(F.contains(text, F.lit(word)), F.lit(n))
        return out

    return bound(F.lower(F.coalesce(header, F.lit(""))), months)


def period(header: Column, basis: Column) -> Column:
    """A struct of period_start, period_end and instant_date.

    With the basis ``point_in_time`` the date is an instant; otherwise it ends the period, which begins as many whole
    months earlier as the header says, and has no start if it doesn't say. Nothing is guessed from the filing's year.
    """
    at = basis == "point_in_time"

    def dates(x: Column) -> Column:
        end, months = x["date"], x["months"]
        start = F.add_months(F.date_add(F.last_day(end), 1), -months)
        return F.struct(F.when(~at, start).alias("period_start"), F.when(~at, end).alias("period_end"), F.when(at, end).alias("instant_date"))

    return bound(F.struct(header_date(header).alias("date"), header_months(header).alias("months")), dates)
