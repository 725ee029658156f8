"""Column expressions shared by the plans. All of them stay inside codegen.

Timestamps carry no zone (``TIMESTAMP_NTZ``), so results do not depend on the session's
time zone, save for the defaults ``date_or_today(None)`` and ``timestamp_or_now(None)``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.schemas import UNKNOWN

NTZ = "timestamp_ntz"
#: A date, and perhaps a time of at least hours and minutes; after a time perhaps a zone
#: (Z, an offset, or a name after a space) and spaces.
TIMESTAMP_FORM = (
    r"^\s*(\d{4,6})([-/])(\d{1,2})\2(\d{1,2})"
    r"(?:(?: +|T)(\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d*)?)?)"
    r"(?: *(?:Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)|(?<! ) [A-Za-z0-9_/+-]+)? *)?\z"
)


def lower_label(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def upper_label(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def known_label(name: str, allowed: Sequence[str]) -> Column:
    """The normalised label if it is allowed, else ``unknown`` (also for NULL)."""
    label = lower_label(name)
    return F.when(label.isin(*allowed), label).otherwise(UNKNOWN)


def label_or_none(name: str) -> Column:
    """NULL becomes ``none``; a text of spaces becomes the empty string."""
    return F.coalesce(lower_label(name), F.lit("none"))


def as_timestamp(name: str) -> Column:
    """Text of the form year-month-day, with or without a time of at least hours and
    minutes, to a timestamp; single digits, slashes for dashes and fractions of a second
    are fine.

    A time may be followed by a zone and by spaces. The zone is read over and the time kept
    as it is written, which is what a timestamp without zone means. Text of another form,
    such as a padded date without a time, gives NULL.

    Whole times of two digits, by far the most, are told by a few characters; only other
    text is matched with the pattern.
    """
    text = F.col(name)

    def char(place: int) -> Column:
        return F.substring(text, place, 1)

    plain = (
        F.length(text).between(19, 26) & (char(14) == ":") & (char(17) == ":") & char(20).isin("", ".")
        & char(1).between("0", "9") & F.substring(text, -1, 1).between("0", "9")
    )
    common = F.when(plain, text.try_cast(NTZ))
    rewritten = F.regexp_replace(text, TIMESTAMP_FORM, "$1-$3-$4 $5").try_cast(NTZ)
    return F.coalesce(common, F.when(text.rlike(TIMESTAMP_FORM), rewritten))


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """df and the columns, as generated ones: a filter on such a column is evaluated after
    it, where one on a projected column would compute it once more before."""
    made = F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))
    return df.select("*", F.inline(made))


def as_number(name: str, kind: str) -> Column:
    return F.col(name).try_cast(kind)


def as_whole_number(name: str) -> Column:
    """Text such as ``120``, ``120.0``, ``12.6`` or ``1e2`` to the nearest int, halves away
    from zero; NULL if it is no number or too large."""
    return F.round(F.col(name).try_cast("decimal(38,18)"), 0).try_cast("int")


def present(*names: str) -> Column:
    """All columns are set. Unlike ``dropna`` this reaches the Parquet scan."""
    return reduce(and_, [F.col(name).isNotNull() for name in names])


def week_of(ts: Column) -> Column:
    """Midnight of the Monday that starts the week."""
    return F.trunc(F.to_date(ts), "week").cast(NTZ)


def month_of(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month").cast(NTZ)


def days_between(start: Column, end: Column) -> Column:
    """Calendar days crossed from ``start`` to ``end``, negative if it goes back."""
    return F.datediff(end, start)


def to_hours(seconds: Column) -> Column:
    # A bigint over 3600.0 would be a decimal; the double rounds half up exactly.
    return F.round(seconds.cast("double") / 3600, 2)


def date_or_today(as_of: str | dt.date | None) -> Column:
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def timestamp_or_now(at: str | dt.datetime | None) -> Column:
    if at is None:
        return F.localtimestamp()
    return F.lit(str(at)).cast(NTZ)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is NULL."""
    return F.when(condition, 1).otherwise(0)
