"""Month names, dates and period labels as built-in column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spanish month abbreviations in calendar order.
MONTH_ABBREVIATIONS = [
    "ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic",
]

# Date layouts tried after the ISO forms, as (shape, pattern); month-first wins
# over day-first, which is reached only when the first number is above twelve.
EXTRA_DATE_LAYOUTS = [
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4}$", "d MMM yyyy"),
    (r"^[A-Z][a-z]{2} \d{4}$", "MMM yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{3,} \d{4}$", "d MMMM yyyy"),
    (r"^[A-Z][a-z]{3,} \d{4}$", "MMMM yyyy"),
]

# A time of day after a date that is not written in ISO form.
CLOCK = r"^(\S+) (\d{1,2}:\d{2}(:\d{2})?)$"


def month_of_abbreviation(name: Column, strict: bool = True) -> Column:
    """Month number 1..12 of a Spanish abbreviation in any case.

    An unknown name raises in strict mode and gives NULL otherwise; NULL stays NULL.
    """
    lookup = F.create_map(
        *[F.lit(v) for i, m in enumerate(MONTH_ABBREVIATIONS, 1) for v in (m, i)]
    )
    month = F.try_element_at(lookup, F.lower(F.trim(name)))
    if not strict:
        return month
    unknown = F.raise_error(F.concat(F.lit("unknown month name: "), name)).cast("int")
    return F.when(name.isNotNull() & month.isNull(), unknown).otherwise(month)


def strict_date(text: Column) -> Column:
    """ISO date; malformed text raises."""
    parsed = F.try_to_date(text, "yyyy-MM-dd")
    broken = F.raise_error(F.concat(F.lit("not a yyyy-MM-dd date: "), text)).cast("date")
    return F.when(text.isNotNull() & parsed.isNull(), broken).otherwise(parsed)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, with the value worked out once however often ``use`` names it.

    Keeps plans and generated code small where filters repeat the whole expression.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def lenient_timestamp(text: Column) -> Column:
    """Timestamp of any known layout, NULL for anything else.

    Works on local fields without a zone, so year and month do not depend on the
    session time zone.
    """

    def day_of(day: Column) -> Column:
        return F.coalesce(
            *[F.when(day.rlike(s), F.try_to_date(day, p)) for s, p in EXTRA_DATE_LAYOUTS]
        )

    def other(trimmed: Column) -> Column:
        return _once(F.regexp_extract(trimmed, CLOCK, 2), lambda clock: with_clock(trimmed, clock))

    def with_clock(trimmed: Column, clock: Column) -> Column:
        hour, rest = F.regexp_extract(clock, "^[0-9]+", 0), F.regexp_extract(clock, ":.*$", 0)
        day = F.when(clock != "", F.regexp_extract(trimmed, CLOCK, 1)).otherwise(trimmed)
        found = _once(day, day_of)
        timed = F.concat(found.cast("string"), F.lit(" "), F.lpad(hour, 2, "0"), rest)
        return F.when(clock != "", timed.try_cast("timestamp_ntz")).otherwise(
            found.cast("timestamp_ntz")
        )

    return _once(F.trim(text), lambda t: F.coalesce(t.try_cast("timestamp_ntz"), other(t)))


def period_label(year: Column, month: Column) -> Column:
    """``2014-2``: year and month without zero padding; NULL if either is NULL."""
    return F.concat(year.cast("int").cast("string"), F.lit("-"), month.cast("int").cast("string"))


def normalise_period_part(text: Column) -> Column:
    """Canonical text of a year or month argument: ``' 03'`` becomes ``'3'``; blank gives NULL."""
    trimmed = F.trim(text)
    number = trimmed.try_cast("int").cast("string")
    return F.when(trimmed != "", F.coalesce(number, trimmed))
