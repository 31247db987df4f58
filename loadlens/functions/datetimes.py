"""Date plus time of day to ISO-8601 text, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import extract, let, rx, strip

# Positions of month and day in the order they are tried.
MONTH_FIRST = ((0, 1),)
DAY_FIRST_TOO = ((0, 1), (1, 0))

# Accepted shapes of the time of day; a shape is used only if a profile lists it.
CLOCK = {
    "24h": r"(?:2[0-3]|[01]?\d):[0-5]?\d",
    "24h+s": r"(?:2[0-3]|[01]?\d):[0-5]?\d:[0-5]?\d",
    "12h": r"(?:1[0-2]|0?[1-9]):[0-5]?\d\s+[AP]M",
    "12h+s": r"(?:1[0-2]|0?[1-9]):[0-5]?\d:[0-5]?\d\s+[AP]M",
}


def iso_date(date: Column, formats, parts: Column | None = None) -> Column:
    """yyyy-MM-dd by the first order that fits; null if none does. parts: the date split at '/', if there is a column of it."""

    # a cast through yyyy-M-d knows the calendar and needs no time zone
    def attempt(parts, month, day):
        part = lambda i: F.get(parts, F.lit(i))
        iso = F.concat_ws("-", part(2), part(month), part(day)).try_cast("date").cast("string")
        return F.when(F.lpad(part(month), 2, "0") <= "12", iso)

    every = lambda parts: F.coalesce(*[attempt(parts, *order) for order in formats])
    tried = let(F.split(date, "/"), every) if parts is None else every(parts)
    return F.when(date.rlike(r"^\d{1,2}/\d{1,2}/(?!0000)\d{4}$"), tried)


def iso_time(time: Column, shapes) -> Column:
    """HH:mm:ss for a time of day in one of the shapes; null otherwise."""
    hour = F.substring_index(time, ":", 1)
    minute = F.regexp_extract(time, r"^\d+:(\d+)", 1)
    seconds = F.lit("00")
    if any("12h" in s for s in shapes):
        meridiem = F.upper(F.substring(time, -2, 2))
        twelve = hour.try_cast("int") % 12
        hour = (
            F.when(meridiem == "PM", (twelve + 12).cast("string"))
            .when(meridiem == "AM", twelve.cast("string"))
            .otherwise(hour)
        )
    if any("+s" in s for s in shapes):
        seconds = F.regexp_extract(time, r"^\d+:\d+:(\d+)", 1)
    text = F.concat_ws(":", *[F.lpad(c, 2, "0") for c in (hour, minute, seconds)])
    accepted = r"(?i)^(?:" + "|".join(CLOCK[s] for s in shapes) + r")$"
    return F.when(time.rlike(accepted), text)


def _joined(date: Column, time: Column) -> Column:
    return F.coalesce(F.concat(date, F.lit("T"), time), F.lit(""))


def combine(date: Column, time: Column, shapes=("24h", "12h", "24h+s")) -> Column:
    """Month-first, else day-first date with a time that may be 'from a - b' or 'at a'."""
    bare = strip(F.regexp_replace(time, rx(r"(?:from|at)\s*"), ""))
    start = strip(F.substring_index(bare, "-", 1))
    return _joined(iso_date(date, DAY_FIRST_TOO), let(start, lambda t: iso_time(t, shapes)))


def combine_us(date: Column, time: Column) -> Column:
    """Month-first only; 12-hour and 24-hour clocks, with or without seconds."""
    return _joined(iso_date(date, MONTH_FIRST), iso_time(time, tuple(CLOCK)))


def combine_strict(date: Column, time: Column) -> Column:
    """First m/d/yyyy and first H:MM:SS found in the inputs."""
    found_date = extract(date, r"(\d{1,2}/\d{1,2}/\d{4})")
    found_time = extract(time, r"(\d{1,2}:\d{2}:\d{2})")
    return _joined(
        let(found_date, lambda d: iso_date(d, MONTH_FIRST)),
        let(found_time, lambda t: iso_time(t, ("24h+s",))),
    )


def processed_at(local: bool = False) -> Column:
    """Run stamp, one value per query: UTC seconds, or session-local with microseconds."""
    if local:
        return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss")
