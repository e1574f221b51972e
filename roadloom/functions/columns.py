"""Column expressions: rounding, congestion, calendar and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import DEFAULT, Params

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def rounded(x: Column, places: int) -> Column:
    """Half up; the small addend lifts halves that binary fractions fall just short of."""
    return F.round(x + F.lit(1e-9), places)


def observed(speed: str = "speed", reference: str = "reference_speed") -> Column:
    return F.coalesce(F.col(speed).isNotNull() & (F.col(reference) > 0), F.lit(False))


def congested(params: Params = DEFAULT, speed: str = "speed", reference: str = "reference_speed") -> Column:
    return F.coalesce(F.col(speed).isNotNull() & (F.col(reference) > 0) & (F.col(speed) < F.lit(params.congestion_ratio) * F.col(reference)), F.lit(False))


def ratio(speed: str = "speed", reference: str = "reference_speed") -> Column:
    """Speed over reference speed, null where the reference is zero or either is missing."""
    return F.col(speed) / F.nullif(F.col(reference), F.lit(0.0))


def iso_weekday(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + 1


def weekday_name(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), number)


def title(x: Column) -> Column:
    return F.initcap(F.lower(x))


def clock_label(hour: Column) -> Column:
    """``05:00 PM`` for hour 17."""
    twelve = F.when(hour % 12 == 0, F.lit(12)).otherwise(hour % 12)
    return F.concat(F.lpad(twelve.cast("string"), 2, "0"), F.lit(":00 "), F.when(hour < 12, "AM").otherwise("PM"))


def short_clock_label(ts: Column) -> Column:
    """``5:05 PM``, or N/A for null."""
    return F.coalesce(F.date_format(ts, "h:mm a"), F.lit("N/A"))


def long_date_label(day: Column) -> Column:
    """``March 4, 2024``, or N/A for null."""
    return F.coalesce(F.date_format(day, "MMMM d, yyyy"), F.lit("N/A"))


def road_class(f_system: Column) -> Column:
    """The road class of a functional system number; null beyond the known ones."""
    return F.when(f_system == 1, "Interstate").when(f_system == 2, "Expressway").when(f_system.isin(3, 4), "Arterial").when(f_system.isin(5, 6), "Collector").when(f_system == 7, "Local")


def severity_bin(pct: Column) -> Column:
    """0 to 4 by steps of 20, the last one open; -1 for null or less than zero is also the last."""
    step = F.when(pct < 0, F.lit(4)).when(pct < 20, 0).when(pct < 40, 1).when(pct < 60, 2).when(pct < 80, 3).otherwise(4)
    return F.when(pct.isNull(), F.lit(-1)).otherwise(step).cast("int")


def direction_abbreviation(direction: Column) -> Column:
    """NB, SB, EB, WB, CW, CCW; any other direction in title case."""
    known = {"NORTHBOUND": "NB", "SOUTHBOUND": "SB", "EASTBOUND": "EB", "WESTBOUND": "WB", "CLOCKWISE": "CW", "COUNTERCLOCKWISE": "CCW"}
    found = F.lit(None).cast("string")
    for name, short in known.items():
        found = F.when(F.upper(F.trim(direction)) == name, F.lit(short)).otherwise(found)
    return F.coalesce(found, title(direction))


def display_name(road: str, direction: str) -> Column:
    """``I-285 CW`` for the columns of a road and its direction."""
    return F.trim(F.concat_ws(" ", F.col(road), direction_abbreviation(F.col(direction))))


def slug(road: str, direction: str) -> Column:
    """``i-75-no`` for I-75 northbound: a name for paths and addresses."""
    return F.concat(F.lower(F.replace(F.col(road), F.lit("/"), F.lit("-"))), F.lit("-"), F.lower(F.left(F.col(direction), F.lit(2))))
