"""Date and time columns. Unparsable text gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROSECOND_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
SECOND_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def parse_event_time(c: Column) -> Column:
    """ISO text with or without the fraction."""
    return F.coalesce(F.try_to_timestamp(c, F.lit(MICROSECOND_PATTERN)),
                      F.try_to_timestamp(c, F.lit(SECOND_PATTERN)))


def parse_day_first(c: Column) -> Column:
    return F.try_to_date(c, "dd-MM-yyyy")


def age_years(born: Column, on: Column) -> Column:
    """Whole years of 365 days."""
    return F.floor(F.datediff(on, born) / 365)


def hour_label(ts: Column) -> Column:
    return F.date_format(ts, "HH:00")


def part_of_day(hour: Column) -> Column:
    return (F.when((hour >= 6) & (hour < 12), "Morning")
            .when((hour >= 12) & (hour < 18), "Afternoon")
            .when((hour >= 18) & (hour < 24), "Evening")
            .otherwise("Night"))


def outside_day_before(t: Column, as_of: Column) -> Column:
    """True for an event in the future of ``as_of`` or more than one day before it."""
    return (t > as_of) | (t < as_of - F.expr("INTERVAL 1 DAY"))


def seconds_between(first: Column, second: Column) -> Column:
    return F.unix_timestamp(second) - F.unix_timestamp(first)
