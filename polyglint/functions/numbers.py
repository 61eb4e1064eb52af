"""Number, date and display expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import DAY_NAMES


def nan_to_null(value: Column) -> Column:
    return F.when(F.isnan(value), F.lit(None)).otherwise(value)


def to_count(text: Column) -> Column:
    """Text to a whole number; missing, empty or unreadable gives 0."""
    return F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint"))


def guarded_ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 when whole is not positive."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def log_plus_one(value: Column) -> Column:
    return F.log1p(value)


def log_ten(value: Column) -> Column:
    """log10 with everything below 1 lifted to 1."""
    return F.log10(F.greatest(value, F.lit(1)))


def human_number(value: Column) -> Column:
    """1234 -> 1.2K, 5.6e6 -> 5.6M, 7.8e9 -> 7.8B; below 1000 the whole part."""

    def scaled(unit: float, mark: str) -> Column:
        return F.format_string(f"%.1f{mark}", F.round(value / F.lit(unit), 1))

    return (
        F.when(value >= 1e9, scaled(1e9, "B"))
        .when(value >= 1e6, scaled(1e6, "M"))
        .when(value >= 1e3, scaled(1e3, "K"))
        .otherwise(value.cast("bigint").cast("string"))
    )


def iso_duration_seconds(text: Column) -> Column:
    """Seconds in an ISO-8601 duration of weeks, days, hours, minutes and seconds.

    Anything else, including years and months, which have no fixed length, gives null.
    """
    shape = (
        r"^P(?=.)(?:(\d+(?:\.\d+)?)W)?(?:(\d+(?:\.\d+)?)D)?"
        r"(?:T(?=.)(?:(\d+(?:\.\d+)?)H)?(?:(\d+(?:\.\d+)?)M)?(?:(\d+(?:\.\d+)?)S)?)?$"
    )
    units = (604800.0, 86400.0, 3600.0, 60.0, 1.0)
    total = F.lit(0.0)
    for group, seconds in enumerate(units, start=1):
        amount = F.regexp_extract(text, shape, group).try_cast("double")
        total = total + F.coalesce(amount, F.lit(0.0)) * seconds
    return F.when(text.rlike(shape), total)


def parse_timestamp(text: Column, fmt: str = "yyyy-MM-dd'T'HH:mm:ssX") -> Column:
    """Timestamp of the text, null when it does not parse."""
    return F.try_to_timestamp(text, F.lit(fmt))


def weekday_number(moment: Column) -> Column:
    """Monday is 0."""
    return F.weekday(moment)


def weekday_name(number: Column) -> Column:
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.when(number.between(0, 6), F.try_element_at(names, number + 1))


def age_hours(moment: Column, now: Column) -> Column:
    return _age_seconds(moment, now) / 3600.0


def age_days(moment: Column, now: Column) -> Column:
    return _age_seconds(moment, now) / 86400.0


def _age_seconds(moment: Column, now: Column) -> Column:
    return (F.unix_micros(now.cast("timestamp")) - F.unix_micros(moment.cast("timestamp"))) / 1e6


def display_name(*parts: Column) -> Column:
    return F.concat_ws(" + ", *parts)
