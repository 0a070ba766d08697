"""Days of 23, 24 and 25 hours, derived from the time zone alone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ZONE = "America/Santiago"


def _instant(day: Column, zone: str) -> Column:
    """The zoneless UTC time of a day's local midnight, whatever the session's zone."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), day.cast("timestamp_ntz"))


def hours_of_day(day: Column, zone: str = ZONE) -> Column:
    """Hours between a day's local midnights: 23, 24 or 25."""
    return F.timestamp_diff("HOUR", _instant(day, zone), _instant(F.date_add(day, 1), zone)).cast("int")


def quarters_of_day(day: Column, zone: str = ZONE) -> Column:
    return hours_of_day(day, zone) * 4


def is_long(day: Column, zone: str = ZONE) -> Column:
    return hours_of_day(day, zone) == 25


def is_short(day: Column, zone: str = ZONE) -> Column:
    return hours_of_day(day, zone) == 23


def hour_exists(day: Column, hour: Column, zone: str = ZONE) -> Column:
    """Whether the clock showed that hour: it survives the way to UTC and back."""
    local = F.timestamp_add("HOUR", hour, day.cast("timestamp_ntz"))
    return F.hour(F.convert_timezone(F.lit("UTC"), F.lit(zone), F.convert_timezone(F.lit(zone), F.lit("UTC"), local))) == hour


def missing_hours(day: Column, zone: str = ZONE) -> Column:
    return F.filter(F.sequence(F.lit(0), F.lit(23)), lambda h: ~hour_exists(day, h, zone))


def expected_hours(day: Column, zone: str = ZONE) -> Column:
    """The day's hours in order; the repeated 23:00 is hour 24."""
    have = F.filter(F.sequence(F.lit(0), F.lit(23)), lambda h: hour_exists(day, h, zone))
    return F.when(is_long(day, zone), F.array_append(have, F.lit(24))).otherwise(have)


def days(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row a day, both ends included."""
    if first > last:
        raise ValueError(f"the range is inverted: {first} is after {last}")
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))).alias("fecha"))


def calendar(spark: SparkSession, first: date, last: date, zone: str = ZONE) -> DataFrame:
    """fecha, horas, cuartos_esperados, es_dia_largo, es_dia_corto: a row a day, small enough to broadcast."""
    day = F.col("fecha")
    return days(spark, first, last).select("fecha", hours_of_day(day, zone).alias("horas"), quarters_of_day(day, zone).alias("cuartos_esperados"), is_long(day, zone).alias("es_dia_largo"), is_short(day, zone).alias("es_dia_corto"))
