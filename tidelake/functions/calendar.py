"""Calendar and service-hour expressions."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# First hour past each block, the block that closes the day, all blocks, and those of peak hours.
HOUR_BLOCK_LIMITS = [(6, "05-06"), (9, "06-09"), (12, "09-12"), (15, "12-15"), (18, "15-18"), (21, "18-21")]
LAST_HOUR_BLOCK = "21-23"
HOUR_BLOCKS = ["05-06", "06-09", "09-12", "12-15", "15-18", "18-21", "21-23"]
PEAK_BLOCKS = ["06-09", "15-18"]

# Labels of the parts of the day.
DAY_PARTS = {
    "madrugada": ["05-06"],
    "mañana": ["06-09", "09-12"],
    "tarde": ["12-15", "15-18"],
    "noche": ["18-21", "21-23"],
}
UNKNOWN_DAY_PART = "desconocido"

# Spanish names, January first / Sunday first.
MONTH_NAMES = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]
DAY_NAMES = ["Domingo", "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado"]

# Months of the two rainy seasons.
RAINY_MONTHS = [4, 5, 9, 10, 11]

# Colombian public holidays of 2024.
HOLIDAYS_2024 = [
    "2024-01-01", "2024-01-08", "2024-03-25", "2024-03-28", "2024-03-29", "2024-05-01",
    "2024-05-13", "2024-06-03", "2024-06-10", "2024-07-01", "2024-07-20", "2024-08-07",
    "2024-08-19", "2024-10-14", "2024-11-04", "2024-11-11", "2024-12-08", "2024-12-25",
]


def hour_block(ts: Column, zone: str | None = None) -> Column:
    """Service block of a time; hours before 5 and after 23 join the nearest block.

    ``zone`` reads a UTC time on the local clock of that zone first.
    """
    hour = F.hour(F.from_utc_timestamp(ts, zone) if zone else ts)
    first, *rest = HOUR_BLOCK_LIMITS
    chain = reduce(lambda c, step: c.when(hour < step[0], step[1]), rest, F.when(hour < first[0], first[1]))
    return chain.when(hour.isNotNull(), LAST_HOUR_BLOCK)


def time_of_day(block: Column) -> Column:
    parts = list(DAY_PARTS.items())
    chain = F.when(block.isin(parts[0][1]), parts[0][0])
    for label, blocks in parts[1:]:
        chain = chain.when(block.isin(blocks), label)
    return chain.otherwise(UNKNOWN_DAY_PART)


def is_peak(block: Column) -> Column:
    return block.isin(PEAK_BLOCKS)


def month_name(month: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in MONTH_NAMES]), month - 1)


def day_name(sunday_first: Column) -> Column:
    """Name of a day numbered 1 = Sunday ... 7 = Saturday."""
    return F.get(F.array(*[F.lit(n) for n in DAY_NAMES]), sunday_first - 1)


def iso_from_sunday_first(sunday_first: Column) -> Column:
    """1 = Sunday ... 7 = Saturday to 1 = Monday ... 7 = Sunday."""
    return (sunday_first + 5) % 7 + 1


def iso_dow(day: Column) -> Column:
    return F.weekday(day) + 1


def is_weekend(sunday_first: Column) -> Column:
    return sunday_first.isin(1, 7)


def is_rainy(month: Column) -> Column:
    return month.isin(RAINY_MONTHS)


def holiday_calendar(spark: SparkSession, days: list[str] | None = None) -> DataFrame:
    """One row per holiday; the 2024 list unless another is given."""
    rows = [(dt.date.fromisoformat(d),) for d in (HOLIDAYS_2024 if days is None else days)]
    return spark.createDataFrame(rows, "holiday date")


def with_holiday(df: DataFrame, calendar: DataFrame, date_col: str = "trip_date") -> DataFrame:
    """Add ``is_holiday``; a NULL date is not a holiday.

    The calendar stays tiny whatever the data size (a few days a year), so Spark
    broadcasts it by its own size estimate.
    """
    marked = calendar.select(F.col("holiday").alias("_holiday")).distinct()
    return (
        df.join(marked, F.col(date_col) == F.col("_holiday"), "left")
        .withColumn("is_holiday", F.col("_holiday").isNotNull())
        .drop("_holiday")
    )
