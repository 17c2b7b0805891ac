"""Calendar of business days from a year range and a holiday table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.functions.casts import typed
from lonja.functions.dates import period
from lonja.functions.text import strip
from lonja.operators.clean import drop_duplicates_by

# Fixed value: weekday() of the only weekend day, Sunday.
SUNDAY = 6


def year_range(spark: SparkSession, start_year: int, end_year: int) -> DataFrame:
    if start_year > end_year:
        raise ValueError(f"start year {start_year} is after end year {end_year}")
    return spark.range(start_year, end_year + 1).select(F.col("id").cast("int").alias("anio"))


def date_spine(years: DataFrame) -> DataFrame:
    """Every day of every year in ``anio``."""
    first = F.make_date("anio", F.lit(1), F.lit(1))
    last = F.make_date("anio", F.lit(12), F.lit(31))
    return years.select(F.explode(F.sequence(first, last)).alias("fecha"))


def holiday_names(holidays: DataFrame, order_by: str) -> DataFrame:
    """One name per holiday date: rows without date or name go, the last row of a date wins."""
    named = holidays.where("date <> '' and name_es <> ''").select(
        typed(F.col("date"), "date", label="holiday").alias("fecha"),
        strip(F.col("name_es")).alias("nombre_festivo"),
        F.col(order_by),
    )
    return drop_duplicates_by(named, ["fecha"], [order_by], keep="last").drop(order_by)


def calendar_days(spine: DataFrame, holidays: DataFrame) -> DataFrame:
    """Calendar attributes of each day; a business day is neither a Sunday nor a holiday."""
    day = F.col("fecha")
    holiday = F.col("nombre_festivo").isNotNull()
    sunday = F.weekday(day) == SUNDAY
    business = ~sunday & ~holiday
    return spine.join(holidays, "fecha", "left").select(
        "fecha",
        F.year(day).alias("anio"),
        F.month(day).alias("mes"),
        F.day(day).alias("dia"),
        period(day).alias("periodo_yyyymm"),
        F.date_format(day, "MMMM").alias("nombre_mes"),
        (F.weekday(day) + 1).alias("dia_semana"),
        business.alias("es_dia_habil"),
        holiday.alias("es_festivo_co"),
        sunday.alias("es_fin_semana"),
        holiday.alias("es_festivo"),
        "nombre_festivo",
        business.alias("es_habil"),
    )


def backfill_master_columns(calendar: DataFrame) -> DataFrame:
    """Add the three later calendar columns, filled from the older ones on dated rows."""
    dated = F.col("fecha").isNotNull()
    return calendar.withColumns(
        {
            "es_festivo": dated & F.coalesce("es_festivo_co", F.lit(False)),
            "nombre_festivo": F.lit(None).cast("string"),
            "es_habil": dated & F.coalesce("es_dia_habil", F.lit(False)),
        }
    )


def require_calendar(calendar: DataFrame) -> DataFrame:
    """Fail when the calendar has no dated row."""
    if calendar.where("fecha is not null").isEmpty():
        raise RuntimeError("the calendar holds no dates: load it before the commercial sources")
    return calendar


def business_days(calendar: DataFrame) -> DataFrame:
    """Number of business days per month key."""
    return (
        calendar.where("fecha is not null and es_habil")
        .groupBy("periodo_yyyymm")
        .agg(F.count("*").alias("dias_habiles"))
    )


def with_business_days(budget: DataFrame, days: DataFrame, month: str = "mes") -> DataFrame:
    """Add ``dias_habiles_mes``: 0 for a month without calendar rows, null without a month."""
    if month not in budget.columns:
        return budget.withColumn("dias_habiles_mes", F.lit(None).cast("bigint"))
    # One row per month of the calendar: a few thousand rows for centuries of dates.
    counts = F.broadcast(days.select(F.col("periodo_yyyymm").alias("_periodo"), "dias_habiles"))
    return (
        budget.join(counts, period(F.col(month)) == F.col("_periodo"), "left")
        .withColumn(
            "dias_habiles_mes",
            F.when(F.col(month).isNotNull(), F.coalesce("dias_habiles", F.lit(0)).cast("bigint")),
        )
        .drop("_periodo", "dias_habiles")
    )
