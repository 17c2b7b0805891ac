"""Daily targets and the deficit carried from one business day to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lonja.functions.dates import period

DAILY = "decimal(28,6)"
RUNNING = "decimal(38,6)"


def daily_amount(monthly: Column, days: Column) -> Column:
    """Monthly amount per business day; null without days or amount."""
    return F.when(days > 0, monthly / days)


def with_daily_target(df: DataFrame, measure: str, out: str) -> DataFrame:
    """Daily target of one monthly measure; null when a needed column is absent."""
    if not {measure, "dias_habiles_mes"} <= set(df.columns):
        return df.withColumn(out, F.lit(None).cast(DAILY))
    return df.withColumn(
        out, daily_amount(F.col(measure), F.col("dias_habiles_mes")).cast(DAILY)
    )


def day_spine(
    monthly: DataFrame, sales: DataFrame, calendar: DataFrame, group: Sequence[str]
) -> DataFrame:
    """One row per group and business day of every month in which the group has a target.

    ``monthly`` has ``group``, ``periodo_yyyymm``, ``meta_mensual``; ``sales`` has ``group``,
    ``fecha``, ``ventas``, already summed. A month meets its own days through an equality join
    on the month key, so there is no product of all groups and days. Sales outside the spine
    are left out here and counted by ``sales_off_spine``.
    """
    days = calendar.where("fecha is not null and es_habil").select("periodo_yyyymm", "fecha")
    counts = days.groupBy("periodo_yyyymm").agg(F.count("*").alias("_dias"))
    # The calendar is bounded by its years: 366 rows each.
    spine = monthly.join(F.broadcast(counts), "periodo_yyyymm").join(
        F.broadcast(days), "periodo_yyyymm"
    )
    target = daily_amount(F.col("meta_mensual"), F.col("_dias")).cast(DAILY)
    sold = sales.select(
        *[F.col(c).alias(f"_{c}") for c in group], F.col("fecha").alias("_fecha"), "ventas"
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group]
    return spine.join(sold, [*same, F.col("fecha") == F.col("_fecha")], "left").select(
        *group,
        "fecha",
        target.alias("meta_diaria"),
        F.coalesce(F.col("ventas"), F.lit(0)).cast(RUNNING).alias("ventas"),
    )


def sales_off_spine(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Days and amount of sales that fall on Sundays, holidays or outside the calendar."""
    days = calendar.where("fecha is not null and es_habil").select("fecha")
    return sales.join(F.broadcast(days), "fecha", "left_anti").agg(
        F.count("*").alias("dias_grupo"),
        F.coalesce(F.sum("ventas"), F.lit(0)).cast(RUNNING).alias("ventas_fuera"),
    )


def carry_deficit(
    daily: DataFrame,
    group: Sequence[str],
    day: str = "fecha",
    target: str = "meta_diaria",
    sold: str = "ventas",
    reset_monthly: bool = False,
) -> DataFrame:
    """Add ``deficit`` and ``meta_efectiva``: a shortfall moves to the next day, a surplus is lost.

    The recursion ``D = max(0, D_previous + target - sold)`` equals the running sum of
    ``target - sold`` minus the lowest value that sum has had, 0 included. So two window
    aggregates do it. ``daily`` has one row per group and day, which bounds a window
    partition by the number of business days.
    """
    keys = [F.col(c) for c in group]
    if reset_monthly:
        keys.append(period(F.col(day)))
    ordered = Window.partitionBy(*keys).orderBy(day)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gap = (F.col(target) - F.col(sold)).cast(RUNNING)
    summed = daily.withColumn("_running", F.sum(gap).over(so_far).cast(RUNNING))
    lowest = F.least(F.lit(0).cast(RUNNING), F.min("_running").over(so_far))
    deficit = (F.col("_running") - lowest).cast(RUNNING)
    before = F.coalesce(F.lag("deficit").over(ordered), F.lit(0))
    return (
        summed.withColumn("deficit", deficit)
        .withColumn("meta_efectiva", (F.col(target) + before).cast(RUNNING))
        .drop("_running")
    )
