import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lonja.operators import calendar as cal
from lonja.operators import targets


def holidays(spark, rows):
    return spark.createDataFrame(rows, "date string, name_es string, _src_row int")


def test_calendar_days(spark):
    table = holidays(
        spark,
        [
            ("2026-01-01", "Año", 1),
            ("2026-01-06", None, 2),
            (None, "x", 3),
            ("2026-12-25", "primero", 4),
            ("2026-12-25", " Navidad ", 5),
        ],
    )
    spine = cal.date_spine(cal.year_range(spark, 2025, 2027))
    days = cal.calendar_days(spine, cal.holiday_names(table, "_src_row"))
    assert days.count() == 1095
    row = {r["fecha"]: r for r in days.where("anio = 2026").collect()}
    assert row[date(2026, 12, 25)]["nombre_festivo"] == "Navidad"
    assert row[date(2026, 1, 1)]["es_habil"] is False
    assert row[date(2026, 1, 6)]["es_festivo"] is False
    saturday, sunday = row[date(2026, 1, 3)], row[date(2026, 1, 4)]
    assert (saturday["dia_semana"], saturday["es_fin_semana"], saturday["es_habil"]) == (6, False, True)
    assert (sunday["dia_semana"], sunday["es_fin_semana"], sunday["es_habil"]) == (7, True, False)
    assert row[date(2026, 7, 1)]["nombre_mes"] == "July"


def test_year_range_must_be_in_order(spark):
    with pytest.raises(ValueError):
        cal.year_range(spark, 2027, 2026)


def test_an_empty_calendar_fails(spark):
    empty = spark.createDataFrame([(None,)], "fecha date")
    with pytest.raises(RuntimeError):
        cal.require_calendar(empty)


def test_backfill_touches_dated_rows_only(spark):
    older = spark.createDataFrame(
        [(None, True, True), (date(2026, 1, 2), True, None)],
        "fecha date, es_dia_habil boolean, es_festivo_co boolean",
    )
    got = {r["fecha"]: (r["es_habil"], r["es_festivo"]) for r in cal.backfill_master_columns(older).collect()}
    assert got == {None: (False, False), date(2026, 1, 2): (True, False)}


def test_business_days_of_unknown_month_are_zero_and_of_no_month_null(spark):
    days = spark.createDataFrame([(202601, 25)], "periodo_yyyymm int, dias_habiles bigint")
    budget = spark.createDataFrame(
        [(date(2026, 1, 1), 50.0), (date(2030, 1, 1), 50.0), (None, 50.0)], "mes date, t double"
    )
    ruled = targets.with_daily_target(cal.with_business_days(budget, days), "t", "meta")
    got = {r["mes"]: (r["dias_habiles_mes"], r["meta"]) for r in ruled.collect()}
    assert got[date(2026, 1, 1)] == (25, Decimal("2.000000"))
    assert got[date(2030, 1, 1)] == (0, None)
    assert got[None] == (None, None)
    assert targets.with_daily_target(budget, "t", "meta").first()["meta"] is None


def carried(meta, sold):
    """The rule as a loop."""
    deficit, out = Decimal(0), []
    for m, s in zip(meta, sold):
        effective = m + deficit
        deficit = max(Decimal(0), effective - s)
        out.append((deficit, effective))
    return out


@pytest.mark.parametrize("reset", [False, True])
def test_deficit_equals_the_day_by_day_rule(spark, reset):
    rng = random.Random(7)
    rows, want = [], {}
    for g in range(20):
        days = [date(2026, 1, 1) + timedelta(days=i) for i in range(60)]
        meta = [Decimal(rng.randint(0, 900)) / 100 for _ in days]
        sold = [Decimal(rng.randint(0, 2000) if rng.random() < 0.5 else 0) / 100 for _ in days]
        months = [[i for i, d in enumerate(days) if d.month == m] for m in (1, 2, 3)]
        for part in months if reset else [list(range(60))]:
            for i, pair in zip(part, carried([meta[i] for i in part], [sold[i] for i in part])):
                want[(g, days[i])] = pair
        rows += [(g, d, m, s) for d, m, s in zip(days, meta, sold)]
    rng.shuffle(rows)
    df = spark.createDataFrame(
        rows, "g int, fecha date, meta_diaria decimal(28,6), ventas decimal(38,6)"
    )
    got = targets.carry_deficit(df, ["g"], reset_monthly=reset).collect()
    assert {(r["g"], r["fecha"]): (r["deficit"], r["meta_efectiva"]) for r in got} == want


def test_spine_pairs_a_month_with_its_own_business_days(spark):
    calendar = cal.calendar_days(
        cal.date_spine(cal.year_range(spark, 2026, 2026)),
        cal.holiday_names(holidays(spark, [("2026-01-01", "Año", 1)]), "_src_row"),
    )
    monthly = spark.createDataFrame(
        [("n", 202601, Decimal(260)), (None, 202602, Decimal(24))],
        "g string, periodo_yyyymm int, meta_mensual decimal(20,4)",
    )
    sales = spark.createDataFrame(
        [("n", date(2026, 1, 2), Decimal(7)), (None, date(2026, 2, 2), Decimal(3)), ("n", date(2026, 1, 4), Decimal(9))],
        "g string, fecha date, ventas decimal(20,2)",
    )
    spine = targets.day_spine(monthly, sales, calendar, ["g"])
    assert spine.where("g = 'n'").count() == 26
    assert spine.where("g is null").count() == 24
    assert {r["meta_diaria"] for r in spine.where("g = 'n'").collect()} == {Decimal("10.000000")}
    assert spine.agg(F.sum("ventas")).first()[0] == Decimal(10)
    assert tuple(targets.sales_off_spine(sales, calendar).first()) == (1, Decimal(9))
    plan = spine._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
