from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lonja.functions import dates
from lonja.functions.casts import typed, whole_number
from lonja.functions.text import WHITESPACE, header_name, header_names, key_text, strip, strip_visible


def values(spark, rows, dtype, expression):
    df = spark.createDataFrame([(r,) for r in rows], f"v {dtype}")
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


def test_header_names_lose_accents_case_and_punctuation():
    assert header_name("  Fecha Finalización Reserva ") == "fecha_finalizacion_reserva"
    assert header_name("GV-JEFE 1 CANAL REGIONAL") == "gv_jefe_1_canal_regional"
    assert header_name("NOMBRE_CAMPAÑA") == "nombre_campana"
    assert header_name("T&T") == "t_t"
    assert header_name("__a--b__") == "a_b"
    assert header_name("%%%") == "columna"


def test_colliding_headers_get_the_next_free_suffix():
    assert header_names(["Año", "ANO", "ano"]) == ["ano", "ano_1", "ano_2"]
    assert header_names(["a", "A", "a_1"]) == ["a", "a_1", "a_1_1"]
    assert header_names(["", "?"]) == ["columna", "columna_1"]


def test_strip_removes_what_python_strips(spark):
    assert all(ch.isspace() for ch in WHITESPACE)
    rows = [f"{ch}a b{ch}" for ch in WHITESPACE] + ["", " \t\n", None, "x y"]
    expected = [r.strip() if r is not None else None for r in rows]
    assert values(spark, rows, "string", strip) == expected
    edges = [f"{a}{b}" for ch in (*WHITESPACE, "é", "~", "\x7f", "\x00") for a, b in ((ch, "a"), ("a", ch), (ch, ""))]
    rows = rows + edges + [f"!{ch}~" for ch in WHITESPACE]
    assert values(spark, rows, "string", strip_visible) == values(spark, rows, "string", strip)


def test_key_text_turns_blank_into_null(spark):
    rows = [" A\t", "", "  ", None, "b"]
    assert values(spark, rows, "string", key_text) == ["A", None, None, None, "b"]
    assert values(spark, [7, None], "bigint", key_text) == ["7", None]


def test_yyyymmdd(spark):
    rows = [20260630, 20260231, 20261301, 0, -20260630, 2026630, 202663, 2026, 99991231, None]
    got = values(spark, rows, "bigint", dates.from_yyyymmdd)
    day = date(2026, 6, 30)
    last = date(9999, 12, 31)
    assert got == [day, None, None, None, None, day, date(2026, 6, 3), None, last, None]


def test_yyyymmdd_text_goes_through_whole_number(spark):
    rows = ["20260630.0", " 20260630 ", "sin fecha", "", None]
    got = values(spark, rows, "string", lambda v: dates.from_yyyymmdd(whole_number(v)))
    assert got == [date(2026, 6, 30), date(2026, 6, 30), None, None, None]


def test_a_fraction_fails_in_strict_mode_and_is_never_truncated(spark):
    with pytest.raises(PySparkException):
        values(spark, [20260630.5], "double", whole_number)
    permissive = values(spark, [20260630.5, 5.0], "double", lambda v: whole_number(v, "permissive"))
    assert permissive == [None, 5]


def test_yyyymm_is_the_first_of_the_month(spark):
    got = values(spark, [202602, 202613, 202600, None], "bigint", dates.from_yyyymm)
    assert got == [date(2026, 2, 1), None, None, None]


def test_iso_dates(spark):
    rows = ["2026-07-02", "2026-07-02 10:30:00", "2026-07-02T23:59:59", "02/07/2026", "", None]
    day = date(2026, 7, 2)
    assert values(spark, rows, "string", dates.from_iso) == [day, day, day, None, None, None]


def test_typed_casts(spark):
    with pytest.raises(PySparkException):
        values(spark, ["1.5", "x"], "string", lambda v: typed(v, "decimal(8,2)"))
    got = values(spark, ["1.5", "x", None], "string", lambda v: typed(v, "decimal(8,2)", "permissive"))
    assert [None if g is None else float(g) for g in got] == [1.5, None, None]


def test_period_keys(spark):
    df = spark.createDataFrame([(date(2026, 3, 9), 26, 3)], "d date, a int, m int")
    row = df.select(
        dates.period(F.col("d")), dates.period_of_short_year(F.col("a"), F.col("m"))
    ).first()
    assert tuple(row) == (202603, 202603)
