import pytest
from pyspark.sql import functions as F

from lonja.operators import rules


def test_missing_columns_are_all_named(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="ventas: .*a, b"):
        rules.require_columns(df, ["id", "a", "b"], "ventas")


def test_validity_codes(spark):
    rows = [
        ("F1", None, 1),
        ("F1", "NO", 1),
        (None, None, 2),
        (" ", None, 2),
        ("<NA>", None, 2),
        ("F1", "SI", 3),
        ("F1", "si", 3),
        (None, "SI", 4),
    ]
    df = spark.createDataFrame(rows, "codigo_factura string, nota_credito string, want bigint")
    coded = rules.sale_validity(df)
    assert coded.where("sk_validez <> want or sk_validez is null").count() == 0
    assert coded.where("es_venta_valida <> (sk_validez = 1)").count() == 0


def test_absent_columns_give_false_flags(spark):
    row = rules.sale_validity(spark.range(1)).first()
    assert (row["tiene_factura"], row["tiene_nota_credito"], row["sk_validez"]) == (False, False, 2)
    flags = rules.flag_contact_type(spark.range(1)).first()
    assert [flags[c] for c in rules.CONTACT_FLAGS] == [False, False, False]


def test_contact_flags_are_null_for_a_null_type(spark):
    df = spark.createDataFrame([(None,), (" contactos efectivos ",)], "tipo_contacto string")
    null, effective = rules.flag_contact_type(df).collect()
    assert [null[c] for c in rules.CONTACT_FLAGS] == [None, None, None]
    assert [effective[c] for c in rules.CONTACT_FLAGS] == [True, False, False]


def test_contacts_lose_a_channel_key(spark):
    ruled = rules.contact_rules(spark.range(1).withColumn("sk_canal", F.lit(1)))
    assert "sk_canal" not in ruled.columns and ruled.first()["es_alcance_tmk_outbound"] is True


def test_known_key(spark):
    rows = [("5", 5), (" 12 ", 12), ("-1", 0), ("x", 0), ("3.7", 0), (None, 0), ("0", 0)]
    df = spark.createDataFrame(rows, "v string, want bigint")
    assert df.where(rules.known_key(F.col("v")) != F.col("want")).count() == 0


def test_resolve_key_tries_exact_then_stripped(spark):
    mapping = spark.createDataFrame([("A", 1), (" B", 2), ("C", -3)], "nk string, sk bigint")
    df = spark.createDataFrame([("A",), (" A ",), (" B",), ("B",), ("C",), (None,)], "k string")
    got = {r["k"]: r["out"] for r in rules.resolve_key(df, "k", mapping, "out", "nk", "sk").collect()}
    assert got == {"A": 1, " A ": 1, " B": 2, "B": 0, "C": 0, None: 0}


def test_rules_keep_the_grain(spark):
    df = spark.createDataFrame(
        [("F1", None, 1.0), ("F1", "SI", 2.0)], "codigo_factura string, nota_credito string, m double"
    )
    for column in rules.SALES_REQUIRED:
        df = df.withColumn(column, F.lit("x"))
    totals = rules.grain_totals({"a": df, "b": rules.sales_rules(df)}, "m").collect()
    assert {(r["filas"], r["total"]) for r in totals} == {(2, 3.0)}
