"""Business rules: sale validity, contact typification, column contracts, grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lonja.functions.text import strip
from lonja.operators.calendar import with_business_days

# Columns the commercial follow-up needs.
SALES_REQUIRED = ("gv_desc2", "gv_gerente_area", "gv_jefe_1_canal_regional", "gv_especialista")
BUDGET_REQUIRED = ("descrip2", "gerente", "jefe", "especialista")

# Markers and domain codes.
CREDIT_NOTE = "SI"
MISSING_INVOICE_TEXT = "<NA>"
VALID_SALE, NO_INVOICE, CREDITED, CREDITED_NO_INVOICE = 1, 2, 3, 4
CONTACT_FLAGS = {
    "es_contacto_efectivo": "CONTACTOS EFECTIVOS",
    "es_contacto_no_efectivo": "CONTACTOS NO EFECTIVOS",
    "es_no_contacto": "NO CONTACTOS",
}


def require_columns(df: DataFrame, columns: Sequence[str], dataset: str) -> DataFrame:
    """Fail with the names of all missing columns; rows are untouched."""
    present = set(df.columns)
    missing = [c for c in columns if c not in present]
    if missing:
        raise ValueError(f"{dataset}: missing required columns: {', '.join(missing)}")
    return df


def sale_validity(df: DataFrame, *wanted: str) -> DataFrame:
    """Add the wanted of four columns, all by default, in one projection.

    ``tiene_nota_credito``: the marker says SI in any case. ``tiene_factura``: an invoice code
    that is neither blank nor the text for a missing one. ``es_venta_valida``: the second without
    the first. ``sk_validez``: 1 to 4 for the combinations of both. A null, or a column that the
    source lacks, is false; the last two take a flag that ``df`` has as it is.
    """
    present = set(df.columns)
    marker, code = (
        F.col(c).cast("string") if c in present else F.lit(None).cast("string")
        for c in ("nota_credito", "codigo_factura")
    )
    own = {
        "tiene_nota_credito": F.coalesce(F.upper(marker) == CREDIT_NOTE, F.lit(False)),
        "tiene_factura": F.coalesce(
            (strip(code) != "") & (code != MISSING_INVOICE_TEXT), F.lit(False)
        ),
    }
    credited, invoiced = (F.col(n) if n in present else own[n] for n in own)
    number = F.when(credited, F.when(invoiced, CREDITED).otherwise(CREDITED_NO_INVOICE))
    number = number.otherwise(F.when(invoiced, VALID_SALE).otherwise(NO_INVOICE))
    found = {
        **own,
        "es_venta_valida": invoiced & ~credited,
        "sk_validez": number.cast("bigint"),
    }
    return df.withColumns({name: found[name] for name in wanted or found})


def flag_contact_type(df: DataFrame) -> DataFrame:
    """Three typification flags; a null type gives null flags, an absent column gives false."""
    if "tipo_contacto" not in df.columns:
        return df.withColumns({name: F.lit(False) for name in CONTACT_FLAGS})
    kind = F.upper(strip(F.col("tipo_contacto")))
    return df.withColumns({name: kind == text for name, text in CONTACT_FLAGS.items()})


def mark_outbound_scope(df: DataFrame) -> DataFrame:
    """The contact source is outbound as a whole, so the flag is constant."""
    return df.withColumn("es_alcance_tmk_outbound", F.lit(True))


def drop_channel_key(df: DataFrame) -> DataFrame:
    """Contacts carry no channel key."""
    return df.drop("sk_canal")


def sales_rules(df: DataFrame) -> DataFrame:
    return sale_validity(require_columns(df, SALES_REQUIRED, "ventas"))


def budget_rules(df: DataFrame, business_days: DataFrame) -> DataFrame:
    checked = require_columns(df, BUDGET_REQUIRED, "presupuesto")
    return with_business_days(checked, business_days)


def contact_rules(df: DataFrame) -> DataFrame:
    return (
        df.transform(drop_channel_key)
        .transform(mark_outbound_scope)
        .transform(flag_contact_type)
    )


def grain_totals(stages: Mapping[str, DataFrame], measure: str) -> DataFrame:
    """Row count and sum of a measure per stage, to show that rules keep the grain."""
    totals = [
        df.agg(
            F.lit(name).alias("etapa"),
            F.count("*").alias("filas"),
            F.sum(measure).alias("total"),
        )
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, totals)


def known_key(value: Column) -> Column:
    """Surrogate key, or 0 when it is null, negative or not a number."""
    key = value.try_cast("bigint")
    return F.when(key >= 0, key).otherwise(F.lit(0).cast("bigint"))


def resolve_key(
    df: DataFrame, natural_key: str, mapping: DataFrame, out: str, map_key: str, map_sk: str
) -> DataFrame:
    """Surrogate key by natural key; a miss is retried with the stripped text, then gives 0.

    The mapping has one row per key. Spark broadcasts it when its measured size allows and
    otherwise shuffles both sides.
    """
    exact = mapping.select(
        F.col(map_key).cast("string").alias("_exact"), F.col(map_sk).alias("_sk_exact")
    )
    stripped = exact.toDF("_stripped", "_sk_stripped")
    text = F.col(natural_key).cast("string")
    return (
        df.join(exact, text == F.col("_exact"), "left")
        .join(stripped, strip(text) == F.col("_stripped"), "left")
        .withColumn(out, known_key(F.coalesce("_sk_exact", "_sk_stripped")))
        .drop("_exact", "_sk_exact", "_stripped", "_sk_stripped")
    )
