"""KPI reports over the star.

Facts are summed by surrogate key before any dimension is joined, so a fact row meets no join
and only one row per key and task is shuffled. Facts meet each other only through the
attributes of shared dimensions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lonja.operators.dimensions import ALL_DIMENSIONS
from lonja.operators.targets import RUNNING, carry_deficit, day_spine
from lonja.sources.schemas import FACTS, PERIOD, UNKNOWN_LABEL
from lonja.sources.staging import ordinal

Tables = Mapping[str, DataFrame]

AMOUNT = "decimal(38,4)"

# Contact types that count as contact.
EFFECTIVE, NOT_EFFECTIVE = "CONTACTOS EFECTIVOS", "CONTACTOS NO EFECTIVOS"


def ratio(numerator: str, denominator: str) -> Column:
    """Quotient rounded to six places; null when the denominator is 0 or null."""
    quotient = F.try_divide(F.col(numerator).cast("double"), F.col(denominator).cast("double"))
    return F.round(quotient, 6)


def label_of(table: str, attribute: str) -> Column:
    """Display value of an attribute; the unknown member shows its label."""
    sk = F.col(ALL_DIMENSIONS[table].sk)
    return F.when(sk == 0, UNKNOWN_LABEL).otherwise(F.col(attribute))


@dataclass(frozen=True)
class Attribute:
    """One column of a dimension, by which a report is split."""

    table: str
    column: str

    @property
    def sk(self) -> str:
        return ALL_DIMENSIONS[self.table].sk


def _labelled(sums: DataFrame, tables: Tables, by: Attribute | None) -> DataFrame:
    """Replace the surrogate key of summed rows by an attribute of its dimension."""
    if by is None:
        return sums
    labels = tables[by.table].select(by.sk, label_of(by.table, by.column).alias("atributo"))
    return sums.join(labels, by.sk, "left").drop(by.sk)


def _keys(by: Attribute | None, *more: str) -> list[str]:
    return [*([by.sk] if by else []), *more]


def _groups(by: Attribute | None, *more: str) -> list[str]:
    return [*(["atributo"] if by else []), *more]


def sales_parts(tables: Tables, by: Attribute | None = None, *keys: str) -> DataFrame:
    """All and valid sales per surrogate key, labelled but not yet summed by label.

    Validity comes from its four-row dimension.
    """
    sums = (
        tables["fact_ventas"]
        .groupBy(*_keys(by, *keys), "sk_validez")
        .agg(F.sum("valor_antes_iva").alias("ventas"))
    )
    validity = F.broadcast(tables["dim_validez_venta"].select("sk_validez", "es_venta_valida"))
    valid = F.when(F.col("es_venta_valida"), F.col("ventas")).otherwise(F.lit(0))
    rated = sums.join(validity, "sk_validez", "left").withColumn("ventas_validas", valid)
    return _labelled(rated.drop("sk_validez", "es_venta_valida"), tables, by)


def sales_sums(tables: Tables, by: Attribute | None = None, *keys: str) -> DataFrame:
    return _summed(sales_parts(tables, by, *keys), _groups(by, *keys), "ventas", "ventas_validas")


def budget_parts(
    tables: Tables, by: Attribute | None = None, *keys: str, measure: str = "tyt"
) -> DataFrame:
    """Budget per surrogate key, labelled but not yet summed by label."""
    fact = tables["fact_presupuesto"].groupBy(*_keys(by, *keys))
    return _labelled(fact.agg(F.sum(measure).alias("presupuesto")), tables, by)


def _summed(parts: DataFrame, groups: list[str], *measures: str) -> DataFrame:
    return parts.groupBy(*groups).agg(*[F.sum(m).cast(AMOUNT).alias(m) for m in measures])


def total_sales(tables: Tables) -> DataFrame:
    return sales_sums(tables).select("ventas")


def valid_sales(tables: Tables) -> DataFrame:
    return sales_sums(tables).select("ventas_validas")


def total_budget(tables: Tables, measure: str = "tyt") -> DataFrame:
    return budget_parts(tables, measure=measure).select(F.col("presupuesto").cast(AMOUNT))


def _stacked(tables: Tables, by: Attribute | None, measure: str) -> DataFrame:
    """Valid sales and budget summed per label.

    Both facts are summed by key, labelled, stacked and summed by label: the same rows as a
    full outer join with null equal to null, in one shuffle of summed rows.
    """
    none, groups = F.lit(0).cast(AMOUNT), _groups(by)
    sold = sales_parts(tables, by).select(*groups, "ventas_validas", none.alias("presupuesto"))
    planned = budget_parts(tables, by, measure=measure).select(
        *groups, none.alias("ventas_validas"), "presupuesto"
    )
    return _summed(sold.unionByName(planned), groups, "ventas_validas", "presupuesto")


def _rated(sums: DataFrame) -> DataFrame:
    return sums.withColumn("cumplimiento", ratio("ventas_validas", "presupuesto")).withColumn(
        "faltante", shortfall()
    )


def overall_compliance(tables: Tables, measure: str = "tyt") -> DataFrame:
    """Valid sales, budget, compliance and shortfall in total."""
    return _rated(_stacked(tables, None, measure))


def shortfall() -> Column:
    return (
        F.coalesce("presupuesto", F.lit(0)) - F.coalesce("ventas_validas", F.lit(0))
    ).cast(AMOUNT)


def compliance_by(
    tables: Tables, table: str, attribute: str, measure: str = "tyt"
) -> DataFrame:
    """Valid sales against budget per attribute value, ranked by compliance."""
    sums = _stacked(tables, Attribute(table, attribute), measure)
    state = F.when(F.col("cumplimiento") >= 1, "sobrecumple").when(
        F.col("cumplimiento") < 1, "incumple"
    )
    report = _rated(sums).withColumn("estado", state)
    order = [F.col("cumplimiento").desc_nulls_last(), F.col("atributo").asc_nulls_last()]
    return ordinal(report, order, "puesto")


def best_by_compliance(
    tables: Tables, table: str, attribute: str, measure: str = "tyt"
) -> DataFrame:
    """The attribute values in first place."""
    return compliance_by(tables, table, attribute, measure).where("puesto = 1")


def compliance_over(
    tables: Tables,
    attributes: Sequence[Attribute],
    sets: Sequence[Sequence[str]],
    measure: str = "tyt",
) -> DataFrame:
    """Valid sales against budget for several groupings at once, with one scan per fact.

    Every set names some of the attributes' columns; the empty set is the total, and the sets of
    a hierarchy's first levels are its subtotals. ``agrupacion`` says which columns a row is
    grouped by, ``padre`` has the label one level up in a set of several; the columns that a row
    is not grouped by are null. Facts are summed by the surrogate keys that the attributes need,
    so labels and sets meet summed rows only.
    """
    columns = [a.column for a in attributes]
    keys = list(dict.fromkeys(a.sk for a in attributes))
    none = F.lit(0).cast(AMOUNT)
    sold = sales_parts(tables, None, *keys).select(*keys, "ventas_validas", none.alias("presupuesto"))
    planned = budget_parts(tables, None, *keys, measure=measure)
    planned = planned.select(*keys, none.alias("ventas_validas"), "presupuesto")
    parts = sold.unionByName(planned).groupBy(*keys)
    parts = parts.agg(*[F.sum(m).alias(m) for m in ("ventas_validas", "presupuesto")])
    for table in dict.fromkeys(a.table for a in attributes):
        own = [a for a in attributes if a.table == table]
        labels = [label_of(table, a.column).alias(a.column) for a in own]
        parts = parts.join(tables[table].select(own[0].sk, *labels), own[0].sk, "left")
    grouped = parts.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        *[F.sum(m).cast(AMOUNT).alias(m) for m in ("ventas_validas", "presupuesto")],
        *[F.grouping(c).alias(f"_out_{c}") for c in columns],
    )
    inside = {c: F.col(f"_out_{c}") == 0 for c in columns}
    named = F.concat_ws("+", *[F.when(inside[c], F.lit(c)) for c in columns])
    listed = F.array_compact(
        F.array(*[F.when(inside[c], F.struct(F.col(c).alias("label"))) for c in columns])
    )
    parent = F.when(F.size(listed) > 1, F.element_at(listed, -2)["label"])
    rows = grouped.select(
        named.alias("agrupacion"), *columns, parent.alias("padre"), "ventas_validas", "presupuesto"
    )
    return _rated(rows)


def contact_sums(tables: Tables, by: Attribute | None = None) -> DataFrame:
    """Delivered records, attempts and contacts by type, in total or per attribute value."""
    sums = (
        tables["fact_gestion_tmk"]
        .groupBy(*_keys(by), "sk_tipo_contacto")
        .agg(F.sum("cantidad").alias("_cantidad"), F.sum("intentos").alias("_intentos"))
    )
    kinds = tables["dim_tipo_contacto"].select("sk_tipo_contacto", "tipo_contacto")
    kind, amount = F.col("tipo_contacto"), F.col("_cantidad")
    return (
        _labelled(sums.join(kinds, "sk_tipo_contacto", "left"), tables, by)
        .groupBy(*_groups(by))
        .agg(
            F.sum(amount).alias("registros"),
            F.sum("_intentos").cast(AMOUNT).alias("intentos"),
            F.coalesce(F.sum(F.when(kind == EFFECTIVE, amount)), F.lit(0)).alias("efectivos"),
            F.coalesce(F.sum(F.when(kind == NOT_EFFECTIVE, amount)), F.lit(0)).alias(
                "no_efectivos"
            ),
        )
    )


def with_contact_ratios(sums: DataFrame) -> DataFrame:
    """Contacts and the shares of management, contact, effective and non-effective contact."""
    return sums.withColumn("contactos", F.col("efectivos") + F.col("no_efectivos")).withColumns(
        {
            "pct_gestion": ratio("registros", "intentos"),
            "pct_contactabilidad": ratio("contactos", "registros"),
            "pct_efectivos": ratio("efectivos", "registros"),
            "pct_no_efectivos": ratio("no_efectivos", "registros"),
        }
    )


def contact_totals(tables: Tables) -> DataFrame:
    return with_contact_ratios(contact_sums(tables))


def contacts_by(tables: Tables, table: str, attribute: str) -> DataFrame:
    """All contact KPIs per attribute value."""
    return with_contact_ratios(contact_sums(tables, Attribute(table, attribute)))


def top_allies(tables: Tables, n: int = 5) -> DataFrame:
    """The n allies with the best contactability; ties go by name."""
    report = contacts_by(tables, "dim_aliado", "nombre_aliado")
    return (
        report.select("atributo", "contactos", "registros", "pct_contactabilidad")
        .orderBy(F.col("pct_contactabilidad").desc_nulls_last(), F.col("atributo"))
        .limit(n)
    )


def best_campaigns(tables: Tables) -> DataFrame:
    """Every campaign that shares the best contactability."""
    report = contacts_by(tables, "dim_campana", "nombre_campana")
    best = Window.orderBy(F.col("pct_contactabilidad").desc_nulls_last())
    return (
        report.select("atributo", "contactos", "registros", "pct_contactabilidad")
        .withColumn("puesto", F.rank().over(best).cast("bigint"))
        .where("puesto = 1")
    )


def campaign_extremes(tables: Tables) -> DataFrame:
    """Campaigns with the most and with the fewest delivered records, ties kept."""
    report = contacts_by(tables, "dim_campana", "nombre_campana").select("atributo", "registros")
    # Two rows at most.
    ends = F.broadcast(
        report.agg(F.max("registros").alias("mayor"), F.min("registros").alias("menor"))
        .unpivot([], ["mayor", "menor"], "extremo", "registros")
        .where("registros IS NOT NULL")
    )
    return report.join(ends, "registros").select("extremo", "atributo", "registros")


def on_days(tables: Tables, days: Column) -> dict[str, DataFrame]:
    """The star with facts of the calendar days that meet a condition; other tables unchanged.

    Facts meet the months of these days first, by the column that their folders are named after:
    a month given as a value is pruned when the scan is planned, any other condition when the
    calendar has been read. Both sides that are broadcast have a row per month or per day.
    """
    chosen = tables["dim_tiempo"].where(days)
    month = F.coalesce("periodo_yyyymm", F.lit(0)).cast("int").alias(PERIOD.name)
    months = F.broadcast(chosen.select(month).distinct())
    single = F.broadcast(chosen.select("sk_tiempo"))
    return {
        name: df.join(months, PERIOD.name).join(single, "sk_tiempo", "left_semi")
        if name in FACTS
        else df
        for name, df in tables.items()
    }


def in_months(tables: Tables, first: int, last: int) -> dict[str, DataFrame]:
    """The star with the facts of the months ``first`` to ``last`` (yyyymm): their folders alone."""
    inside = F.col(PERIOD.name).between(first, last)
    return {name: df.where(inside) if name in FACTS else df for name, df in tables.items()}


def _dated(sums: DataFrame, tables: Tables, column: str) -> DataFrame:
    days = tables["dim_tiempo"].where("fecha is not null").select("sk_tiempo", column)
    return sums.join(days, "sk_tiempo")


def daily_sales(tables: Tables, table: str, attribute: str) -> DataFrame:
    """Valid sales per attribute value and day, as ``(atributo, fecha, ventas)``."""
    parts = sales_parts(tables, Attribute(table, attribute), "sk_tiempo")
    return (
        _dated(parts, tables, "fecha")
        .groupBy("atributo", "fecha")
        .agg(F.sum("ventas_validas").cast(AMOUNT).alias("ventas"))
    )


def monthly_budget(
    tables: Tables, table: str, attribute: str, measure: str = "tyt"
) -> DataFrame:
    """Budget per attribute value and month, as ``(atributo, periodo_yyyymm, meta_mensual)``."""
    parts = budget_parts(tables, Attribute(table, attribute), "sk_tiempo", measure=measure)
    return (
        _dated(parts, tables, "periodo_yyyymm")
        .groupBy("atributo", "periodo_yyyymm")
        .agg(F.sum("presupuesto").cast(AMOUNT).alias("meta_mensual"))
    )


def daily_compliance(
    tables: Tables, table: str, attribute: str, reset_monthly: bool = False, measure: str = "tyt"
) -> DataFrame:
    """Daily target, sales, running deficit and effective target per attribute value."""
    daily = day_spine(
        monthly_budget(tables, table, attribute, measure),
        daily_sales(tables, table, attribute),
        tables["dim_tiempo"],
        ["atributo"],
    )
    carried = carry_deficit(daily, ["atributo"], reset_monthly=reset_monthly)
    return carried.withColumn("meta_diaria", F.col("meta_diaria").cast(RUNNING))
