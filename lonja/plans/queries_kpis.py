"""Queries for the KPI reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.operators import kpis
from lonja.plans.registry import query, star
from lonja.sources.schemas import PERIOD

_SOLD = """SELECT f.*, v.es_venta_valida FROM fact_ventas f
  JOIN dim_validez_venta v ON v.sk_validez = f.sk_validez"""
_VALID = "coalesce(sum(valor_antes_iva) FILTER (es_venta_valida), 0)"


@query("g1_total_sales", "SELECT CAST(sum(valor_antes_iva) AS DOUBLE) AS ventas FROM fact_ventas")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.total_sales(star(spark, sf))


@query("g2_valid_sales", f"SELECT CAST({_VALID} AS DOUBLE) AS ventas_validas FROM sold", sold=_SOLD)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.valid_sales(star(spark, sf))


@query(
    "g3_total_budget", "SELECT CAST(sum(tyt) AS DOUBLE) AS presupuesto FROM fact_presupuesto"
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.total_budget(star(spark, sf))


_OVERALL = f"""SELECT (SELECT {_VALID} FROM sold) AS v, (SELECT sum(tyt) FROM fact_presupuesto) AS p"""


@query(
    "g4_compliance",
    """SELECT CAST(v AS DOUBLE) AS ventas_validas, CAST(p AS DOUBLE) AS presupuesto,
      round(CAST(v AS DOUBLE) / nullif(CAST(p AS DOUBLE), 0), 6) AS cumplimiento FROM overall""",
    sold=_SOLD,
    overall=_OVERALL,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.overall_compliance(star(spark, sf)).drop("faltante")


@query(
    "g5_shortfall",
    "SELECT CAST(p - v AS DOUBLE) AS faltante FROM overall",
    sold=_SOLD,
    overall=_OVERALL,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.overall_compliance(star(spark, sf)).select("faltante")


def _compliance(table: str, sk: str, attribute: str) -> dict[str, str]:
    """Oracle views of a compliance report: an outer join of the two summed facts."""
    label = f"CASE WHEN d.{sk} = 0 THEN 'No informado' ELSE d.{attribute} END"
    return {
        "sold": _SOLD,
        "s": f"SELECT {label} AS atributo, {_VALID} AS v FROM sold f"
        f" JOIN {table} d ON d.{sk} = f.{sk} GROUP BY 1",
        "b": f"SELECT {label} AS atributo, sum(tyt) AS p FROM fact_presupuesto f"
        f" JOIN {table} d ON d.{sk} = f.{sk} GROUP BY 1",
        "both_sides": """SELECT coalesce(s.atributo, b.atributo) AS atributo, coalesce(v, 0) AS v,
          coalesce(p, 0) AS p FROM s FULL JOIN b ON s.atributo IS NOT DISTINCT FROM b.atributo""",
        "rated": """SELECT *, round(CAST(v AS DOUBLE) / nullif(CAST(p AS DOUBLE), 0), 6) AS c
          FROM both_sides""",
    }


_REPORT = """SELECT atributo, CAST(v AS DOUBLE) AS ventas_validas, CAST(p AS DOUBLE) AS presupuesto,
  c AS cumplimiento, CAST(p - v AS DOUBLE) AS faltante,
  CASE WHEN c >= 1 THEN 'sobrecumple' WHEN c < 1 THEN 'incumple' END AS estado,
  row_number() OVER (ORDER BY c DESC NULLS LAST, atributo NULLS LAST) AS puesto FROM rated"""

_HIERARCHY = ("dim_jerarquia_comercial", "sk_jerarquia")
for _name, (_table, _sk, _attribute) in {
    "g6_sales_vs_budget_by_region": ("dim_region", "sk_region", "nombre_region"),
    "g7_compliance_by_ally": ("dim_aliado", "sk_aliado", "nombre_aliado"),
    "g7_compliance_by_manager": (*_HIERARCHY, "gerente"),
    "g7_compliance_by_chief": (*_HIERARCHY, "jefe"),
    "g7_compliance_by_specialist": (*_HIERARCHY, "especialista"),
}.items():

    def _register(name: str, table: str, sk: str, attribute: str) -> None:
        @query(name, _REPORT, **_compliance(table, sk, attribute))
        def _(spark: SparkSession, sf: str) -> DataFrame:
            return kpis.compliance_by(star(spark, sf), table, attribute)

    _register(_name, _table, _sk, _attribute)


_LEVELS = ("gerente", "jefe", "especialista")
_SETS = [(), *[_LEVELS[:n] for n in (1, 2, 3)], ("jefe",), ("especialista",), ("nombre_aliado",)]
_LABELS = ", ".join(
    [f"CASE WHEN j.sk_jerarquia = 0 THEN 'No informado' ELSE j.{c} END AS {c}" for c in _LEVELS]
    + ["CASE WHEN a.sk_aliado = 0 THEN 'No informado' ELSE a.nombre_aliado END AS nombre_aliado"]
)
_DIMS = "JOIN dim_jerarquia_comercial j ON j.sk_jerarquia = f.sk_jerarquia JOIN dim_aliado a ON a.sk_aliado = f.sk_aliado"
_GROUPED = ", ".join(f"({', '.join(s)})" for s in _SETS)
_IN = {c: f"grouping({c}) = 0" for c in (*_LEVELS, "nombre_aliado")}


@query(
    "g7_compliance_by_hierarchy",
    """SELECT agrupacion, gerente, jefe, especialista, nombre_aliado, padre,
      CAST(v AS DOUBLE) AS ventas_validas, CAST(p AS DOUBLE) AS presupuesto,
      round(CAST(v AS DOUBLE) / nullif(CAST(p AS DOUBLE), 0), 6) AS cumplimiento,
      CAST(p - v AS DOUBLE) AS faltante FROM grouped""",
    sold=_SOLD,
    labelled=f"""SELECT {_LABELS}, CASE WHEN es_venta_valida THEN valor_antes_iva ELSE 0 END AS v, 0 AS p
      FROM sold f {_DIMS} UNION ALL SELECT {_LABELS}, 0, tyt FROM fact_presupuesto f {_DIMS}""",
    grouped=f"""SELECT concat_ws('+', {", ".join(f"CASE WHEN {w} THEN '{c}' END" for c, w in _IN.items())})
        AS agrupacion, gerente, jefe, especialista, nombre_aliado,
      CASE WHEN grouping(gerente) = 0 AND grouping(especialista) = 0 THEN jefe
        WHEN grouping(gerente) = 0 AND grouping(jefe) = 0 THEN gerente END AS padre,
      sum(v) AS v, sum(p) AS p
      FROM labelled GROUP BY GROUPING SETS ({_GROUPED})""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    # The four answers by manager, chief, specialist and ally, the subtotals and the total.
    attributes = [kpis.Attribute("dim_jerarquia_comercial", c) for c in _LEVELS]
    attributes.append(kpis.Attribute("dim_aliado", "nombre_aliado"))
    return kpis.compliance_over(star(spark, sf), attributes, _SETS)


@query(
    "g6_best_region",
    f"SELECT * FROM ({_REPORT}) WHERE puesto = 1",
    **_compliance("dim_region", "sk_region", "nombre_region"),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.best_by_compliance(star(spark, sf), "dim_region", "nombre_region")


_TYPED = """SELECT f.*, k.tipo_contacto FROM fact_gestion_tmk f
  JOIN dim_tipo_contacto k ON k.sk_tipo_contacto = f.sk_tipo_contacto"""
_SUMS = """CAST(sum(cantidad) AS BIGINT) AS registros, CAST(sum(intentos) AS DOUBLE) AS intentos,
  CAST(coalesce(sum(cantidad) FILTER (tipo_contacto = 'CONTACTOS EFECTIVOS'), 0) AS BIGINT) AS efectivos,
  CAST(coalesce(sum(cantidad) FILTER (tipo_contacto = 'CONTACTOS NO EFECTIVOS'), 0) AS BIGINT)
    AS no_efectivos"""
_RATIOS = """efectivos + no_efectivos AS contactos,
  round(registros / nullif(intentos, 0), 6) AS pct_gestion,
  round((efectivos + no_efectivos) / nullif(CAST(registros AS DOUBLE), 0), 6) AS pct_contactabilidad,
  round(efectivos / nullif(CAST(registros AS DOUBLE), 0), 6) AS pct_efectivos,
  round(no_efectivos / nullif(CAST(registros AS DOUBLE), 0), 6) AS pct_no_efectivos"""
_TOTALS = {"typed": _TYPED, "sums": f"SELECT {_SUMS} FROM typed"}


@query("g8_records_delivered", "SELECT registros FROM sums", **_TOTALS)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.contact_totals(star(spark, sf)).select("registros")


@query(
    "g9_contacts",
    "SELECT efectivos, no_efectivos, efectivos + no_efectivos AS contactos FROM sums",
    **_TOTALS,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.contact_totals(star(spark, sf)).select("efectivos", "no_efectivos", "contactos")


_SHARES = ("pct_contactabilidad", "pct_efectivos", "pct_no_efectivos")


@query(
    "g10_contact_shares",
    f"SELECT {', '.join(_SHARES)} FROM (SELECT *, {_RATIOS} FROM sums)",
    **_TOTALS,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.contact_totals(star(spark, sf)).select(*_SHARES)


@query("g11_management_share", f"SELECT pct_gestion FROM (SELECT *, {_RATIOS} FROM sums)", **_TOTALS)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.contact_totals(star(spark, sf)).select("pct_gestion")


def _contacts(table: str, sk: str, attribute: str) -> dict[str, str]:
    return {
        "typed": _TYPED,
        "rated": f"""SELECT *, {_RATIOS} FROM (
          SELECT CASE WHEN d.{sk} = 0 THEN 'No informado' ELSE d.{attribute} END AS atributo, {_SUMS}
          FROM typed f JOIN {table} d ON d.{sk} = f.{sk} GROUP BY 1)""",
    }


_ALLY = ("dim_aliado", "sk_aliado", "nombre_aliado")
_CAMPAIGN = ("dim_campana", "sk_campana", "nombre_campana")
_SEGMENT = ("dim_segmento", "sk_segmento", "nombre_segmento")
_BRIEF = "atributo, contactos, registros, pct_contactabilidad"


@query(
    "g12_top_allies",
    f"SELECT {_BRIEF} FROM rated ORDER BY pct_contactabilidad DESC NULLS LAST, atributo LIMIT 5",
    **_contacts(*_ALLY),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.top_allies(star(spark, sf))


@query(
    "g13_best_campaigns",
    f"""SELECT {_BRIEF}, 1 AS puesto FROM rated
    WHERE pct_contactabilidad = (SELECT max(pct_contactabilidad) FROM rated)""",
    **_contacts(*_CAMPAIGN),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.best_campaigns(star(spark, sf))


@query(
    "g1_sales_of_business_quarter",
    """SELECT t.periodo_yyyymm AS mes, CAST(sum(valor_antes_iva) AS DOUBLE) AS ventas, count(*) AS filas
    FROM fact_ventas f JOIN dim_tiempo t ON t.sk_tiempo = f.sk_tiempo
    WHERE t.fecha IS NOT NULL AND t.mes <= 3 AND t.es_habil GROUP BY ALL""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    # Business days of first quarters: the other months' folders are pruned by the calendar.
    tables = star(spark, sf)
    days = F.col("fecha").isNotNull() & (F.col("mes") <= 3) & F.col("es_habil")
    sold = kpis.on_days(tables, days)["fact_ventas"].groupBy(F.col(PERIOD.name).cast("bigint").alias("mes"))
    total = F.sum("valor_antes_iva").cast("double").alias("ventas")
    return sold.agg(total, F.count("*").alias("filas"))


@query(
    "g4_compliance_of_one_month",
    """SELECT ventas_validas, presupuesto FROM (
      SELECT CAST(sum(valor_antes_iva) FILTER (v.es_venta_valida) AS DOUBLE) AS ventas_validas
      FROM fact_ventas f JOIN dim_tiempo t ON t.sk_tiempo = f.sk_tiempo
      JOIN dim_validez_venta v ON v.sk_validez = f.sk_validez WHERE t.periodo_yyyymm = 199603),
    (SELECT CAST(sum(tyt) AS DOUBLE) AS presupuesto FROM fact_presupuesto f
      JOIN dim_tiempo t ON t.sk_tiempo = f.sk_tiempo WHERE t.periodo_yyyymm = 199603)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    month = kpis.in_months(star(spark, sf), 199603, 199603)
    return kpis.overall_compliance(month).select("ventas_validas", "presupuesto")


@query(
    "g14_campaign_extremes",
    """SELECT 'mayor' AS extremo, atributo, registros FROM rated
      WHERE registros = (SELECT max(registros) FROM rated) UNION ALL
    SELECT 'menor', atributo, registros FROM rated
      WHERE registros = (SELECT min(registros) FROM rated)""",
    **_contacts(*_CAMPAIGN),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.campaign_extremes(star(spark, sf))


for _name, _where in {
    "g15_contacts_by_segment": _SEGMENT,
    "g15_contacts_by_campaign": _CAMPAIGN,
    "g15_contacts_by_ally": _ALLY,
}.items():

    def _register_contacts(name: str, table: str, sk: str, attribute: str) -> None:
        @query(name, "SELECT * FROM rated", **_contacts(table, sk, attribute))
        def _(spark: SparkSession, sf: str) -> DataFrame:
            return kpis.contacts_by(star(spark, sf), table, attribute)

    _register_contacts(_name, *_where)


# A four-digit amount per day, rounded half up to six digits in whole numbers.
_PER_DAY = """CAST(CAST((CAST(m.meta * 10000 AS HUGEINT) * 200 + b.dias_habiles)
  // (2 * b.dias_habiles) AS DOUBLE) / 1000000 AS DECIMAL(28,6))"""


def _daily(table: str, sk: str, attribute: str, reset: bool) -> dict[str, str]:
    label = f"CASE WHEN d.{sk} = 0 THEN 'No informado' ELSE d.{attribute} END"
    per = "g, periodo_yyyymm" if reset else "g"
    same = "AND s.periodo_yyyymm = c.periodo_yyyymm" if reset else ""
    return {
        "sold": _SOLD,
        "valid_days": f"""SELECT {label} AS g, t.fecha, {_VALID} AS ventas FROM sold f
          JOIN {table} d ON d.{sk} = f.{sk} JOIN dim_tiempo t ON t.sk_tiempo = f.sk_tiempo
          WHERE t.fecha IS NOT NULL GROUP BY 1, 2""",
        "months": f"""SELECT {label} AS g, t.periodo_yyyymm, sum(tyt) AS meta FROM fact_presupuesto f
          JOIN {table} d ON d.{sk} = f.{sk} JOIN dim_tiempo t ON t.sk_tiempo = f.sk_tiempo
          WHERE t.fecha IS NOT NULL GROUP BY 1, 2""",
        "days": f"""SELECT m.g, c.periodo_yyyymm, c.fecha, {_PER_DAY} AS meta,
            CAST(coalesce(v.ventas, 0) AS DECIMAL(38,6)) AS ventas
          FROM months m JOIN business_days b ON b.periodo_yyyymm = m.periodo_yyyymm
          JOIN calendar c ON c.periodo_yyyymm = m.periodo_yyyymm AND c.es_habil
          LEFT JOIN valid_days v ON v.g IS NOT DISTINCT FROM m.g AND v.fecha = c.fecha""",
        "steps": f"SELECT *, row_number() OVER (PARTITION BY {per} ORDER BY fecha) AS i FROM days",
        "carry": f"""SELECT g, periodo_yyyymm, fecha, meta, ventas, i,
            CAST(greatest(0, meta - ventas) AS DECIMAL(38,6)) AS deficit,
            CAST(meta AS DECIMAL(38,6)) AS efectiva FROM steps WHERE i = 1
          UNION ALL
          SELECT s.g, s.periodo_yyyymm, s.fecha, s.meta, s.ventas, s.i,
            CAST(greatest(0, s.meta + c.deficit - s.ventas) AS DECIMAL(38,6)),
            CAST(s.meta + c.deficit AS DECIMAL(38,6))
          FROM carry c JOIN steps s ON s.g IS NOT DISTINCT FROM c.g AND s.i = c.i + 1 {same}""",
    }


_DAILY_OUT = """SELECT g AS atributo, CAST(fecha AS VARCHAR) AS fecha,
  CAST(meta AS DOUBLE) AS meta_diaria, CAST(ventas AS DOUBLE) AS ventas,
  CAST(deficit AS DOUBLE) AS deficit, CAST(efectiva AS DOUBLE) AS meta_efectiva FROM carry"""


@query(
    "g16_daily_compliance_by_region",
    _DAILY_OUT,
    **_daily("dim_region", "sk_region", "nombre_region", reset=False),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.daily_compliance(star(spark, sf), "dim_region", "nombre_region")


@query(
    "g16_daily_compliance_monthly",
    _DAILY_OUT,
    **_daily("dim_jerarquia_comercial", "sk_jerarquia", "gerente", reset=True),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return kpis.daily_compliance(
        star(spark, sf), "dim_jerarquia_comercial", "gerente", reset_monthly=True
    )


@query(
    "g16_sales_off_business_days",
    """SELECT count(*) AS dias_grupo, CAST(sum(ventas) AS DOUBLE) AS ventas_fuera FROM (
      SELECT sk_region, sk_tiempo, sum(valor_antes_iva) AS ventas FROM sold
      WHERE es_venta_valida GROUP BY ALL) s
    WHERE NOT EXISTS (SELECT 1 FROM dim_tiempo t WHERE t.sk_tiempo = s.sk_tiempo AND t.es_habil)""",
    sold=_SOLD,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    tables = star(spark, sf)
    sums = kpis.sales_sums(tables, None, "sk_region", "sk_tiempo").where("ventas_validas <> 0")
    business = tables["dim_tiempo"].where("fecha is not null and es_habil").select("sk_tiempo")
    off = sums.join(business, "sk_tiempo", "left_anti")
    return off.agg(
        F.count("*").alias("dias_grupo"), F.sum("ventas_validas").alias("ventas_fuera")
    )
