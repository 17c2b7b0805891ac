"""Queries for business rules, targets and the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.operators import calendar as cal
from lonja.operators import clean, rules, targets
from lonja.operators import dimensions as dims
from lonja.plans.registry import query
from lonja.sources import analogues as src
from lonja.sources.staging import ordinal


def _invoices(spark: SparkSession, sf: str) -> DataFrame:
    """Sales with every form of missing invoice and of credit-note marker."""
    code, note = F.col("codigo_factura"), F.col("nota_credito")
    return (
        src.sales(
            spark, sf, ["codigo_factura", "nota_credito", "cedula_vendedor", "valor_antes_de_iva"]
        )
        .withColumn(
            "codigo_factura",
            F.when(code.endswith("-2"), F.lit(" \t"))
            .when(code.endswith("-3"), F.lit("<NA>"))
            .otherwise(code),
        )
        .withColumn(
            "nota_credito",
            F.when(F.col("cedula_vendedor").endswith("7"), F.lower(note))
            .when(F.col("cedula_vendedor").endswith("8"), F.lit("NO"))
            .otherwise(note),
        )
    )


_INVOICES = """SELECT valor_antes_de_iva, cedula_vendedor,
  CASE WHEN codigo_factura LIKE '%-2' THEN chr(32) || chr(9) WHEN codigo_factura LIKE '%-3' THEN '<NA>'
    ELSE codigo_factura END AS codigo_factura,
  CASE WHEN cedula_vendedor LIKE '%7' THEN lower(nota_credito)
    WHEN cedula_vendedor LIKE '%8' THEN 'NO' ELSE nota_credito END AS nota_credito FROM sales"""
_FLAGGED = """SELECT *, coalesce(upper(nota_credito) = 'SI', false) AS tiene_nota_credito,
  coalesce(trim(codigo_factura, chr(32) || chr(9)) <> '' AND codigo_factura <> '<NA>', false)
    AS tiene_factura FROM invoices"""


@query(
    "c1_required_columns",
    """SELECT gv_desc2, gv_gerente_area, gv_jefe_1_canal_regional, gv_especialista,
    count(*) AS filas FROM sales GROUP BY ALL""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    required = list(rules.SALES_REQUIRED)
    checked = rules.require_columns(src.sales(spark, sf, required), required, "ventas")
    return checked.groupBy(*required).agg(F.count("*").alias("filas"))


@query(
    "c2_credit_note",
    "SELECT nota_credito, tiene_nota_credito, count(*) AS filas FROM flagged GROUP BY ALL",
    invoices=_INVOICES,
    flagged=_FLAGGED,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    flagged = rules.sale_validity(_invoices(spark, sf), "tiene_nota_credito")
    return flagged.groupBy("nota_credito", "tiene_nota_credito").agg(F.count("*").alias("filas"))


@query(
    "c3_valid_sale",
    """SELECT codigo_factura, tiene_factura, tiene_nota_credito,
      tiene_factura AND NOT tiene_nota_credito AS es_venta_valida, count(*) AS filas,
      CAST(sum(valor_antes_de_iva) AS DOUBLE) AS total FROM flagged GROUP BY ALL""",
    invoices=_INVOICES,
    flagged=_FLAGGED,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    flagged = rules.sale_validity(_invoices(spark, sf))
    return flagged.groupBy(
        "codigo_factura", "tiene_factura", "tiene_nota_credito", "es_venta_valida"
    ).agg(F.count("*").alias("filas"), F.sum("valor_antes_de_iva").alias("total"))


@query(
    "c4_validity_code",
    """SELECT CASE WHEN tiene_factura AND NOT tiene_nota_credito THEN 1
      WHEN NOT tiene_factura AND NOT tiene_nota_credito THEN 2
      WHEN tiene_factura THEN 3 ELSE 4 END AS sk_validez, count(*) AS filas
    FROM flagged GROUP BY ALL""",
    invoices=_INVOICES,
    flagged=_FLAGGED,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    coded = rules.sale_validity(_invoices(spark, sf))
    return coded.groupBy("sk_validez").agg(F.count("*").alias("filas"))


@query(
    "c5_contact_flags",
    """SELECT tipo_contacto, tipo_contacto = 'CONTACTOS EFECTIVOS' AS es_contacto_efectivo,
      tipo_contacto = 'CONTACTOS NO EFECTIVOS' AS es_contacto_no_efectivo,
      tipo_contacto = 'NO CONTACTOS' AS es_no_contacto, count(*) AS filas,
      CAST(sum(cantidad) AS BIGINT) AS cantidad FROM contacts GROUP BY ALL""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    # Typed with other case and padding; the flags must not depend on it.
    kind = F.concat(F.lit(" "), F.initcap("tipo_contacto"), F.lit("\t"))
    flagged = rules.flag_contact_type(src.contacts(spark, sf).withColumn("tipo_contacto", kind))
    return (
        flagged.withColumn("tipo_contacto", F.upper(F.trim(F.btrim("tipo_contacto", F.lit(" \t")))))
        .groupBy("tipo_contacto", *rules.CONTACT_FLAGS)
        .agg(F.count("*").alias("filas"), F.sum("cantidad").alias("cantidad"))
    )


@query(
    "c6_outbound_scope",
    """SELECT nombre_campana, true AS es_alcance_tmk_outbound, count(*) AS filas
    FROM contacts GROUP BY ALL""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    marked = rules.mark_outbound_scope(src.contacts(spark, sf))
    return marked.groupBy("nombre_campana", "es_alcance_tmk_outbound").agg(
        F.count("*").alias("filas")
    )


@query(
    "c7_no_channel_key",
    """SELECT event_id, cantidad, CAST(intentos AS DOUBLE) AS intentos FROM contact_events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    records = src.contacts(spark, sf, keys=True).select("event_id", "cantidad", "intentos")
    return rules.drop_channel_key(records.withColumn("sk_canal", F.lit(7)))


@query(
    "c8_grain_totals",
    """SELECT 'antes' AS etapa, count(*) AS filas, CAST(sum(valor_antes_de_iva) AS DOUBLE) AS total
    FROM sales UNION ALL
    SELECT 'despues', count(*), CAST(sum(valor_antes_de_iva) AS DOUBLE) FROM sales""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    columns = [*rules.SALES_REQUIRED, "codigo_factura", "nota_credito", "valor_antes_de_iva"]
    before = src.sales(spark, sf, columns)
    return rules.grain_totals(
        {"antes": before, "despues": rules.sales_rules(before)}, "valor_antes_de_iva"
    )


@query("c9_business_days", "SELECT periodo_yyyymm, dias_habiles FROM business_days")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return cal.business_days(src.calendar(spark, sf))


def _ruled_budget(spark: SparkSession, sf: str) -> DataFrame:
    raw = src.under_headers(src.budget(spark, sf), "presupuesto")
    days = cal.business_days(src.calendar(spark, sf))
    return rules.budget_rules(clean.clean_budget(raw), days)


@query(
    "c10_budget_business_days",
    """SELECT CAST(mes AS VARCHAR) AS mes, dias_habiles_mes, count(*) AS filas
    FROM presupuesto GROUP BY ALL""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _ruled_budget(spark, sf).groupBy("mes", "dias_habiles_mes").agg(
        F.count("*").alias("filas")
    )


# A four-digit amount per day, rounded half up to six digits in whole numbers: DuckDB divides
# decimals as doubles, which misses exact halves.
_PER_DAY = """CAST(CAST((CAST({0} * 10000 AS HUGEINT) * 200 + {1}) // (2 * {1}) AS DOUBLE) / 1000000
  AS DECIMAL(28,6))"""
_TERMINALS = _PER_DAY.format("terminales", "dias_habiles_mes")
_TOTAL = _PER_DAY.format("t_t", "dias_habiles_mes")


@query(
    "c11_daily_target",
    f"""SELECT CAST(mes AS VARCHAR) AS mes, region, canal, canal2, unidad_de_gestion,
      CAST(terminales AS DOUBLE) AS terminales, CAST(t_t AS DOUBLE) AS t_t,
      CASE WHEN dias_habiles_mes > 0 THEN CAST({_TERMINALS} AS DOUBLE) END AS meta_terminales,
      CASE WHEN dias_habiles_mes > 0 THEN CAST({_TOTAL} AS DOUBLE) END AS meta_tyt
    FROM presupuesto""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    daily = targets.with_daily_target(_ruled_budget(spark, sf), "terminales", "meta_terminales")
    daily = targets.with_daily_target(daily, "t_t", "meta_tyt")
    columns = ["mes", "region", "canal", "canal2", "unidad_de_gestion", "terminales", "t_t"]
    return daily.select(*columns, "meta_terminales", "meta_tyt")


def _spine(spark: SparkSession, sf: str) -> DataFrame:
    """Days with target and valid sales per channel."""
    monthly = (
        src.budget(spark, sf)
        .groupBy("canal", F.col("mes").alias("periodo_yyyymm"))
        .agg(F.sum(F.coalesce("t_t", F.col("terminales") + F.col("tecnologia"))).alias("meta_mensual"))
    )
    return targets.day_spine(monthly, _daily_sales(spark, sf), src.calendar(spark, sf), ["canal"])


def _daily_sales(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["canal", "fecha_venta", "codigo_factura", "nota_credito", "valor_antes_de_iva"]
    valid = rules.sale_validity(src.sales(spark, sf, columns)).where("es_venta_valida")
    dated = clean.parse_yyyymmdd(valid, ["fecha_venta"])
    return dated.groupBy("canal", F.col("fecha_venta").alias("fecha")).agg(
        F.sum("valor_antes_de_iva").alias("ventas")
    )


_VALID_DAYS = """SELECT canal, CAST(strptime(CAST(fecha_venta AS VARCHAR), '%Y%m%d') AS DATE) AS fecha,
    sum(valor_antes_de_iva) AS ventas FROM sales
  WHERE codigo_factura IS NOT NULL AND nota_credito IS NULL GROUP BY ALL"""
_DAYS = f"""SELECT m.canal, c.fecha, {_PER_DAY.format("m.meta", "b.dias_habiles")} AS meta_diaria,
    CAST(coalesce(v.ventas, 0) AS DECIMAL(38,6)) AS ventas
  FROM (SELECT canal, mes, sum(coalesce(t_t, terminales + tecnologia)) AS meta FROM budget
    GROUP BY ALL) m
  JOIN business_days b ON b.periodo_yyyymm = m.mes
  JOIN calendar c ON c.periodo_yyyymm = m.mes AND c.es_habil
  LEFT JOIN valid_days v ON v.canal = m.canal AND v.fecha = c.fecha"""
_STEPS = "SELECT *, row_number() OVER (PARTITION BY canal ORDER BY fecha) AS i FROM days"
_CARRY = """SELECT canal, fecha, meta_diaria, ventas, i,
    CAST(greatest(0, meta_diaria - ventas) AS DECIMAL(38,6)) AS deficit,
    CAST(meta_diaria AS DECIMAL(38,6)) AS meta_efectiva FROM steps WHERE i = 1
  UNION ALL
  SELECT s.canal, s.fecha, s.meta_diaria, s.ventas, s.i,
    CAST(greatest(0, s.meta_diaria + c.deficit - s.ventas) AS DECIMAL(38,6)),
    CAST(s.meta_diaria + c.deficit AS DECIMAL(38,6))
  FROM carry c JOIN steps s ON s.canal = c.canal AND s.i = c.i + 1"""
_DAY_OUT = """canal, CAST(fecha AS VARCHAR) AS fecha, CAST(meta_diaria AS DOUBLE) AS meta_diaria,
  CAST(ventas AS DOUBLE) AS ventas"""


@query(
    "c12_deficit_carry",
    f"""SELECT {_DAY_OUT}, CAST(deficit AS DOUBLE) AS deficit,
      CAST(meta_efectiva AS DOUBLE) AS meta_efectiva FROM carry""",
    valid_days=_VALID_DAYS,
    days=_DAYS,
    steps=_STEPS,
    carry=_CARRY,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return targets.carry_deficit(_spine(spark, sf), ["canal"])


@query("c13_day_spine", f"SELECT {_DAY_OUT} FROM days", valid_days=_VALID_DAYS, days=_DAYS)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _spine(spark, sf)


@query(
    "c13_sales_off_spine",
    """SELECT count(*) AS dias_grupo, CAST(sum(ventas) AS DOUBLE) AS ventas_fuera FROM valid_days v
    WHERE NOT EXISTS (SELECT 1 FROM calendar c WHERE c.fecha = v.fecha AND c.es_habil)""",
    valid_days=_VALID_DAYS,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return targets.sales_off_spine(_daily_sales(spark, sf), src.calendar(spark, sf))


@query(
    "c14_known_key",
    """SELECT CASE WHEN l_suppkey % 7 IN (0, 1, 2) THEN 0 ELSE l_suppkey END AS sk,
      count(*) AS filas FROM lineitem GROUP BY ALL""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    key = F.expr(
        """CASE l_suppkey % 7 WHEN 0 THEN NULL WHEN 1 THEN concat('-', l_suppkey + 1)
        WHEN 2 THEN concat('K', l_suppkey) WHEN 3 THEN concat(' ', l_suppkey, ' ')
        ELSE cast(l_suppkey as string) END"""
    )
    lines = src.table(spark, sf, "lineitem").select(rules.known_key(key).alias("sk"))
    return lines.groupBy("sk").agg(F.count("*").alias("filas"))


@query(
    "c15_resolve_key",
    """SELECT gv_desc2 AS aliado, CASE WHEN gv_desc2 IS NULL OR gv_desc2 IN ('A5', 'A7') THEN 0
      ELSE CAST(substr(gv_desc2, 2) AS BIGINT) END AS sk, count(*) AS filas FROM sales GROUP BY ALL""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    spec = dims.TEXT_DIMENSIONS["dim_aliado"]
    events = src.sales(spark, sf, ["gv_desc2", "cedula_vendedor"])
    known = dims.members(spec, {"ventas": events}).where("aliado_nk not in ('A5', 'A7')")
    mapping = known.select("aliado_nk", F.expr("cast(substr(aliado_nk, 2) as bigint)").alias("sk"))
    padded = F.when(
        F.col("cedula_vendedor").endswith("3"), F.concat(F.lit(" "), "gv_desc2", F.lit("\t"))
    ).otherwise(F.col("gv_desc2"))
    resolved = rules.resolve_key(
        events.select(padded.alias("nk"), "gv_desc2"), "nk", mapping, "sk", "aliado_nk", "sk"
    )
    return resolved.groupBy(F.col("gv_desc2").alias("aliado"), "sk").agg(
        F.count("*").alias("filas")
    )


@query(
    "c16_sales_rules",
    """SELECT CAST(fecha_venta AS VARCHAR) AS fecha_venta, codigo_factura, identificacion,
      cedula_vendedor, CAST(valor_antes_de_iva AS DOUBLE) AS valor_antes_de_iva,
      tiene_nota_credito, tiene_factura, es_venta_valida, sk_validez FROM ventas""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    ruled = rules.sales_rules(clean.clean_sales(src.sales_raw(spark, sf)))
    return ruled.select(
        "fecha_venta",
        "codigo_factura",
        "identificacion",
        "cedula_vendedor",
        "valor_antes_de_iva",
        "tiene_nota_credito",
        "tiene_factura",
        "es_venta_valida",
        "sk_validez",
    )


@query(
    "c17_budget_rules",
    """SELECT * REPLACE (CAST(mes AS VARCHAR) AS mes, CAST(terminales AS DOUBLE) AS terminales,
      CAST(tecnologia AS DOUBLE) AS tecnologia, CAST(t_t AS DOUBLE) AS t_t) FROM presupuesto""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _ruled_budget(spark, sf)


@query(
    "c18_contact_rules",
    """SELECT * REPLACE (CAST(periodo AS VARCHAR) AS periodo,
      CAST(fecha_gestion AS VARCHAR) AS fecha_gestion, CAST(fecha_cargue AS VARCHAR) AS fecha_cargue,
      CAST(intentos AS DOUBLE) AS intentos) FROM registros""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    raw = src.under_headers(src.contacts(spark, sf), "registros")
    return rules.contact_rules(clean.clean_contacts(raw))


@query("d1_date_spine", "SELECT CAST(fecha AS VARCHAR) AS fecha FROM spine")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return cal.date_spine(src.years(spark, sf))


@query("d2_calendar", "SELECT * REPLACE (CAST(fecha AS VARCHAR) AS fecha) FROM calendar")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return src.calendar(spark, sf)


def _calendar_merge(spark: SparkSession, sf: str) -> DataFrame:
    """All years with holidays merged into a calendar that ends in 1997 and has none."""
    years = src.years(spark, sf)
    days = src.calendar(spark, sf)
    no_holidays = days.where("false").select("fecha", "nombre_festivo")
    older = cal.calendar_days(cal.date_spine(years.where("anio <= 1997")), no_holidays)
    numbered = ordinal(older, [F.col("fecha")], "sk_tiempo")
    existing = dims.ensure_seeds(
        numbered.select(*dims.STAR["dim_tiempo"].names), "dim_tiempo"
    )
    return dims.merge_members(existing, days, dims.CALENDAR)


_OLDER = "SELECT *, row_number() OVER (ORDER BY fecha) AS sk FROM calendar WHERE anio <= 1997"


@query(
    "d3_calendar_merge",
    """SELECT 0 AS sk_tiempo, CAST(NULL AS VARCHAR) AS fecha, CAST(NULL AS VARCHAR) AS nombre_festivo,
      false AS es_habil, 0 AS periodo_yyyymm, 'kept' AS accion UNION ALL
    SELECT sk, CAST(fecha AS VARCHAR), nombre_festivo, es_habil, periodo_yyyymm, 'updated'
    FROM older_days UNION ALL
    SELECT (SELECT max(sk) FROM older_days) + row_number() OVER (ORDER BY fecha),
      CAST(fecha AS VARCHAR), nombre_festivo, es_habil, periodo_yyyymm, 'inserted'
    FROM calendar WHERE anio > 1997""",
    older_days=_OLDER,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _calendar_merge(spark, sf).select(
        "sk_tiempo",
        "fecha",
        "nombre_festivo",
        "es_habil",
        "periodo_yyyymm",
        F.col("_action").alias("accion"),
    )


@query(
    "d3_calendar_merge_counts",
    """SELECT count(*) FILTER (anio > 1997) AS inserted, count(*) FILTER (anio <= 1997) AS updated,
      0 AS skipped FROM calendar""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return dims.merge_counts(_calendar_merge(spark, sf))


@query(
    "d4_calendar_loaded",
    """SELECT count(*) AS dias, CAST(min(fecha) AS VARCHAR) AS primero,
      CAST(max(fecha) AS VARCHAR) AS ultimo FROM calendar""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    days = cal.require_calendar(src.calendar(spark, sf))
    return days.agg(
        F.count("*").alias("dias"), F.min("fecha").alias("primero"), F.max("fecha").alias("ultimo")
    )
