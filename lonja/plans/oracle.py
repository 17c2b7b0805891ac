"""DuckDB statements that answer the registered queries from the same tables.

Each statement is a body over shared views; ``statement`` puts in front the views it uses.
Money leaves as double and dates as ISO text, as in the registered queries.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

VIEWS["sales"] = """
SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS fecha_venta,
  CAST(strftime(l_shipdate + INTERVAL 3 DAY, '%Y%m%d') AS BIGINT) AS fecha_finalizacion_reserva,
  CASE WHEN l_linestatus = 'O' THEN 'Tramitada' ELSE 'Activated' END AS descripcion_estado_reserva,
  'C' || o_custkey AS identificacion,
  CASE WHEN l_linenumber = 1 THEN l_quantity END AS cuotas,
  CASE WHEN l_suppkey % 50 = 0 THEN '-' ELSE CAST(l_suppkey AS VARCHAR) END AS cedula_vendedor,
  r.r_name AS region_comercial,
  'archivo_' || l_linestatus AS archivo,
  CASE WHEN l_linestatus = 'F' THEN 'F' || l_orderkey || '-' || l_linenumber END AS codigo_factura,
  'D' || n2.n_regionkey AS gv_division,
  CASE WHEN l_suppkey % 3 <> 0 THEN s_name END AS gv_especialista,
  CASE WHEN l_suppkey % 3 <> 0 THEN n2.n_name END AS gv_jefe_1_canal_regional,
  o_orderpriority AS canal, o_orderstatus AS canal2,
  CASE WHEN l_suppkey % 10 <> 0 THEN 'A' || (l_suppkey % 20) END AS gv_desc2,
  p_type AS categoria,
  CAST(year(l_shipdate) % 100 AS BIGINT) AS ano, CAST(month(l_shipdate) AS BIGINT) AS mes,
  CAST(day(l_shipdate) AS BIGINT) AS dia,
  r.r_name AS d_division, 'G' || n2.n_regionkey AS gv_gerente_area,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
    AS DECIMAL(18,2)) AS valor_antes_de_iva,
  p_brand AS marca,
  CASE WHEN l_returnflag = 'R' THEN 'SI' END AS nota_credito
FROM lineitem
LEFT JOIN orders ON o_orderkey = l_orderkey
LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation n1 ON n1.n_nationkey = c_nationkey
LEFT JOIN region r ON r.r_regionkey = n1.n_regionkey
LEFT JOIN part ON p_partkey = l_partkey
LEFT JOIN supplier ON s_suppkey = l_suppkey
LEFT JOIN nation n2 ON n2.n_nationkey = s_nationkey"""

VIEWS["sales_raw"] = """
SELECT * FROM sales UNION ALL SELECT * FROM sales WHERE codigo_factura LIKE '%000-%'"""

VIEWS["budget_once"] = """
SELECT mes, region, canal, canal2, nullif(seg, 'BUILDING') AS sub_canal, 'STANDARD' AS categoria,
  seg AS unidad_de_gestion, CAST(NULL AS VARCHAR) AS especialista, CAST(NULL AS VARCHAR) AS jefe,
  'G' || rk AS gerente, 'A' || rk AS descrip2, terminales,
  CAST(terminales * CAST('0.25' AS DECIMAL(5,2)) AS DECIMAL(20,4)) AS tecnologia,
  CASE WHEN seg <> 'FURNITURE'
    THEN CAST(terminales * CAST('1.25' AS DECIMAL(5,2)) AS DECIMAL(20,4)) END AS t_t
FROM (SELECT CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS mes, r_name AS region,
    r_regionkey AS rk, o_orderpriority AS canal, o_orderstatus AS canal2, c_mktsegment AS seg,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) * CAST('0.2135' AS DECIMAL(5,4))
      AS DECIMAL(20,4)) AS terminales
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
  GROUP BY ALL)"""

VIEWS["budget"] = """
SELECT * FROM budget_once UNION ALL
SELECT * REPLACE (
  CAST(terminales * CAST('0.1' AS DECIMAL(5,1)) AS DECIMAL(20,4)) AS terminales,
  CAST(tecnologia * CAST('0.1' AS DECIMAL(5,1)) AS DECIMAL(20,4)) AS tecnologia,
  CAST(t_t * CAST('0.1' AS DECIMAL(5,1)) AS DECIMAL(20,4)) AS t_t)
FROM budget_once WHERE mes = 199603 AND region = 'ASIA'"""

VIEWS["contact_events"] = """
SELECT event_id, CAST(1 + event_id % 5 AS BIGINT) AS cantidad,
  CASE WHEN user_id % 31 = 0 THEN 'SIN_REGION' ELSE r_name END AS division_comercial,
  'C' || lpad(CAST(user_id % 24 AS VARCHAR), 2, '0') AS nombre_campana,
  CAST(strftime(ts, '%Y%m') AS BIGINT) AS periodo,
  CASE WHEN event_id % 67 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS fecha_gestion,
  CASE WHEN event_id % 67 = 0 THEN NULL
    WHEN event_type IN ('purchase', 'signup') THEN 'CONTACTOS EFECTIVOS'
    WHEN event_type = 'click' THEN 'CONTACTOS NO EFECTIVOS' ELSE 'NO CONTACTOS'
    END AS tipo_contacto,
  event_type AS detalle1,
  CAST((1 + event_id % 5) * (1 + user_id % 4) AS DECIMAL(18,2)) AS intentos,
  strftime(last_day(CAST(ts AS DATE)), '%Y-%m-%d') AS fecha_cargue,
  CASE WHEN user_id % 2 <> 0 THEN 'AREA' || (user_id % 3) END AS area_comercial,
  'S' || (CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) % 9) AS segmento,
  CAST(day(ts) AS BIGINT) AS dia, 'A' || (user_id % 20) AS aliado, 'G' || (user_id % 5) AS gerente,
  CAST(NULL AS VARCHAR) AS jefe, CAST(NULL AS VARCHAR) AS especialista
FROM events LEFT JOIN region ON r_regionkey = user_id % 5"""

VIEWS["contacts"] = "SELECT * EXCLUDE (event_id) FROM contact_events"

VIEWS["years"] = """
SELECT DISTINCT anio FROM (
  SELECT unnest(range(a, b + 1)) AS anio FROM (
    SELECT min(year(o_orderdate)) AS a, max(year(o_orderdate)) - 1 AS b FROM orders
    UNION ALL SELECT min(year(ts)), max(year(ts)) FROM events))"""

VIEWS["holidays"] = """
SELECT DISTINCT CAST(anio || '-' || md AS DATE) AS fecha, nombre FROM years, (VALUES
  ('01-01', 'Año Nuevo'), ('05-01', 'Día del Trabajo'), ('07-20', 'Independencia'),
  ('08-07', 'Batalla de Boyacá'), ('12-08', 'Inmaculada Concepción'), ('12-25', 'Navidad')
  ) AS h(md, nombre)"""

VIEWS["spine"] = """
SELECT CAST(unnest(generate_series(make_date(anio, 1, 1), make_date(anio, 12, 31),
  INTERVAL 1 DAY)) AS DATE) AS fecha FROM years"""

VIEWS["calendar"] = """
SELECT s.fecha, year(s.fecha) AS anio, month(s.fecha) AS mes, day(s.fecha) AS dia,
  year(s.fecha) * 100 + month(s.fecha) AS periodo_yyyymm, monthname(s.fecha) AS nombre_mes,
  isodow(s.fecha) AS dia_semana,
  isodow(s.fecha) <> 7 AND nombre IS NULL AS es_dia_habil, nombre IS NOT NULL AS es_festivo_co,
  isodow(s.fecha) = 7 AS es_fin_semana, nombre IS NOT NULL AS es_festivo,
  nombre AS nombre_festivo, isodow(s.fecha) <> 7 AND nombre IS NULL AS es_habil
FROM spine s LEFT JOIN holidays h ON h.fecha = s.fecha"""

VIEWS["business_days"] = """
SELECT periodo_yyyymm, count(*) AS dias_habiles FROM calendar WHERE es_habil GROUP BY 1"""

# Cleaned and ruled sources.
VIEWS["sales_clean"] = """
SELECT DISTINCT * REPLACE (
  CAST(strptime(CAST(fecha_venta AS VARCHAR), '%Y%m%d') AS DATE) AS fecha_venta,
  CAST(strptime(CAST(fecha_finalizacion_reserva AS VARCHAR), '%Y%m%d') AS DATE)
    AS fecha_finalizacion_reserva,
  CAST(cuotas AS DECIMAL(8,2)) AS cuotas)
FROM sales_raw"""
VIEWS["budget_clean"] = """
SELECT * REPLACE (make_date(CAST(mes // 100 AS BIGINT), CAST(mes % 100 AS BIGINT), 1) AS mes)
FROM budget"""
VIEWS["contacts_clean"] = """
SELECT DISTINCT * REPLACE (
  make_date(CAST(periodo // 100 AS BIGINT), CAST(periodo % 100 AS BIGINT), 1) AS periodo,
  CAST(fecha_gestion AS DATE) AS fecha_gestion, CAST(fecha_cargue AS DATE) AS fecha_cargue)
FROM contacts"""
VIEWS["ventas"] = """
SELECT *, coalesce(nota_credito = 'SI', false) AS tiene_nota_credito,
  codigo_factura IS NOT NULL AS tiene_factura,
  codigo_factura IS NOT NULL AND coalesce(nota_credito <> 'SI', true) AS es_venta_valida,
  CASE WHEN codigo_factura IS NOT NULL AND nota_credito IS NULL THEN 1
    WHEN codigo_factura IS NULL AND nota_credito IS NULL THEN 2
    WHEN codigo_factura IS NOT NULL THEN 3 ELSE 4 END AS sk_validez
FROM sales_clean"""
VIEWS["presupuesto"] = """
SELECT b.*, coalesce(dias_habiles, 0) AS dias_habiles_mes FROM budget_clean b
LEFT JOIN business_days d ON d.periodo_yyyymm = year(b.mes) * 100 + month(b.mes)"""
VIEWS["registros"] = """
SELECT *, true AS es_alcance_tmk_outbound,
  tipo_contacto = 'CONTACTOS EFECTIVOS' AS es_contacto_efectivo,
  tipo_contacto = 'CONTACTOS NO EFECTIVOS' AS es_contacto_no_efectivo,
  tipo_contacto = 'NO CONTACTOS' AS es_no_contacto
FROM contacts_clean"""


def _single(sk: str, key: str, sources: str, extra: str, seed: str) -> str:
    return f"""
SELECT 0 AS {sk}, 'NO_INFORMADO' AS {key}, {seed} UNION ALL
SELECT row_number() OVER (ORDER BY {key}), {key}, {extra}
FROM (SELECT DISTINCT {key} FROM ({sources}) WHERE {key} IS NOT NULL)"""


VIEWS["dim_region"] = _single(
    "sk_region",
    "region_nk",
    "SELECT region_comercial AS region_nk FROM ventas UNION SELECT region FROM presupuesto"
    " UNION SELECT division_comercial FROM registros",
    "region_nk, upper(region_nk) LIKE '%SIN%'",
    "'No informado' AS nombre_region, true AS es_sin_region",
)
VIEWS["dim_categoria"] = _single(
    "sk_categoria",
    "categoria_nk",
    "SELECT categoria AS categoria_nk FROM ventas UNION SELECT categoria FROM presupuesto",
    "categoria_nk",
    "'No informado' AS nombre_categoria",
)
VIEWS["dim_aliado"] = _single(
    "sk_aliado",
    "aliado_nk",
    "SELECT gv_desc2 AS aliado_nk FROM ventas UNION SELECT descrip2 FROM presupuesto"
    " UNION SELECT aliado FROM registros",
    "aliado_nk",
    "'No informado' AS nombre_aliado",
)
VIEWS["dim_unidad_gestion"] = _single(
    "sk_unidad_gestion",
    "unidad_gestion_nk",
    "SELECT unidad_de_gestion AS unidad_gestion_nk FROM presupuesto",
    "unidad_gestion_nk",
    "'No informado' AS nombre_unidad_gestion",
)
VIEWS["dim_marca"] = _single(
    "sk_marca",
    "marca_nk",
    "SELECT marca AS marca_nk FROM ventas",
    "marca_nk",
    "'No informado' AS nombre_marca",
)
VIEWS["dim_vendedor"] = _single(
    "sk_vendedor",
    "cedula_vendedor_nk",
    "SELECT cedula_vendedor AS cedula_vendedor_nk FROM ventas",
    "NULL",
    "'No informado' AS nombre_vendedor",
)
VIEWS["dim_campana"] = _single(
    "sk_campana",
    "campana_nk",
    "SELECT nombre_campana AS campana_nk FROM registros",
    "campana_nk",
    "'No informado' AS nombre_campana",
)
VIEWS["dim_segmento"] = _single(
    "sk_segmento",
    "segmento_nk",
    "SELECT segmento AS segmento_nk FROM registros",
    "segmento_nk, segmento_nk",
    "'No informado' AS segmento_normalizado, 'No informado' AS nombre_segmento",
)
VIEWS["dim_canal"] = """
SELECT 0 AS sk_canal, 'NO_INFORMADO' AS canal, CAST(NULL AS VARCHAR) AS canal2, CAST(NULL AS VARCHAR) AS sub_canal UNION ALL
SELECT row_number() OVER (ORDER BY canal NULLS LAST, canal2 NULLS LAST, sub_canal NULLS LAST), *
FROM (SELECT canal, canal2, CAST(NULL AS VARCHAR) AS sub_canal FROM ventas
  UNION SELECT canal, canal2, sub_canal FROM presupuesto) WHERE canal IS NOT NULL"""
VIEWS["dim_tipo_contacto"] = """
SELECT 0 AS sk_tipo_contacto, 'NO_INFORMADO' AS tipo_contacto, CAST(NULL AS VARCHAR) AS detalle_contacto,
  'No informado' AS nombre_tipo_contacto UNION ALL
SELECT row_number() OVER (ORDER BY tipo_contacto, detalle1 NULLS LAST), tipo_contacto, detalle1,
  tipo_contacto
FROM (SELECT DISTINCT tipo_contacto, detalle1 FROM registros WHERE tipo_contacto IS NOT NULL)"""
VIEWS["dim_jerarquia_comercial"] = """
SELECT 0 AS sk_jerarquia, 'No informado' AS gerente, 'No informado' AS jefe,
  'No informado' AS especialista UNION ALL
SELECT row_number() OVER (ORDER BY g NULLS LAST, j NULLS LAST, e NULLS LAST), g, j, e
FROM (SELECT gv_gerente_area AS g, gv_jefe_1_canal_regional AS j, gv_especialista AS e FROM ventas
  UNION SELECT gerente, jefe, especialista FROM presupuesto
  UNION SELECT gerente, jefe, especialista FROM registros)"""
VIEWS["dim_validez_venta"] = """
SELECT * FROM (VALUES (1, true, false, true, 'Venta valida'), (2, false, false, false, 'Sin factura'),
  (3, true, true, false, 'Con nota credito'),
  (4, false, true, false, 'Sin factura con nota credito'))
  AS v(sk_validez, tiene_factura, tiene_nota_credito, es_venta_valida, descripcion)"""
VIEWS["dim_tiempo"] = """
SELECT 0 AS sk_tiempo, CAST(NULL AS DATE) AS fecha, 0 AS anio, 1 AS mes, CAST(NULL AS BIGINT) AS dia, 0 AS periodo_yyyymm,
  'No informado' AS nombre_mes, CAST(NULL AS BIGINT) AS dia_semana, false AS es_dia_habil,
  false AS es_festivo_co, CAST(NULL AS BOOLEAN) AS es_fin_semana, false AS es_festivo,
  CAST(NULL AS VARCHAR) AS nombre_festivo,
  false AS es_habil UNION ALL
SELECT row_number() OVER (ORDER BY fecha), * FROM calendar"""

VIEWS["fact_ventas"] = """
SELECT coalesce(t.sk_tiempo, 0) AS sk_tiempo, coalesce(r.sk_region, 0) AS sk_region,
  coalesce(c.sk_canal, 0) AS sk_canal, coalesce(g.sk_categoria, 0) AS sk_categoria,
  coalesce(j.sk_jerarquia, 0) AS sk_jerarquia, coalesce(a.sk_aliado, 0) AS sk_aliado,
  coalesce(m.sk_marca, 0) AS sk_marca, coalesce(d.sk_vendedor, 0) AS sk_vendedor,
  v.sk_validez, v.codigo_factura, v.valor_antes_de_iva AS valor_antes_iva, v.cuotas
FROM ventas v
LEFT JOIN dim_tiempo t ON t.fecha = v.fecha_venta
LEFT JOIN dim_region r ON r.region_nk = v.region_comercial
LEFT JOIN dim_canal c ON c.canal IS NOT DISTINCT FROM v.canal
  AND c.canal2 IS NOT DISTINCT FROM v.canal2 AND c.sub_canal IS NULL
LEFT JOIN dim_categoria g ON g.categoria_nk = v.categoria
LEFT JOIN dim_jerarquia_comercial j ON j.gerente IS NOT DISTINCT FROM v.gv_gerente_area
  AND j.jefe IS NOT DISTINCT FROM v.gv_jefe_1_canal_regional
  AND j.especialista IS NOT DISTINCT FROM v.gv_especialista
LEFT JOIN dim_aliado a ON a.aliado_nk = v.gv_desc2
LEFT JOIN dim_marca m ON m.marca_nk = v.marca
LEFT JOIN dim_vendedor d ON d.cedula_vendedor_nk = v.cedula_vendedor"""
VIEWS["fact_presupuesto"] = """
SELECT coalesce(t.sk_tiempo, 0) AS sk_tiempo, coalesce(r.sk_region, 0) AS sk_region,
  coalesce(c.sk_canal, 0) AS sk_canal, coalesce(g.sk_categoria, 0) AS sk_categoria,
  coalesce(u.sk_unidad_gestion, 0) AS sk_unidad_gestion,
  coalesce(j.sk_jerarquia, 0) AS sk_jerarquia, coalesce(a.sk_aliado, 0) AS sk_aliado,
  p.terminales, p.tecnologia,
  CAST(coalesce(p.t_t, p.terminales + p.tecnologia) AS DECIMAL(20,4)) AS tyt
FROM presupuesto p
LEFT JOIN dim_tiempo t ON t.fecha = p.mes
LEFT JOIN dim_region r ON r.region_nk = p.region
LEFT JOIN dim_canal c ON c.canal IS NOT DISTINCT FROM p.canal
  AND c.canal2 IS NOT DISTINCT FROM p.canal2 AND c.sub_canal IS NOT DISTINCT FROM p.sub_canal
LEFT JOIN dim_categoria g ON g.categoria_nk = p.categoria
LEFT JOIN dim_unidad_gestion u ON u.unidad_gestion_nk = p.unidad_de_gestion
LEFT JOIN dim_jerarquia_comercial j ON j.gerente IS NOT DISTINCT FROM p.gerente
  AND j.jefe IS NOT DISTINCT FROM p.jefe AND j.especialista IS NOT DISTINCT FROM p.especialista
LEFT JOIN dim_aliado a ON a.aliado_nk = p.descrip2"""
VIEWS["fact_gestion_tmk"] = """
SELECT coalesce(t.sk_tiempo, 0) AS sk_tiempo, coalesce(r.sk_region, 0) AS sk_region,
  coalesce(j.sk_jerarquia, 0) AS sk_jerarquia, coalesce(a.sk_aliado, 0) AS sk_aliado,
  coalesce(c.sk_campana, 0) AS sk_campana, coalesce(s.sk_segmento, 0) AS sk_segmento,
  coalesce(k.sk_tipo_contacto, 0) AS sk_tipo_contacto, g.cantidad, g.intentos
FROM registros g
LEFT JOIN dim_tiempo t ON t.fecha = coalesce(g.fecha_gestion, g.periodo)
LEFT JOIN dim_region r ON r.region_nk = g.division_comercial
LEFT JOIN dim_jerarquia_comercial j ON j.gerente IS NOT DISTINCT FROM g.gerente
  AND j.jefe IS NOT DISTINCT FROM g.jefe AND j.especialista IS NOT DISTINCT FROM g.especialista
LEFT JOIN dim_aliado a ON a.aliado_nk = g.aliado
LEFT JOIN dim_campana c ON c.campana_nk = g.nombre_campana
LEFT JOIN dim_segmento s ON s.segmento_nk = g.segmento
LEFT JOIN dim_tipo_contacto k ON k.tipo_contacto IS NOT DISTINCT FROM g.tipo_contacto
  AND k.detalle_contacto IS NOT DISTINCT FROM g.detalle1"""


def statement(body: str, **local: str) -> str:
    """The body preceded by the views it uses, directly or through other views."""
    needed: set[str] = set()
    pending = [body, *local.values()]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        fresh = [v for v in VIEWS if v in words and v not in needed and v not in local]
        needed.update(fresh)
        pending += [VIEWS[v] for v in fresh]
    views = {name: sql for name, sql in VIEWS.items() if name in needed} | local
    if not views:
        return body
    listed = ",\n".join(f"{name} AS ({sql})" for name, sql in views.items())
    recursive = any(re.search(rf"\b{name}\b", sql) for name, sql in local.items())
    return f"WITH {'RECURSIVE ' if recursive else ''}{listed}\n{body}"
