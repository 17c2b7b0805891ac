"""Queries for column profiles and key, grain and domain audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lonja.functions import dates
from lonja.functions.text import header_names
from lonja.operators import profiling
from lonja.plans.oracle import VIEWS
from lonja.plans.registry import query
from lonja.sources import analogues as src
from lonja.sources.schemas import BUDGET_HEADERS, CONTACT_HEADERS, SALES_HEADERS

# Every column of a source, under its cleaned name, with its landing type.
_SALES = dict(zip(header_names(list(SALES_HEADERS)), SALES_HEADERS.values(), strict=True))
_BUDGET = dict(zip(header_names(list(BUDGET_HEADERS)), BUDGET_HEADERS.values(), strict=True))
_CONTACTS = dict(zip(header_names(list(CONTACT_HEADERS)), CONTACT_HEADERS.values(), strict=True))


def _profile_oracle(column: str, dtype: str) -> str:
    return f"""SELECT '{column}' AS columna, '{dtype}' AS tipo, count({column}) AS no_nulos,
      count(*) - count({column}) AS nulos, count(DISTINCT {column}) AS distintos,
      round(100.0 * (count(*) - count({column})) / count(*), 2) AS pct_nulos FROM sales"""


@query(
    "i1_column_profile",
    " UNION ALL ".join(_profile_oracle(c, t.simpleString()) for c, t in _SALES.items()),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.profile_columns(src.sales(spark, sf))


@query(
    "i1_column_profile_approx",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS columna, count({c}) AS no_nulos, count(*) - count({c}) AS nulos,
        count(DISTINCT {c}) AS distintos, true AS dentro_del_error FROM sales"""
        for c in _SALES
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.sketch_agreement(src.sales(spark, sf))


_COUNTED = " UNION ALL ".join(
    f"SELECT '{c}' AS columna, CAST({c} AS VARCHAR) AS valor, count(*) AS n FROM sales"
    f" WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in _SALES
)


@query(
    "i2_top_values",
    """SELECT columna, valor, n, row_number() OVER (PARTITION BY columna ORDER BY n DESC, valor)
      AS puesto FROM counted
    WHERE columna IN (SELECT columna FROM counted GROUP BY 1 HAVING count(*) <= 30)
    QUALIFY puesto <= 10""",
    counted=_COUNTED,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.top_values(src.sales(spark, sf))


_ORDER = ["event_id"]


@query(
    "i2_sample_values",
    """SELECT columna, valor, row_number() OVER (PARTITION BY columna ORDER BY event_id) AS puesto
    FROM melted QUALIFY puesto <= 15""",
    melted=" UNION ALL ".join(
        f"SELECT event_id, '{c}' AS columna, CAST({c} AS VARCHAR) AS valor FROM contact_events"
        f" WHERE {c} IS NOT NULL"
        for c in _CONTACTS
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    records = src.contacts(spark, sf, keys=True)
    return profiling.sample_values(records, _ORDER, list(_CONTACTS))


# Sources of the profile over everything: analogue view, columns, and the view's name in SQL.
_SOURCES = {
    "ventas": (src.sales, _SALES, "sales"),
    "presupuesto": (src.budget, _BUDGET, "budget"),
    "registros": (src.contacts, _CONTACTS, "contacts"),
}


@query(
    "i1_profile_of_all_sources",
    " UNION ALL ".join(
        _profile_oracle(c, t.simpleString()).replace("SELECT ", f"SELECT '{name}' AS fuente, ", 1).replace("FROM sales", f"FROM {view}")
        for name, (_, columns, view) in _SOURCES.items()
        for c, t in columns.items()
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    frames = {name: view(spark, sf) for name, (view, _, _) in _SOURCES.items()}
    return profiling.of_sources(frames, lambda _, df: profiling.profile_columns(df))


@query(
    "i2_top_values_of_all_sources",
    """SELECT fuente, columna, valor, n,
      row_number() OVER (PARTITION BY fuente, columna ORDER BY n DESC, valor) AS puesto FROM counted
    WHERE fuente || '/' || columna IN (SELECT fuente || '/' || columna FROM counted
      GROUP BY fuente, columna HAVING count(*) <= 30)
    QUALIFY puesto <= 10""",
    counted=" UNION ALL ".join(
        f"SELECT '{name}' AS fuente, '{c}' AS columna, CAST({c} AS VARCHAR) AS valor, count(*) AS n"
        f" FROM {view} WHERE {c} IS NOT NULL GROUP BY {c}"
        for name, (_, columns, view) in _SOURCES.items()
        for c in columns
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    frames = {name: view(spark, sf) for name, (view, _, _) in _SOURCES.items()}
    return profiling.of_sources(frames, lambda _, df: profiling.top_values(df))


# The place of a row in its source; a budget cross that comes twice has equal columns but amounts.
_PLACES = {
    "ventas": ("l_orderkey", "l_linenumber"),
    "presupuesto": tuple(_BUDGET),
    "registros": ("event_id",),
}
_PLACED = {
    "ventas": VIEWS["sales"].replace(
        "\nFROM lineitem", ", l_orderkey, l_linenumber\nFROM lineitem", 1
    ),
    "presupuesto": "SELECT * FROM budget",
    "registros": "SELECT * FROM contact_events",
}


def _sampled(name: str, column: str) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in _PLACES[name])
    return f"""(SELECT '{name}' AS fuente, '{column}' AS columna, CAST({column} AS VARCHAR) AS valor,
      row_number() OVER (ORDER BY {order}, CAST({column} AS VARCHAR)) AS puesto
      FROM placed_{name} WHERE {column} IS NOT NULL QUALIFY puesto <= 15)"""


@query(
    "i2_samples_of_all_sources",
    " UNION ALL ".join(_sampled(n, c) for n, (_, columns, _) in _SOURCES.items() for c in columns),
    **{f"placed_{name}": sql for name, sql in _PLACED.items()},
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    frames = {
        "ventas": src.sales(spark, sf, keys=True),
        "presupuesto": src.budget(spark, sf),
        "registros": src.contacts(spark, sf, keys=True),
    }
    return profiling.of_sources(
        frames, lambda name, df: profiling.sample_values(df, _PLACES[name], list(_SOURCES[name][1]))
    )


@query(
    "i3_table_shape",
    """SELECT count(*) AS filas, 16 AS columnas,
      CAST((count(jefe) = 0) AS BIGINT) + CAST((count(especialista) = 0) AS BIGINT) AS columnas_vacias,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM contacts)) AS filas_duplicadas
    FROM contacts""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.table_shape(src.contacts(spark, sf))


_KEYS = {
    "pedido": ["l_orderkey"],
    "pedido+linea": ["l_orderkey", "l_linenumber"],
    "pedido+parte": ["l_orderkey", "l_partkey"],
    "pedido+linea+parte+proveedor": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
}


@query(
    "i4_candidate_keys",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS clave, 0 AS filas_nulas, CAST(sum(n) AS BIGINT) AS filas_evaluadas,
        count(*) AS claves_unicas, CAST(sum(n - 1) AS BIGINT) AS filas_duplicadas,
        sum(n - 1) = 0 AS es_unica
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY {", ".join(key)})"""
        for name, key in _KEYS.items()
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.candidate_keys(src.table(spark, sf, "lineitem"), _KEYS)


_SALE_KEYS = {
    "factura": ["codigo_factura"],
    "cliente": ["identificacion"],
    "factura+cliente": ["codigo_factura", "identificacion"],
    "factura+vendedor+fecha+valor+marca": [
        "codigo_factura",
        "cedula_vendedor",
        "fecha_venta",
        "valor_antes_de_iva",
        "marca",
    ],
    "cuotas+aliado": ["cuotas", "gv_desc2"],
}


@query(
    "i4_candidate_keys_with_nulls",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS clave,
        CAST(coalesce(sum(n) FILTER (NOT w), 0) AS BIGINT) AS filas_nulas,
        CAST(sum(n) FILTER (w) AS BIGINT) AS filas_evaluadas, count(*) FILTER (w) AS claves_unicas,
        CAST(sum(n - 1) FILTER (w) AS BIGINT) AS filas_duplicadas,
        sum(n - 1) FILTER (w) = 0 AS es_unica
        FROM (SELECT count(*) AS n, {" AND ".join(f"{c} IS NOT NULL" for c in key)} AS w
          FROM sales GROUP BY {", ".join(key)})"""
        for name, key in _SALE_KEYS.items()
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    columns = sorted({c for key in _SALE_KEYS.values() for c in key})
    return profiling.candidate_keys(src.sales(spark, sf, columns), _SALE_KEYS)


@query(
    "i5_key_cardinality",
    """SELECT CAST(sum(n) AS BIGINT) AS filas,
      CAST(coalesce(sum(n) FILTER (k IS NULL), 0) AS BIGINT) AS nulos,
      CAST(sum(n) FILTER (k IS NOT NULL) AS BIGINT) AS no_nulos, count(k) AS distintos,
      count(*) FILTER (k IS NOT NULL AND n > 1) AS valores_repetidos,
      CAST(sum(n) FILTER (k IS NOT NULL AND n > 1) AS BIGINT) AS filas_en_grupos,
      CAST(sum(n - 1) FILTER (k IS NOT NULL) AS BIGINT) AS filas_extra, false AS es_unica
    FROM (SELECT codigo_factura AS k, count(*) AS n FROM sales GROUP BY 1)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.key_cardinality(src.sales(spark, sf, ["codigo_factura"]), "codigo_factura")


_REPEATED = """SELECT codigo_factura, count(*) AS ocurrencias FROM sales
  WHERE codigo_factura IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""


@query("i6_repeated_keys", "SELECT * FROM repeated", repeated=_REPEATED)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.repeated_values(src.sales(spark, sf, ["codigo_factura"]), ["codigo_factura"])


@query(
    "i7_repetition_histogram",
    "SELECT ocurrencias, count(*) AS claves FROM repeated GROUP BY 1",
    repeated=_REPEATED,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    events = src.sales(spark, sf, ["codigo_factura"])
    return profiling.repetition_histogram(events, ["codigo_factura"])


_VARYING = [c for c in _SALES if c != "codigo_factura"]


@query(
    "i8_varying_columns",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS columna, count(*) AS grupos_con_variacion FROM (
        SELECT codigo_factura FROM sales WHERE codigo_factura IS NOT NULL GROUP BY 1
        HAVING count(DISTINCT {c}) + CAST(count(*) > count({c}) AS BIGINT) > 1)"""
        for c in _VARYING
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.varying_columns(src.sales(spark, sf), ["codigo_factura"], _VARYING)


@query(
    "i9_repeated_sample",
    """SELECT s.codigo_factura, r.ocurrencias, s.fecha_venta, s.identificacion, s.cedula_vendedor,
      s.marca, CAST(s.valor_antes_de_iva AS DOUBLE) AS valor_antes_de_iva, s.gv_desc2
    FROM sales s JOIN (SELECT * FROM repeated ORDER BY codigo_factura LIMIT 5) r
      ON r.codigo_factura = s.codigo_factura""",
    repeated=_REPEATED,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    preview = [
        "fecha_venta",
        "identificacion",
        "cedula_vendedor",
        "marca",
        "valor_antes_de_iva",
        "gv_desc2",
    ]
    events = src.sales(spark, sf, ["codigo_factura", *preview])
    return profiling.sample_repeated(events, "codigo_factura", preview)


@query(
    "i10_short_codes",
    """SELECT cedula_vendedor AS codigo, count(*) AS n FROM sales
    WHERE length(cedula_vendedor) < 5 GROUP BY 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.short_codes(src.sales(spark, sf, ["cedula_vendedor"]), "cedula_vendedor")


_MEASURES = [c for c, t in _BUDGET.items() if isinstance(t, DecimalType)]
_CROSS = [c for c in _BUDGET if c not in _MEASURES]


@query(
    "i11_repeated_crosses",
    f"""SELECT * EXCLUDE (terminales, tecnologia, t_t), CAST(terminales AS DOUBLE) AS terminales,
      CAST(tecnologia AS DOUBLE) AS tecnologia, CAST(t_t AS DOUBLE) AS t_t
    FROM (SELECT {", ".join(_CROSS + _MEASURES)}, count(*) AS filas,
      CAST(sum(count(*)) OVER (PARTITION BY {", ".join(_CROSS)}) AS BIGINT) AS ocurrencias,
      count(*) OVER (PARTITION BY {", ".join(_CROSS)}) AS combinaciones
      FROM budget GROUP BY {", ".join(_CROSS + _MEASURES)})
    WHERE ocurrencias > 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.repeated_crosses(src.budget(spark, sf), _CROSS, _MEASURES)


# Fixed value: the declared grain of the contacts.
_GROUP = ["nombre_campana", "fecha_gestion", "aliado", "tipo_contacto", "detalle1"]
_GROUP_VARY = [c for c in _CONTACTS if c not in _GROUP]


@query(
    "i12_largest_group",
    f"""SELECT {", ".join(_GROUP)}, count(*) AS filas,
      CAST(sum(cantidad) AS BIGINT) AS suma_cantidad, CAST(sum(intentos) AS DOUBLE) AS suma_intentos,
      {", ".join(f"count(DISTINCT {c}) + CAST(count(*) > count({c}) AS BIGINT) > 1 AS varia_{c}"
                 for c in _GROUP_VARY)}
    FROM contacts GROUP BY {", ".join(_GROUP)}
    ORDER BY filas DESC, {", ".join(f"{c} ASC NULLS FIRST" for c in _GROUP)} LIMIT 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    records = src.contacts(spark, sf)
    return profiling.largest_group(records, _GROUP, ["cantidad", "intentos"], _GROUP_VARY)


@query(
    "i12_group_sizes",
    f"""SELECT count(*) AS grupos, count(*) FILTER (n > 1) AS grupos_repetidos, max(n) AS mayor_grupo
    FROM (SELECT count(*) AS n FROM contacts GROUP BY {", ".join(_GROUP)})""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.group_sizes(src.contacts(spark, sf), _GROUP)


# The audited column pairs, sales or contacts against budget.
_PAIRS = {
    "region": ("budget", "region", "sales", "region_comercial"),
    "region_division": ("budget", "region", "sales", "gv_division"),
    "region_contactos": ("budget", "region", "contacts", "division_comercial"),
    "especialista": ("budget", "especialista", "sales", "gv_especialista"),
    "especialista_contactos": ("budget", "especialista", "contacts", "especialista"),
    "jefe": ("budget", "jefe", "sales", "gv_jefe_1_canal_regional"),
    "jefe_contactos": ("budget", "jefe", "contacts", "jefe"),
    "gerente": ("budget", "gerente", "sales", "gv_gerente_area"),
    "gerente_contactos": ("budget", "gerente", "contacts", "gerente"),
    "aliado": ("budget", "descrip2", "sales", "gv_desc2"),
    "aliado_contactos": ("budget", "descrip2", "contacts", "aliado"),
    "canal": ("budget", "canal", "sales", "canal"),
    "canal2": ("budget", "canal2", "sales", "canal2"),
    "categoria": ("budget", "categoria", "sales", "categoria"),
}


def _overlap_oracle(pair: str, left: str, a: str, right: str, b: str) -> str:
    both = f"""FROM (SELECT DISTINCT {a} AS v FROM {left} WHERE {a} IS NOT NULL) x
      FULL JOIN (SELECT DISTINCT {b} AS v FROM {right} WHERE {b} IS NOT NULL) y ON x.v = y.v"""
    return f"""SELECT '{pair}' AS par, count(x.v) AS n_a, count(y.v) AS n_b,
      count(*) FILTER (x.v IS NOT NULL AND y.v IS NOT NULL) AS n_comunes,
      count(*) FILTER (y.v IS NULL) AS n_solo_a, count(*) FILTER (x.v IS NULL) AS n_solo_b
    {both}"""


@query("i13_domain_overlap", " UNION ALL ".join(_overlap_oracle(p, *c) for p, c in _PAIRS.items()))
def _(spark: SparkSession, sf: str) -> DataFrame:
    columns = sorted({pair[3] for pair in _PAIRS.values() if pair[2] == "sales"})
    frames = {
        "sales": src.sales(spark, sf, columns),
        "budget": src.budget(spark, sf),
        "contacts": src.contacts(spark, sf),
    }
    return profiling.domain_overlap(
        {name: (frames[a], ac, frames[b], bc) for name, (a, ac, b, bc) in _PAIRS.items()}
    )


_PERIODS = """SELECT 'presupuesto' AS fuente, mes AS p FROM budget UNION
  SELECT 'ventas', (2000 + ano) * 100 + mes FROM sales UNION
  SELECT 'registros', periodo FROM contacts"""


@query(
    "i14_period_coverage",
    """SELECT fuente, count(*) AS periodos, min(p) AS primero, max(p) AS ultimo,
      count(*) FILTER (p IN (SELECT p FROM periods WHERE fuente = 'presupuesto')) AS comunes,
      count(*) FILTER (p IN (SELECT p FROM periods WHERE fuente = 'presupuesto')) = count(*)
        AS subconjunto FROM periods GROUP BY 1""",
    periods=_PERIODS,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    short = dates.period_of_short_year(F.col("ano"), F.col("mes"))
    sources = {
        "presupuesto": src.budget(spark, sf).select(F.col("mes").alias("p")),
        "ventas": src.sales(spark, sf, ["ano", "mes"]).select(short.alias("p")),
        "registros": src.contacts(spark, sf).select(F.col("periodo").alias("p")),
    }
    return profiling.period_coverage(sources, "p", "presupuesto")


_STATS = """SELECT '{0}' AS medida, count({0}) AS n, CAST(sum({0}) AS DOUBLE) AS suma,
  CAST(min({0}) AS DOUBLE) AS minimo, CAST(max({0}) AS DOUBLE) AS maximo,
  round(avg(CAST({0} AS DOUBLE)), 4) AS media,
  round(stddev_samp(CAST({0} AS DOUBLE)), 4) AS desviacion FROM {1}"""


@query(
    "i15_measure_stats",
    " UNION ALL ".join(_STATS.format(m, "budget") for m in _MEASURES),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.measure_stats(src.budget(spark, sf), _MEASURES)


@query("i15_sales_stats", _STATS.format("valor_antes_de_iva", "sales"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    measure = ["valor_antes_de_iva"]
    return profiling.measure_stats(src.sales(spark, sf, measure), measure)


@query(
    "i15_contact_stats",
    " UNION ALL ".join(_STATS.format(m, "contacts") for m in ("cantidad", "intentos")),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.measure_stats(src.contacts(spark, sf), ["cantidad", "intentos"])


_QUARTILES = """SELECT '{0}' AS medida, round(quantile_cont(CAST({0} AS DOUBLE), 0.25), 4) AS p25,
  round(quantile_cont(CAST({0} AS DOUBLE), 0.5), 4) AS p50,
  round(quantile_cont(CAST({0} AS DOUBLE), 0.75), 4) AS p75 FROM {1}"""


@query(
    "i15_quartiles",
    " UNION ALL ".join(
        [
            _QUARTILES.format("valor_antes_de_iva", "sales"),
            _QUARTILES.format("cantidad", "contacts"),
            _QUARTILES.format("intentos", "contacts"),
        ]
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    records = src.contacts(spark, sf)
    found = profiling.quartiles(
        src.sales(spark, sf, ["valor_antes_de_iva"]), "valor_antes_de_iva"
    )
    for measure in ("cantidad", "intentos"):
        found = found.unionByName(profiling.quartiles(records, measure))
    return found.select("medida", *[F.round(p, 4).alias(p) for p in ("p25", "p50", "p75")])


@query(
    "i15_value_counts",
    """SELECT 'tipo_contacto' AS columna, tipo_contacto AS valor, count(*) AS n FROM contacts
      GROUP BY ALL UNION ALL
    SELECT 'segmento', segmento, count(*) FROM contacts GROUP BY ALL UNION ALL
    SELECT 'nota_credito', nota_credito, count(*) FROM sales GROUP BY ALL UNION ALL
    SELECT 'descripcion_estado_reserva', descripcion_estado_reserva, count(*) FROM sales
      GROUP BY ALL""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    states = ["nota_credito", "descripcion_estado_reserva"]
    contacts = profiling.value_counts(src.contacts(spark, sf), ["tipo_contacto", "segmento"])
    return contacts.unionByName(profiling.value_counts(src.sales(spark, sf, states), states))


@query(
    "i16_shares",
    """SELECT round(100.0 * count(*) FILTER (fecha_gestion IS NULL) / count(*), 2) AS sin_fecha,
      round(100.0 * count(*) FILTER (cantidad = 1) / count(*), 2) AS cantidad_uno,
      round(100.0 * count(*) FILTER (cantidad > 1) / count(*), 2) AS cantidad_mayor,
      round(100.0 * count(*) FILTER (intentos = cantidad) / count(*), 2) AS intentos_igual
    FROM contacts""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.col("cantidad")
    return profiling.share(
        src.contacts(spark, sf),
        {
            "sin_fecha": F.col("fecha_gestion").isNull(),
            "cantidad_uno": amount == 1,
            "cantidad_mayor": amount > 1,
            "intentos_igual": F.col("intentos") == amount,
        },
    )


@query(
    "i17_additive_gap",
    """SELECT count(*) FILTER (abs(t_t - (terminales + tecnologia)) > 0.01) AS filas_fuera,
      CAST(max(abs(t_t - (terminales + tecnologia))) AS DOUBLE) AS delta_maximo FROM budget""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    budget = src.budget(spark, sf)
    return profiling.additive_gap(budget, "t_t", ["terminales", "tecnologia"], 0.01)


@query(
    "i16_untyped_records",
    """SELECT count(*) AS filas, CAST(sum(cantidad) AS BIGINT) AS cantidad FROM contacts
    WHERE tipo_contacto IS NULL""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    untyped = src.contacts(spark, sf).where("tipo_contacto is null")
    return untyped.agg(F.count("*").alias("filas"), F.sum("cantidad").alias("cantidad"))


@query(
    "i18_validity_breakdown",
    """SELECT count(*) FILTER (codigo_factura IS NOT NULL AND nota_credito IS NULL) AS validas,
      count(*) FILTER (codigo_factura IS NULL) AS sin_factura,
      count(*) FILTER (nota_credito = 'SI') AS con_nota_credito FROM sales""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    events = src.sales(spark, sf, ["codigo_factura", "nota_credito"])
    return profiling.validity_breakdown(events, "codigo_factura", "nota_credito")
