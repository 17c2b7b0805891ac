"""Queries for dimensions, facts and checks on the loaded mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.operators import dimensions as dims
from lonja.operators import quality
from lonja.operators.facts import FACT_SPECS, build_fact, lookup_key
from lonja.plans.registry import loaded, query, star
from lonja.sources import analogues as src
from lonja.sources.schemas import DIMENSIONS, FACTS, PERIOD, STAR


def _frames(spark: SparkSession, sf: str, table: str) -> dict[str, DataFrame]:
    """Only the sources of one dimension, and of the sales only its columns."""
    spec = dims.TEXT_DIMENSIONS[table]
    frames = {
        "ventas": lambda columns: src.sales(spark, sf, columns),
        "presupuesto": lambda columns: src.budget(spark, sf),
        "registros": lambda columns: src.contacts(spark, sf),
    }
    return {
        source: frames[source]([c for c in columns if c]) for source, columns in spec.sources.items()
    }


def _member_query(name: str, table: str) -> None:
    sk = STAR[table].names[0]

    @query(name, f"SELECT * EXCLUDE ({sk}) FROM {table} WHERE {sk} > 0")
    def _(spark: SparkSession, sf: str) -> DataFrame:
        return dims.members(dims.TEXT_DIMENSIONS[table], _frames(spark, sf, table))


for _name, _table in {
    "e1_dim_region": "dim_region",
    "e1_dim_categoria": "dim_categoria",
    "e1_dim_aliado": "dim_aliado",
    "e2_dim_unidad_gestion": "dim_unidad_gestion",
    "e2_dim_marca": "dim_marca",
    "e2_dim_vendedor": "dim_vendedor",
    "e2_dim_campana": "dim_campana",
    "e2_dim_segmento": "dim_segmento",
    "e3_dim_canal": "dim_canal",
    "e3_dim_tipo_contacto": "dim_tipo_contacto",
    "e4_dim_jerarquia": "dim_jerarquia_comercial",
}.items():
    _member_query(_name, _table)


@query(
    "e5_observed_validity",
    "SELECT * FROM dim_validez_venta WHERE sk_validez IN (SELECT sk_validez FROM ventas)",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return dims.observed_validity(loaded(spark, sf)[1].ruled["ventas"])


def _as_key_rows(table: str) -> str:
    sk, *columns = STAR[table].names
    spec = dims.TEXT_DIMENSIONS[table]
    parts = [*spec.key, "NULL", "NULL"][:3]
    cast = ", ".join(f"CAST({p} AS VARCHAR) AS k{i}" for i, p in enumerate(parts, 1))
    return f"SELECT '{table}' AS tabla, {sk} AS sk, {cast} FROM {table}"


@query("e6_surrogate_keys", " UNION ALL ".join(map(_as_key_rows, dims.TEXT_DIMENSIONS)))
def _(spark: SparkSession, sf: str) -> DataFrame:
    tables = star(spark, sf)
    result = None
    for table, spec in dims.TEXT_DIMENSIONS.items():
        parts = [F.col(c) for c in spec.key] + [F.lit(None)] * (3 - len(spec.key))
        rows = tables[table].select(
            F.lit(table).alias("tabla"),
            F.col(spec.sk).alias("sk"),
            *[p.cast("string").alias(f"k{i}") for i, p in enumerate(parts, 1)],
        )
        result = rows if result is None else result.unionByName(rows)
    return result


@query(
    "e6_merge_report",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS tabla, count(*) FILTER ({d.sk} > 0) AS inserted, 0 AS updated,
        0 AS skipped FROM {t}"""
        for t, d in dims.TEXT_DIMENSIONS.items()
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return loaded(spark, sf)[1].merges


def _fact_query(table: str, name: str, amounts: tuple[str, ...]) -> None:
    spec = FACT_SPECS[table]
    as_double = ", ".join(f"CAST({a} AS DOUBLE) AS {a}" for a in amounts)

    @query(name, f"SELECT * REPLACE ({as_double}) FROM {table}")
    def _(spark: SparkSession, sf: str) -> DataFrame:
        result = loaded(spark, sf)[1]
        fact = build_fact(spec, result.ruled[spec.source], result.tables, "2026-01-01 00:00:00")
        return fact.drop(spec.sk, "fecha_carga_dw", PERIOD.name)


_fact_query("fact_ventas", "f1_fact_ventas", ("valor_antes_iva", "cuotas"))
_fact_query("fact_presupuesto", "f2_fact_presupuesto", ("terminales", "tecnologia", "tyt"))
_fact_query("fact_gestion_tmk", "f3_fact_gestion_tmk", ("intentos",))


@query(
    "f4_key_lookup",
    """SELECT v.gerente, v.jefe, v.especialista, coalesce(j.sk_jerarquia, 0) AS sk_jerarquia,
      count(*) AS filas
    FROM (SELECT gv_gerente_area AS gerente, gv_jefe_1_canal_regional AS jefe,
      CASE WHEN cedula_vendedor LIKE '%5' THEN 'sin alta' ELSE gv_especialista END AS especialista
      FROM sales) v
    LEFT JOIN dim_jerarquia_comercial j ON j.gerente IS NOT DISTINCT FROM v.gerente
      AND j.jefe IS NOT DISTINCT FROM v.jefe
      AND j.especialista IS NOT DISTINCT FROM v.especialista
    GROUP BY ALL""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    spec = dims.TEXT_DIMENSIONS["dim_jerarquia_comercial"]
    columns = [*spec.sources["ventas"], "cedula_vendedor"]
    unknown = F.col("cedula_vendedor").endswith("5")
    events = src.sales(spark, sf, columns).withColumn(
        "gv_especialista", F.when(unknown, "sin alta").otherwise(F.col("gv_especialista"))
    )
    pairs = dict(zip(spec.key, dims.source_key(events, spec.sources["ventas"])))
    keyed = lookup_key(events, star(spark, sf)[spec.table], spec.sk, pairs)
    named = [F.col(c).alias(n) for c, n in zip(spec.sources["ventas"], spec.key)]
    return keyed.groupBy(*named, spec.sk).agg(F.count("*").alias("filas"))


@query(
    "f5_fact_keys",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS tabla, count(*) AS filas, 1 AS menor, count(*) AS mayor,
        count(*) AS distintas, 1 AS cargas FROM {t}"""
        for t in FACTS
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    tables = star(spark, sf)
    result = None
    for table, spec in FACT_SPECS.items():
        keys = tables[table].agg(
            F.lit(table).alias("tabla"),
            F.count("*").alias("filas"),
            F.min(spec.sk).alias("menor"),
            F.max(spec.sk).alias("mayor"),
            F.countDistinct(spec.sk).alias("distintas"),
            F.countDistinct("fecha_carga_dw").alias("cargas"),
        )
        result = keys if result is None else result.unionByName(keys)
    return result


_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS tabla, count(*) AS filas FROM {t}" for t in STAR)


@query("d5_table_counts", _COUNTS)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.table_counts(star(spark, sf))


@query(
    "d6_unknown_members",
    " UNION ALL ".join(
        f"SELECT '{t}' AS tabla, count(*) FILTER ({STAR[t].names[0]} = 0) AS miembros_sk0 FROM {t}"
        for t in DIMENSIONS
        if t != "dim_validez_venta"
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.unknown_members(star(spark, sf))


def _orphan_oracle(known: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{fact}' AS hecho, '{key}' AS fk, count(*) AS huerfanos FROM {fact} f
        WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = f.{key} AND {known.format(key)})"""
        for fact, key, dim in quality.FOREIGN_KEYS
    )


@query("d7_orphans", _orphan_oracle("true"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.orphan_counts(star(spark, sf))


@query("d7_orphans_without_unknown", _orphan_oracle("d.{0} <> 0"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The same check against dimensions without their unknown member: it has orphans to find."""
    tables = star(spark, sf)
    bare = {t: tables[t].where(F.col(STAR[t].names[0]) != 0) for t in DIMENSIONS}
    return quality.orphan_counts({**tables, **bare})


@query(
    "d8_key_violations",
    " UNION ALL ".join(
        [f"SELECT '{t}' AS tabla, 'pk_unica' AS regla, 0 AS violaciones" for t in STAR]
        + [
            f"""SELECT '{t}', 'nk_unica', count(*) FROM (SELECT 1 FROM {t}
            GROUP BY {", ".join(dims.ALL_DIMENSIONS[t].key)} HAVING count(*) > 1)"""
            for t in DIMENSIONS
        ]
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.key_violations(star(spark, sf))


def _value_oracle() -> str:
    parts = []
    for table, schema in STAR.items():
        conditions = {}
        for field in schema.fields:
            own_key = field.name == schema.names[0] and table in FACTS
            absent = own_key or field.name == "fecha_carga_dw"
            if not field.nullable:
                conditions[f"{field.name}_no_nulo"] = "false" if absent else f"{field.name} IS NULL"
            if field.metadata:
                conditions[f"{field.name}_largo"] = f"length({field.name}) > {field.metadata['length']}"
        extra = {
            "dim_tiempo": {"mes_1_12": "mes NOT BETWEEN 1 AND 12"},
            "fact_ventas": {"valor_no_negativo": "valor_antes_iva < 0"},
            "fact_gestion_tmk": {"cantidad_no_negativa": "cantidad < 0"},
            "fact_presupuesto": {"tyt_suma": "abs(tyt - (terminales + tecnologia)) >= 0.01"},
        }
        conditions.update(extra.get(table, {}))
        parts += [
            f"SELECT '{table}' AS tabla, '{rule}' AS regla, "
            f"count(*) FILTER ({condition}) AS violaciones FROM {table}"
            for rule, condition in conditions.items()
        ]
    return " UNION ALL ".join(parts)


@query("d8_value_violations", _value_oracle())
def _(spark: SparkSession, sf: str) -> DataFrame:
    return quality.value_violations(star(spark, sf))


@query("d9_validity_domain", "SELECT count(*) AS filas, count(*) >= 4 AS ok FROM dim_validez_venta")
def _(spark: SparkSession, sf: str) -> DataFrame:
    domain = star(spark, sf)["dim_validez_venta"]
    return domain.agg(
        F.count("*").alias("filas"), (F.count("*") >= quality.VALIDITY_ROWS).alias("ok")
    )


@query("d10_contact_without_channel", "SELECT count(*) AS filas, true AS ok FROM fact_gestion_tmk")
def _(spark: SparkSession, sf: str) -> DataFrame:
    tables = star(spark, sf)
    ok = quality.has_no_channel(tables)
    return tables["fact_gestion_tmk"].agg(F.count("*").alias("filas"), F.lit(ok).alias("ok"))


def _report_oracle() -> str:
    names = ["esquema", *[f"existe {t}" for t in STAR], *[f"conteo {t}" for t in FACTS]]
    names += [f"miembro sk=0 en {t}" for t in DIMENSIONS if t != "dim_validez_venta"]
    names += ["dominio dim_validez_venta", *[f"integridad referencial {t}" for t in FACTS]]
    names += ["fact_gestion_tmk sin sk_canal", "resumen"]
    listed = ", ".join(f"('{n}')" for n in names)
    return f"""SELECT n.chequeo, true AS ok, CASE
      WHEN n.chequeo LIKE 'conteo %' THEN 'filas=' || c.filas
      WHEN n.chequeo LIKE 'miembro %' THEN 'filas=1' WHEN n.chequeo LIKE 'dominio %' THEN 'filas=4'
      WHEN n.chequeo LIKE 'integridad %' THEN 'huerfanos=0'
      WHEN n.chequeo = 'resumen' THEN 'chequeos={len(names) - 1} fallidos=0' ELSE '' END AS detalle
    FROM (VALUES {listed}) AS n(chequeo)
    LEFT JOIN counts c ON n.chequeo = 'conteo ' || c.tabla"""


@query("d11_validation_report", _report_oracle(), counts=_COUNTS)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return loaded(spark, sf)[1].report


@query(
    "d12_stage_counts",
    """SELECT 'extract' AS etapa, 'ventas' AS tabla, count(*) AS filas FROM sales_raw UNION ALL
    SELECT 'extract', 'presupuesto', count(*) FROM budget UNION ALL
    SELECT 'extract', 'registros', count(*) FROM contacts UNION ALL
    SELECT 'transform', 'ventas', count(*) FROM sales_clean UNION ALL
    SELECT 'transform', 'presupuesto', count(*) FROM budget_clean UNION ALL
    SELECT 'transform', 'registros', count(*) FROM contacts_clean UNION ALL
    SELECT 'business_rules', 'ventas', count(*) FROM ventas UNION ALL
    SELECT 'business_rules', 'presupuesto', count(*) FROM presupuesto UNION ALL
    SELECT 'business_rules', 'registros', count(*) FROM registros UNION ALL
    SELECT 'load', tabla, filas FROM counts""",
    counts=_COUNTS,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return loaded(spark, sf)[1].stages
