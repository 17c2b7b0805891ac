"""Queries for sources, sinks, merges and cleaning steps."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.functions import dates
from lonja.functions.casts import whole_number
from lonja.functions.text import header_names, key_text
from lonja.operators import clean, profiling
from lonja.operators import calendar as cal
from lonja.operators import dimensions as dims
from lonja.plans.load import evolve
from lonja.plans.oracle import VIEWS
from lonja.plans.registry import loaded, new_mart, query, reloaded
from lonja.session import shared_folder
from lonja.sources import analogues as src
from lonja.sources.mart_tables import conformed, export_csv, export_json
from lonja.sources.registry import (
    PLACE,
    Source,
    first_rows,
    landing_sources,
    missing_columns,
    read_all_sources,
    read_source,
)
from lonja.sources.schemas import DIMENSIONS, LANDING, PERIOD, STAR
from lonja.sources.staging import side_by_side, stage

_SALES_ORDER = header_names(LANDING["ventas"].names)


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}/{uuid4().hex}"


_HEADED = ", ".join(
    f'{"CAST(valor_antes_de_iva AS DOUBLE)" if n == "valor_antes_de_iva" else n} AS "{h}"'
    for n, h in zip(_SALES_ORDER, LANDING["ventas"].names)
)


@query("a1_read_source", f"SELECT {_HEADED} FROM sales")
def _(spark: SparkSession, sf: str) -> DataFrame:
    root = _folder(spark, "landing")
    sources = landing_sources(root, "csv")
    export_csv(src.under_headers(src.sales(spark, sf), "ventas"), sources["ventas"].path)
    landed = read_source(spark, sources, "ventas")
    return landed.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in LANDING["ventas"]])


_FORMATS = ("csv", "json", "parquet")
_EACH_FORMAT = "(VALUES ('csv'), ('json'), ('parquet')) AS f(formato)"


# Rows of a compressed text file, which one task reads as a whole.
_TEXT_ROWS = 1_000_000


def _land(df: DataFrame, fmt: str, path: str) -> None:
    """Append files of one format to a landing folder; text is compressed, at the fastest level."""
    writer = df.write.option("header", "true").option("ignoreNullFields", "false")
    if fmt != "parquet":
        writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
        writer = writer.option("maxRecordsPerFile", _TEXT_ROWS)
    writer.format(fmt).mode("append").save(path)


def _landed_parts(spark: SparkSession, name: str, *parts: DataFrame) -> dict[str, dict[str, Source]]:
    """The parts of one source appended to its folder, once in every format."""
    landed = {}
    for fmt in _FORMATS:
        landed[fmt] = landing_sources(_folder(spark, "landing"), fmt)
        for part in parts:
            _land(part, fmt, landed[fmt][name].path)
    return landed


def _each(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Frames of all formats, with the format's name."""
    return reduce(DataFrame.unionByName, [df.withColumn("formato", F.lit(f)) for f, df in parts.items()])


_BUDGET_HEADERS = LANDING["presupuesto"].names
_BUDGET_COLUMNS = header_names(_BUDGET_HEADERS)
_AMOUNTS = ("terminales", "tecnologia", "t_t")
_BUDGET_VALUES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in _AMOUNTS else c for c in _BUDGET_COLUMNS)


@query("a1_moved_columns", f"SELECT formato, {_BUDGET_VALUES} FROM budget, {_EACH_FORMAT}")
def _(spark: SparkSession, sf: str) -> DataFrame:
    raw = src.under_headers(src.budget(spark, sf), "presupuesto")
    turned = raw.select(*[F.col(f"`{c}`") for c in reversed(raw.columns)])
    even = F.col("MES") % 2 == 0
    found = {}
    for fmt, sources in _landed_parts(spark, "presupuesto", raw.where(even), turned.where(~even)).items():
        values = [
            F.col(f"`{f.name}`").cast(f.dataType).alias(c)
            for f, c in zip(LANDING["presupuesto"].fields, _BUDGET_COLUMNS, strict=True)
        ]
        found[fmt] = read_source(spark, sources, "presupuesto").select(*values)
    return _each(found)


@query(
    "a1_missing_in_one_file",
    f"""SELECT formato, 'DESCRIP2' AS columna, 1 AS archivos, count(*) AS filas_completas
    FROM budget, {_EACH_FORMAT} WHERE mes % 2 = 0 GROUP BY formato""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    # The crosses are summed once, and every folder is written from them.
    raw = stage(src.under_headers(src.budget(spark, sf), "presupuesto"), "presupuesto")
    even = F.col("MES") % 2 == 0
    whole, short = raw.where(even), raw.where(~even).drop("DESCRIP2").coalesce(1)
    mixed = _landed_parts(spark, "presupuesto", whole, short)
    complete = _landed_parts(spark, "presupuesto", whole)
    lacking = _each({f: missing_columns(spark, s, "presupuesto") for f, s in mixed.items()})
    rows = _each(
        {
            f: read_source(spark, s, "presupuesto").agg(F.count("*").alias("filas_completas"))
            for f, s in complete.items()
        }
    )
    columns = lacking.groupBy("formato", "columna").agg(F.count("*").alias("archivos"))
    return columns.join(rows, "formato").select("columna", "archivos", "filas_completas", "formato")


@query(
    "a1_mixed_number_types",
    f"""SELECT formato, categoria, count(*) AS filas, sum(CASE l % 3
      WHEN 0 THEN floor(v) WHEN 1 THEN v ELSE v + 0.125 END) AS valor
    FROM (SELECT p_type AS categoria, l_orderkey AS l, CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2))
        * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS DOUBLE) AS v
      FROM lineitem JOIN part ON p_partkey = l_partkey), {_EACH_FORMAT}
    GROUP BY ALL""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    # Files with whole amounts, with decimals and with floating point.
    columns = ["categoria", "valor_antes_de_iva"]
    sales = src.sales(spark, sf, columns, keys=True).select("l_orderkey", *columns)
    # The view is built once, and the parts of every format are written from it.
    raw = stage(sales, "ventas")
    amount = F.col("valor_antes_de_iva")
    kinds = (F.floor(amount).cast("bigint"), amount, amount.cast("double") + 0.125)
    parts = [
        raw.where(F.col("l_orderkey") % 3 == i).select(
            *[
                {"CATEGORIA": F.col("categoria"), "Valor Antes de iva": kind}
                .get(h, F.lit(None).cast("string"))
                .alias(h)
                for h in LANDING["ventas"].names
            ]
        )
        for i, kind in enumerate(kinds)
    ]
    found = {}
    for fmt, sources in _landed_parts(spark, "ventas", *parts).items():
        value = F.sum(F.col("`Valor Antes de iva`").cast("decimal(28,3)")).cast("double")
        landed = read_source(spark, sources, "ventas").groupBy(F.col("CATEGORIA").alias("categoria"))
        found[fmt] = landed.agg(F.count("*").alias("filas"), value.alias("valor"))
    return _each(found)


@query(
    "b15_landed_formats",
    """SELECT formato, count(*) AS filas, sum(CAST(valor_antes_de_iva AS DOUBLE)) AS valor
    FROM sales, (VALUES (0), (1)) AS c(extra), (VALUES ('csv'), ('json'), ('parquet')) AS f(formato)
    GROUP BY formato""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    # The view is built once, and every format is landed from it.
    sales = stage(src.sales(spark, sf), "ventas")
    # Every sale twice, a tenth of a cent apart, and once more exactly: rounding must not merge them.
    copies = sales.withColumn("_more", F.explode(F.array(*map(F.lit, (0.001, 0.002, 0.002)))))
    amount = F.col("valor_antes_de_iva").cast("double") + F.col("_more")
    raw = src.under_headers(copies.withColumn("valor_antes_de_iva", amount).drop("_more"), "ventas")

    def landed(fmt: str) -> DataFrame:
        sources = landing_sources(_folder(spark, "landing"), fmt)
        _land(raw, fmt, sources["ventas"].path)
        cleaned = clean.clean_sales(read_source(spark, sources, "ventas"))
        total = F.sum(F.col("valor_antes_de_iva").cast("decimal(28,2)")).cast("double")
        return cleaned.agg(F.lit(fmt).alias("formato"), F.count("*").alias("filas"), total.alias("valor"))

    return reduce(DataFrame.unionByName, side_by_side(landed, _FORMATS))


@query(
    "a2_read_all_sources",
    """SELECT 'ventas' AS fuente, count(*) AS filas FROM sales_raw UNION ALL
    SELECT 'presupuesto', count(*) FROM budget UNION ALL
    SELECT 'registros', count(*) FROM contacts UNION ALL
    SELECT 'festivos', count(*) * 8 FROM years""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    sources = landing_sources(_folder(spark, "landing"))
    landed = src.raw_sources(spark, sf)
    landed["festivos"] = src.holidays(src.years(spark, sf)).select("date", "name_es")
    for key, df in landed.items():
        df.write.parquet(sources[key].path)
    counts = [
        df.agg(F.lit(key).alias("fuente"), F.count("*").alias("filas"))
        for key, df in read_all_sources(spark, sources).items()
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


@query(
    "a3_first_rows",
    f"""SELECT * EXCLUDE (k, l) FROM (SELECT {_HEADED}, k, l FROM sales_keyed) ORDER BY k, l LIMIT 100""",
    sales_keyed=VIEWS["sales"].replace(
        "\nFROM lineitem", ", l_orderkey AS k, l_linenumber AS l\nFROM lineitem", 1
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    # Files of sorted rows, whose first rows are those that come first in them.
    sources = landing_sources(_folder(spark, "landing"))
    keyed = src.sales(spark, sf, keys=True).orderBy("l_orderkey", "l_linenumber")
    src.under_headers(keyed, "ventas").write.parquet(sources["ventas"].path)
    return first_rows(read_source(spark, sources, "ventas", order=PLACE), 100)


@query(
    "a4_full_load",
    """SELECT 'fact_ventas' AS tabla, sk_region AS sk, count(*) AS filas,
      CAST(sum(valor_antes_iva) AS DOUBLE) AS total FROM fact_ventas GROUP BY ALL UNION ALL
    SELECT 'fact_presupuesto', sk_region, count(*), CAST(sum(tyt) AS DOUBLE)
      FROM fact_presupuesto GROUP BY ALL UNION ALL
    SELECT 'fact_gestion_tmk', sk_region, count(*), CAST(sum(cantidad) AS DOUBLE)
      FROM fact_gestion_tmk GROUP BY ALL""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    # The second load of this mart has replaced all that the first one wrote.
    mart = reloaded(spark, sf)
    parts = []
    for table, measure in (
        ("fact_ventas", "valor_antes_iva"),
        ("fact_presupuesto", "tyt"),
        ("fact_gestion_tmk", "cantidad"),
    ):
        parts.append(
            mart.read(table)
            .groupBy(F.col("sk_region").alias("sk"))
            .agg(F.count("*").alias("filas"), F.sum(measure).cast("double").alias("total"))
            .withColumn("tabla", F.lit(table))
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _region_merge(spark: SparkSession, sf: str) -> DataFrame:
    spec = dims.TEXT_DIMENSIONS["dim_region"]
    frames = {
        "ventas": src.sales(spark, sf, ["region_comercial"]),
        "presupuesto": src.budget(spark, sf),
        "registros": src.contacts(spark, sf),
    }
    earlier = {k: v for k, v in frames.items() if k != "registros"}
    old = dims.members(spec, earlier).withColumn("nombre_region", F.lower("region_nk"))
    seeds = dims.seed_rows(spark, spec.table)
    existing = dims.merge_members(seeds, old, spec).drop("_action")
    unknown = seeds.select(*spec.key, F.lit("x").alias("nombre_region"), "es_sin_region")
    incoming = dims.members(spec, frames).unionByName(unknown)
    return dims.merge_members(existing, incoming, spec)


_REGION_OLD = """SELECT row_number() OVER (ORDER BY nk) AS sk, nk FROM (
  SELECT region_comercial AS nk FROM sales UNION SELECT region FROM budget) WHERE nk IS NOT NULL"""
_REGION_NEW = """SELECT (SELECT max(sk) FROM region_old) + row_number() OVER (ORDER BY nk) AS sk, nk
  FROM (SELECT DISTINCT division_comercial AS nk FROM contacts)
  WHERE nk IS NOT NULL AND nk NOT IN (SELECT nk FROM region_old)"""


@query(
    "a5_dimension_merge",
    """SELECT 0 AS sk_region, 'NO_INFORMADO' AS region_nk, 'No informado' AS nombre_region,
      true AS es_sin_region, 'skipped' AS accion UNION ALL
    SELECT sk, nk, nk, upper(nk) LIKE '%SIN%', 'updated' FROM region_old UNION ALL
    SELECT sk, nk, nk, upper(nk) LIKE '%SIN%', 'inserted' FROM region_new""",
    region_old=_REGION_OLD,
    region_new=_REGION_NEW,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _region_merge(spark, sf).withColumnRenamed("_action", "accion")


@query(
    "a5_dimension_merge_counts",
    """SELECT (SELECT count(*) FROM region_new) AS inserted,
      (SELECT count(*) FROM region_old) AS updated, 1 AS skipped""",
    region_old=_REGION_OLD,
    region_new=_REGION_NEW,
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return dims.merge_counts(_region_merge(spark, sf))


def _natural_key(table: str, text: str = "VARCHAR") -> str:
    """The whole natural key as one text, the same expression in both engines."""
    parts = [f"coalesce(CAST({c} AS {text}), '-')" for c in dims.ALL_DIMENSIONS[table].key]
    return " || '/' || ".join(parts)


@query(
    "a6_seed_members",
    " UNION ALL ".join(
        f"SELECT '{table}' AS tabla, {STAR[table].names[0]} AS sk, {_natural_key(table)} AS nk FROM {table}"
        for table in DIMENSIONS
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    tables = loaded(spark, sf)[1].tables
    parts = []
    for table in DIMENSIONS:
        sk = STAR[table].names[0]
        # Members without their fixed rows, then seeded twice: the second time adds nothing.
        bare = tables[table].where(F.col(sk) > (0 if table != "dim_validez_venta" else 2))
        seeded = dims.ensure_seeds(dims.ensure_seeds(bare, table), table)
        nk = F.expr(_natural_key(table, "string")).alias("nk")
        parts.append(seeded.select(F.lit(table).alias("tabla"), F.col(sk).alias("sk"), nk))
    return reduce(DataFrame.unionByName, parts)


@query(
    "a7_star_tables",
    " UNION ALL ".join(
        f"SELECT '{t}' AS tabla, {len(s.names)} AS columnas, count(*) AS filas FROM {t}"
        for t, s in STAR.items()
    ),
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    mart, _result = loaded(spark, sf)
    mart.create()
    parts = [
        df.agg(
            F.lit(table).alias("tabla"),
            F.lit(len(df.drop(PERIOD.name).columns)).alias("columnas"),
            F.count("*").alias("filas"),
        )
        for table, df in mart.read_all().items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query(
    "a8_calendar_backfill",
    """SELECT CAST(fecha AS VARCHAR) AS fecha, periodo_yyyymm, es_dia_habil, es_festivo_co,
      CASE WHEN fecha IS NULL THEN false ELSE es_festivo_co END AS es_festivo,
      CAST(NULL AS VARCHAR) AS nombre_festivo,
      CASE WHEN fecha IS NULL THEN false ELSE es_dia_habil END AS es_habil FROM dim_tiempo""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    older = loaded(spark, sf)[1].tables["dim_tiempo"].select(
        "fecha", "periodo_yyyymm", "es_dia_habil", "es_festivo_co"
    )
    return cal.backfill_master_columns(older)


@query(
    "a8_calendar_migration",
    """SELECT CAST(fecha AS VARCHAR) AS fecha, es_habil, es_festivo, CAST(NULL AS VARCHAR) AS nombre_festivo
    FROM dim_tiempo""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    """A stored calendar from before the three later columns, brought up to date in its mart."""
    later = ("es_festivo", "nombre_festivo", "es_habil")
    mart = new_mart(spark)
    spark.sql(f"CREATE DATABASE {mart.database}")
    older = loaded(spark, sf)[1].tables["dim_tiempo"].drop(*later)
    older.write.option("path", f"{mart.location}/dim_tiempo/old").saveAsTable(mart.name("dim_tiempo"))
    mart.create()
    evolve(mart)
    return spark.table(mart.name("dim_tiempo")).select("fecha", *later)


@query(
    "a9_export",
    """SELECT formato, codigo_factura, count(*) AS ocurrencias
    FROM sales, (VALUES ('csv'), ('json')) AS f(formato) WHERE codigo_factura IS NOT NULL
    GROUP BY ALL HAVING count(*) > 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    report = profiling.repeated_values(
        src.sales(spark, sf, ["codigo_factura"]), ["codigo_factura"]
    )
    root = _folder(spark, "reports")
    export_csv(report, f"{root}/csv")
    export_json(report, f"{root}/json")
    reader = spark.read.schema(report.schema)
    back = {
        "csv": reader.option("header", "true").csv(f"{root}/csv"),
        "json": spark.read.schema(report.schema).json(f"{root}/json"),
    }
    parts = [df.withColumn("formato", F.lit(name)) for name, df in back.items()]
    return parts[0].unionByName(parts[1])


_SALES_OUT = "* REPLACE (CAST(valor_antes_de_iva AS DOUBLE) AS valor_antes_de_iva)"


@query("b1_normalize_columns", f"SELECT {_SALES_OUT} FROM sales")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return src.under_headers(src.sales(spark, sf), "ventas").transform(clean.normalize_columns)


@query("b2_strip_text", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def _(spark: SparkSession, sf: str) -> DataFrame:
    padded = src.table(spark, sf, "documents").select(
        "doc_id",
        "text",
        F.concat(F.lit("\t"), "lang", F.lit(" ")).alias("lang"),
        F.concat(F.lit(" "), "source", F.lit("\r\n")).alias("source"),
        "n_chars",
    )
    return clean.strip_text(padded)


_DAY_TEXT = """CASE WHEN l_suppkey % 11 = 0 THEN NULL WHEN l_suppkey % 13 = 0 THEN 'sin fecha'
  WHEN l_suppkey % 17 = 0 THEN strftime(l_shipdate, '%Y%m') || '99'
  WHEN l_suppkey % 19 = 0 THEN strftime(l_shipdate, '%Y%m%d') || '.0'
  ELSE strftime(l_shipdate, '%Y%m%d') END"""


@query(
    "b3_parse_yyyymmdd",
    f"""SELECT l_orderkey, l_linenumber, texto,
      CAST(CAST(try_strptime(CAST(CAST(TRY_CAST(texto AS DOUBLE) AS BIGINT) AS VARCHAR), '%Y%m%d')
        AS DATE) AS VARCHAR) AS fecha
    FROM (SELECT *, {_DAY_TEXT} AS texto FROM lineitem)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    text = F.expr(
        """CASE WHEN l_suppkey % 11 = 0 THEN NULL WHEN l_suppkey % 13 = 0 THEN 'sin fecha'
        WHEN l_suppkey % 17 = 0 THEN date_format(l_shipdate, 'yyyyMM') || '99'
        WHEN l_suppkey % 19 = 0 THEN date_format(l_shipdate, 'yyyyMMdd') || '.0'
        ELSE date_format(l_shipdate, 'yyyyMMdd') END"""
    )
    lines = src.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.alias("texto"))
    return clean.parse_yyyymmdd(lines.withColumn("fecha", F.col("texto")), ["fecha"])


@query(
    "b4_parse_yyyymm",
    """SELECT 'presupuesto' AS fuente, mes AS valor,
      CAST(make_date(CAST(mes // 100 AS BIGINT), CAST(mes % 100 AS BIGINT), 1) AS VARCHAR) AS fecha,
      count(*) AS filas FROM budget GROUP BY ALL UNION ALL
    SELECT 'registros', periodo,
      CAST(make_date(CAST(periodo // 100 AS BIGINT), CAST(periodo % 100 AS BIGINT), 1) AS VARCHAR),
      count(*) FROM contacts GROUP BY ALL""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    months = src.budget(spark, sf).select(F.lit("presupuesto").alias("fuente"), F.col("mes").alias("valor"))
    periods = src.contacts(spark, sf).select(F.lit("registros").alias("fuente"), F.col("periodo").alias("valor"))
    both = months.unionByName(periods).withColumn("fecha", F.col("valor"))
    parsed = clean.parse_yyyymm(both, "fecha")
    return parsed.groupBy("fuente", "valor", "fecha").agg(F.count("*").alias("filas"))


@query(
    "b5_parse_iso",
    """SELECT event_id, CASE WHEN event_id % 7 = 0 OR fecha_gestion IS NULL THEN NULL
      ELSE fecha_gestion END AS fecha FROM contact_events""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("fecha_gestion")
    written = (
        F.when(F.col("event_id") % 7 == 0, F.date_format(day.cast("date"), "dd/MM/yyyy"))
        .when(F.col("event_id") % 5 == 0, F.concat(day, F.lit(" 10:30:00")))
        .when(F.col("event_id") % 3 == 0, F.concat(day, F.lit("T23:59:59")))
        .otherwise(day)
    )
    records = src.contacts(spark, sf, keys=True).select("event_id", written.alias("fecha"))
    return clean.parse_iso(records, ["fecha"])


@query(
    "b6_cast_columns",
    """SELECT l_orderkey, l_linenumber,
      CASE WHEN l_suppkey % 23 <> 0 THEN CAST(CAST(l_quantity AS DECIMAL(8,2)) AS DOUBLE) END AS cantidad,
      CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS precio,
      CAST(l_partkey AS VARCHAR) AS parte FROM lineitem""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    text = src.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.expr("if(l_suppkey % 23 = 0, 'n/a', cast(l_quantity as string))").alias("cantidad"),
        F.col("l_extendedprice").alias("precio"),
        F.col("l_partkey").alias("parte"),
    )
    types = {"cantidad": "decimal(8,2)", "precio": "decimal(18,2)", "parte": "string", "x": "date"}
    return clean.cast_columns(text, types, mode="permissive")


@query(
    "b7_drop_duplicate_rows",
    """SELECT DISTINCT event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props FROM (
      SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 100 = 0)""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    events = src.table(spark, sf, "events").select(
        "event_id",
        F.expr("unix_micros(cast(ts as timestamp))").alias("ts_us"),
        "user_id",
        "event_type",
        "value",
        "props",
    )
    copies = F.expr("if(event_id % 100 = 0, array(1, 2), array(1))")
    return clean.drop_duplicate_rows(events.withColumn("_c", F.explode(copies)).drop("_c"))


_LINE_KEY = ["l_orderkey", "l_linenumber"]
_LINE_ORDER = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]
_LINE_SELECT = "* REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate)"


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = src.table(spark, sf, "lineitem")
    return lines.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


def _line_oracle(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in _LINE_ORDER)
    return f"""SELECT {_LINE_SELECT} FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) = 1"""


@query("b8_first_per_key", _line_oracle("ASC"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_duplicates_by(_lines(spark, sf), _LINE_KEY, _LINE_ORDER, "first")


@query("b8_last_per_key", _line_oracle("DESC"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_duplicates_by(_lines(spark, sf), _LINE_KEY, _LINE_ORDER, "last")


@query(
    "b8_unrepeated_keys",
    f"""SELECT {_LINE_SELECT} FROM lineitem
    QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_duplicates_by(_lines(spark, sf), _LINE_KEY, _LINE_ORDER, "none")


@query(
    "b9_fill_nulls",
    """SELECT fecha_venta, coalesce(codigo_factura, 'SIN') AS codigo_factura,
      coalesce(nota_credito, 'NO') AS nota_credito, gv_desc2, coalesce(cuotas, 0) AS cuotas
    FROM sales""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["fecha_venta", "codigo_factura", "nota_credito", "gv_desc2", "cuotas"]
    values = {"codigo_factura": "SIN", "nota_credito": "NO", "cuotas": 0.0, "ausente": 1}
    return clean.fill_nulls(src.sales(spark, sf, columns), values)


@query(
    "b10_drop_null_rows",
    """SELECT fecha_venta, codigo_factura, gv_desc2, cedula_vendedor FROM sales
    WHERE codigo_factura IS NOT NULL AND gv_desc2 IS NOT NULL""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["fecha_venta", "codigo_factura", "gv_desc2", "cedula_vendedor"]
    return clean.drop_null_rows(src.sales(spark, sf, columns), ["codigo_factura", "gv_desc2", "x"])


@query(
    "b11_key_text",
    """SELECT CASE WHEN cedula_vendedor <> '-' THEN cedula_vendedor END AS clave, count(*) AS filas
    FROM sales GROUP BY ALL""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    code = F.col("cedula_vendedor")
    padded = F.when(code == "-", F.lit(" \t")).otherwise(F.concat(F.lit("\n "), code, F.lit("\t")))
    keyed = src.sales(spark, sf, ["cedula_vendedor"]).select(key_text(padded).alias("clave"))
    return keyed.groupBy("clave").agg(F.count("*").alias("filas"))


@query(
    "b12_period",
    """SELECT CAST(fecha_venta // 100 AS BIGINT) AS periodo, (2000 + ano) * 100 + mes AS periodo_corto,
      count(*) AS filas FROM sales GROUP BY ALL""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    events = src.sales(spark, sf, ["fecha_venta", "ano", "mes"])
    day = dates.from_yyyymmdd(whole_number(F.col("fecha_venta")))
    return events.groupBy(
        dates.period(day).cast("bigint").alias("periodo"),
        dates.period_of_short_year(F.col("ano"), F.col("mes")).alias("periodo_corto"),
    ).agg(F.count("*").alias("filas"))


_DAY_COLUMNS = [f for f in STAR["dim_tiempo"].names if f != "sk_tiempo"]


@query(
    "b13_dimension_rows",
    """SELECT CAST(strftime(fecha, '%Y%m%d') AS BIGINT) AS sk_tiempo,
      * REPLACE (CAST(fecha AS VARCHAR) AS fecha) FROM calendar""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    days = src.calendar(spark, sf)
    as_text = days.select(
        F.date_format("fecha", "yyyyMMdd").alias("sk_tiempo"),
        *[
            F.concat(F.col(c).cast("string"), F.lit(" ")).alias(c)
            if c in ("nombre_mes", "nombre_festivo")
            else F.col(c).cast("string").alias(c)
            for c in _DAY_COLUMNS
        ],
    )
    return conformed(as_text, "dim_tiempo")


@query(
    "b14_fact_rows",
    """SELECT l_orderkey AS sk_venta, l_partkey AS sk_tiempo, l_suppkey AS sk_region, 1 AS sk_canal,
      2 AS sk_categoria, 3 AS sk_jerarquia, 4 AS sk_aliado, 5 AS sk_marca, 6 AS sk_vendedor,
      7 AS sk_validez,
      CASE WHEN l_linestatus = 'F' THEN 'F' || l_linenumber END AS codigo_factura,
      CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS valor_antes_iva,
      CAST(CAST(CASE WHEN l_linenumber = 1 THEN l_quantity END AS DECIMAL(8,2)) AS DOUBLE) AS cuotas
    FROM lineitem""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    keys = STAR["fact_ventas"].names[3:10]
    rows = src.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("sk_venta"),
        F.col("l_partkey").cast("string").alias("sk_tiempo"),
        F.col("l_suppkey").cast("double").alias("sk_region"),
        *[F.lit(str(i)).alias(key) for i, key in enumerate(keys, 1)],
        F.expr("if(l_linestatus = 'F', concat(' F', l_linenumber, '\t'), '  ')").alias(
            "codigo_factura"
        ),
        F.col("l_extendedprice").alias("valor_antes_iva"),
        F.expr("if(l_linenumber = 1, l_quantity, null)").alias("cuotas"),
        F.lit("2026-01-01 00:00:00").alias("fecha_carga_dw"),
        F.coalesce(F.date_format("l_shipdate", "yyyyMM"), F.lit("0")).alias(PERIOD.name),
    )
    return conformed(rows, "fact_ventas").drop("fecha_carga_dw", PERIOD.name)


@query(
    "b15_clean_sales",
    """SELECT * REPLACE (CAST(fecha_venta AS VARCHAR) AS fecha_venta,
      CAST(fecha_finalizacion_reserva AS VARCHAR) AS fecha_finalizacion_reserva,
      CAST(cuotas AS DOUBLE) AS cuotas, CAST(valor_antes_de_iva AS DOUBLE) AS valor_antes_de_iva)
    FROM sales_clean""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_sales(src.sales_raw(spark, sf))


@query(
    "b15_clean_budget",
    """SELECT * REPLACE (CAST(mes AS VARCHAR) AS mes, CAST(terminales AS DOUBLE) AS terminales,
      CAST(tecnologia AS DOUBLE) AS tecnologia, CAST(t_t AS DOUBLE) AS t_t) FROM budget_clean""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_budget(src.under_headers(src.budget(spark, sf), "presupuesto"))


@query(
    "b15_clean_contacts",
    """SELECT * REPLACE (CAST(periodo AS VARCHAR) AS periodo,
      CAST(fecha_gestion AS VARCHAR) AS fecha_gestion, CAST(fecha_cargue AS VARCHAR) AS fecha_cargue,
      CAST(intentos AS DOUBLE) AS intentos) FROM contacts_clean""",
)
def _(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_contacts(src.under_headers(src.contacts(spark, sf), "registros"))
