"""Views that give the test tables the shape of the commercial sources.

Every row of ``lineitem`` is a sale event, ``orders`` is summed to monthly budgets and every
row of ``events`` is a contact record. Nulls, which the tables lack, are put in by rule. All
look-ups are left joins on unique keys, so a view joins only the tables its columns need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.functions.text import header_names
from lonja.operators.calendar import calendar_days, date_spine, holiday_names
from lonja.sources.schemas import LANDING

# Civil holidays by month and day; the nameless one must be dropped and of the
# two names of one date the last must win.
HOLIDAYS = (
    ("01-01", "Año Nuevo"),
    ("03-01", None),
    ("05-01", "Día del Trabajo"),
    ("07-20", "Independencia"),
    ("08-07", "Batalla de Boyacá"),
    ("12-08", "Inmaculada Concepción"),
    ("12-25", "Natividad"),
    ("12-25", "Navidad"),
)

_YMD = "cast(date_format({0}, 'yyyyMMdd') as bigint)"

# Column, expression, and the look-up it needs.
_SALES = {
    "fecha_venta": (_YMD.format("l_shipdate"), None),
    "fecha_finalizacion_reserva": (_YMD.format("date_add(to_date(l_shipdate), 3)"), None),
    "descripcion_estado_reserva": ("if(l_linestatus = 'O', 'Tramitada', 'Activated')", None),
    "identificacion": ("concat('C', o_custkey)", "orders"),
    "cuotas": ("if(l_linenumber = 1, l_quantity, null)", None),
    "cedula_vendedor": ("if(l_suppkey % 50 = 0, '-', cast(l_suppkey as string))", None),
    "region_comercial": ("r_name", "region"),
    "archivo": ("concat('archivo_', l_linestatus)", None),
    "codigo_factura": (
        "if(l_linestatus = 'F', concat('F', l_orderkey, '-', l_linenumber), null)",
        None,
    ),
    "gv_division": ("concat('D', s_regionkey)", "seller"),
    "gv_especialista": ("if(l_suppkey % 3 = 0, null, s_name)", "seller"),
    "gv_jefe_1_canal_regional": ("if(l_suppkey % 3 = 0, null, s_nation)", "seller"),
    "canal": ("o_orderpriority", "orders"),
    "canal2": ("o_orderstatus", "orders"),
    "gv_desc2": ("if(l_suppkey % 10 = 0, null, concat('A', l_suppkey % 20))", None),
    "categoria": ("p_type", "part"),
    "ano": ("cast(year(l_shipdate) % 100 as bigint)", None),
    "mes": ("cast(month(l_shipdate) as bigint)", None),
    "dia": ("cast(day(l_shipdate) as bigint)", None),
    "d_division": ("r_name", "region"),
    "gv_gerente_area": ("concat('G', s_regionkey)", "seller"),
    "valor_antes_de_iva": (
        "cast(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2)))"
        " as decimal(18,2))",
        None,
    ),
    "marca": ("p_brand", "part"),
    "nota_credito": ("if(l_returnflag = 'R', 'SI', null)", None),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None, keys: bool = False
) -> DataFrame:
    """Sale events; ``keys`` adds the line's own columns that fix a row order."""
    columns = list(columns or _SALES)
    needs = {_SALES[c][1] for c in columns} - {None}
    lines = table(spark, sf_dir, "lineitem")
    if "part" in needs:
        # First, while the lines are narrow: a part table too large to broadcast shuffles them.
        part = table(spark, sf_dir, "part")
        lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    orders = table(spark, sf_dir, "orders")
    if "region" in needs:
        customer = table(spark, sf_dir, "customer")
        nation = table(spark, sf_dir, "nation")
        region = table(spark, sf_dir, "region")
        places = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(
            region, F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )
        # The few columns of an order meet its place before the wider lines do.
        orders = orders.join(places, F.col("o_custkey") == F.col("c_custkey"), "left")
    if needs & {"orders", "region"}:
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "seller" in needs:
        nation = table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("s_place"),
            F.col("n_name").alias("s_nation"),
            F.col("n_regionkey").alias("s_regionkey"),
        )
        # One after the other: Spark takes a join for as large as the product of its sides, and would
        # shuffle all lines for suppliers that meet their nations first.
        supplier = table(spark, sf_dir, "supplier")
        lines = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        lines = lines.join(nation, F.col("s_nationkey") == F.col("s_place"), "left")
    own = list(table(spark, sf_dir, "lineitem").columns) if keys else []
    return lines.select(*own, *[F.expr(_SALES[c][0]).alias(c) for c in columns])


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales plus a second copy of some of them, under the raw headers."""
    twice = F.coalesce(F.col("codigo_factura").like("%000-%"), F.lit(False))
    copies = F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return under_headers(
        sales(spark, sf_dir).withColumn("_copy", F.explode(copies)).drop("_copy"), "ventas"
    )


def budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly budget crosses, with a second allocation for one month and region."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    crosses = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .groupBy(
            F.date_format("o_orderdate", "yyyyMM").cast("bigint").alias("mes"),
            F.col("r_name").alias("region"),
            F.col("r_regionkey").alias("_region"),
            F.col("o_orderpriority").alias("canal"),
            F.col("o_orderstatus").alias("canal2"),
            F.col("c_mktsegment").alias("unidad_de_gestion"),
        )
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("_precio"))
        .withColumn(
            "terminales",
            (F.col("_precio") * F.lit("0.2135").cast("decimal(5,4)")).cast("decimal(20,4)"),
        )
    )
    measured = crosses.select(
        "mes",
        "region",
        "canal",
        "canal2",
        F.expr("nullif(unidad_de_gestion, 'BUILDING')").alias("sub_canal"),
        F.lit("STANDARD").alias("categoria"),
        "unidad_de_gestion",
        F.lit(None).cast("string").alias("especialista"),
        F.lit(None).cast("string").alias("jefe"),
        F.expr("concat('G', _region)").alias("gerente"),
        F.expr("concat('A', _region)").alias("descrip2"),
        "terminales",
        _times("terminales", "0.25").alias("tecnologia"),
        F.when(
            F.col("unidad_de_gestion") != "FURNITURE", _times("terminales", "1.25")
        ).alias("t_t"),
    )
    twice = F.expr("mes = 199603 and region = 'ASIA'")
    copies = F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        measured.withColumn("_copy", F.explode(copies))
        .withColumns(
            {
                m: F.when(F.col("_copy") == 2, _times(m, "0.1")).otherwise(F.col(m))
                for m in ("terminales", "tecnologia", "t_t")
            }
        )
        .drop("_copy")
    )


def _times(column: str, factor: str) -> Column:
    scale = len(factor.split(".")[1])
    return (F.col(column) * F.lit(factor).cast(f"decimal(5,{scale})")).cast("decimal(20,4)")


def contacts(spark: SparkSession, sf_dir: str, keys: bool = False) -> DataFrame:
    """Contact records; ``keys`` adds the event id, which fixes a row order."""
    regions = table(spark, sf_dir, "region")
    events = table(spark, sf_dir, "events").join(
        regions, F.col("user_id") % 5 == F.col("r_regionkey"), "left"
    )
    untyped = F.col("event_id") % 67 == 0
    kind = F.col("event_type")
    amount = (1 + F.col("event_id") % 5).cast("bigint")
    return events.select(
        *(["event_id"] if keys else []),
        amount.alias("cantidad"),
        F.when(F.col("user_id") % 31 == 0, "SIN_REGION")
        .otherwise(F.col("r_name"))
        .alias("division_comercial"),
        F.expr("concat('C', lpad(cast(user_id % 24 as string), 2, '0'))").alias("nombre_campana"),
        F.date_format("ts", "yyyyMM").cast("bigint").alias("periodo"),
        F.when(~untyped, F.date_format("ts", "yyyy-MM-dd")).alias("fecha_gestion"),
        F.when(~untyped & kind.isin("purchase", "signup"), "CONTACTOS EFECTIVOS")
        .when(~untyped & (kind == "click"), "CONTACTOS NO EFECTIVOS")
        .when(~untyped, "NO CONTACTOS")
        .alias("tipo_contacto"),
        kind.alias("detalle1"),
        (amount * (1 + F.col("user_id") % 4)).cast("decimal(18,2)").alias("intentos"),
        F.date_format(F.last_day(F.to_date("ts")), "yyyy-MM-dd").alias("fecha_cargue"),
        F.expr("if(user_id % 2 = 0, null, concat('AREA', user_id % 3))").alias("area_comercial"),
        F.expr("concat('S', cast(get_json_object(props, '$.k') as bigint) % 9)").alias("segmento"),
        F.day("ts").cast("bigint").alias("dia"),
        F.expr("concat('A', user_id % 20)").alias("aliado"),
        F.expr("concat('G', user_id % 5)").alias("gerente"),
        F.lit(None).cast("string").alias("jefe"),
        F.lit(None).cast("string").alias("especialista"),
    )


def under_headers(df: DataFrame, source: str) -> DataFrame:
    """The columns of a landing source in file order, under their raw headers."""
    raw = LANDING[source].names
    return df.select(*[F.col(n).alias(h) for n, h in zip(header_names(raw), raw)])


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three sources as they land."""
    return {
        "ventas": sales_raw(spark, sf_dir),
        "presupuesto": under_headers(budget(spark, sf_dir), "presupuesto"),
        "registros": under_headers(contacts(spark, sf_dir), "registros"),
    }


def years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years of the calendar: those of the orders but for the last, and those of the events.

    The last order year stays out, so that some dates have no calendar row.
    """
    order_day, event_day = F.year("o_orderdate"), F.year("ts")
    spans = (
        table(spark, sf_dir, "orders")
        .agg(F.min(order_day).alias("a"), (F.max(order_day) - 1).alias("b"))
        .unionByName(
            table(spark, sf_dir, "events").agg(
                F.min(event_day).alias("a"), F.max(event_day).alias("b")
            )
        )
    )
    return spans.select(F.explode(F.sequence("a", "b")).alias("anio")).distinct()


def holidays(years_table: DataFrame) -> DataFrame:
    """The holiday source for the given years, in file order ``_src_row``."""
    rows = F.array(
        *[
            F.struct(
                F.lit(day).alias("day"),
                F.lit(name).cast("string").alias("name_es"),
                F.lit(i).alias("_src_row"),
            )
            for i, (day, name) in enumerate(HOLIDAYS)
        ]
    )
    return years_table.select("anio", F.explode(rows).alias("h")).select(
        F.concat_ws("-", F.col("anio").cast("string"), "h.day").alias("date"),
        "h.name_es",
        "h._src_row",
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar days of the data's years."""
    span = years(spark, sf_dir)
    return calendar_days(date_spine(span), holiday_names(holidays(span), "_src_row"))
