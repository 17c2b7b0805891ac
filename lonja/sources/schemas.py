"""Landing schemas of the raw sources and the star schema of the mart.

Table and column names, types, lengths and seed rows are fixed values: they are the data model.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

LONG, TEXT, DAY, FLAG, INT = LongType(), StringType(), DateType(), BooleanType(), IntegerType()
DOUBLE = DoubleType()
MONEY, INSTALMENTS = DecimalType(18, 2), DecimalType(8, 2)
TARGET, ATTEMPTS = DecimalType(20, 4), DecimalType(18, 2)


def _landing(**columns: DataType) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in columns.items()])


# Raw header of each landing column, in file order, with its landing type.
SALES_HEADERS: dict[str, DataType] = {
    "Fecha Venta": LONG,
    "Fecha Finalización Reserva": LONG,
    "Descripción Estado Reserva": TEXT,
    "Identificación": TEXT,
    "Cuotas": DOUBLE,
    "Cédula Vendedor": TEXT,
    "Región Comercial": TEXT,
    "Archivo": TEXT,
    "Código Factura": TEXT,
    "GV-Division": TEXT,
    "GV-Especialista": TEXT,
    "GV-JEFE 1 CANAL REGIONAL": TEXT,
    "CANAL": TEXT,
    "CANAL2": TEXT,
    "GV_Desc2": TEXT,
    "CATEGORIA": TEXT,
    "AÑO": LONG,
    "MES": LONG,
    "DIA": LONG,
    "D_Division": TEXT,
    "GV-Gerente Area": TEXT,
    "Valor Antes de iva": MONEY,
    "Marca": TEXT,
    "Nota_credito": TEXT,
}
BUDGET_HEADERS: dict[str, DataType] = {
    "MES": LONG,
    "REGION": TEXT,
    "CANAL": TEXT,
    "CANAL2": TEXT,
    "SUB CANAL": TEXT,
    "CATEGORIA": TEXT,
    "UNIDAD DE GESTION": TEXT,
    "ESPECIALISTA": TEXT,
    "JEFE": TEXT,
    "GERENTE": TEXT,
    "DESCRIP2": TEXT,
    "TERMINALES": TARGET,
    "TECNOLOGIA": TARGET,
    "T&T": TARGET,
}
CONTACT_HEADERS: dict[str, DataType] = {
    "CANTIDAD": LONG,
    "DIVISION_COMERCIAL": TEXT,
    "NOMBRE_CAMPAÑA": TEXT,
    "PERIODO": LONG,
    "FECHA_GESTION": TEXT,
    "TIPO_CONTACTO": TEXT,
    "DETALLE1": TEXT,
    "INTENTOS": ATTEMPTS,
    "FECHA_CARGUE": TEXT,
    "AREA_COMERCIAL": TEXT,
    "SEGMENTO": TEXT,
    "dia": LONG,
    "ALIADO": TEXT,
    "gerente": TEXT,
    "jefe": TEXT,
    "Especialista": TEXT,
}
LANDING = {
    "ventas": StructType([StructField(n, t) for n, t in SALES_HEADERS.items()]),
    "presupuesto": StructType([StructField(n, t) for n, t in BUDGET_HEADERS.items()]),
    "registros": StructType([StructField(n, t) for n, t in CONTACT_HEADERS.items()]),
}
HOLIDAYS = _landing(date=TEXT, name_es=TEXT)

# Types of the cleaned columns; columns not listed keep their landing type.
SALES_TYPES: dict[str, DataType] = {
    "cuotas": INSTALMENTS,
    "valor_antes_de_iva": MONEY,
    "ano": LONG,
    "mes": LONG,
    "dia": LONG,
    "identificacion": TEXT,
    "cedula_vendedor": TEXT,
    "codigo_factura": TEXT,
    "region_comercial": TEXT,
    "gv_division": TEXT,
    "d_division": TEXT,
    "canal": TEXT,
    "canal2": TEXT,
    "categoria": TEXT,
    "marca": TEXT,
    "nota_credito": TEXT,
}
BUDGET_TYPES: dict[str, DataType] = {
    "terminales": TARGET,
    "tecnologia": TARGET,
    "t_t": TARGET,
    "region": TEXT,
    "canal": TEXT,
    "canal2": TEXT,
    "sub_canal": TEXT,
    "categoria": TEXT,
    "unidad_de_gestion": TEXT,
    "especialista": TEXT,
    "jefe": TEXT,
    "gerente": TEXT,
    "descrip2": TEXT,
}
CONTACT_TYPES: dict[str, DataType] = {
    "cantidad": LONG,
    "dia": LONG,
    "intentos": ATTEMPTS,
    "division_comercial": TEXT,
    "nombre_campana": TEXT,
    "tipo_contacto": TEXT,
    "detalle1": TEXT,
    "area_comercial": TEXT,
    "segmento": TEXT,
    "aliado": TEXT,
    "gerente": TEXT,
    "jefe": TEXT,
    "especialista": TEXT,
}


def _required(name: str, dtype: DataType) -> StructField:
    return StructField(name, dtype, False)


def _text(name: str, length: int, nullable: bool = False) -> StructField:
    return StructField(name, TEXT, nullable, {"length": length})


def _keys(*names: str) -> list[StructField]:
    return [_required(name, LONG) for name in names]


LOADED_AT = _required("fecha_carga_dw", TimestampNTZType())

# The thirteen dimensions and three facts.
STAR: dict[str, StructType] = {
    "dim_tiempo": StructType(
        [
            *_keys("sk_tiempo"),
            StructField("fecha", DAY),
            _required("anio", INT),
            _required("mes", INT),
            StructField("dia", INT),
            _required("periodo_yyyymm", INT),
            _text("nombre_mes", 20, True),
            StructField("dia_semana", INT),
            _required("es_dia_habil", FLAG),
            _required("es_festivo_co", FLAG),
            StructField("es_fin_semana", FLAG),
            _required("es_festivo", FLAG),
            _text("nombre_festivo", 120, True),
            _required("es_habil", FLAG),
        ]
    ),
    "dim_region": StructType(
        [
            *_keys("sk_region"),
            _text("region_nk", 100),
            _text("nombre_region", 100),
            _required("es_sin_region", FLAG),
        ]
    ),
    "dim_canal": StructType(
        [
            *_keys("sk_canal"),
            _text("canal", 80),
            _text("canal2", 80, True),
            _text("sub_canal", 80, True),
        ]
    ),
    "dim_categoria": StructType(
        [*_keys("sk_categoria"), _text("categoria_nk", 80), _text("nombre_categoria", 80)]
    ),
    "dim_jerarquia_comercial": StructType(
        [
            *_keys("sk_jerarquia"),
            _text("gerente", 80, True),
            _text("jefe", 80, True),
            _text("especialista", 80, True),
        ]
    ),
    "dim_aliado": StructType(
        [*_keys("sk_aliado"), _text("aliado_nk", 80), _text("nombre_aliado", 120)]
    ),
    "dim_unidad_gestion": StructType(
        [
            *_keys("sk_unidad_gestion"),
            _text("unidad_gestion_nk", 120),
            _text("nombre_unidad_gestion", 120),
        ]
    ),
    "dim_marca": StructType(
        [*_keys("sk_marca"), _text("marca_nk", 80), _text("nombre_marca", 80)]
    ),
    "dim_vendedor": StructType(
        [
            *_keys("sk_vendedor"),
            _text("cedula_vendedor_nk", 40),
            _text("nombre_vendedor", 120, True),
        ]
    ),
    "dim_validez_venta": StructType(
        [
            *_keys("sk_validez"),
            _required("tiene_factura", FLAG),
            _required("tiene_nota_credito", FLAG),
            _required("es_venta_valida", FLAG),
            _text("descripcion", 80),
        ]
    ),
    "dim_campana": StructType(
        [*_keys("sk_campana"), _text("campana_nk", 200), _text("nombre_campana", 200)]
    ),
    "dim_segmento": StructType(
        [
            *_keys("sk_segmento"),
            _text("segmento_nk", 80),
            _text("segmento_normalizado", 80),
            _text("nombre_segmento", 80),
        ]
    ),
    "dim_tipo_contacto": StructType(
        [
            *_keys("sk_tipo_contacto"),
            _text("tipo_contacto", 80),
            _text("detalle_contacto", 120, True),
            _text("nombre_tipo_contacto", 160),
        ]
    ),
    "fact_ventas": StructType(
        [
            *_keys(
                "sk_venta",
                "sk_tiempo",
                "sk_region",
                "sk_canal",
                "sk_categoria",
                "sk_jerarquia",
                "sk_aliado",
                "sk_marca",
                "sk_vendedor",
                "sk_validez",
            ),
            _text("codigo_factura", 40, True),
            _required("valor_antes_iva", MONEY),
            StructField("cuotas", INSTALMENTS),
            LOADED_AT,
        ]
    ),
    "fact_presupuesto": StructType(
        [
            *_keys(
                "sk_presupuesto",
                "sk_tiempo",
                "sk_region",
                "sk_canal",
                "sk_categoria",
                "sk_unidad_gestion",
                "sk_jerarquia",
                "sk_aliado",
            ),
            _required("terminales", TARGET),
            _required("tecnologia", TARGET),
            _required("tyt", TARGET),
            LOADED_AT,
        ]
    ),
    "fact_gestion_tmk": StructType(
        [
            *_keys(
                "sk_gestion",
                "sk_tiempo",
                "sk_region",
                "sk_jerarquia",
                "sk_aliado",
                "sk_campana",
                "sk_segmento",
                "sk_tipo_contacto",
            ),
            _required("cantidad", LONG),
            StructField("intentos", ATTEMPTS),
            LOADED_AT,
        ]
    ),
}
DIMENSIONS = tuple(name for name in STAR if name.startswith("dim_"))
FACTS = tuple(name for name in STAR if name.startswith("fact_"))

# Month of a fact row's date as yyyymm, 0 without a date: the folders of a fact's files. It is no
# column of the data model.
PERIOD = StructField("_periodo", INT, nullable=False)

# The unknown member of each dimension (sk 0) and the four validity rows.
UNKNOWN_KEY = "NO_INFORMADO"
UNKNOWN_LABEL = "No informado"
SEEDS: dict[str, list[tuple]] = {
    "dim_tiempo": [
        (0, None, 0, 1, None, 0, UNKNOWN_LABEL, None, False, False, None, False, None, False)
    ],
    "dim_region": [(0, UNKNOWN_KEY, UNKNOWN_LABEL, True)],
    "dim_canal": [(0, UNKNOWN_KEY, None, None)],
    "dim_categoria": [(0, UNKNOWN_KEY, UNKNOWN_LABEL)],
    "dim_jerarquia_comercial": [(0, UNKNOWN_LABEL, UNKNOWN_LABEL, UNKNOWN_LABEL)],
    "dim_aliado": [(0, UNKNOWN_KEY, UNKNOWN_LABEL)],
    "dim_unidad_gestion": [(0, UNKNOWN_KEY, UNKNOWN_LABEL)],
    "dim_marca": [(0, UNKNOWN_KEY, UNKNOWN_LABEL)],
    "dim_vendedor": [(0, UNKNOWN_KEY, UNKNOWN_LABEL)],
    "dim_validez_venta": [
        (1, True, False, True, "Venta valida"),
        (2, False, False, False, "Sin factura"),
        (3, True, True, False, "Con nota credito"),
        (4, False, True, False, "Sin factura con nota credito"),
    ],
    "dim_campana": [(0, UNKNOWN_KEY, UNKNOWN_LABEL)],
    "dim_segmento": [(0, UNKNOWN_KEY, UNKNOWN_LABEL, UNKNOWN_LABEL)],
    "dim_tipo_contacto": [(0, UNKNOWN_KEY, None, UNKNOWN_LABEL)],
}
