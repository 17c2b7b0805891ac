"""Facts: measures of a ruled source plus the surrogate key of each of its dimensions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lonja.functions.dates import period
from lonja.operators.dimensions import TEXT_DIMENSIONS, Dimension, source_key
from lonja.operators.rules import NO_INVOICE
from lonja.sources.mart_tables import conformed
from lonja.sources.schemas import PERIOD, STAR
from lonja.sources.staging import ROW


@dataclass(frozen=True)
class Fact:
    """Source, its columns, date expression, measures (SQL expressions) and key of one fact."""

    table: str
    sk: str
    source: str
    columns: tuple[str, ...]
    date: str
    measures: Mapping[str, str]

    def dimensions(self, specs: Mapping[str, Dimension]) -> list[Dimension]:
        """Text dimensions whose key this fact carries."""
        columns = set(STAR[self.table].names)
        return [d for d in specs.values() if d.sk in columns]


# Date and measures of the facts, with their defaults for missing values.
FACT_SPECS: dict[str, Fact] = {
    f.table: f
    for f in (
        Fact(
            "fact_ventas",
            "sk_venta",
            "ventas",
            ("fecha_venta", "sk_validez", "codigo_factura", "valor_antes_de_iva", "cuotas"),
            "fecha_venta",
            {
                "sk_validez": f"coalesce(sk_validez, {NO_INVOICE})",
                "codigo_factura": "codigo_factura",
                "valor_antes_iva": "coalesce(valor_antes_de_iva, 0)",
                "cuotas": "cuotas",
            },
        ),
        Fact(
            "fact_presupuesto",
            "sk_presupuesto",
            "presupuesto",
            ("mes", "terminales", "tecnologia", "t_t"),
            "mes",
            {
                "terminales": "coalesce(terminales, 0)",
                "tecnologia": "coalesce(tecnologia, 0)",
                "tyt": "coalesce(t_t, coalesce(terminales, 0) + coalesce(tecnologia, 0))",
            },
        ),
        Fact(
            "fact_gestion_tmk",
            "sk_gestion",
            "registros",
            ("fecha_gestion", "periodo", "cantidad", "intentos"),
            "coalesce(fecha_gestion, periodo)",
            {"cantidad": "coalesce(cantidad, 0)", "intentos": "intentos"},
        ),
    )
}

# (fact, key column, dimension) of every foreign key.
FOREIGN_KEYS: list[tuple[str, str, str]] = [
    (fact, key, table)
    for fact in FACT_SPECS
    for table, schema in STAR.items()
    if table.startswith("dim_")
    for key in (schema.names[0],)
    if key in STAR[fact].names
]


def used_columns(
    source: str, specs: Mapping[str, Dimension] = TEXT_DIMENSIONS
) -> list[str]:
    """Columns of a source that some fact or dimension reads."""
    used = [c for fact in FACT_SPECS.values() if fact.source == source for c in fact.columns]
    for spec in specs.values():
        used += [c for c in spec.sources.get(source, ()) if c]
    return list(dict.fromkeys(used))


def lookup_key(df: DataFrame, dim: DataFrame, sk: str, pairs: Mapping[str, Column]) -> DataFrame:
    """Add the surrogate key of the dimension row whose key equals the given expressions.

    Null equals null, a miss gives 0. The dimension has one row per key, so rows of ``df`` keep
    their number. No join hint: the dimension is a written table, so Spark knows its size,
    broadcasts it below the threshold and shuffles above it, splitting hot keys.
    """
    target = dim.select(
        F.col(sk).alias("_sk"), *[F.col(c).alias(f"_nk_{i}") for i, c in enumerate(pairs)]
    )
    condition = [e.eqNullSafe(F.col(f"_nk_{i}")) for i, e in enumerate(pairs.values())]
    return (
        df.join(target, condition, "left")
        .withColumn(sk, F.coalesce("_sk", F.lit(0)))
        .drop("_sk", *[f"_nk_{i}" for i in range(len(pairs))])
    )


def build_fact(
    spec: Fact,
    ruled: DataFrame,
    dims: Mapping[str, DataFrame],
    loaded_at: str,
    specs: Mapping[str, Dimension] = TEXT_DIMENSIONS,
) -> DataFrame:
    """The fact table of one ruled source.

    ``ruled`` is a staged frame whose row number becomes the fact's own key. ``loaded_at`` is
    one literal for the whole run.
    """
    keyed: dict[str, dict[str, Column]] = {}
    own = spec.dimensions(specs)
    projection = [F.expr(spec.date).alias("_date")]
    for dim in own:
        for i, part in enumerate(source_key(ruled, dim.sources[spec.source])):
            name = f"_{dim.table}_{i}"
            projection.append(part.alias(name))
            keyed.setdefault(dim.table, {})[dim.key[i]] = F.col(name)
    for name, expression in spec.measures.items():
        projection.append(F.expr(expression).alias(name))
    row = F.col(ROW) if ROW in ruled.columns else F.lit(None).cast("bigint")
    fact = ruled.select(row.alias(spec.sk), *projection)
    fact = lookup_key(fact, dims["dim_tiempo"], "sk_tiempo", {"fecha": F.col("_date")})
    for dim in own:
        fact = lookup_key(fact, dims[dim.table], dim.sk, keyed[dim.table])
    month = F.coalesce(period(F.col("_date")), F.lit(0)).cast("int")
    stamp = F.lit(loaded_at).cast("timestamp_ntz")
    return conformed(fact.withColumns({"fecha_carga_dw": stamp, PERIOD.name: month}), spec.table)
