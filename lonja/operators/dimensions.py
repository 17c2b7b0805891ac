"""Dimensions: one declaration per dimension drives member building, merging and lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from lonja.functions.text import key_text
from lonja.operators.clean import drop_duplicates_by
from lonja.sources.mart_tables import conformed
from lonja.sources.schemas import SEEDS, STAR
from lonja.sources.staging import literal_rows, ordinal, stage, stage_numbered


@dataclass(frozen=True)
class Dimension:
    """Natural key, attributes and sources of one dimension.

    ``sources`` names, per source, the column of each natural-key part (None: always null).
    ``attributes`` are SQL expressions over the natural key. ``updated`` columns change when a
    known member comes again. ``null_keys`` says which keys are no members: those with a null
    ``first`` part, only the wholly null one (``all``), or ``none``.
    """

    table: str
    sk: str
    key: tuple[str, ...]
    sources: Mapping[str, tuple[str | None, ...]] = field(default_factory=dict)
    attributes: Mapping[str, str] = field(default_factory=dict)
    updated: tuple[str, ...] = ()
    null_keys: Literal["first", "all", "none"] = "first"

    def is_member(self, parts: Sequence[Column]) -> Column:
        if self.null_keys == "none":
            return F.lit(True)
        if self.null_keys == "first":
            return parts[0].isNotNull()
        return F.coalesce(*parts).isNotNull()


# Natural keys, source columns and attributes of the text dimensions.
TEXT_DIMENSIONS: dict[str, Dimension] = {
    d.table: d
    for d in (
        Dimension(
            "dim_region",
            "sk_region",
            ("region_nk",),
            {
                "ventas": ("region_comercial",),
                "presupuesto": ("region",),
                "registros": ("division_comercial",),
            },
            {
                "nombre_region": "region_nk",
                "es_sin_region": "contains(upper(region_nk), 'SIN')",
            },
            ("nombre_region", "es_sin_region"),
        ),
        Dimension(
            "dim_canal",
            "sk_canal",
            ("canal", "canal2", "sub_canal"),
            {
                "ventas": ("canal", "canal2", None),
                "presupuesto": ("canal", "canal2", "sub_canal"),
            },
        ),
        Dimension(
            "dim_categoria",
            "sk_categoria",
            ("categoria_nk",),
            {"ventas": ("categoria",), "presupuesto": ("categoria",)},
            {"nombre_categoria": "categoria_nk"},
            ("nombre_categoria",),
        ),
        Dimension(
            "dim_jerarquia_comercial",
            "sk_jerarquia",
            ("gerente", "jefe", "especialista"),
            {
                "ventas": ("gv_gerente_area", "gv_jefe_1_canal_regional", "gv_especialista"),
                "presupuesto": ("gerente", "jefe", "especialista"),
                "registros": ("gerente", "jefe", "especialista"),
            },
            null_keys="none",
        ),
        Dimension(
            "dim_aliado",
            "sk_aliado",
            ("aliado_nk",),
            {"ventas": ("gv_desc2",), "presupuesto": ("descrip2",), "registros": ("aliado",)},
            {"nombre_aliado": "aliado_nk"},
            ("nombre_aliado",),
        ),
        Dimension(
            "dim_unidad_gestion",
            "sk_unidad_gestion",
            ("unidad_gestion_nk",),
            {"presupuesto": ("unidad_de_gestion",)},
            {"nombre_unidad_gestion": "unidad_gestion_nk"},
            ("nombre_unidad_gestion",),
        ),
        Dimension(
            "dim_marca",
            "sk_marca",
            ("marca_nk",),
            {"ventas": ("marca",)},
            {"nombre_marca": "marca_nk"},
            ("nombre_marca",),
        ),
        Dimension(
            "dim_vendedor",
            "sk_vendedor",
            ("cedula_vendedor_nk",),
            {"ventas": ("cedula_vendedor",)},
            {"nombre_vendedor": "cast(null as string)"},
            ("nombre_vendedor",),
        ),
        Dimension(
            "dim_campana",
            "sk_campana",
            ("campana_nk",),
            {"registros": ("nombre_campana",)},
            {"nombre_campana": "campana_nk"},
            ("nombre_campana",),
        ),
        Dimension(
            "dim_segmento",
            "sk_segmento",
            ("segmento_nk",),
            {"registros": ("segmento",)},
            {"segmento_normalizado": "segmento_nk", "nombre_segmento": "segmento_nk"},
            ("segmento_normalizado", "nombre_segmento"),
        ),
        Dimension(
            "dim_tipo_contacto",
            "sk_tipo_contacto",
            ("tipo_contacto", "detalle_contacto"),
            {"registros": ("tipo_contacto", "detalle1")},
            {"nombre_tipo_contacto": "tipo_contacto"},
            ("nombre_tipo_contacto",),
        ),
    )
}
VALIDITY = Dimension(
    "dim_validez_venta",
    "sk_validez",
    ("tiene_factura", "tiene_nota_credito"),
    updated=("es_venta_valida", "descripcion"),
)
CALENDAR = Dimension(
    "dim_tiempo",
    "sk_tiempo",
    ("fecha",),
    updated=tuple(
        f.name for f in STAR["dim_tiempo"].fields if f.name not in ("sk_tiempo", "fecha")
    ),
)
ALL_DIMENSIONS = {**TEXT_DIMENSIONS, VALIDITY.table: VALIDITY, CALENDAR.table: CALENDAR}

_PARTS = ("_k1", "_k2", "_k3")


def seed_rows(spark: SparkSession, table: str) -> DataFrame:
    """The fixed members of a dimension: one to four rows."""
    return literal_rows(spark, SEEDS[table], STAR[table])


def ensure_seeds(existing: DataFrame, table: str) -> DataFrame:
    """Insert the fixed members whose surrogate key is absent; existing rows stay."""
    sk = ALL_DIMENSIONS[table].sk
    # A surrogate key is unique, so at most as many rows as there are seeds.
    present = F.broadcast(existing.select(sk).where(F.col(sk).isin([r[0] for r in SEEDS[table]])))
    missing = seed_rows(existing.sparkSession, table).join(present, sk, "left_anti")
    return existing.unionByName(missing.select(*existing.columns))


def source_key(df: DataFrame, columns: Sequence[str | None]) -> list[Column]:
    """Natural-key expressions over a source; an absent column counts as null."""
    return [
        key_text(F.col(c)) if c in df.columns else F.lit(None).cast("string") for c in columns
    ]


def key_order(names: Sequence[str]) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def members(spec: Dimension, frames: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct members of one dimension over all its sources, with attributes."""
    keys = [
        frames[source].select(
            *[e.alias(n) for e, n in zip(source_key(frames[source], columns), spec.key)]
        )
        for source, columns in spec.sources.items()
        if source in frames
    ]
    found = reduce(DataFrame.unionByName, keys).distinct()
    return with_attributes(found.where(spec.is_member([F.col(c) for c in spec.key])), spec)


def with_attributes(keys: DataFrame, spec: Dimension) -> DataFrame:
    return keys.withColumns({name: F.expr(e) for name, e in spec.attributes.items()})


def all_member_keys(
    frames: Mapping[str, DataFrame], specs: Mapping[str, Dimension] = TEXT_DIMENSIONS
) -> DataFrame:
    """Distinct members of all dimensions as ``(_dim, _k1, _k2, _k3)``.

    Each dimension reads its own columns of a source alone, and their distinct values combine in
    the scan tasks. Only these are stripped and tested, and only they are shuffled.
    """
    parts = []
    for source, df in frames.items():
        for spec in specs.values():
            if source not in spec.sources:
                continue
            columns = spec.sources[source]
            own = list(dict.fromkeys(c for c in columns if c in df.columns))
            raw = df.select(*(own or [F.lit(None).alias("_none")])).distinct()
            key = source_key(raw, columns)
            member = spec.is_member(key)
            key += [F.lit(None).cast("string")] * (len(_PARTS) - len(key))
            named = [k.alias(p) for k, p in zip(key, _PARTS)]
            parts.append(raw.where(member).select(F.lit(spec.table).alias("_dim"), *named))
    return reduce(DataFrame.unionByName, parts).distinct()


def number_new_members(
    keys: DataFrame,
    existing: Mapping[str, DataFrame],
    specs: Mapping[str, Dimension] = TEXT_DIMENSIONS,
) -> DataFrame:
    """Surrogate keys for members no dimension knows yet, all dimensions in one sorted write.

    Members are numbered by dimension and natural key (nulls last), on from each dimension's
    highest surrogate key.
    """
    known = reduce(
        DataFrame.unionByName,
        [_as_parts(existing[table], spec) for table, spec in specs.items()],
    )
    whole = ("_dim", *_PARTS)
    fresh = keys.join(_prefixed(known, whole), _same_key(whole), "left_anti")
    numbered = stage_numbered(
        fresh, "new-members", [F.col("_dim"), *key_order(_PARTS)], column="_n"
    )
    # One row per dimension: eleven rows.
    first = F.broadcast(numbered.groupBy("_dim").agg(F.min("_n").alias("_first")))
    highest = F.broadcast(known.groupBy("_dim").agg(F.max("_sk").alias("_highest")))
    return (
        numbered.join(first, "_dim")
        .join(highest, "_dim", "left")
        .withColumn("_sk", F.coalesce("_highest", F.lit(0)) + F.col("_n") - F.col("_first") + 1)
        .drop("_n", "_first", "_highest")
    )


def merge_report(
    keys: DataFrame,
    fresh: DataFrame,
    existing: Mapping[str, DataFrame],
    specs: Mapping[str, Dimension] = TEXT_DIMENSIONS,
) -> DataFrame:
    """Inserted, updated and skipped (sk 0) members per dimension of a load."""
    known = reduce(
        DataFrame.unionByName,
        [_as_parts(existing[table], spec) for table, spec in specs.items()],
    )
    whole = ("_dim", *_PARTS)
    met = known.join(_prefixed(keys, whole), _same_key(whole), "left_semi")
    action = F.when(F.col("_sk") == 0, "skipped").otherwise("updated").alias("_action")
    actions = met.select("_dim", action).unionByName(
        fresh.select("_dim", F.lit("inserted").alias("_action"))
    )
    return merge_counts(actions.groupBy(F.col("_dim").alias("tabla")))


def _as_parts(dim: DataFrame, spec: Dimension) -> DataFrame:
    values = [F.col(c) for c in spec.key]
    values += [F.lit(None).cast("string")] * (len(_PARTS) - len(values))
    return dim.select(
        F.lit(spec.table).alias("_dim"),
        F.col(spec.sk).alias("_sk"),
        *[v.alias(p) for v, p in zip(values, _PARTS)],
    )


def from_parts(keys: DataFrame, spec: Dimension, *extra: str) -> DataFrame:
    """Members of one dimension out of the combined key table."""
    chosen = keys.where(F.col("_dim") == spec.table).select(
        *[F.col(p).alias(n) for p, n in zip(_PARTS, spec.key)], *extra
    )
    return with_attributes(chosen, spec)


def _prefixed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"_in_{c}") for c in columns])


def _same_key(key: Sequence[str]) -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(f"_in_{c}")) for c in key]


def updated_members(existing: DataFrame, incoming: DataFrame, spec: Dimension) -> DataFrame:
    """Existing members with the updatable columns of their incoming row; sk 0 never changes.

    ``_action`` says ``updated``, ``skipped`` (sk 0) or ``kept`` (no incoming row).
    """
    fresh = _prefixed(incoming, [*spec.key, *spec.updated]).withColumn("_found", F.lit(True))
    matched = existing.join(fresh, _same_key(spec.key), "left")
    found = F.col("_found").isNotNull()
    apply = found & (F.col(spec.sk) != 0)
    columns = [
        F.when(apply, F.col(f"_in_{c}")).otherwise(F.col(c)).alias(c)
        if c in spec.updated
        else F.col(c)
        for c in existing.columns
    ]
    action = F.when(apply, "updated").when(found, "skipped").otherwise("kept")
    return matched.select(*columns, action.alias("_action"))


def merge_members(
    existing: DataFrame,
    incoming: DataFrame,
    spec: Dimension,
    last_by: str | None = None,
) -> DataFrame:
    """Type-1 merge by natural key, null equal to null. Nothing is deleted.

    Known members keep their surrogate key and take the updatable columns; new members get the
    next keys in natural-key order unless they bring one. When a key comes more than once, the
    row that is last in ``last_by`` wins; without an order, unlike rows of one key are an error.
    """
    if last_by:
        incoming = drop_duplicates_by(incoming, spec.key, [last_by], keep="last").drop(last_by)
    else:
        incoming = incoming.distinct()
    # Incoming members may come from a scan of whole sources: run it once.
    incoming = stage(incoming, f"incoming-{spec.table}")
    if not last_by:
        _require_single(incoming, spec)
    fresh = incoming.join(_prefixed(existing, spec.key), _same_key(spec.key), "left_anti")
    if spec.sk in incoming.columns:
        known = updated_members(existing, incoming.where(f"{spec.sk} is distinct from 0"), spec)
        new = fresh.where(f"{spec.sk} <> 0")
        fresh = fresh.where(f"{spec.sk} is null")
        given = conformed(new, spec.table).withColumn("_action", F.lit("inserted"))
    else:
        known, given = updated_members(existing, incoming, spec), None
    highest = existing.agg(F.coalesce(F.max(spec.sk), F.lit(0)).alias("m")).first()["m"]
    numbered = ordinal(fresh, key_order(spec.key), "_n")
    inserted = conformed(
        numbered.withColumn(spec.sk, F.col("_n") + F.lit(highest)), spec.table
    ).withColumn("_action", F.lit("inserted"))
    merged = known.unionByName(inserted)
    return merged.unionByName(given) if given is not None else merged


def _require_single(incoming: DataFrame, spec: Dimension) -> None:
    key = list(spec.key)
    repeated = incoming.groupBy(*key).count().where("count > 1").select(*key).limit(5).collect()
    if repeated:
        listed = ", ".join(str(tuple(row)) for row in repeated)
        raise ValueError(f"{spec.table}: unlike rows of one key and no order given: {listed}")


def merge_counts(merged: DataFrame | GroupedData) -> DataFrame:
    """Inserted, updated and skipped members of a merge."""
    return merged.agg(
        *[
            F.count_if(F.col("_action") == action).alias(action)
            for action in ("inserted", "updated", "skipped")
        ]
    )


def observed_validity(sales: DataFrame) -> DataFrame:
    """The validity rows whose code occurs in the sales."""
    codes = sales.select("sk_validez").distinct()
    return seed_rows(sales.sparkSession, VALIDITY.table).join(codes, "sk_validez", "left_semi")
