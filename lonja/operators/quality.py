"""Checks on the loaded mart: presence, unknown members, orphans, keys, domains."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lonja.operators.dimensions import ALL_DIMENSIONS, VALIDITY
from lonja.operators.facts import FOREIGN_KEYS
from lonja.sources.mart_tables import Draft, MartTables
from lonja.sources.schemas import DIMENSIONS, FACTS, STAR
from lonja.sources.staging import literal_rows

# The validity domain has four rows; totals may differ from their parts by a cent.
VALIDITY_ROWS = 4
TOTAL_TOLERANCE = 0.01

Tables = Mapping[str, DataFrame]


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def table_counts(tables: Tables) -> DataFrame:
    """Rows of every table; parquet answers a bare count from its footers."""
    return _stack(
        [
            df.agg(F.lit(name).alias("tabla"), F.count("*").alias("filas"))
            for name, df in tables.items()
        ]
    )


def unknown_members(tables: Tables) -> DataFrame:
    """Rows with sk 0 per dimension that must have an unknown member."""
    return _stack(
        [
            tables[name].agg(
                F.lit(name).alias("tabla"),
                F.count_if(F.col(STAR[name].names[0]) == 0).alias("miembros_sk0"),
            )
            for name in DIMENSIONS
            if name != VALIDITY.table
        ]
    )


def orphan_counts(tables: Tables) -> DataFrame:
    """Fact rows without their dimension row, for each of the 23 foreign keys.

    Each fact is scanned once for all its keys and counted by key value in the scan tasks; only
    the distinct key values meet the dimensions, never the fact rows.
    """
    used = []
    for fact in FACTS:
        keys = [key for table, key, _ in FOREIGN_KEYS if table == fact]
        used.append(
            tables[fact]
            .select(*keys)
            .unpivot([], keys, "fk", "sk")
            .groupBy("fk", "sk")
            .agg(F.count("*").alias("_n"))
            .select(F.lit(fact).alias("hecho"), "fk", "sk", "_n")
        )
    known = _stack(
        [
            tables[dim].select(F.lit(key).alias("_fk"), F.col(key).alias("_sk"))
            for key, dim in sorted({(key, dim) for _, key, dim in FOREIGN_KEYS})
        ]
    ).distinct()
    # No anti join: Spark would push it below the counting, and the fact rows would meet the dimensions.
    same = (F.col("fk") == F.col("_fk")) & (F.col("sk") == F.col("_sk"))
    lost = _stack(used).join(known, same, "left").where(F.col("_fk").isNull())
    # A line per foreign key, also for an empty fact.
    spark = tables[FACTS[0]].sparkSession
    pair = "hecho string, fk string"
    lines = literal_rows(spark, [(fact, key) for fact, key, _ in FOREIGN_KEYS], pair)
    return (
        lost.select("hecho", "fk", "_n")
        .unionByName(lines.withColumn("_n", F.lit(0).cast("bigint")))
        .groupBy("hecho", "fk")
        .agg(F.sum("_n").alias("huerfanos"))
    )


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that occur more than once, null equal to null."""
    return df.groupBy(*key).agg(F.count("*").alias("filas")).where("filas > 1")


def key_violations(tables: Tables) -> DataFrame:
    """Surrogate and natural keys that are not unique: one row per table and key."""
    parts = []
    for name, df in tables.items():
        keys = {"pk": [STAR[name].names[0]]}
        if name in ALL_DIMENSIONS:
            keys["nk"] = list(ALL_DIMENSIONS[name].key)
        for label, columns in keys.items():
            parts.append(
                repeated_keys(df, columns).agg(
                    F.lit(name).alias("tabla"),
                    F.lit(f"{label}_unica").alias("regla"),
                    F.count("*").alias("violaciones"),
                )
            )
    return _stack(parts)


def value_rules(table: str) -> dict[str, Column]:
    """Violated-row conditions of one table: required columns, text lengths, value ranges."""
    found: dict[str, Column] = {}
    for field in STAR[table].fields:
        if not field.nullable:
            found[f"{field.name}_no_nulo"] = F.col(field.name).isNull()
        if isinstance(field.dataType, StringType):
            found[f"{field.name}_largo"] = F.length(field.name) > field.metadata["length"]
    if table == "dim_tiempo":
        found["mes_1_12"] = ~F.col("mes").between(1, 12)
    if table == "fact_ventas":
        found["valor_no_negativo"] = F.col("valor_antes_iva") < 0
    if table == "fact_gestion_tmk":
        found["cantidad_no_negativa"] = F.col("cantidad") < 0
    if table == "fact_presupuesto":
        gap = F.abs(F.col("tyt") - (F.col("terminales") + F.col("tecnologia")))
        found["tyt_suma"] = gap >= F.lit(TOTAL_TOLERANCE).cast("decimal(20,4)")
    return found


def value_violations(tables: Tables) -> DataFrame:
    """Violations of every value rule; one scan per table for all of its rules."""
    parts = []
    for name, df in tables.items():
        rules = value_rules(name)
        counts = df.agg(*[F.count_if(condition).alias(rule) for rule, condition in rules.items()])
        parts.append(
            counts.unpivot([], list(rules), "regla", "violaciones").select(
                F.lit(name).alias("tabla"), "regla", "violaciones"
            )
        )
    return _stack(parts)


def constraint_violations(tables: Tables) -> DataFrame:
    """Key and value rules together."""
    return key_violations(tables).unionByName(value_violations(tables))


def require_no_violations(tables: Tables) -> None:
    """Raise with every key or value rule that these tables break."""
    broken = constraint_violations(tables).where("violaciones > 0").collect()
    if broken:
        listed = ", ".join(f"{r['tabla']}.{r['regla']}: {r['violaciones']}" for r in broken)
        raise ValueError(f"constraint violations: {listed}")


def require_same_totals(
    before: Mapping[str, Mapping[str, object]], after: Mapping[str, Mapping[str, object]]
) -> None:
    """Raise unless each fact has the rows and the sums of its ruled source, as counted in writing."""
    changed = []
    for table, totals in after.items():
        for name in {**before[table], **totals}:
            if before[table].get(name) != totals.get(name):
                changed.append(f"{table} rows" if name == "filas" else name)
    if changed:
        raise ValueError(f"the load changed rows or sums of {', '.join(sorted(changed))}")


def has_no_channel(tables: Tables) -> bool:
    """The contact fact carries no channel key."""
    return "sk_canal" not in tables["fact_gestion_tmk"].columns


def _check(condition: Column, name: Column, detail: Column) -> list[Column]:
    return [name.alias("chequeo"), condition.alias("ok"), detail.alias("detalle")]


_LINE = "chequeo string, ok boolean, detalle string"


def validation_report(mart: MartTables | Draft) -> DataFrame:
    """``(chequeo, ok, detalle)``: the 38 checks after a load, the last one a summary."""
    spark = mart.spark
    present = {name: mart.exists(name) for name in (*DIMENSIONS, *FACTS)}
    seen = [("esquema", spark.catalog.databaseExists(mart.database), "")]
    seen += [(f"existe {name}", ok, "") for name, ok in present.items()]
    lines = [literal_rows(spark, seen, _LINE)]
    if all(present.values()):
        lines += _content_checks(mart.read_all())
    checks = _stack(lines)
    failed = F.count_if(~F.col("ok"))
    summary = checks.agg(
        *_check(
            failed == 0,
            F.lit("resumen"),
            F.concat(F.lit("chequeos="), F.count("*"), F.lit(" fallidos="), failed),
        )
    )
    return checks.unionByName(summary)


def _content_checks(tables: Tables) -> list[DataFrame]:
    spark = tables["dim_tiempo"].sparkSession
    facts = table_counts({name: tables[name] for name in FACTS})
    fact_rows = facts.select(
        *_check(
            F.lit(True),
            F.concat(F.lit("conteo "), "tabla"),
            F.concat(F.lit("filas="), "filas"),
        )
    )
    unknown = unknown_members(tables).select(
        *_check(
            F.col("miembros_sk0") >= 1,
            F.concat(F.lit("miembro sk=0 en "), "tabla"),
            F.concat(F.lit("filas="), "miembros_sk0"),
        )
    )
    domain = tables[VALIDITY.table].agg(
        *_check(
            F.count("*") >= VALIDITY_ROWS,
            F.lit(f"dominio {VALIDITY.table}"),
            F.concat(F.lit("filas="), F.count("*")),
        )
    )
    orphans = (
        orphan_counts(tables)
        .groupBy("hecho")
        .agg(F.sum("huerfanos").alias("n"))
        .select(
            *_check(
                F.col("n") == 0,
                F.concat(F.lit("integridad referencial "), "hecho"),
                F.concat(F.lit("huerfanos="), "n"),
            )
        )
    )
    without = ("fact_gestion_tmk sin sk_canal", has_no_channel(tables), "")
    channel = literal_rows(spark, [without], _LINE)
    return [fact_rows, unknown, domain, orphans, channel]


def require_passed(report: DataFrame) -> None:
    """Raise with the failed checks; the report has 38 rows."""
    failed = report.where("not ok and chequeo <> 'resumen'").collect()
    if failed:
        lines = "; ".join(f"{row['chequeo']}: {row['detalle']}" for row in failed)
        raise RuntimeError(f"{len(failed)} check(s) failed: {lines}")
