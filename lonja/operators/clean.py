"""Cleaning steps; each takes a DataFrame and gives a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any, Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, StringType

from lonja.functions import dates
from lonja.functions.casts import Mode, typed, whole_number
from lonja.functions.text import header_names, strip_visible
from lonja.sources.schemas import BUDGET_TYPES, CONTACT_TYPES, SALES_TYPES
from lonja.sources.staging import stage

# Date columns of the sources by notation.
SALES_DAYS = ("fecha_venta", "fecha_finalizacion_reserva")
CONTACT_DAYS = ("fecha_gestion", "fecha_cargue")

# As many hashes of repeated rows, 8 bytes each, go to every task; with more, all rows are shuffled.
REPEATED_HASHES = 1_000_000


def normalize_columns(df: DataFrame) -> DataFrame:
    """Snake-case ASCII column names; metadata only."""
    return df.toDF(*header_names(df.columns))


def strip_text(df: DataFrame) -> DataFrame:
    """Remove outer whitespace from every text column."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return _replace(df, {name: strip_visible(F.col(f"`{name}`")) for name in text})


def parse_yyyymmdd(df: DataFrame, columns: Sequence[str], mode: Mode = "strict") -> DataFrame:
    return _replace(
        df, {c: dates.from_yyyymmdd(_whole(df, c, mode)) for c in columns if c in df.columns}
    )


def parse_yyyymm(df: DataFrame, column: str, mode: Mode = "strict") -> DataFrame:
    if column not in df.columns:
        return df
    return _replace(df, {column: dates.from_yyyymm(_whole(df, column, mode))})


def _whole(df: DataFrame, column: str, mode: Mode) -> Column:
    """The column as bigint; an integer column needs no checks."""
    if isinstance(df.schema[column].dataType, IntegralType):
        return F.col(column).cast("bigint")
    return whole_number(F.col(column), mode, column)


def parse_iso(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _replace(df, {c: dates.from_iso(F.col(c)) for c in columns if c in df.columns})


def cast_columns(
    df: DataFrame, types: Mapping[str, DataType | str], mode: Mode = "strict"
) -> DataFrame:
    """Cast the listed columns that are present."""
    if not isinstance(types, Mapping):
        raise TypeError(f"types must map column to type, got {type(types).__name__}")
    wanted = {
        name: dtype if isinstance(dtype, str) else dtype.simpleString()
        for name, dtype in types.items()
        if name in df.columns
    }
    have = dict(df.dtypes)
    return _replace(
        df,
        {
            name: typed(F.col(name), dtype, mode, name)
            for name, dtype in wanted.items()
            if have[name] != dtype
        },
    )


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Keep one of each group of equal rows; nulls are equal.

    Equal rows have equal hashes. So the rows are staged, their hashes counted, and only rows whose
    hash occurs again are shuffled and compared, by all columns. Where too many do, all rows are;
    copies combine before the shuffle.
    """
    rows = stage(df, "rows")
    own = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    counted = rows.groupBy(own.alias("_hash")).agg(F.count("*").alias("_n"))
    repeated = stage(counted.where("_n > 1").select("_hash"), "repeated")
    found = repeated.count()
    if not found:
        return rows
    if found > REPEATED_HASHES:
        return rows.dropDuplicates()
    # At most REPEATED_HASHES rows.
    listed = F.broadcast(repeated)
    alone = rows.join(listed, own == F.col("_hash"), "left_anti")
    again = rows.join(listed, own == F.col("_hash"), "left_semi")
    return alone.unionByName(again.dropDuplicates())


def drop_duplicates_by(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    keep: Literal["first", "last", "none"] = "first",
) -> DataFrame:
    """One row per key: the first or last in ``order_by``, or only keys that occur once.

    First and last rank within the key, and Spark keeps just the top row per key and task
    before it shuffles, so a hot key does not pile up. ``none`` needs no ordering: a key
    counted once has a single value in every column, which ``any_value`` returns.
    """
    keys = [k for k in keys if k in df.columns]
    if not keys:
        return df
    if keep == "none":
        others = [c for c in df.columns if c not in keys]
        counted = df.groupBy(*keys).agg(
            F.count("*").alias("_n"), *[F.any_value(c).alias(c) for c in others]
        )
        return counted.where("_n = 1").select(*df.columns)
    columns = [F.col(c) for c in order_by]
    if keep == "first":
        order = [c.asc_nulls_first() for c in columns]
    else:
        order = [c.desc_nulls_last() for c in columns]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def fill_nulls(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    present = {name: value for name, value in values.items() if name in df.columns}
    return df.fillna(present) if present else df


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of the listed columns that are present."""
    present = [c for c in columns if c in df.columns]
    return df.dropna(how="any", subset=present) if present else df


def unrounded(df: DataFrame, types: Mapping[str, DataType]) -> dict[str, DataType | str]:
    """``types`` without a rounding: text amounts keep twelve decimals, numbers their type."""
    have = dict(df.dtypes)
    found: dict[str, DataType | str] = {}
    for name, dtype in types.items():
        if not isinstance(dtype, DecimalType):
            found[name] = dtype
        elif have.get(name) == "string":
            found[name] = "decimal(38,12)"
    return found


def typed_once(df: DataFrame, types: Mapping[str, DataType], mode: Mode) -> DataFrame:
    """Typed columns without exact duplicates; rows are compared before amounts are rounded."""
    return (
        df.transform(cast_columns, unrounded(df, types), mode)
        .transform(drop_duplicate_rows)
        .transform(cast_columns, types, mode)
    )


def clean_sales(raw: DataFrame, mode: Mode = "strict") -> DataFrame:
    return (
        raw.transform(normalize_columns)
        .transform(strip_text)
        .transform(parse_yyyymmdd, SALES_DAYS, mode)
        .transform(typed_once, SALES_TYPES, mode)
    )


def clean_budget(raw: DataFrame, mode: Mode = "strict") -> DataFrame:
    """Repeated budget crosses are separate allocations, so rows are not deduplicated."""
    return (
        raw.transform(normalize_columns)
        .transform(strip_text)
        .transform(parse_yyyymm, "mes", mode)
        .transform(cast_columns, BUDGET_TYPES, mode)
    )


def clean_contacts(raw: DataFrame, mode: Mode = "strict") -> DataFrame:
    return (
        raw.transform(normalize_columns)
        .transform(strip_text)
        .transform(parse_iso, CONTACT_DAYS)
        .transform(parse_yyyymm, "periodo", mode)
        .transform(typed_once, CONTACT_TYPES, mode)
    )


def _replace(df: DataFrame, changed: Mapping[str, Column]) -> DataFrame:
    """One projection with some columns replaced, in place."""
    if not changed:
        return df
    return df.select(
        *[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in df.columns]
    )
