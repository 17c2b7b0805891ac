"""Source registry: logical key to file, format and explicit schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lonja.sources.landing import (
    file_schemas,
    files_of,
    lacking_columns,
    read_files,
    require_columns,
    with_content,
)
from lonja.sources.schemas import HOLIDAYS, LANDING

# Column of ``read_source(order=...)`` by which a load takes its first rows; it is no source column.
PLACE = "_src_place"


# Every format gives its values as the file holds them; text formats give text, and a broken
# line fails the job instead of becoming a row of nulls.
_OPTIONS = {
    "csv": {"header": "true", "mode": "FAILFAST"},
    "json": {"primitivesAsString": "true", "mode": "FAILFAST"},
}


@dataclass(frozen=True)
class Source:
    """One registered file set and the columns it must have. Options go to the reader."""

    path: str
    schema: StructType
    format: str = "parquet"
    options: tuple[tuple[str, str], ...] = ()


def landing_sources(root: str, fmt: str = "parquet") -> dict[str, Source]:
    """The sales, budget, contact and holiday sources below one landing folder."""
    schemas = {**LANDING, "festivos": HOLIDAYS}
    return {
        key: Source(f"{root.rstrip('/')}/{key}", schema, fmt) for key, schema in schemas.items()
    }


def _schemas(
    spark: SparkSession, key: str, source: Source
) -> tuple[Callable[[], DataFrameReader], dict[str, StructType]]:
    """How a source is read, and the columns of its files."""
    options = {**_OPTIONS.get(source.format, {}), **dict(source.options)}
    try:
        files = files_of(spark, source.path, options)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        files = []

    def reader() -> DataFrameReader:
        return spark.read.format(source.format).options(**options)

    schemas = with_content(spark, file_schemas(reader, files))
    if not schemas:
        raise FileNotFoundError(f"source {key!r} has no file at {source.path}")
    return reader, schemas


def read_source(
    spark: SparkSession, sources: Mapping[str, Source], key: str, order: str | None = None
) -> DataFrame:
    """Read the declared columns of one registered source, with the types of its files.

    Fails, with the files' names, when a file lacks a declared column; other columns are left
    out. Columns are found by name in every file, whatever their order there, and a column whose
    type differs between files takes one that holds all. Files without content are no files. The
    cleaning gives the types, the same way for every format. ``order`` names a column to add that
    sorts rows by file name and place in the file.
    """
    if key not in sources:
        raise KeyError(f"unknown source {key!r}; registered: {', '.join(sorted(sources))}")
    source = sources[key]
    reader, schemas = _schemas(spark, key, source)
    require_columns(key, schemas, source.schema.names)
    by_position = source.format == "csv"
    return read_files(reader, source.path, schemas, source.schema.names, by_position, order)


def missing_columns(spark: SparkSession, sources: Mapping[str, Source], key: str) -> DataFrame:
    """Every file of a source that lacks a declared column, as ``(fuente, archivo, columna)``."""
    source = sources[key]
    _, schemas = _schemas(spark, key, source)
    lacking = lacking_columns(schemas, source.schema.names)
    rows = [(key, file, column) for file, columns in lacking.items() for column in columns]
    return spark.createDataFrame(rows, "fuente string, archivo string, columna string")


def read_all_sources(spark: SparkSession, sources: Mapping[str, Source]) -> dict[str, DataFrame]:
    """Lazy frames of all registered sources."""
    return {key: read_source(spark, sources, key) for key in sources}


def first_rows(df: DataFrame, n: int, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows in file order where ``df`` knows it, else in a stated order.

    Every task keeps its first ``n`` rows, so no more than these are shuffled.
    """
    if PLACE in df.columns:
        return df.orderBy(PLACE).limit(n).drop(PLACE)
    return df.orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in order_by]).limit(n)
