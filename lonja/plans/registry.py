"""Registered queries: name, Spark function, and the DuckDB statement with the same answer."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from threading import Lock
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from lonja.plans.load import LoadResult, run_load, seed_calendar
from lonja.plans.oracle import statement
from lonja.session import apply_settings, shared_folder
from lonja.sources import analogues
from lonja.sources.mart_tables import MartTables
from lonja.sources.staging import stage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_LOADING = Lock()
_LOADED: dict[tuple[str, str], tuple[MartTables, LoadResult]] = {}
_RELOADED: dict[tuple[str, str], MartTables] = {}


def query(name: str, sql: str | None = None, **local: str) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use the shared oracle views and ``local`` ones."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(function(apply_settings(spark), sf_dir.rstrip("/")))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = statement(sql, **local)
        return function

    return register


def portable(df: DataFrame) -> DataFrame:
    """Decimals as double and dates as ISO text, so that two engines compare alike."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            value = value.cast("double").alias(field.name)
        elif isinstance(field.dataType, DateType):
            value = value.cast("string").alias(field.name)
        columns.append(value)
    return df.select(*columns)


def new_mart(spark: SparkSession) -> MartTables:
    """An empty mart in a database and folder of its own."""
    name = f"lonja_{uuid4().hex[:12]}"
    return MartTables(spark, name, f"{shared_folder(spark)}/marts/{name}")


def fresh_load(
    spark: SparkSession, sf_dir: str, raw: Mapping[str, DataFrame] | None = None
) -> tuple[MartTables, LoadResult]:
    """Calendar and full load of the tables in ``sf_dir``, or of ``raw``, into a new mart."""
    mart = new_mart(spark)
    mart.create()
    years = analogues.years(spark, sf_dir)
    seed_calendar(mart, years, analogues.holidays(years), "_src_row")
    return mart, run_load(mart, raw or analogues.raw_sources(spark, sf_dir))


def loaded(spark: SparkSession, sf_dir: str) -> tuple[MartTables, LoadResult]:
    """The loaded mart of a table folder, built by its first use in a Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _LOADING:
        if key not in _LOADED:
            _LOADED[key] = fresh_load(spark, sf_dir)
        return _LOADED[key]


def reloaded(spark: SparkSession, sf_dir: str) -> MartTables:
    """A mart of its own that was loaded twice, built by its first use in a Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _LOADING:
        if key not in _RELOADED:
            # The sources land once, and both loads read them.
            raw = {name: stage(df, name) for name, df in analogues.raw_sources(spark, sf_dir).items()}
            mart, _ = fresh_load(spark, sf_dir, raw)
            run_load(mart, raw)
            _RELOADED[key] = mart
        return _RELOADED[key]


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return loaded(spark, sf_dir)[1].tables
