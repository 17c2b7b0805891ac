"""Mart tables: versions in folders, published together by one manifest, listed in the catalog."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from lonja.functions.text import key_text
from lonja.sources.files import Store
from lonja.sources.schemas import FACTS, PERIOD, STAR


class StaleDraft(RuntimeError):
    """Another load has published since the draft was begun."""


@dataclass(frozen=True)
class Manifest:
    """One published state of the mart: its number, the folder of every table it has written,
    and the folder of the frames that the load staged."""

    number: int = 0
    tables: dict[str, str] = field(default_factory=dict)
    staged: str | None = None


def stored_schema(table: str) -> StructType:
    """Declared columns; a fact is laid out by the month in ``PERIOD``."""
    return StructType([*STAR[table].fields, *([PERIOD] if table in FACTS else [])])


class MartTables:
    """The star tables as external parquet tables of one catalog database.

    A load writes complete new folders into a draft and publishes all of them at once, by one
    manifest file that only one writer can create. So readers of this class see all tables as
    they were or all as they are after a load, and a load that fails changes nothing. The
    catalog's locations follow each manifest, and are put right by ``create`` if a driver is lost
    in between.
    """

    def __init__(self, spark: SparkSession, database: str, location: str):
        self.spark = spark
        self.database = database
        self.location = location.rstrip("/")
        self._store = Store(spark, self.location)

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def create(self) -> None:
        """Create the database and every missing table; running it again changes nothing."""
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.location}/_database'"
        )
        head = self.head()
        for table in STAR:
            if not self.exists(table):
                folder = head.tables.get(table, f"{self.location}/{table}/{uuid4().hex}")
                columns = ", ".join(
                    f"`{f.name}` {f.dataType.simpleString()}" for f in stored_schema(table).fields
                )
                parts = f"PARTITIONED BY ({PERIOD.name})" if table in FACTS else ""
                self.spark.sql(
                    f"CREATE TABLE {self.name(table)} ({columns}) USING parquet {parts} LOCATION '{folder}'"
                )
            if table in head.tables:
                self._point(table, head.tables[table])

    def head(self) -> Manifest:
        """The newest published state."""
        numbers = self._numbers()
        return self._manifest(numbers[-1]) if numbers else Manifest()

    def _numbers(self) -> list[int]:
        names = self._store.names(f"{self.location}/_manifests")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _file(self, number: int) -> str:
        return f"{self.location}/_manifests/{number:010}.json"

    def _manifest(self, number: int) -> Manifest:
        return Manifest(**json.loads(self._store.read(self._file(number))))

    def read(self, table: str) -> DataFrame:
        return self._read(table, self.head())

    def read_all(self) -> dict[str, DataFrame]:
        head = self.head()
        return {table: self._read(table, head) for table in STAR}

    def _read(self, table: str, state: Manifest) -> DataFrame:
        folder = state.tables.get(table)
        if folder is None:
            return self.spark.table(self.name(table))
        return self.spark.read.schema(stored_schema(table)).parquet(folder)

    def draft(self, staged: str | None = None) -> Draft:
        """A set of new versions on top of the newest published state."""
        return Draft(self, self.head(), staged)

    def replace(self, table: str, df: DataFrame) -> None:
        """Full load of one table: publish ``df`` as its new version in the declared types."""
        draft = self.draft()
        draft.write(table, df)
        draft.publish()

    def publish(self, base: Manifest, tables: dict[str, str], staged: str | None) -> Manifest:
        """Publish ``tables`` on top of ``base``; fails if something else has been published."""
        new = Manifest(base.number + 1, {**base.tables, **tables}, staged)
        content = {"number": new.number, "tables": new.tables, "staged": new.staged}
        if not self._store.create(self._file(new.number), json.dumps(content, indent=1)):
            raise StaleDraft(f"{self.database}: state {new.number} has been published by another load")
        for table in tables:
            self._point(table, new.tables[table])
        return new

    def _point(self, table: str, folder: str) -> None:
        """Let the catalog's table be the version in ``folder``."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}")
        now = described.where("col_name = 'Location'").first()["data_type"]
        if now.rstrip("/").endswith(folder.rsplit("/", 1)[-1]):
            return
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{folder}'")
        if table in FACTS:
            self.spark.sql(f"MSCK REPAIR TABLE {self.name(table)} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(self.name(table))

    def discard(self, *folders: str | None) -> None:
        """Delete folders that no manifest names: versions and staged frames of a load that failed."""
        for folder in filter(None, folders):
            self._store.delete(folder)

    def keep(self, states: int) -> None:
        """Delete all but the newest ``states`` manifests, and what only the others refer to.

        Frames that were read from a deleted state can't be read any more.
        """
        numbers = self._numbers()
        kept = [self._manifest(n) for n in numbers[-states:]]
        used = {f for m in kept for f in (*m.tables.values(), m.staged)}
        for number in numbers[:-states]:
            old = self._manifest(number)
            self.discard(*({*old.tables.values(), old.staged} - used))
            self._store.delete(self._file(number))


class Draft:
    """New versions of some tables on top of a published state, for one load.

    It reads like the mart it will become, so that checks can run before anyone sees it.
    """

    def __init__(self, mart: MartTables, base: Manifest, staged: str | None = None):
        self.mart, self.base, self.staged = mart, base, staged
        self.spark, self.database = mart.spark, mart.database
        self._written: dict[str, str] = {}

    def exists(self, table: str) -> bool:
        return self.mart.exists(table)

    def write(self, table: str, df: DataFrame) -> None:
        """Write ``df`` as the new version of ``table`` in the declared types.

        A fact is dealt out by month; adaptive execution splits the months that are large.
        """
        folder = f"{self.mart.location}/{table}/{uuid4().hex}"
        rows = conformed(df, table)
        if table in FACTS:
            rows.hint("rebalance", F.col(PERIOD.name)).write.partitionBy(PERIOD.name).parquet(folder)
        else:
            rows.write.parquet(folder)
        self._written[table] = folder

    def _state(self) -> Manifest:
        return Manifest(self.base.number, {**self.base.tables, **self._written})

    def read(self, table: str) -> DataFrame:
        return self.mart._read(table, self._state())

    def read_all(self) -> dict[str, DataFrame]:
        return {table: self.read(table) for table in STAR}

    def publish(self) -> Manifest:
        return self.mart.publish(self.base, self._written, self.staged)

    def discard(self) -> None:
        """Delete what the draft has written."""
        self.mart.discard(*self._written.values(), self.staged)


def conformed(df: DataFrame, table: str) -> DataFrame:
    """Columns of ``table`` in declared order and type; a missing required column is an error.

    Optional text, and all text of a fact, is stripped and blank becomes null. A required flag
    that is null becomes false.
    """
    schema = stored_schema(table)
    absent = [f.name for f in schema.fields if not f.nullable and f.name not in df.columns]
    if absent:
        raise ValueError(f"{table}: missing required columns: {', '.join(absent)}")
    return df.select(*[_conformed(f, f.name in df.columns, table) for f in schema.fields])


def _conformed(field: StructField, present: bool, table: str) -> Column:
    value = F.col(field.name) if present else F.lit(None)
    if isinstance(field.dataType, StringType) and (field.nullable or table in FACTS):
        value = key_text(value)
    value = value.cast(field.dataType)
    if isinstance(field.dataType, BooleanType) and not field.nullable:
        value = F.coalesce(value, F.lit(False))
    return value.alias(field.name)


def export_csv(df: DataFrame, path: str) -> None:
    """Write a report as CSV part files with a header."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """Write a report as JSON lines."""
    df.write.mode("overwrite").json(path)
