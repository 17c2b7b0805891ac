"""One contract for all files of a source, and rows in the order of the files."""

import gzip
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

from lonja.plans import queries_sources, registry
from lonja.sources import analogues, staging
from lonja.sources.landing import common_type
from lonja.sources.registry import PLACE, Source, first_rows, missing_columns, read_source

SCHEMA = (
    StructType().add("a", LongType()).add("b", StringType()).add("c", DecimalType(18, 2))
)
FORMATS = ["csv", "json", "parquet", "orc"]


def source(tmp_path, fmt, *frames, **options):
    for df in frames:
        writer = df.coalesce(1).write.option("header", "true").option("ignoreNullFields", "false")
        writer.format(fmt).mode("append").save(f"{tmp_path}/s")
    return {"s": Source(f"{tmp_path}/s", SCHEMA, fmt, tuple(options.items()))}


def values(df):
    return sorted(tuple(None if v is None else str(v) for v in row) for row in df.collect())


@pytest.mark.parametrize("fmt", FORMATS)
def test_columns_are_found_by_name(spark, tmp_path, fmt):
    one = spark.createDataFrame([("1", "x", "2")], "a string, b string, c string")
    two = spark.createDataFrame([("8", "y", "9", "7")], "c string, b string, more string, a string")
    landed = read_source(spark, source(tmp_path, fmt, one, two), "s")
    assert landed.columns == ["a", "b", "c"]
    assert values(landed) == [("1", "x", "2"), ("7", "y", "8")]


@pytest.mark.parametrize("fmt", FORMATS)
def test_a_file_without_a_column_is_named(spark, tmp_path, fmt):
    whole = spark.createDataFrame([("1", "x", "2")], "a string, b string, c string")
    short = spark.createDataFrame([("3", "4")], "a string, c string")
    sources = source(tmp_path, fmt, whole, short)
    with pytest.raises(ValueError, match=r"part-.*lacks the columns b"):
        read_source(spark, sources, "s")
    (row,) = missing_columns(spark, sources, "s").collect()
    assert (row["fuente"], row["columna"]) == ("s", "b") and row["archivo"].endswith(f".{fmt}") or fmt == "orc"


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_number_types_meet(spark, tmp_path, fmt):
    whole = spark.createDataFrame([(1, "x", 5)], "a bigint, b string, c bigint")
    exact = spark.createDataFrame([(2, "x", Decimal("5.25"))], "a bigint, b string, c decimal(18,2)")
    landed = read_source(spark, source(tmp_path / "1", fmt, whole, exact), "s")
    cents = F.col("c").cast("decimal(18,2)")
    assert values(landed.select("a", cents)) == [("1", "5.00"), ("2", "5.25")]
    floating = spark.createDataFrame([(3, "x", 0.5)], "a int, b string, c double")
    landed = read_source(spark, source(tmp_path / "2", fmt, whole, exact, floating), "s")
    found = values(landed.select("a", F.col("c").cast("decimal(18,2)")))
    assert found == [("1", "5.00"), ("2", "5.25"), ("3", "0.50")]


def test_numbers_and_text_meet_in_text(spark, tmp_path):
    numbers = spark.createDataFrame([(1, 7, 2)], "a bigint, b bigint, c bigint")
    texts = spark.createDataFrame([(1, "x7", 2)], "a bigint, b string, c bigint")
    landed = read_source(spark, source(tmp_path, "parquet", numbers, texts), "s")
    assert values(landed) == [("1", "7", "2"), ("1", "x7", "2")]


def test_common_types():
    decimal = DecimalType
    assert common_type([LongType(), LongType()]) == LongType()
    assert common_type([IntegerType(), LongType()]) == LongType()
    assert common_type([IntegerType(), FloatType()]) == DoubleType()
    assert common_type([decimal(18, 2), LongType()]) == decimal(21, 2)
    assert common_type([decimal(18, 2), decimal(20, 4)]) == decimal(20, 4)
    assert common_type([decimal(38, 0), decimal(38, 38)]) == StringType()
    assert common_type([decimal(18, 2), StringType()]) == StringType()


def test_files_alike_are_one_scan(spark, tmp_path):
    one = spark.createDataFrame([("1", "x", "2")], "a string, b string, c string")
    landed = read_source(spark, source(tmp_path, "csv", one, one, one), "s")
    assert landed._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_empty_files_are_no_files(spark, tmp_path):
    folder = tmp_path / "s"
    folder.mkdir()
    (folder / "empty.csv").write_text("")
    sources = {"s": Source(str(folder), SCHEMA, "csv")}
    with pytest.raises(FileNotFoundError, match="no file"):
        read_source(spark, sources, "s")
    (folder / "a.csv").write_text('c,b,a\n1,"x, y",2\n')
    (folder / "b.csv").write_text("a,b,c\n")
    assert values(read_source(spark, sources, "s")) == [("2", "x, y", "1")]
    with pytest.raises(FileNotFoundError, match="no file"):
        read_source(spark, {"s": Source(f"{tmp_path}/nowhere", SCHEMA, "csv")}, "s")


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_compressed_files_without_text_are_no_files(spark, tmp_path, fmt):
    folder = tmp_path / "s"
    folder.mkdir()
    (folder / f"part-0.{fmt}.gz").write_bytes(gzip.compress(b""))
    sources = {"s": Source(str(folder), SCHEMA, fmt)}
    with pytest.raises(FileNotFoundError, match="no file"):
        read_source(spark, sources, "s")
    whole = spark.createDataFrame([("1", "x", "2")], "a string, b string, c string")
    queries_sources._land(whole.coalesce(1), fmt, str(folder))
    assert values(read_source(spark, sources, "s")) == [("1", "x", "2")]
    assert missing_columns(spark, sources, "s").count() == 0


def test_a_file_of_rows_without_columns_lacks_them(spark, tmp_path):
    folder = tmp_path / "s"
    folder.mkdir()
    (folder / "part-0.json.gz").write_bytes(gzip.compress(b"{}\n"))
    with pytest.raises(ValueError, match=r"lacks the columns a, b, c"):
        read_source(spark, {"s": Source(str(folder), SCHEMA, "json")}, "s")


def test_first_rows_are_those_of_the_first_files(spark, tmp_path):
    folder = tmp_path / "s"
    folder.mkdir()
    for name, header, start in (("b", "a,b,c", 100), ("a", "c,b,a", 0)):
        lines = [f"{start + i},x,{start + i}" for i in range(50)]
        (folder / f"{name}.csv").write_text("\n".join([header, *lines]) + "\n")
    landed = read_source(spark, {"s": Source(str(folder), SCHEMA, "csv")}, "s", order=PLACE)
    found = first_rows(landed, 60)
    assert found.columns == ["a", "b", "c"]
    assert sorted(int(r["a"]) for r in found.collect()) == [*range(50), *range(100, 110)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" in plan


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_text_lands_compressed_in_files_of_bounded_rows(spark, tmp_path, fmt, monkeypatch):
    monkeypatch.setattr(queries_sources, "_TEXT_ROWS", 2)
    df = spark.createDataFrame([(i, None, "2") for i in range(5)], "a int, b string, c string").coalesce(1)
    queries_sources._land(df, fmt, f"{tmp_path}/s")
    assert len(list(tmp_path.glob(f"s/*.{fmt}.gz"))) == 3
    landed = read_source(spark, {"s": Source(f"{tmp_path}/s", SCHEMA, fmt)}, "s")
    assert values(landed) == [(str(i), None, "2") for i in range(5)]


def test_lines_meet_their_orders_with_the_places_in_one_join(spark, sf):
    plan = analogues.sales(spark, sf, ["region_comercial"])._jdf.queryExecution().optimizedPlan()
    first = next(line for line in plan.toString().splitlines() if "Join" in line)
    assert "l_orderkey" in first


def test_a_mart_loaded_twice_builds_its_sources_once(spark, sf, monkeypatch):
    built, loads = [], []
    monkeypatch.setattr(registry, "_RELOADED", {})
    monkeypatch.setattr(registry.analogues, "raw_sources", lambda *a: built.append(a) or {"x": spark.range(3)})
    monkeypatch.setattr(registry, "seed_calendar", lambda *a: None)
    monkeypatch.setattr(registry, "run_load", lambda mart, raw: loads.append(raw["x"].inputFiles()))
    registry.reloaded(spark, sf)
    assert len(built) == 1 and len(loads) == 2 and loads[0] == loads[1] and loads[0]


def test_all_formats_are_landed_from_one_view(spark, sf, monkeypatch):
    staged = []

    def stage(df, name):
        staged.append(name)
        return staging.stage(df, name)

    monkeypatch.setattr(queries_sources, "stage", stage)
    found = registry.QUERIES["b15_landed_formats"](spark, sf).collect()
    assert staged == ["ventas"]
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert {(r["formato"], r["filas"]) for r in found} == {(f, 2 * lines) for f in ("csv", "json", "parquet")}
