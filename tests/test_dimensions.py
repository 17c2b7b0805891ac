from contextlib import contextmanager
from dataclasses import replace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lonja.operators import dimensions as dims
from lonja.sources import staging
from lonja.operators.facts import FOREIGN_KEYS, lookup_key
from lonja.sources.mart_tables import conformed
from lonja.sources.schemas import SEEDS, STAR
from lonja.sources.staging import ordinal, stage_numbered

REGION = dims.TEXT_DIMENSIONS["dim_region"]
HIERARCHY = dims.TEXT_DIMENSIONS["dim_jerarquia_comercial"]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_there_are_twenty_three_foreign_keys():
    assert len(FOREIGN_KEYS) == 23
    assert all(len(r) == len(STAR[t].names) for t, seed in SEEDS.items() for r in seed)


def test_members_unite_differently_named_columns(spark):
    frames = {
        "ventas": spark.createDataFrame([(" N ",), ("S",), (None,)], "region_comercial string"),
        "presupuesto": spark.createDataFrame([("N",), ("",)], "region string"),
        "registros": spark.createDataFrame([("sin_region",)], "division_comercial string"),
    }
    found = rows(dims.members(REGION, frames), "region_nk", "es_sin_region")
    assert found == [("N", False), ("S", False), ("sin_region", True)]


def test_null_keys(spark):
    channel = dims.TEXT_DIMENSIONS["dim_canal"]
    ventas = spark.createDataFrame(
        [("a", "b"), ("a", "b"), ("a", None), (None, "b")], "canal string, canal2 string"
    )
    assert dims.members(channel, {"ventas": ventas}).count() == 2
    levels = "gerente string, jefe string, especialista string"
    people = spark.createDataFrame([("g", None, None), (None, "j", None), (None, None, None)], levels)
    assert dims.members(HIERARCHY, {"registros": people}).count() == 3
    some = replace(HIERARCHY, null_keys="all")
    assert dims.members(some, {"registros": people}).count() == 2
    keys = dims.all_member_keys({"registros": people}, {"d": some})
    assert keys.count() == 2


def existing_regions(spark):
    seeds = dims.seed_rows(spark, "dim_region")
    known = spark.createDataFrame([(4, "B", "b", False), (9, "A", "a", False)], STAR["dim_region"])
    return seeds.unionByName(known)


def test_merge_keeps_keys_updates_attributes_and_never_touches_zero(spark):
    incoming = spark.createDataFrame(
        [
            ("A", "first", False, 1),
            ("A", "last", True, 2),
            ("D", "d", False, 3),
            ("C", "c", False, 4),
            ("NO_INFORMADO", "x", False, 5),
        ],
        "region_nk string, nombre_region string, es_sin_region boolean, orden int",
    )
    merged = dims.merge_members(existing_regions(spark), incoming, REGION, last_by="orden")
    assert rows(merged, "sk_region", "region_nk", "nombre_region", "_action") == [
        (0, "NO_INFORMADO", "No informado", "skipped"),
        (10, "C", "c", "inserted"),
        (11, "D", "d", "inserted"),
        (4, "B", "b", "kept"),
        (9, "A", "last", "updated"),
    ]
    assert tuple(dims.merge_counts(merged).first()) == (2, 1, 1)
    again = dims.merge_members(merged.drop("_action"), incoming, REGION, last_by="orden")
    columns = STAR["dim_region"].names
    assert rows(again, *columns) == rows(merged, *columns)
    assert tuple(dims.merge_counts(again).first()) == (0, 3, 1)


def test_unlike_rows_of_one_key_need_an_order(spark):
    two = [("A", "first", False), ("A", "last", True), ("B", "b", False), ("B", "b", False)]
    incoming = spark.createDataFrame(two, "region_nk string, nombre_region string, es_sin_region boolean")
    with pytest.raises(ValueError, match="dim_region: unlike rows .*'A'"):
        dims.merge_members(existing_regions(spark), incoming, REGION)
    merged = dims.merge_members(existing_regions(spark), incoming.where("region_nk = 'B'"), REGION)
    assert merged.where("region_nk = 'B'").count() == 1


def test_merge_treats_null_key_parts_as_equal(spark):
    existing = spark.createDataFrame([(1, "g", None, None)], STAR[HIERARCHY.table])
    incoming = existing.drop("sk_jerarquia")
    merged = dims.merge_members(existing, incoming, HIERARCHY)
    assert [(r["sk_jerarquia"], r["_action"]) for r in merged.collect()] == [(1, "updated")]


def test_merge_takes_a_supplied_key_and_skips_key_zero(spark):
    existing = dims.seed_rows(spark, "dim_validez_venta").where("sk_validez <= 2")
    incoming = dims.seed_rows(spark, "dim_validez_venta").withColumn(
        "sk_validez", F.when(F.col("sk_validez") == 4, 0).otherwise(F.col("sk_validez"))
    )
    merged = dims.merge_members(existing, incoming, dims.VALIDITY)
    assert rows(merged, "sk_validez", "_action") == [(1, "updated"), (2, "updated"), (3, "inserted")]


def test_seeds_are_inserted_only_where_absent(spark):
    bare = spark.createDataFrame([(4, "B", "b", False)], STAR["dim_region"])
    once = dims.ensure_seeds(bare, "dim_region")
    assert rows(once, "sk_region") == [(0,), (4,)]
    assert rows(dims.ensure_seeds(once, "dim_region"), "sk_region") == [(0,), (4,)]


def test_bulk_numbering_continues_each_dimension(spark):
    frames = {
        "registros": spark.createDataFrame(
            [("B", "y"), ("D", "x"), ("C", "x")], "division_comercial string, segmento string"
        )
    }
    specs = {t: dims.TEXT_DIMENSIONS[t] for t in ("dim_region", "dim_segmento")}
    keys = dims.all_member_keys(frames, specs)
    empty = {
        t: spark.createDataFrame([], STAR[t])
        for t in dims.TEXT_DIMENSIONS
        if t != "dim_region"
    }
    numbered = dims.number_new_members(keys, {"dim_region": existing_regions(spark), **empty})
    assert rows(numbered, "_dim", "_k1", "_sk") == [
        ("dim_region", "C", 10),
        ("dim_region", "D", 11),
        ("dim_segmento", "x", 1),
        ("dim_segmento", "y", 2),
    ]


def test_lookup_is_null_safe_and_a_miss_gives_zero(spark):
    dim = spark.createDataFrame(
        [(0, "No informado", None, None), (1, "g", None, "e"), (2, None, None, None)],
        STAR[HIERARCHY.table],
    )
    df = spark.createDataFrame(
        [("g", None, "e"), (None, None, None), ("g", "j", "e"), ("No informado", None, None)],
        "a string, b string, c string",
    )
    pairs = {"gerente": F.col("a"), "jefe": F.col("b"), "especialista": F.col("c")}
    got = lookup_key(df, dim, "sk_jerarquia", pairs)
    assert {tuple(r) for r in got.collect()} == {
        ("g", None, "e", 1),
        (None, None, None, 2),
        ("g", "j", "e", 0),
        ("No informado", None, None, 0),
    }


@contextmanager
def settings(spark, **values):
    values = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_lookup_beyond_the_broadcast_size_splits_a_hot_key(spark, tmp_path):
    """One key holds a third of the rows, null another third."""
    spark.range(2000).selectExpr("id as sk", "concat('k', id) as nk").write.parquet(f"{tmp_path}/d")
    dim = spark.read.parquet(f"{tmp_path}/d")
    df = spark.range(0, 200000, 1, 8).selectExpr(
        "id",
        "case id % 3 when 0 then 'k7' when 1 then null else concat('k', id % 4000) end as k",
    )

    def result():
        found = lookup_key(df, dim, "sk", {"nk": F.col("k")})
        return found.groupBy("sk").agg(F.count("*"), F.sum("id"))

    small = result()
    want = sorted(map(tuple, small.collect()))
    assert "BroadcastHashJoin" in final_plan(small)
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="50000",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="50000",
        adaptive__skewJoin__skewedPartitionFactor="1.2",
    ):
        large = result()
        assert sorted(map(tuple, large.collect())) == want
        assert "SortMergeJoin(skew=true)" in final_plan(large)


@pytest.mark.parametrize("parts", [1, 7])
def test_staged_numbers_are_gap_free(spark, parts):
    df = spark.range(1000).repartition(parts)
    numbered = stage_numbered(df, "t")
    got = sorted(r["_src_row"] for r in numbered.collect())
    assert got == list(range(1, 1001))


def parts_of(monkeypatch):
    """Record how many write tasks each staged frame had."""
    seen = []
    original = staging.stage

    def spy(df, name):
        written = original(df, name)
        if "_part" in written.columns:
            seen.append(written.select("_part").distinct().count())
        return written

    monkeypatch.setattr(staging, "stage", spy)
    return seen


def test_ordered_numbers_follow_the_order_over_several_tasks(spark, monkeypatch):
    seen = parts_of(monkeypatch)
    df = spark.range(1000).selectExpr("id", "id % 10 as g").repartition(6)
    order = [F.col("g").desc(), F.col("id")]
    numbers = F.row_number().over(Window.orderBy(*order)).cast("bigint")
    with settings(spark, adaptive__coalescePartitions__enabled="false"):
        found = ordinal(df, order, "n")
        assert rows(found, "id", "n") == rows(df.withColumn("n", numbers), "id", "n")
    assert seen == [4]


def test_weighted_numbers_are_running_totals_over_several_tasks(spark, monkeypatch):
    seen = parts_of(monkeypatch)
    df = spark.range(100).selectExpr("id", "id % 3 as w").repartition(5)
    with settings(spark, adaptive__coalescePartitions__enabled="false"):
        staged = stage_numbered(df, "t", [F.col("id")], "upto", weight="w")
        got = sorted(tuple(r) for r in staged.select("id", "upto").collect())
    total, want = 0, []
    for i in range(100):
        total += i % 3
        want.append((i, total))
    assert got == want and seen == [4]


def test_conformed_types(spark):
    df = spark.createDataFrame([("3", " a ", None)], "sk_region string, region_nk string, es_sin_region boolean")
    with pytest.raises(ValueError, match="nombre_region"):
        conformed(df, "dim_region")
    row = conformed(df.withColumn("nombre_region", F.lit("x")), "dim_region").first()
    assert tuple(row) == (3, " a ", "x", False)
