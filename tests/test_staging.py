"""Staged tables and large joins: numbers without gaps, and no needless shuffle of rows."""

import pytest
from pyspark.sql import functions as F

from lonja.operators import quality
from lonja.operators.dimensions import all_member_keys
from lonja.operators.facts import FOREIGN_KEYS
from lonja.sources import analogues
from lonja.sources.schemas import STAR
from lonja.sources.staging import ROW, stage_numbered


@pytest.fixture
def large_tables(spark):
    """Plans as for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_numbered_rows_are_not_shuffled(spark, large_tables):
    rows = spark.range(1000).repartition(7).withColumn("text", F.lit("x"))
    numbered = stage_numbered(rows, "rows")
    found = numbered.orderBy(ROW).collect()
    assert [r[ROW] for r in found] == list(range(1, 1001))
    assert sorted(r.id for r in found) == list(range(1000))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_lines_are_not_shuffled_for_small_suppliers(spark, sf):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # More than the suppliers or the nations, less than the product of their sizes.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100000")
    try:
        sold = analogues.sales(spark, sf, ["gv_division", "gv_especialista"])
        plan = sold._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2


def test_fact_rows_are_counted_before_they_meet_the_dimensions(spark):
    # Tables whose size Spark knows to be small, as that of written ones.
    tables = {
        t: spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
        for t, schema in STAR.items()
    }
    keys = {key for fact, key, _ in FOREIGN_KEYS if fact == "fact_ventas"}
    one = spark.range(3).select(*[F.lit(0 if c == "sk_region" else 7).cast("bigint").alias(c) for c in keys])
    tables["fact_ventas"] = one
    tables["dim_region"] = spark.range(1).select(F.col("id").alias("sk_region"))
    counts = quality.orphan_counts(tables)
    found = {r["fk"]: r["huerfanos"] for r in counts.where("hecho = 'fact_ventas'").collect()}
    assert found == {key: 0 if key == "sk_region" else 3 for key in keys}
    plan = counts._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(plan) if "Join Left" in line)
    assert "Aggregate" in "".join(plan[join : join + 4])


def test_members_combine_before_their_rows_are_made(spark):
    frame = spark.createDataFrame([("N", "x"), (" N", "x"), ("", None)], "region string, canal string")
    keys = all_member_keys({"presupuesto": frame})
    found = {(r["_dim"], r["_k1"], r["_k2"]) for r in keys.collect()}
    assert {("dim_region", "N", None), ("dim_canal", "x", None)} <= found and len(found) == keys.count()
    assert "Generate" not in keys._jdf.queryExecution().optimizedPlan().toString()
    empty = all_member_keys({"presupuesto": frame.drop("canal").limit(0)})
    assert empty.count() == 0
