"""Drafts, manifests, retention, parallel loads, older marts and months as folders."""

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from threading import Barrier

import pytest
from pyspark.sql import functions as F
from test_load import landing, raw, sale  # noqa: F401

from lonja.operators import calendar as cal
from lonja.operators import kpis
from lonja.plans import load
from lonja.plans.registry import new_mart
from lonja.sources.mart_tables import StaleDraft
from lonja.sources.schemas import DIMENSIONS, PERIOD, STAR

NO_HOLIDAYS = "date string, name_es string, _src_row int"


def seeded(spark, first=2026, last=2026):
    mart = new_mart(spark)
    days = spark.createDataFrame([("2026-05-01", "Trabajo", 1)], NO_HOLIDAYS)
    counts = load.seed_calendar(mart, cal.year_range(spark, first, last), days, "_src_row")
    return mart, counts


def locations(spark, mart):
    found = {}
    for table in STAR:
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {mart.name(table)}")
        found[table] = described.where("col_name = 'Location'").first()["data_type"]
    return found


def folders(mart):
    tables = [p for t in STAR for p in Path(mart.location, t).glob("*")]
    return len(tables)


def staged_folders(mart):
    return set(Path(mart.location).parents[1].glob("staged/load-*"))


@pytest.fixture(scope="module")
def mart(spark, raw):  # noqa: F811
    """A mart with sales in every month, loaded once."""
    mart, counts = seeded(spark)
    assert counts == {"inserted": 365, "updated": 0, "skipped": 0}
    more = [sale(20260000 + m * 100 + 3, f"M{m}", None) for m in range(1, 13)]
    load.run_load(mart, {**raw, "ventas": raw["ventas"].unionByName(landing(spark, "ventas", more))})
    return mart


def test_a_load_that_fails_changes_nothing(spark, mart, raw, monkeypatch):  # noqa: F811
    before, state = locations(spark, mart), mart.head()
    facts = [t for t in STAR if t.startswith("fact_")] + ["dim_aliado"]
    content = {t: sorted(map(str, mart.read(t).collect())) for t in facts}
    held, staged = folders(mart), staged_folders(mart)
    report, facts_of = load.validation_report, load.build_fact

    def broken_report(draft):
        return report(draft).withColumn("ok", F.col("chequeo") != "conteo fact_ventas")

    def lossy_fact(spec, *args):
        fact = facts_of(spec, *args)
        return fact.where("false") if spec.table == "fact_gestion_tmk" else fact

    for name, broken in (("validation_report", broken_report), ("build_fact", lossy_fact)):
        with monkeypatch.context() as patch, pytest.raises((ValueError, RuntimeError), match="fact"):
            patch.setattr(load, name, broken)
            load.run_load(mart, {**raw, "ventas": raw["ventas"].limit(2)})
        assert mart.head() == state and locations(spark, mart) == before
        assert {t: sorted(map(str, mart.read(t).collect())) for t in facts} == content
        assert {t: sorted(map(str, spark.table(mart.name(t)).collect())) for t in facts} == content
        assert (folders(mart), staged_folders(mart)) == (held, staged)


def test_a_months_report_reads_one_folder(mart):
    tables = mart.read_all()
    months = {p.name for p in Path(mart.head().tables["fact_ventas"]).glob(f"{PERIOD.name}=*")}
    assert f"{PERIOD.name}=202601" in months and f"{PERIOD.name}=0" in months and len(months) > 12
    one = kpis.in_months(tables, 202603, 202603)["fact_ventas"]
    assert [r[0].split("/")[-2] for r in one.select("_metadata.file_path").collect()] == [f"{PERIOD.name}=202603"]
    plan = executed(kpis.total_sales(kpis.in_months(tables, 202603, 202603)))
    assert f"PartitionFilters: [isnotnull({PERIOD.name}" in plan
    days = F.col("fecha").isNotNull() & (F.col("mes") == 3)
    dynamic = kpis.on_days(tables, days)["fact_ventas"]
    assert "dynamicpruning" in executed(dynamic) and dynamic.count() == 1
    assert all(kpis.on_days(tables, days)[t] is tables[t] for t in DIMENSIONS)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_folders_do_not_pile_up(mart, raw):  # noqa: F811
    counts = []
    for _ in range(2):
        load.run_load(mart, raw)
        counts.append((folders(mart), len(mart._store.names(f"{mart.location}/_manifests"))))
    assert counts[0] == counts[1] and counts[1][1] == load.KEPT_STATES
    kept = {mart.head().staged, mart._manifest(mart.head().number - 1).staged}
    assert all(Path(folder).exists() for folder in kept)


def test_counts_of_the_calendar(spark):
    mart, _ = seeded(spark)
    years = cal.year_range(spark, 2025, 2026)
    none = spark.createDataFrame([], NO_HOLIDAYS)
    assert load.seed_calendar(mart, years, none, "_src_row") == {"inserted": 365, "updated": 365, "skipped": 0}
    late, early = mart.draft(), mart.draft()
    for draft in (late, early):
        draft.write("dim_marca", spark.createDataFrame([(0, "a", "b")], STAR["dim_marca"]))
    early.publish()
    with pytest.raises(StaleDraft):
        late.publish()
    assert mart.head().tables["dim_marca"] == early._written["dim_marca"]


def test_two_loads_at_once_give_no_key_twice(spark, mart, raw, monkeypatch):  # noqa: F811
    gate, tries = Barrier(2), []
    original = load.load_facts

    def together(draft, *args):
        tries.append(draft.base.number)
        if len(tries) <= 2:
            gate.wait(300)
        return original(draft, *args)

    monkeypatch.setattr(load, "load_facts", together)

    def run(name):
        more = landing(spark, "ventas", [sale(20260107, f"F-{name}", None, GV_Desc2=f"ally {name}")])
        return load.run_load(mart, {**raw, "ventas": raw["ventas"].unionByName(more)})

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(run, ["one", "two"]))
    # One of the two began on the older state, lost, and ran again on the other's.
    assert len(tries) == 3 and tries[0] == tries[1] == tries[2] - 1
    allies = mart.read("dim_aliado").collect()
    assert {"ally one", "ally two"} <= {r["aliado_nk"] for r in allies}
    assert len({r["sk_aliado"] for r in allies}) == len(allies)


def test_a_mart_with_the_old_calendar_loads(spark, raw):  # noqa: F811
    """A stored calendar without the three later columns, as an earlier release wrote it."""
    newer, _ = seeded(spark)
    old = newer.read("dim_tiempo").drop("es_festivo", "nombre_festivo", "es_habil")
    mart = new_mart(spark)
    spark.sql(f"CREATE DATABASE {mart.database}")
    old.write.option("path", f"{mart.location}/dim_tiempo/v1").saveAsTable(mart.name("dim_tiempo"))
    load.run_load(mart, raw)
    assert mart.read("dim_tiempo").columns == STAR["dim_tiempo"].names
    assert spark.table(mart.name("dim_tiempo")).columns == STAR["dim_tiempo"].names
    days = {r["fecha"]: r for r in mart.read("dim_tiempo").collect()}
    assert sum(r["es_festivo"] for r in days.values()) == 1
    assert all(r["es_habil"] == r["es_dia_habil"] for d, r in days.items() if d)
    mart.create()
    assert load.evolve(mart) == []
