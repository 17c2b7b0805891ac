from datetime import date

import pytest
from pyspark.sql import functions as F

from lonja.operators import calendar as cal
from lonja.operators import clean, kpis, quality
from lonja.operators.quality import require_passed, validation_report
from lonja.plans import load
from lonja.plans.registry import new_mart
from lonja.sources.schemas import LANDING, STAR


def landing(spark, source, rows):
    """Rows as dicts by header; absent headers are null."""
    schema = LANDING[source]
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def sale(day, invoice, value, **more):
    base = {"Fecha Venta": day, "Código Factura": invoice, "Valor Antes de iva": value}
    return {**base, "Región Comercial": "NORTE", "CANAL": "C", "CATEGORIA": "X", **more}


@pytest.fixture(scope="module")
def raw(spark):
    from decimal import Decimal as D

    ventas = [
        sale(20260105, "F1", D("100.00"), GV_Desc2="A1"),
        sale(20260105, "F1", D("100.00"), GV_Desc2="A1"),
        sale(20260106, " F1", D("50.00"), GV_Desc2=" A2 "),
        sale(20260106, "<NA>", D("7.00")),
        sale(20300101, None, None, Nota_credito="si"),
        sale(None, "F9", D("5.00"), **{"Región Comercial": "\t"}),
    ]
    presupuesto = [
        {"MES": 202601, "REGION": "NORTE", "CANAL": "C", "TERMINALES": D("60"), "TECNOLOGIA": D("40")},
        {"MES": 202601, "REGION": "NORTE", "CANAL": "C", "TERMINALES": D("60"), "TECNOLOGIA": D("40")},
        {"MES": 202613, "REGION": "SUR", "T&T": D("0"), "DESCRIP2": "A2"},
    ]
    registros = [
        {"PERIODO": 202601, "FECHA_GESTION": "2026-01-05", "CANTIDAD": 3, "TIPO_CONTACTO": "CONTACTOS EFECTIVOS", "ALIADO": "A1"},
        {"PERIODO": 202601, "FECHA_GESTION": None, "CANTIDAD": None, "ALIADO": "A1", "DETALLE1": "d"},
        {"PERIODO": 202601, "CANTIDAD": 1, "TIPO_CONTACTO": "NO_INFORMADO", "gerente": "g"},
    ]
    return {
        "ventas": landing(spark, "ventas", ventas),
        "presupuesto": landing(spark, "presupuesto", presupuesto),
        "registros": landing(spark, "registros", registros),
    }


@pytest.fixture(scope="module")
def mart(spark):
    mart = new_mart(spark)
    mart.create()
    return mart


@pytest.fixture(scope="module")
def result(spark, mart, raw):
    with pytest.raises(RuntimeError, match="calendar"):
        load.run_load(mart, raw)
    none = spark.createDataFrame([], "date string, name_es string, _src_row int")
    load.seed_calendar(mart, cal.year_range(spark, 2026, 2026), none, "_src_row")
    return load.run_load(mart, raw)


def facts(mart, table):
    columns = STAR[table].names[1:-1]
    return sorted((tuple(r) for r in mart.read(table).select(*columns).collect()), key=str)


def joined(mart, fact, dim, column):
    key = STAR[dim].names[0]
    named = mart.read(fact).join(mart.read(dim).select(key, column), key)
    return sorted((r[column] for r in named.collect()), key=str)


def test_facts_have_one_row_per_cleaned_row(mart, result):
    assert [mart.read(t).count() for t in ("fact_ventas", "fact_presupuesto", "fact_gestion_tmk")] == [5, 3, 3]
    stages = {(r["etapa"], r["tabla"]): r["filas"] for r in result.stages.collect()}
    assert stages["extract", "ventas"] == 6 and stages["transform", "ventas"] == 5


def test_unknown_dates_and_members_point_to_zero(mart, result):
    sales = mart.read("fact_ventas")
    assert sales.where("sk_tiempo = 0").count() == 2
    assert sales.where("sk_region = 0").count() == 1
    assert sales.where("valor_antes_iva = 0").count() == 1
    assert mart.read("fact_presupuesto").where("sk_tiempo = 0").count() == 1
    contacts = mart.read("fact_gestion_tmk")
    # A null date falls back to the month; the text of the unknown member means sk 0.
    assert contacts.where("sk_tiempo = 0").count() == 0
    assert contacts.where("sk_tipo_contacto = 0").count() == 2
    assert contacts.where("cantidad = 0").count() == 1


def test_a_wholly_null_hierarchy_is_a_member(mart, result):
    assert mart.read("fact_ventas").where("sk_jerarquia = 0").count() == 0
    assert joined(mart, "fact_gestion_tmk", "dim_jerarquia_comercial", "gerente") == [None, None, "g"]


def test_budget_totals_default_to_their_parts(mart, result):
    assert sorted(float(r["tyt"]) for r in mart.read("fact_presupuesto").collect()) == [0.0, 100.0, 100.0]


def test_validity_and_kpis(mart, result):
    tables = mart.read_all()
    assert sorted(r["sk_validez"] for r in tables["fact_ventas"].collect()) == [1, 1, 1, 2, 4]
    report = {r["atributo"]: r for r in kpis.compliance_by(tables, "dim_region", "nombre_region").collect()}
    assert float(report["NORTE"]["ventas_validas"]) == 150.0
    assert report["NORTE"]["cumplimiento"] == 0.75 and report["NORTE"]["estado"] == "incumple"
    assert report["SUR"]["cumplimiento"] is None and report["SUR"]["estado"] is None
    assert float(report["No informado"]["ventas_validas"]) == 5.0
    totals = kpis.contact_totals(tables).first()
    assert (totals["registros"], totals["efectivos"], totals["pct_contactabilidad"]) == (4, 3, 0.75)


def test_report_has_38_passed_checks(mart, result):
    report = result.report.collect()
    assert len(report) == 38 and all(r["ok"] for r in report)


def test_a_second_load_keeps_keys_and_content(mart, result, raw):
    dimensions = [t for t in STAR if t.startswith("dim_")]
    before = {t: sorted(map(str, mart.read(t).collect())) for t in dimensions}
    measured = {t: facts(mart, t) for t in STAR if t.startswith("fact_")}
    again = load.run_load(mart, raw)
    assert {t: sorted(map(str, mart.read(t).collect())) for t in dimensions} == before
    merges = {r["tabla"]: tuple(r)[1:] for r in again.merges.collect()}
    assert merges["dim_aliado"] == (0, 2, 0)
    assert merges["dim_tipo_contacto"] == (0, 1, 1)
    assert {t: facts(mart, t) for t in measured} == measured


def test_new_members_get_the_next_keys(spark, mart, result, raw):
    top = mart.read("dim_aliado").agg(F.max("sk_aliado")).first()[0]
    more = landing(spark, "ventas", [sale(20260107, "F3", None, GV_Desc2="A0")])
    load.run_load(mart, {**raw, "ventas": raw["ventas"].unionByName(more)})
    added = mart.read("dim_aliado").where("aliado_nk = 'A0'").first()
    assert added["sk_aliado"] == top + 1


def test_a_failed_load_leaves_the_old_version(mart, result):
    before = mart.read("dim_marca").count()
    broken = mart.read("dim_marca").withColumn("marca_nk", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        mart.replace("dim_marca", broken)
    assert mart.read("dim_marca").count() == before


def test_checks_find_damage(mart, result):
    tables = mart.read_all()
    lossy = {**tables, "dim_region": tables["dim_region"].where("sk_region = 0")}
    found = {(r["hecho"], r["fk"]): r["huerfanos"] for r in quality.orphan_counts(lossy).collect()}
    assert len(found) == 23
    assert found["fact_ventas", "sk_region"] == tables["fact_ventas"].where("sk_region > 0").count()
    assert sum(found.values()) == sum(v for (_, fk), v in found.items() if fk == "sk_region")
    twice = {"dim_aliado": tables["dim_aliado"].unionByName(tables["dim_aliado"])}
    assert all(r["violaciones"] > 0 for r in quality.key_violations(twice).collect())
    bad = {"fact_gestion_tmk": tables["fact_gestion_tmk"].withColumn("cantidad", F.lit(-1))}
    negative = quality.value_violations(bad).where("violaciones > 0").collect()
    assert [(r["regla"], r["violaciones"]) for r in negative] == [("cantidad_no_negativa", 3)]


def test_empty_facts_pass_the_reference_check(spark, result):
    empty = new_mart(spark)
    empty.create()
    report = {r["chequeo"]: r["ok"] for r in validation_report(empty).collect()}
    assert report["integridad referencial fact_ventas"] is True
    assert report["miembro sk=0 en dim_region"] is False
    with pytest.raises(RuntimeError, match="check"):
        require_passed(validation_report(empty))


def test_declarations_and_sample_size_can_be_replaced(spark, mart, result, raw):
    from dataclasses import replace

    from lonja.operators.dimensions import TEXT_DIMENSIONS

    region, segment = TEXT_DIMENSIONS["dim_region"], TEXT_DIMENSIONS["dim_segmento"]
    specs = {
        **TEXT_DIMENSIONS,
        "dim_region": replace(region, sources={**region.sources, "ventas": ("d_division",)}),
        "dim_segmento": replace(
            segment, attributes={**segment.attributes, "segmento_normalizado": "upper(segmento_nk)"}
        ),
        "dim_jerarquia_comercial": replace(
            TEXT_DIMENSIONS["dim_jerarquia_comercial"], null_keys="all"
        ),
    }
    other = new_mart(spark)
    other.create()
    none = spark.createDataFrame([], "date string, name_es string, _src_row int")
    load.seed_calendar(other, cal.year_range(spark, 2026, 2026), none, "_src_row")
    more = landing(spark, "registros", [{"SEGMENTO": "bajo"}])
    sources = {**raw, "registros": raw["registros"].unionByName(more)}
    load.run_load(other, sources, specs=specs)
    assert other.read("fact_ventas").where("sk_region = 0").count() == 5
    assert other.read("fact_ventas").where("sk_jerarquia = 0").count() == 5
    labels = other.read("dim_segmento").where("sk_segmento > 0").collect()
    assert [r["segmento_normalizado"] for r in labels] == ["BAJO"]
    sampled = load.run_load(other, sources, max_rows=2)
    assert sampled.tables["fact_presupuesto"].count() == 2


def test_the_calendar_grows_and_keeps_its_keys(spark, mart, result):
    before = {r["fecha"]: r["sk_tiempo"] for r in mart.read("dim_tiempo").collect()}
    named = spark.createDataFrame([("2026-05-01", "Trabajo", 1)], "date string, name_es string, _src_row int")
    load.seed_calendar(mart, cal.year_range(spark, 2025, 2026), named, "_src_row")
    after = {r["fecha"]: r for r in mart.read("dim_tiempo").collect()}
    assert len(after) == 1 + 365 + 365
    assert {d: after[d]["sk_tiempo"] for d in before} == before
    assert [r["nombre_festivo"] for r in after.values() if r["es_festivo"]] == ["Trabajo"]


def test_command_line(spark, raw, tmp_path):
    from lonja.plans import job
    from lonja.sources.registry import landing_sources

    sources = landing_sources(str(tmp_path / "landing"), "csv")
    for key, df in raw.items():
        df.write.option("header", "true").csv(sources[key].path)
    festivos = spark.createDataFrame([("2026-01-01", "Año")], "date string, name_es string")
    festivos.write.option("header", "true").csv(sources["festivos"].path)
    shared = ["--database", "lonja_cli", "--location", str(tmp_path / "mart")]
    shared += ["--landing", str(tmp_path / "landing"), "--format", "csv"]
    assert job.main(["load", *shared]) == 1
    assert job.main(["calendar", *shared, "--start-year", "2026", "--end-year", "2025"]) == 1
    assert job.main(["calendar", *shared, "--start-year", "2026", "--end-year", "2026"]) == 0
    assert job.main(["load", *shared]) == 0
    assert spark.table("lonja_cli.fact_ventas").count() == 5


def test_csv_that_breaks_its_schema_fails(spark, tmp_path):
    from lonja.sources.registry import landing_sources, read_source

    sources = landing_sources(str(tmp_path), "csv")
    headers = LANDING["presupuesto"].names
    text = spark.createDataFrame([("enero", *["x"] * 10, "1", "1", "2")], headers)
    text.write.option("header", "true").csv(sources["presupuesto"].path)
    landed = read_source(spark, sources, "presupuesto")
    with pytest.raises(Exception, match="cannot cast"):
        clean.clean_budget(landed.withColumn("T&T", F.lit("mucho"))).collect()
    row = clean.clean_budget(landed.withColumn("T&T", F.lit("mucho")), "permissive").first()
    assert (row["mes"], row["t_t"], float(row["terminales"])) == (None, None, 1.0)


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_landed_formats_clean_alike(spark, tmp_path, fmt):
    from lonja.sources.registry import landing_sources, read_source

    sources = landing_sources(str(tmp_path), fmt)
    headers = LANDING["ventas"].names
    values = {"Fecha Venta": "20260105.0", "Código Factura": "F1", "MES": "1"}
    rows = []
    for amount in (10.001, 10.002, 10.002, 10.0):
        own = {**values, "Valor Antes de iva": amount}
        rows.append(tuple(own.get(h) for h in headers))
    rows.append(tuple({**values, "Fecha Venta": "sin fecha", "Valor Antes de iva": 10.0}.get(h) for h in headers))
    schema = ", ".join(f"`{h}` {'double' if h == 'Valor Antes de iva' else 'string'}" for h in headers)
    df = spark.createDataFrame(rows, schema)
    writer = df.write.option("header", "true").option("ignoreNullFields", "false")
    writer.format(fmt).save(sources["ventas"].path)
    cleaned = clean.clean_sales(read_source(spark, sources, "ventas"))
    found = [(r["fecha_venta"], float(r["valor_antes_de_iva"]), r["mes"]) for r in cleaned.collect()]
    day = date(2026, 1, 5)
    assert sorted(found, key=str) == sorted([(day, 10.0, 1)] * 3 + [(None, 10.0, 1)], key=str)

    short = df.drop("GV_Desc2", "Marca")
    writer = short.write.option("header", "true").option("ignoreNullFields", "false")
    writer.format(fmt).mode("overwrite").save(sources["ventas"].path)
    with pytest.raises(ValueError, match="GV_Desc2, Marca"):
        read_source(spark, sources, "ventas")


def test_the_last_holiday_file_wins(spark, tmp_path):
    from lonja.sources.registry import landing_sources, read_source

    sources = landing_sources(str(tmp_path), "csv")
    folder = tmp_path / "festivos"
    folder.mkdir()
    (folder / "a.csv").write_text("date,name_es\n" + "2026-05-01,Viejo\n" * 50)
    (folder / "b.csv").write_text("date,name_es\n2026-05-01,Otro\n2026-05-01,Nuevo\n")
    names = cal.holiday_names(read_source(spark, sources, "festivos", order="n"), "n")
    assert [r["nombre_festivo"] for r in names.collect()] == ["Nuevo"]


def test_a_fact_that_drops_rows_fails_the_load(mart, result, raw, monkeypatch):
    original = load.build_fact

    def fewer(spec, *args):
        fact = original(spec, *args)
        return fact.where("valor_antes_iva <> 0") if spec.table == "fact_ventas" else fact

    monkeypatch.setattr(load, "build_fact", fewer)
    with pytest.raises(ValueError, match="fact_ventas"):
        load.run_load(mart, raw)
    monkeypatch.undo()
    load.run_load(mart, raw)


def test_a_repeated_member_fails_the_load(mart, result, raw, monkeypatch):
    original = load.dims.updated_members

    def twice(existing, incoming, spec):
        members = original(existing, incoming, spec)
        return members.unionByName(members) if spec.table == "dim_marca" else members

    monkeypatch.setattr(load.dims, "updated_members", twice)
    with pytest.raises(ValueError, match="dim_marca"):
        load.run_load(mart, raw)
