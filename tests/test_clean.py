import pytest

from lonja.operators import clean
from lonja.sources.registry import first_rows, landing_sources, read_source

ROWS = [(1, "a", 10), (2, "a", 20), (3, "b", None), (4, None, 5), (5, None, 5)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "id int, k string, v int")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_exact_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x")], "a int, b string")
    once = clean.drop_duplicate_rows(df)
    assert once.count() == 2
    assert clean.drop_duplicate_rows(once).count() == 2


def test_duplicates_by_key_keep_first_last_or_none(rows):
    assert ids(clean.drop_duplicates_by(rows, ["k"], ["id"], "first")) == [1, 3, 4]
    assert ids(clean.drop_duplicates_by(rows, ["k"], ["id"], "last")) == [2, 3, 5]
    assert ids(clean.drop_duplicates_by(rows, ["k"], ["id"], "none")) == [3]
    assert ids(clean.drop_duplicates_by(rows, ["absent"], ["id"])) == [1, 2, 3, 4, 5]


def test_keys_that_occur_once_keep_their_nulls(rows):
    row = clean.drop_duplicates_by(rows, ["k"], ["id"], "none").first()
    assert tuple(row) == (3, "b", None)


def test_a_hot_key_is_cut_to_one_row_per_task_before_the_shuffle(rows):
    for keep in ("first", "last"):
        plan = clean.drop_duplicates_by(rows, ["k"], ["id"], keep)
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in text and "Partial" in text


def test_nulls(rows):
    filled = clean.fill_nulls(rows, {"v": 0, "absent": 1})
    assert {r["v"] for r in filled.collect()} == {0, 5, 10, 20}
    assert ids(clean.drop_null_rows(rows, ["k", "v", "absent"])) == [1, 2]
    assert clean.drop_null_rows(rows, ["absent"]) is rows


def test_cast_columns_needs_a_mapping_and_ignores_absent_columns(rows):
    with pytest.raises(TypeError):
        clean.cast_columns(rows, ["v"])
    assert dict(clean.cast_columns(rows, {"v": "bigint", "x": "date"}).dtypes)["v"] == "bigint"


def test_budget_is_not_deduplicated(spark):
    raw = spark.createDataFrame([(202601, " N ", 1.0), (202601, " N ", 1.0)], "MES bigint, REGION string, `T&T` double")
    cleaned = clean.clean_budget(raw)
    assert cleaned.columns == ["mes", "region", "t_t"]
    assert [str(r["mes"]) + r["region"] for r in cleaned.collect()] == ["2026-01-01N"] * 2


def test_cleaning_finds_duplicates_that_differ_in_padding(spark):
    raw = spark.createDataFrame(
        [("20260105.0", "F1 "), ("20260105", "\tF1")], "`Fecha Venta` string, `Código Factura` string"
    )
    assert clean.clean_sales(raw).count() == 1


def test_first_rows_follow_the_stated_order(rows):
    assert ids(first_rows(rows, 2, ["v", "id"])) == [3, 4]


def test_sources_fail_fast(spark, tmp_path):
    sources = landing_sources(str(tmp_path))
    with pytest.raises(KeyError, match="registered"):
        read_source(spark, sources, "otra")
    with pytest.raises(FileNotFoundError, match="ventas"):
        read_source(spark, sources, "ventas")


@pytest.mark.parametrize("limit", [0, 100])
def test_only_rows_with_a_copy_are_compared(spark, monkeypatch, limit):
    """The same rows whether the repeated hashes are few or too many; nulls move between columns."""
    monkeypatch.setattr(clean, "REPEATED_HASHES", limit)
    rows = [(i, None if i % 2 else "x", float(i)) for i in range(50)]
    rows += [rows[3], rows[3], rows[8], (None, "y", 0.0), (None, "y", -0.0), (1, "y", None), (None, None, 1.0)]
    once = clean.drop_duplicate_rows(spark.createDataFrame(rows, "a int, b string, c double"))
    assert {tuple(r) for r in once.collect()} == set(rows) and once.count() == len(set(rows))
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert ("LeftAnti" in plan) == (limit > 0)
