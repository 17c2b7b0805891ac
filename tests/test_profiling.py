import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lonja.operators import profiling

COLUMNS = ["k", "a", "b", "c", "x"]


@pytest.fixture(scope="module")
def data():
    """One key holds a third of the rows."""
    rng = random.Random(3)
    rows = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else rng.choice([None, *[f"k{j}" for j in range(120)]])
        rows.append(
            (key, rng.choice([1, 2, None]), rng.choice(["u", "v"]), None, float(rng.randint(0, 40)))
        )
    return rows + rows[:7]


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(data, "k string, a int, b string, c string, x double").repartition(5)


def test_column_profile(df, data):
    got = {r["columna"]: r for r in profiling.profile_columns(df).collect()}
    for i, name in enumerate(COLUMNS):
        filled = [r[i] for r in data if r[i] is not None]
        row = got[name]
        assert (row["no_nulos"], row["nulos"]) == (len(filled), len(data) - len(filled))
        assert row["distintos"] == len(set(filled))
        assert row["pct_nulos"] == round(100 * (len(data) - len(filled)) / len(data), 2)
    empty = profiling.profile_columns(df.where("false")).collect()
    assert sorted(r["columna"] for r in empty) == sorted(COLUMNS)
    assert {(r["no_nulos"], r["distintos"], r["pct_nulos"]) for r in empty} == {(0, 0, None)}
    approx = {r["columna"]: r["distintos"] for r in profiling.profile_columns_approx(df).collect()}
    assert approx["a"] == 2 and approx["c"] == 0


def test_top_values_only_of_low_cardinality(df, data):
    got = profiling.top_values(df).collect()
    assert {r["columna"] for r in got} == {"a", "b"}
    counts = Counter(str(r[1]) for r in data if r[1] is not None)
    assert {r["valor"]: r["n"] for r in got if r["columna"] == "a"} == counts


def test_shape(df, data):
    row = profiling.table_shape(df).first()
    assert tuple(row) == (len(data), 5, 1, len(data) - len(set(data)))


def test_candidate_keys(df, data):
    candidates = {"k": ["k"], "k+x": ["k", "x"], "a+b+x": ["a", "b", "x"]}
    got = {r["clave"]: r for r in profiling.candidate_keys(df, candidates).collect()}
    for name, key in candidates.items():
        places = [COLUMNS.index(c) for c in key]
        whole = [tuple(r[p] for p in places) for r in data]
        whole = [t for t in whole if None not in t]
        row = got[name]
        assert row["filas_nulas"] == len(data) - len(whole)
        assert row["filas_evaluadas"] == len(whole)
        assert row["claves_unicas"] == len(set(whole))
        assert row["es_unica"] == (len(set(whole)) == len(whole))


def groups(data):
    found = defaultdict(list)
    for row in data:
        if row[0] is not None:
            found[row[0]].append(row)
    return {k: v for k, v in found.items() if len(v) > 1}


def test_repeated_keys(df, data):
    want = {k: len(v) for k, v in groups(data).items()}
    assert {r["k"]: r["ocurrencias"] for r in profiling.repeated_values(df, ["k"]).collect()} == want
    histogram = profiling.repetition_histogram(df, ["k"]).collect()
    assert {r["ocurrencias"]: r["claves"] for r in histogram} == Counter(want.values())
    row = profiling.key_cardinality(df, "k").first()
    filled = [r[0] for r in data if r[0] is not None]
    assert row["filas_extra"] == len(filled) - len(set(filled))
    assert row["filas_en_grupos"] == sum(want.values()) and row["valores_repetidos"] == len(want)


def test_varying_columns_count_null_as_a_value(df, data):
    got = {
        r["columna"]: r["grupos_con_variacion"]
        for r in profiling.varying_columns(df, ["k"], ["a", "b", "c", "x"]).collect()
    }
    for i, name in enumerate(COLUMNS[1:], 1):
        want = sum(len({r[i] for r in rows}) > 1 for rows in groups(data).values())
        assert got[name] == want


def test_largest_group(df, data):
    row = profiling.largest_group(df, ["k"], ["x"], ["a", "c"]).first()
    mine = groups(data)["hot"]
    assert row["k"] == "hot" and row["filas"] == len(mine)
    assert row["suma_x"] == sum(r[4] for r in mine)
    assert row["varia_a"] is True and row["varia_c"] is False


def test_repeated_crosses_keep_every_combination(df, data):
    got = profiling.repeated_crosses(df, ["k", "a"], ["x"]).collect()
    keys = Counter((r[0], r[1]) for r in data)
    detail = Counter((r[0], r[1], r[4]) for r in data)
    want = {d: n for d, n in detail.items() if keys[d[:2]] > 1}
    assert {(r["k"], r["a"], r["x"]): r["filas"] for r in got} == want
    assert all(r["ocurrencias"] == keys[(r["k"], r["a"])] for r in got)


def test_overlap_reports_empty_domains_too(spark, df):
    other = spark.createDataFrame([(" HOT ",), ("zz",), (None,)], "k string")
    pairs = {"k": (df, "k", other, "k"), "c": (df, "c", other, "k")}
    got = {r["par"]: tuple(r)[1:] for r in profiling.domain_overlap(pairs).collect()}
    n = len({r["k"] for r in df.select("k").collect()} - {None})
    assert got["k"] == (n, 2, 1, n - 1, 1)
    assert got["c"] == (0, 2, 0, 0, 2)


def test_quartiles_match_linear_interpolation(df, data):
    row = profiling.quartiles(df, "x").first()
    want = np.percentile([r[4] for r in data], [25, 50, 75])
    assert [row["p25"], row["p50"], row["p75"]] == pytest.approx(list(want))
    empty = profiling.quartiles(df.where("false"), "x").first()
    assert empty["p50"] is None


def test_sample_and_short_codes(df, data):
    sample = profiling.sample_repeated(df, "k", ["x"], 2).collect()
    first = sorted(groups(data))[:2]
    assert Counter(r["k"] for r in sample) == {k: len(groups(data)[k]) for k in first}
    codes = {r["codigo"]: r["n"] for r in profiling.short_codes(df, "k", 3).collect()}
    assert codes == Counter(r[0] for r in data if r[0] is not None and len(r[0]) < 3)


def test_additive_gap(spark):
    rows = [(10.0, 4.0, 6.0), (10.0, 4.0, 5.0), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "t double, a double, b double")
    assert tuple(profiling.additive_gap(df, "t", ["a", "b"], 0.01).first()) == (1, 1.0)


def test_samples_of_sparse_columns_and_of_tied_places(spark, monkeypatch):
    """Columns that are rare at the start, and rows that share the last place of it."""
    monkeypatch.setattr(profiling, "HEAD_ROWS", 20)
    rows = [(i // 6, f"v{-i % 6}{i}", f"s{i}" if i % 9 == 8 else None, None) for i in range(400)]
    df = spark.createDataFrame(rows, "p int, v string, s string, n string").repartition(5)
    got = {(r["columna"], r["puesto"]): r["valor"] for r in profiling.sample_values(df, ["p"], ["v", "s", "n"]).collect()}
    expected = {}
    for i, name in ((1, "v"), (2, "s")):
        first = sorted((r[0], r[i]) for r in rows if r[i] is not None)[:15]
        expected |= {(name, n): value for n, (_, value) in enumerate(first, 1)}
    assert got == expected
